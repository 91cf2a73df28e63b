"""Training documents that hold copies of benchmark items, edited ones too.

Word n-grams of the items are seeds. One pass over the documents looks every
n-gram up in a bitmap of seed hashes, whose size is fixed, so nothing that grows
with the corpus or the benchmark is sent to all tasks; what hits is counted, and the ``SEEDS`` rarest n-grams of each item are
joined by hash: the rarest it has, however frequent, so a passage that leaked into very
many documents is still looked for. A document and an item are a candidate pair if they
share a rare seed or a quarter of the item's seeds, two at least: one common phrase is no
evidence. Rare is an n-gram in at most ``RARE_SHARE`` of the documents. One seed is also
enough if the item has no other, or is so short that one can reach the similarity asked
for.

Around the seeds of a pair the Smith-Waterman score of the item against the
document's words is computed. A pair is reported if the score is at least
``MIN_SIMILARITY`` of what the unchanged item would get.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from harvestline.llm.common import Batches, keep, map_arrow, text_bytes

WORDS = 3  # words of a seed
SEEDS = 32  # n-grams of an item that are joined
RARE_SHARE = 1e-3
MIN_SIMILARITY = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
SALTS = 8  # parts of the hits of an n-gram
BITS = 26  # the bitmap has 2**BITS bits, 8 MB
KEY_SEED = 42
_SPACES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def words(text: str) -> list[bytes]:
    """Lower-case words; all ASCII other than letters and digits parts them."""
    return text.lower().encode().translate(_SPACES).split()


def codes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found))


def grams(code: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams, as many as words less two."""
    if len(code) < WORDS:
        return np.empty(0, dtype=np.uint64)
    wide = code.astype(np.uint64) + np.uint64(1)
    count = len(code) - WORDS + 1
    mixed = sum(wide[i : i + count] * _FACTORS[i] for i in range(WORDS))
    return (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[0]


def seeds_of(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_key``, ``gram``, ``at``: the n-grams of the items, with their places."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                made = grams(codes(words(text or ""))).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(item, len(made)), pa.array(made), pa.array(np.arange(len(made)))],
                    ["item_key", "gram", "at"],
                )

    kind = bench.schema[id_col].dataType.simpleString()
    return map_arrow(bench.select(id_col, text_col), rows, f"item_key {kind}, gram long, at long")


def bitmap(hashes: DataFrame, name: str) -> np.ndarray:
    """Bits of all hashes, as bytes; gathered by 64-bit word, 2**(BITS - 6) at most."""
    place = hashes.select(F.shiftrightunsigned(name, 64 - BITS).alias("p"))
    by_word = (
        place.groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
        .toArrow()
    )
    bits = np.zeros(1 << (BITS - 6), dtype=np.int64)
    bits[by_word["w"].to_numpy()] = by_word["b"].to_numpy()
    return bits.view(np.uint8)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the (unsigned) hashes that are in the bitmap."""
    place = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)


def keyed_texts(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``text``, ``doc_key`` of the documents whose key may be among ``keys``.

    Looked up in a bitmap of fixed size, so that only they are shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(keys, "doc_key"))

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            made = [xxhash.xxh64_intdigest(t, KEY_SEED) for t in text_bytes(batch.column(1))]
            key = np.array(made, dtype=np.uint64)
            where = pa.array(in_bitmap(shared.value, key))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(where) for c in batch.columns), pa.array(key.view(np.int64)).take(where)],
                ["_id", "text", "doc_key"],
            )

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    schema = StructType([*texts.schema.fields, StructField("doc_key", LongType())])
    return map_arrow(texts, rows, schema)


HITS = ArrayType(
    StructType([StructField("pos", IntegerType()), StructField("gram", LongType())])
)


def seed_hits(docs: DataFrame, bits: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``doc_key``, ``hits`` of the documents with an n-gram in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            ids, keys, pos, gram, ends = [], [], [], [], [0]
            for k, raw in enumerate(text_bytes(batch.column(1))):
                made = grams(codes(words(raw.decode())))
                hit = in_bitmap(shared.value, made)
                if len(hit):
                    ids.append(k)
                    keys.append(xxhash.xxh64_intdigest(raw, KEY_SEED))
                    pos.append(hit.astype(np.int32))
                    gram.append(made[hit].view(np.int64))
                    ends.append(ends[-1] + len(hit))
            if ids:
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(pos)), pa.array(np.concatenate(gram))],
                    ["pos", "gram"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(ids)),
                        pa.array(np.array(keys, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    ],
                    ["doc_id", "doc_key", "hits"],
                )

    schema = StructType(
        [
            StructField("doc_id", docs.schema[id_col].dataType),
            StructField("doc_key", LongType()),
            StructField("hits", HITS),
        ]
    )
    return map_arrow(docs.select(id_col, text_col), rows, schema)


def windows(shifts: list[int], item_words: int, doc_words: int) -> list[tuple[int, int]]:
    """Stretches of the document around where its seeds place the item."""
    slack = item_words // 2 + 5
    merged: list[list[int]] = []
    for start in sorted(shifts):
        low, high = max(0, start - slack), min(doc_words, start + item_words + slack)
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    return [(a, b) for a, b in merged]


def align(item: np.ndarray, stretches: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman score of the item's words against each stretch."""
    longest = max(map(len, stretches))
    text = np.full((len(stretches), longest), -1, dtype=np.int64)
    for row, stretch in zip(text, stretches, strict=True):
        row[: len(stretch)] = stretch
    slope = GAP * np.arange(longest, dtype=np.int32)
    above = np.zeros((len(stretches), longest + 1), dtype=np.int32)
    best = np.zeros(len(stretches), dtype=np.int32)
    for word in item.astype(np.int64):
        step = above[:, :-1] + np.where(text == word, MATCH, MISMATCH).astype(np.int32)
        step = np.maximum(np.maximum(step, above[:, 1:] + GAP), 0)
        above[:, 1:] = np.maximum.accumulate(step - slope, axis=1) + slope
        best = np.maximum(best, above.max(axis=1))
    return best


ALIGN_CELLS = 1 << 21  # of the stretches aligned at once


def _scored(jobs: list[tuple[int, object, np.ndarray, np.ndarray]]):
    """Best score by (row, item) of jobs of one item each: row, item, words, stretch."""
    best: dict[tuple[int, object], tuple[int, int]] = {}
    by_item = defaultdict(list)
    for row, item, code, stretch in jobs:
        by_item[item].append((row, code, stretch))
    for item, own in by_item.items():
        own.sort(key=lambda x: len(x[2]))
        while own:
            count = max(1, ALIGN_CELLS // len(own[-1][2]))
            part, own = own[-count:], own[:-count]
            for (row, code, _), score in zip(
                part, align(part[0][1], [s for _, _, s in part]), strict=True
            ):
                most = best.get((row, item), (0, 0))[0]
                best[row, item] = (max(most, int(score)), len(code))
    return best


def leaks(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` with ``score`` and ``similarity``; ``doc_key`` tells the text.

    ``similarity`` is the score over that of the unchanged item. Rows with equal
    ids and texts are one document here. Null texts count as empty; documents and
    items of fewer than three words are in no pair. A null id is carried as null.
    Each different text of an item id, null too, is looked for; a pair has the best
    score over the texts of its id.
    """
    item_id, item_text = F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text")
    items = bench.select(item_id, item_text).distinct().withColumn(
        "item_key", F.sha2(F.to_json(F.struct("item_id", "item_text")), 256)
    )
    items = keep(items, "items")
    seeds = keep(seeds_of(items, "item_key", "item_text"), "seeds")
    hits = keep(seed_hits(docs, bitmap(seeds, "gram"), id_col, text_col), "seed-hits")
    flat = hits.select("doc_id", "doc_key", F.explode("hits").alias("h")).select(
        "doc_id", "doc_key", "h.pos", "h.gram"
    )
    spread = (
        flat.select("doc_id", "doc_key", "gram").distinct().groupBy("gram").agg(F.count("*").alias("df"))
    )
    sizes = seeds.groupBy("item_key").agg(
        F.count_distinct("gram").alias("of"), (F.count("*") + WORDS - 1).alias("words")
    )
    short = F.col("words") * min_similarity <= WORDS
    quarter = F.ceil(F.least("of", F.lit(SEEDS)) / 4)
    enough = F.greatest(F.least("of", F.lit(2)), quarter)
    sizes = sizes.select("item_key", F.when(short, 1).otherwise(enough).alias("enough"))
    # A window holds the n-grams of one item, that of an item in several places once.
    rarest = Window.partitionBy("item_key").orderBy("df", "gram")
    counted = seeds.join(spread, "gram").withColumn("rank", F.dense_rank().over(rarest))
    chosen = counted.where(F.col("rank") <= SEEDS).drop("rank")
    rare = keep(chosen.join(sizes, "item_key"), "seed-counts")
    n_docs = docs.count()
    # A passage in very many documents has its n-grams there too: they are dealt out.
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    dealt = flat.withColumn("salt", F.pmod(F.xxhash64("doc_key"), F.lit(SALTS)).cast("int"))
    shared = dealt.join(rare.withColumn("salt", F.explode(salts)), ["gram", "salt"])
    candidates = (
        shared.groupBy("doc_id", "doc_key", "item_key")
        .agg(
            F.collect_set(F.col("pos") - F.col("at")).alias("shifts"),
            F.count_distinct("gram").alias("grams"),
            F.min("df").alias("df"),
            F.min("enough").alias("enough"),
        )
        .where(
            (F.col("grams") >= F.col("enough"))
            | (F.col("df") <= RARE_SHARE * n_docs + 1)
        )
        .select("doc_id", "doc_key", "item_key", "shifts")
    )
    candidates = keep(candidates, "candidates")
    told = candidates.join(items, "item_key").groupBy("doc_id", "doc_key").agg(
        F.collect_list(F.struct("item_id", "item_text", "shifts", "item_key")).alias("items")
    )
    told = keep(told, "told")
    texts = keyed_texts(docs, told, id_col, text_col)
    same = (texts["doc_key"] == told["doc_key"]) & texts["_id"].eqNullSafe(told["doc_id"])
    rows = texts.join(told, same).select("doc_id", told["doc_key"], "text", "items")
    kinds = {"doc": docs.schema[id_col].dataType, "item": bench.schema[item_col].dataType}
    schema = (
        f"doc_id {kinds['doc'].simpleString()}, doc_key long, "
        f"item_id {kinds['item'].simpleString()}, score long, similarity double"
    )
    found = map_arrow(rows, _aligner(min_similarity), schema)
    best = found.groupBy("doc_id", "doc_key", "item_id").agg(
        F.max(F.struct("similarity", "score")).alias("best")
    )
    return best.select("doc_id", "doc_key", "item_id", "best.score", "best.similarity")


def _aligner(min_similarity: float):
    def rows(batches: Batches) -> Batches:
        for batch in batches:
            jobs, ids = [], {}
            texts = batch.column(2)
            for k, told in enumerate(batch.column(3).to_pylist()):
                code = codes(words(texts[k].as_py() or ""))
                for item in told:
                    own = codes(words(item["item_text"] or ""))
                    for low, high in windows(item["shifts"], len(own), len(code)):
                        jobs.append((k, item["item_key"], own, code[low:high].copy()))
                    ids[item["item_key"]] = item["item_id"]
            found = [
                (k, ids[item], score, score / (MATCH * size))
                for (k, item), (score, size) in _scored(jobs).items()
                if score >= min_similarity * MATCH * size
            ]
            where = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(where),
                    batch.column(1).take(where),
                    pa.array([f[1] for f in found], batch.schema.field(3).type.value_type[0].type),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.float64()),
                ],
                ["doc_id", "doc_key", "item_id", "score", "similarity"],
            )

    return rows


def drop_leaks(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """``docs`` less the rows that hold a copy of a benchmark item, all columns kept."""
    found = leaks(docs, bench, id_col, text_col, **how).select("doc_id", "doc_key").distinct()
    found = keep(found, "leaks")
    key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = (key == found["doc_key"]) & docs[id_col].eqNullSafe(found["doc_id"])
    return docs.join(found, same, "left_anti")
