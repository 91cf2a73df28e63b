"""Near-duplicates by SimHash fingerprints, compared exactly tile by tile.

A fingerprint bit is set if more than half of the hashes of a text's word
shingles have it. Fingerprints that differ in at most ``radius`` bits are linked.

Fingerprints with the same population counts in each of four 16-bit parts form a
tile. The counts of two fingerprints differ in sum by at most the number of
differing bits, so tile pairs whose counts differ by more than the radius are
skipped, and all others are compared whole with exclusive-or and bit counts. The
number of tiles is fixed (17 to the power 4); large tiles are cut into chunks.
Work still grows with the square of the number of different fingerprints, by
about a hundredth of all pairs.

``keep_one_similar`` links by Jaccard similarity of shingle sets. Texts of
similarity 0.8 differ in about a seventh of the bits, where 64 bits do not tell
them from strangers, so a set has ``WIDE`` of them. Sets are tiled by their size:
similar ones differ in size by a quarter at most. Chunks of near tiles are compared
whole, by the first word of the fingerprints, then by all; what is within the radius
is verified exactly on the shingle sets before it is linked.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from harvestline.llm.common import Batches, appended, keep, map_arrow, text_bytes, with_columns, without
from harvestline.llm.graph import Forest, components

WORDS = 3
RADIUS = 2
SEED = 42
PARTS = 4
LEVELS = 64 // PARTS + 1
CHUNK = 1024  # fingerprints compared with as many at once
SLAB = 1 << 16  # shingles hashed before their bits are counted
SIMILARITY = 0.8
WIDE = 4  # words of 64 bits in the fingerprint of a set
FIRST_RADIUS, WIDE_RADIUS = 24, 72  # five deviations above what is expected at SIMILARITY
LEAST_SHINGLES = 4  # smaller sets are similar only if they are equal
FINGERPRINT = "fingerprint"
COMPONENT = "component_id"


def shingle_hashes(text: bytes, words: int = WORDS) -> Iterator[int]:
    """XXH64 of every run of ``words`` words; a shorter text is one run."""
    found = text.lower().split()
    joined = b" ".join(found)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    hashed = xxhash.xxh64_intdigest
    if len(found) <= words:
        if found:
            yield hashed(joined, SEED)
        return
    for start, end in zip(starts, ends[words - 1 :], strict=False):
        yield hashed(joined[start : end - 1], SEED)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Fingerprint as a signed 64-bit number; 0 for a text without words."""
    total, ones = 0, np.zeros(64, dtype=np.int64)
    hashes = shingle_hashes(text, words)
    while slab := list(itertools.islice(hashes, SLAB)):
        octets = np.array(slab, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(slab)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def add_fingerprint(
    docs: DataFrame, text_col: str = "text", out: str = FINGERPRINT, words: int = WORDS
) -> DataFrame:
    """``docs`` with a fingerprint (long); a column of that name is replaced.

    A null text counts as empty. Repeated rows each get theirs.
    """
    docs = without(docs, out)
    place = docs.columns.index(text_col)

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            made = [fingerprint(t, words) for t in text_bytes(batch.column(place))]
            yield with_columns(batch, **{out: pa.array(made, pa.int64())})

    return map_arrow(docs, rows, appended(docs, StructField(out, LongType())))


def _part(fp: Column, i: int) -> Column:
    width = 64 // PARTS
    return F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1)))


def tile_of(fp: Column) -> Column:
    """Number of the tile: the population counts of the parts as digits."""
    code = F.lit(0)
    for i in range(PARTS):
        code = code * LEVELS + _part(fp, i)
    return code


def _near_tiles(radius: int) -> list[tuple[int, ...]]:
    """Differences of the counts of two tiles that may hold a link, one of each sign."""
    steps = itertools.product(range(-radius, radius + 1), repeat=PARTS)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * PARTS]


def tiles(distinct: DataFrame) -> DataFrame:
    """Rows of ``tile``, ``chunk``, ``fps``: at most about ``CHUNK`` fingerprints each.

    The tile sizes that are broadcast have at most 17**4 rows.
    """
    placed = distinct.select("fp", tile_of(F.col("fp")).alias("tile"))
    sizes = placed.groupBy("tile").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    return (
        placed.join(F.broadcast(sizes), "tile")
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), "chunks"))
        .groupBy("tile", "chunk")
        .agg(F.collect_list("fp").alias("fps"))
    )


def tile_pairs(tiled: DataFrame, radius: int) -> DataFrame:
    """Pairs of chunks that may hold links, each pair once."""
    digits = [
        F.pmod(F.floor(F.col("tile") / LEVELS**i), F.lit(LEVELS)) for i in reversed(range(PARTS))
    ]
    near = []
    for step in _near_tiles(radius):
        inside = F.lit(True)
        code = F.lit(0)
        for digit, d in zip(digits, step, strict=True):
            inside &= (digit + d).between(0, LEVELS - 1)
            code = code * LEVELS + digit + d
        near.append(F.when(inside, code.cast("int")))
    left = tiled.select(
        F.col("tile").alias("own"),
        F.col("chunk").alias("own_chunk"),
        F.col("fps").alias("a"),
        F.explode(F.array_compact(F.array(*near))).alias("tile"),
    )
    right = tiled.withColumnRenamed("fps", "b")
    once = (F.col("own") != F.col("tile")) | (F.col("own_chunk") <= F.col("chunk"))
    same = (F.col("own") == F.col("tile")) & (F.col("own_chunk") == F.col("chunk"))
    return left.join(right, "tile").where(once).select("a", "b", same.alias("same"))


def linked(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all fingerprints of two chunks that are linked."""
    nodes = np.concatenate([a, b])
    forest = Forest(len(nodes))
    u, v = a.view(np.uint64), b.view(np.uint64)
    rows = max(1, (1 << 18) // max(1, len(v)))
    for start in range(0, len(u), rows):
        apart = np.bitwise_count(u[start : start + rows, None] ^ v[None, :])
        i, j = np.nonzero(apart <= radius)
        i += start
        if same:
            i, j = i[i < j], j[i < j]
            forest.link(i, j)
        else:
            forest.link(i, j + len(a))
    node, root = forest.edges()
    return nodes[node], nodes[root]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` among the different fingerprints ``fp``, enough to join the linked."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for x, y, same in zip(*batch.columns, strict=True):
                first = x.values.to_numpy(zero_copy_only=False)
                second = y.values.to_numpy(zero_copy_only=False)
                found.append(linked(first, second, same.as_py(), radius))
            for ends in (
                [np.concatenate(side) for side in zip(*found, strict=True)] if found else [],
            ):
                if ends:
                    yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends], ["a", "b"])

    tiled = keep(tiles(fps), "tiles")
    return map_arrow(tile_pairs(tiled, radius), rows, "a long, b long")


def fingerprint_components(printed: DataFrame, id_col: str, radius: int = RADIUS) -> DataFrame:
    """For every fingerprint the smallest id in its component: ``fingerprint``, ``component_id``."""
    distinct = keep(
        printed.groupBy(F.col(FINGERPRINT).alias("fp")).agg(F.min(id_col).alias("first")),
        "fingerprints",
    )
    roots = keep(components(links(distinct.select("fp"), radius)), "roots")
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    placed = keep(placed, "placed")
    least = keep(placed.groupBy("root").agg(F.min("first").alias(COMPONENT)), "least")
    return keep(
        placed.join(least, "root").select(F.col("fp").alias(FINGERPRINT), COMPONENT), "components"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` and ``component_id``.

    ``component_id`` is the smallest id reachable over links; null ids are passed
    over, so it is null if a component has no other. A null or empty text, or one
    of white space, has fingerprint 0. Rows with equal ids count each. Other
    columns are not carried.
    """
    printed = keep(
        add_fingerprint(docs.select(id_col, text_col), text_col, words=words).drop(text_col),
        "printed",
    )
    return printed.join(fingerprint_components(printed, id_col, radius), FINGERPRINT)


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """``docs`` less near-duplicates: one row of each component, with its columns.

    The row with the smallest id stays, null ids last; of equal ids the one with
    the smaller fingerprint, of repeated rows any one. An empty table stays empty.
    """
    names = docs.columns
    printed = keep(
        add_fingerprint(docs.select(id_col, text_col), text_col, words=words).drop(text_col),
        "printed",
    )
    none, known = F.col(id_col).isNull(), F.coalesce(F.col(id_col), F.lit(0))
    places = printed.select(
        FINGERPRINT, F.struct(none.alias("none"), known.alias("id")).alias("place")
    )
    distinct = keep(
        places.groupBy(F.col(FINGERPRINT).alias("fp")).agg(F.min("place").alias("place")),
        "fingerprints",
    )
    roots = keep(components(links(distinct.select("fp"), radius)), "roots")
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        F.coalesce("component", "fp").alias("root"),
        F.struct("place.none", "place.id", "fp").alias("place"),
    )
    chosen = keep(
        placed.groupBy("root").agg(F.min("place").alias("place")).select("place.*"), "chosen"
    )
    mine = ("_hl_none", "_hl_id", "_hl_fp")
    rows = add_fingerprint(without(docs, *mine), text_col, out="_hl_fp", words=words)
    once = rows.withColumns({"_hl_none": none, "_hl_id": known}).dropDuplicates([*mine])
    wanted = chosen.select(
        F.col("none").alias("_hl_none"), F.col("id").alias("_hl_id"), F.col("fp").alias("_hl_fp")
    )
    return once.join(wanted, [*mine], "left_semi").select(*[f"`{c}`" for c in names])


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The different shingle hashes of a text, in order."""
    return np.unique(np.fromiter(shingle_hashes(text, words), dtype=np.uint64))


def wide_fingerprint(shingles: np.ndarray) -> np.ndarray:
    """``WIDE`` words; a bit is set if more than half of the shingles have it."""
    made = np.zeros(WIDE, dtype=np.uint64)
    ones = np.zeros((WIDE, 64), dtype=np.int64)
    for start in range(0, len(shingles), SLAB):
        mixed = shingles[start : start + SLAB]
        for k in range(WIDE):
            octets = mixed.astype("<u8").view(np.uint8).reshape(-1, 8)
            ones[k] += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            mixed = (mixed + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(31)
            mixed = mixed * np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(29)
    for k in range(WIDE):
        made[k] = np.packbits(2 * ones[k] > len(shingles), bitorder="little").view("<u8")[0]
    return made


def set_key(shingles: np.ndarray) -> int:
    """Signed 64-bit number of a shingle set; equal sets have equal keys."""
    return int(np.array(xxhash.xxh64_intdigest(shingles.tobytes(), SEED), np.uint64).view(np.int64))


def add_sets(docs: DataFrame, text_col: str, words: int, full: bool = False) -> DataFrame:
    """The columns but the text, with ``key`` and ``n`` of the set and its bits or itself."""
    place = docs.columns.index(text_col)
    rest = [f for f in docs.schema.fields if f.name != text_col]

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            keys, sizes, made = [], [], []
            for text in text_bytes(batch.column(place)):
                own = shingle_set(text, words)
                keys.append(set_key(own))
                sizes.append(len(own))
                made.append((own if full else wide_fingerprint(own)).view(np.int64))
            ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *made])
            yield pa.RecordBatch.from_arrays(
                [
                    *(c for i, c in enumerate(batch.columns) if i != place),
                    pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                [*(f.name for f in rest), "key", "n", "bits"],
            )

    schema = StructType([*rest, StructField("key", LongType()), StructField("n", LongType())])
    return map_arrow(docs, rows, schema.add("bits", ArrayType(LongType())))


def set_tiles(sets: DataFrame) -> DataFrame:
    """Rows of ``tile``, ``chunk``, ``members``: sets of near size, cut into chunks."""
    placed = sets.where(F.col("n") >= LEAST_SHINGLES).withColumn(
        "tile", F.floor(F.log(F.col("n")) / F.log(F.lit(1 / SIMILARITY)) - 1e-9).cast("int")
    )
    sizes = placed.groupBy("tile").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    return (
        placed.join(F.broadcast(sizes), "tile")
        .withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks"))
        .groupBy("tile", "chunk")
        .agg(F.collect_list(F.struct("key", "n", "root", "bits")).alias("members"))
    )


def set_tile_pairs(tiled: DataFrame) -> DataFrame:
    """Pairs of chunks of the same tile, of one and the next, or the one after, each once."""
    left = tiled.select(
        F.col("tile").alias("own"),
        F.col("chunk").alias("own_chunk"),
        F.col("members").alias("a"),
        # rounding at an edge may put a ratio of exactly 0.8 two tiles apart
        F.explode(F.array(F.col("tile"), F.col("tile") + 1, F.col("tile") + 2)).alias("tile"),
    )
    right = tiled.withColumnRenamed("members", "b")
    same = (F.col("own") == F.col("tile")) & (F.col("own_chunk") == F.col("chunk"))
    once = (F.col("own") != F.col("tile")) | (F.col("own_chunk") <= F.col("chunk"))
    return left.join(right, "tile").where(once).select("a", "b", same.alias("same"))


def _members(found: pa.Array) -> tuple[np.ndarray, ...]:
    key, n, root, bits = (found.field(i) for i in range(4))
    plain = [c.to_numpy(zero_copy_only=False) for c in (key, n, root)]
    wide = bits.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, WIDE)
    return *plain, np.ascontiguousarray(wide.T)


def near_sets(a: tuple, b: tuple, same: bool, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of pairs within the radius that are not linked yet; or for each of ``a`` the nearest."""
    (key_a, n_a, root_a, bits_a), (key_b, n_b, root_b, bits_b) = a, b
    first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    rows = max(1, (1 << 18) // max(1, len(key_b)))
    for start in range(0, len(key_a), rows):
        apart = np.bitwise_count(bits_a[0, start : start + rows, None] ^ bits_b[0][None, :])
        i, j = np.nonzero(apart <= FIRST_RADIUS)
        i += start
        low, high = np.minimum(n_a[i], n_b[j]), np.maximum(n_a[i], n_b[j])
        open_ = (low >= SIMILARITY * high - 1e-9 * high) & (root_a[i] != root_b[j])
        if same and not nearest:
            open_ &= i < j
        i, j = i[open_], j[open_]
        total = sum(np.bitwise_count(bits_a[k, i] ^ bits_b[k, j]).astype(np.int64) for k in range(WIDE))
        if len(i):
            close = total <= WIDE_RADIUS
            i, j, total = i[close], j[close], total[close]
        if nearest and len(i):
            order = np.lexsort((key_b[j], total, i))
            i, j = i[order], j[order]
            head = np.append(True, i[1:] != i[:-1])
            i, j = i[head], j[head]
        first.append(key_a[i])
        second.append(key_b[j])
    return np.concatenate(first), np.concatenate(second)


def near_pairs(tiled: DataFrame, nearest: bool) -> DataFrame:
    """Candidate pairs ``a`` < ``b`` of keys, each once."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            for x, y, same in zip(*batch.columns, strict=True):
                ends = near_sets(_members(x.values), _members(y.values), same.as_py(), nearest)
                if len(ends[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends], ["a", "b"])

    found = map_arrow(set_tile_pairs(tiled), rows, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have Jaccard similarity of at least ``similarity``."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = (e.values.to_numpy(zero_copy_only=False) for e in (x, y))
                shared = len(np.intersect1d(u, v, assume_unique=True))
                good.append(shared >= similarity * (len(u) + len(v) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], ["a", "b"]
            )

    of = lambda end: sets.select(F.col("key").alias(end), F.col("bits").alias(f"set_{end}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "set_a", "set_b")
    return map_arrow(both, rows, "a long, b long")


def set_components(
    docs: DataFrame, distinct: DataFrame, text_col: str, words: int, similarity: float
) -> DataFrame:
    """``node``, ``component`` of the keys that are linked to a smaller one.

    First each set is verified against the nearest of every chunk, which joins most
    of a large group of copies by few pairs; then all pairs that are not joined.
    """
    edges = None
    labelled = distinct.withColumn("root", F.col("key"))
    for nearest in (True, False):
        tiled = keep(set_tiles(labelled), "set-tiles")
        pairs = keep(near_pairs(tiled, nearest), "near-pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        told = distinct.join(ends, "key", "left_semi").select("key", "place")
        sets = keep(_sets_of(docs, told, text_col, words), "sets")
        found = keep(similar(pairs, sets, similarity), "similar")
        edges = found if edges is None else edges.union(found)
        roots = keep(components(edges), "roots")
        labelled = distinct.join(roots, distinct.key == roots.node, "left").select(
            "key", "n", "place", "bits", F.coalesce("component", "key").alias("root")
        )
    return roots


def _sets_of(docs: DataFrame, told: DataFrame, text_col: str, words: int) -> DataFrame:
    """``key``, ``bits``: the shingle sets of the keys, each from one of its rows.

    Rows are found by id and text: many may have no id, or the same.
    """
    wanted = told.select("place.*", F.col("key").alias("_key"))
    rows = docs.join(wanted, ["none", "id", "text_key"]).select("_key", text_col)
    rows = rows.dropDuplicates(["_key"])
    made = add_sets(rows, text_col, words, full=True).where(F.col("_key") == F.col("key"))
    return made.select("key", "bits").dropDuplicates(["key"])


def keep_one_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``docs`` less near-duplicates by Jaccard similarity of sets of ``words``-word shingles.

    Rows are linked if their similarity is at least ``similarity`` (``SIMILARITY`` or
    more); of each component one row stays, chosen as in ``keep_one`` with the key of
    the set for the fingerprint. Texts without words are equal to one another.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"the radius is made for a similarity of {SIMILARITY} or more")
    names = docs.columns
    none, known = F.col(id_col).isNull(), F.coalesce(F.col(id_col), F.lit(0))
    text_key = F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key")
    placed = docs.select(none.alias("none"), known.alias("id"), text_key, F.col(text_col))
    printed = keep(add_sets(placed, text_col, words), "printed")
    distinct = keep(
        printed.groupBy("key").agg(
            F.min(F.struct("none", "id", "text_key")).alias("place"),
            F.min("n").alias("n"),
            F.min("bits").alias("bits"),
        ),
        "fingerprints",
    )
    roots = set_components(placed, distinct, text_col, words, similarity)
    chosen = keep(
        distinct.join(roots, distinct.key == roots.node, "left")
        .groupBy(F.coalesce("component", "key").alias("root"))
        .agg(F.min(F.struct("place.none", "place.id", "key")).alias("place"))
        .select("place.*"),
        "chosen",
    )
    mine = ("_hl_none", "_hl_id", "_hl_key")
    rows = _with_key(without(docs, *mine), text_col, words)
    once = rows.withColumns({"_hl_none": none, "_hl_id": known}).dropDuplicates([*mine])
    wanted = chosen.select(
        F.col("none").alias("_hl_none"), F.col("id").alias("_hl_id"), F.col("key").alias("_hl_key")
    )
    return once.join(wanted, [*mine], "left_semi").select(*[f"`{c}`" for c in names])


def _with_key(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    place = docs.columns.index(text_col)

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            made = [set_key(shingle_set(t, words)) for t in text_bytes(batch.column(place))]
            yield with_columns(batch, _hl_key=pa.array(made, pa.int64()))

    return map_arrow(docs, rows, appended(docs, StructField("_hl_key", LongType())))
