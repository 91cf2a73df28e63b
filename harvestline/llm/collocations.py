"""Phrases whose words occur together more often than their parts would by chance.

Every n-gram is known by a fingerprint: prefix polynomials are summed with numpy, and
the difference of two prefixes is the fingerprint of what lies between (Rabin-Karp);
over bytes this hashes words, over their hashes n-grams. Fingerprints are counted in a
shuffle. Those that are frequent are counted once more, with a pointer to an occurrence
and the range of a second, independent fingerprint, and are read from the text at
their pointer. Where the second fingerprint is not the same for all occurrences, or a
text does not have the fingerprint it was found by, two phrases have collided:
those are counted again by their text.

A phrase can only be frequent if all its parts are. So words are counted first,
then pairs of frequent words, then longer phrases whose pairs are all frequent. What
is frequent goes to the tasks as a bitmap of bounded size (``MOST_BITS``). A bit set by
accident lets too much through, never too little, so the counts are exact whatever
the size.

Cases: a null text is empty, a null lang is ``und``. Rows that are equal in all
columns count each. Ids are not used; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestline.llm.common import Batches, keep, map_arrow

LEAST = 100
LONGEST = 5
TOP = 2000
NO_LANG = "und"
RANKED_AT_ONCE = 50_000  # phrases, all languages together
# Bytes of text at once; longer texts are cut between pieces. A chunk takes about a hundred times
# its size in a worker, and two workers run for each core where two steps share a stage.
CHUNK = 1 << 19
BITS_PER_ITEM = 16
MOST_BITS = 1 << 28  # 32 MB
FULL = 64  # bits of a fingerprint; tests take fewer, so that phrases collide

# White space between words, and marks that end a piece.
SPACES, MARKS = b" \t", b".,;:!?\n\x0b\x0c\r"

_WORD, _SPACE, _MARK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = _SPACE
_KIND[list(MARKS)] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Two independent fingerprints. Bases are odd, so that they have an inverse modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_BYTES = tuple(
    np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64) for seed in (11, 12)
)


@dataclass
class Words:
    """Words of a run of texts, in order."""

    row: np.ndarray  # number of the text
    piece: np.ndarray  # rising number of the piece; n-grams stay within one
    start: np.ndarray  # byte in the text
    hashes: tuple[np.ndarray, ...]  # one or two hashes of each word
    data: np.ndarray  # bytes of all the texts, lower-case
    first: np.ndarray  # where words begin and end in them
    last: np.ndarray

    def spelled(self, at: int, n: int) -> str:
        ends = zip(self.first[at : at + n].tolist(), self.last[at : at + n].tolist(), strict=True)
        return " ".join(self.data[a:b].tobytes().decode() for a, b in ends)


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of texts, the number of the text of each run of bytes, and where runs begin.

    Several texts that fit into a chunk go together; a longer one is cut behind marks.
    """
    bytes_, rows, starts, total = [], [], [], 0
    for row, value in enumerate(column):
        text = value.as_buffer() if value.is_valid else b""
        data = np.frombuffer(text, np.uint8)
        at = 0
        while at < len(data):
            end = min(len(data), at + CHUNK - total)
            if end < len(data):
                back = np.flatnonzero(_KIND[data[max(at, end - 65536) : end]] == _MARK)
                if len(back):
                    end = max(at, end - 65536) + int(back[-1]) + 1
                elif total:
                    end = at  # begin another chunk with it
                else:
                    ahead = end
                    while ahead < len(data):
                        marks = np.flatnonzero(_KIND[data[ahead : ahead + CHUNK]] == _MARK)
                        if len(marks):
                            break
                        ahead += CHUNK
                    end = ahead + int(marks[0]) + 1 if ahead < len(data) else len(data)
            if end > at:
                bytes_.append(data[at:end])
                rows.append(row)
                starts.append(at)
                total += end - at
            if end < len(data) or total >= CHUNK:
                yield np.concatenate(bytes_), np.array(rows), np.array(starts), _lengths(bytes_)
                bytes_, rows, starts, total = [], [], [], 0
            at = end
    if bytes_:
        yield np.concatenate(bytes_), np.array(rows), np.array(starts), _lengths(bytes_)


def _lengths(parts: list[np.ndarray]) -> np.ndarray:
    return np.array([len(p) for p in parts])


def _beginnings(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Kind of every byte, whether it is of a word, and where words begin."""
    kind = _KIND[data]
    word = kind == _WORD
    before = np.append(False, word[:-1])
    before[begins] = False
    return kind, word, np.flatnonzero(word & ~before)


def words_of(column: pa.Array, lanes: int = 2) -> Iterator[Words]:
    """The words of a text column, chunk by chunk; A-Z are lowered, null has none.

    ``lanes``: how many of the two hashes are wanted.
    """
    for data, rows, starts, lengths in _chunks(column.cast(pa.large_binary())):
        begins = np.cumsum(lengths) - lengths
        kind, word, first = _beginnings(data, begins)
        if not len(first):
            continue
        run = np.searchsorted(begins, first, "right") - 1
        after = np.append(word[1:], False)
        after[begins[1:] - 1] = False
        last = np.flatnonzero(word & ~after) + 1
        lowered = _LOWER[data]
        yield Words(
            rows[run],
            # Pieces end at marks and texts; both numbers rise, so their sum tells pieces apart.
            np.cumsum(kind == _MARK)[first] + run,
            first - begins[run] + starts[run],
            tuple(
                between(prefix_polynomial(table[lowered], base), base, first, last, last - first)
                for table, base in zip(_BYTES[:lanes], _BASES, strict=False)
            ),
            lowered,
            first,
            last,
        )


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < count:
        size = max(count, 1 << 16)
        held = tuple(
            np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)))
            for b in (base, pow(base, -1, 1 << 64))
        )
        _POWERS[base] = held
    return held[0][:count], held[1][:count]


def mixed(values: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """Numbers with all bits stirred; polynomials modulo a power of two have weak low ones."""
    odd = np.atleast_1d(np.asarray(salt, np.uint64)) | np.uint64(1)
    x = values + odd * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def prefix_polynomial(hashes: np.ndarray, base: int) -> np.ndarray:
    """Sums of hash times power of the base, over all words before each place."""
    return np.append(np.uint64(0), np.cumsum(hashes * powers(base, len(hashes))[0]))


def between(
    prefix: np.ndarray, base: int, first: np.ndarray, last: np.ndarray, salt: np.ndarray
) -> np.ndarray:
    """Fingerprints of what lies between two places; they do not depend on the place."""
    inverse = powers(base, len(prefix))[1]
    return mixed((prefix[last] - prefix[first]) * inverse[first], salt)


def salts(langs: list[str]) -> np.ndarray:
    made = [xxhash.xxh64_intdigest(lang) for lang in langs]
    return np.array(made, np.uint64) if made else np.empty(0, np.uint64)


def fingerprints(
    phrases: list[str], sizes: np.ndarray, langs: list[str], bits: int = FULL
) -> tuple[np.ndarray, np.ndarray]:
    """Both fingerprints of phrases of so many words, as they are found in a text."""
    key, check = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
    for words in words_of(pa.array(phrases, pa.string())):
        made = Grams(words, langs, bits)
        first = np.flatnonzero(np.append(True, words.row[1:] != words.row[:-1]))
        row = words.row[first]
        for n in np.unique(sizes[row]):
            mine = sizes[row] == n
            key[row[mine]] = made.key(first[mine], int(n))
            check[row[mine]] = made.check(first[mine], int(n))
    return key, check


class Grams:
    """Fingerprints of the n-grams of a chunk."""

    def __init__(self, words: Words, langs: list[str], bits: int):
        self.words, self.shift = words, np.uint64(FULL - bits)
        self.salt = salts(langs)[words.row]
        self.prefix = [prefix_polynomial(h, b) for h, b in zip(words.hashes, _BASES, strict=False)]

    def starts(self, n: int) -> np.ndarray:
        """Words that begin n words of one piece."""
        piece = self.words.piece
        if n > len(piece):
            return np.empty(0, np.int64)
        return np.flatnonzero(piece[: len(piece) - n + 1] == piece[n - 1 :])

    def key(self, at: np.ndarray, n: int) -> np.ndarray:
        return (self._gram(0, at, n) >> self.shift).view(np.int64)

    def check(self, at: np.ndarray, n: int) -> np.ndarray:
        return self._gram(1, at, n).view(np.int64)

    def _gram(self, k: int, at: np.ndarray, n: int) -> np.ndarray:
        # The salt tells languages apart.
        return between(self.prefix[k], _BASES[k], at, at + n, self.salt[at] + np.uint64(2 * n))


def bit_places(keys: np.ndarray, bits: int) -> np.ndarray:
    return mixed(keys.view(np.uint64), 7) & np.uint64(bits - 1)


def bitmap(spark: SparkSession, keys: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits of the ``key`` column: ``BITS_PER_ITEM`` or more a key, ``most_bits`` in all.

    Set in tasks and sent as blocks, so the driver sees the bitmap and no keys.
    """
    count = keys.count()
    bits = 1 << min(
        int(math.log2(most_bits)), max(16, math.ceil(math.log2(BITS_PER_ITEM * max(1, count))))
    )
    block = 1 << 16  # bits

    def places(batches: Batches) -> Batches:
        for batch in batches:
            at = bit_places(batch.column(0).to_numpy(), bits).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at // block), pa.array(at % block, pa.int64())], ["block", "bit"]
            )

    def fill(batches: Batches) -> Batches:
        for batch in batches:
            packed = []
            for places in batch.column(1):
                filled = np.zeros(block, np.uint8)
                filled[places.values.to_numpy()] = 1
                packed.append(np.packbits(filled).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], ["block", "bytes"]
            )

    placed = map_arrow(keys.select("key"), places, "block long, bit long")
    # A block is a set of at most 65,536 numbers.
    sets = placed.groupBy("block").agg(F.collect_set("bit").alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    filled = map_arrow(sets.repartition("block"), fill, "block long, bytes binary")
    for row in filled.toLocalIterator():
        at = row["block"] * block // 8
        out[at : at + block // 8] = np.frombuffer(row["bytes"], np.uint8)
    return out


def held(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = bit_places(keys, 8 * len(bits))
    shift = 7 - (at & np.uint64(7)).astype(np.uint8)
    return bits[(at >> np.uint64(3)).view(np.int64)] >> shift & 1 == 1


# --- counting fingerprints --------------------------------------------------------

COUNTS = "n int, key long, total long, low long, high long, pointer long"
DOC_BITS = 32  # of a pointer; the rest is the byte in the text


def texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``doc``, ``lang``, ``text``; equal rows have one number, and serve each other's pointers.

    A number has ``DOC_BITS`` bits only, so a pointer is one long, which hash aggregates can
    hold. Different texts may share it: at the pointer, the fingerprint tells them apart.
    """
    made = docs.select(
        F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    doc = F.shiftright(F.xxhash64("text", "lang"), 64 - DOC_BITS)
    return made.select(doc.alias("doc"), "lang", "text")


def summed(n: int, key: np.ndarray, check: np.ndarray, pointer: np.ndarray):
    """A row for each different key: its count, the range of checks, the least pointer."""
    order = np.argsort(key)
    sorted_ = key[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(key) else order
    if not len(first):
        return None
    checks = check[order]
    columns = [
        np.full(len(first), n, np.int32),
        sorted_[first],
        np.diff(np.append(first, len(order))),
        np.minimum.reduceat(checks, first),
        np.maximum.reduceat(checks, first),
        np.minimum.reduceat(pointer[order], first),
    ]
    names = [c.split()[0] for c in COUNTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def frequent_keys(
    rows: DataFrame, lengths: range, frequent: np.ndarray | None, inner: int, least: int, bits: int
) -> DataFrame:
    """``key`` of n-grams that occur ``least`` times; all their parts of ``inner`` words are in
    the bitmap, if there is one.

    These rows are nearly as many as the words of the corpus, so they hold a key and a
    count only. Keys that collide count together, which lets too many through.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for words in words_of(batch.column(2), lanes=1):
                made = Grams(words, langs, bits)
                good = np.ones(len(words.row), bool)
                if shared.value is not None:
                    at = made.starts(inner)
                    good[:] = False
                    good[at] = held(made.key(at, inner), shared.value)
                for n in lengths:
                    at = with_parts(made.starts(n), good, n - inner + 1)
                    key, total = np.unique(made.key(at, n), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(total)], ["key", "total"]
                    )

    counts = map_arrow(rows, emit, "key long, total long").groupBy("key")
    return counts.agg(F.sum("total").alias("total")).where(F.col("total") >= least).select("key")


def with_parts(at: np.ndarray, good: np.ndarray, parts: int) -> np.ndarray:
    """Of the places, those where so many parts in a row are good."""
    for k in range(parts):
        at = at[good[at + k]]
    return at


def count_grams(rows: DataFrame, frequent: np.ndarray, longest: int, bits: int) -> DataFrame:
    """Counts of the n-grams whose fingerprints are in the bitmap.

    And the words of each language: as n = 0, with the salt of the language for a key.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            doc = batch.column(0).to_numpy() << (64 - DOC_BITS)
            langs = batch.column(1).to_pylist()
            for words in words_of(batch.column(2)):
                made = Grams(words, langs, bits)
                pointer = doc[words.row] + words.start
                salt = made.salt.view(np.int64)
                yield summed(0, salt, salt, pointer)
                good = held(made.key(made.starts(1), 1), shared.value)
                for n in range(1, longest + 1):
                    at = with_parts(made.starts(n), good, n)
                    key = made.key(at, n)
                    inside = held(key, shared.value)
                    at, key = at[inside], key[inside]
                    out = summed(n, key, made.check(at, n), pointer[at])
                    if out is not None:
                        yield out

    return (
        map_arrow(rows, emit, COUNTS)
        .groupBy("n", "key")
        .agg(
            F.sum("total").alias("total"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.min("pointer").alias("pointer"),
        )
    )


def collided() -> Column:
    return F.col("low") != F.col("high")


# --- reading phrases at their pointers --------------------------------------------


def read_phrases(rows: DataFrame, counted: DataFrame, bits: int) -> DataFrame:
    """``n``, ``key``, ``lang``, ``phrase``, ``total``, read at the pointers and checked.

    Pointers are the smallest of all occurrences, so they meet in few documents, and only
    those are shuffled. What has another fingerprint than its pointer says is left out.
    """
    offset = 64 - DOC_BITS
    start = F.col("pointer").bitwiseAND(F.lit((1 << offset) - 1))
    wanted = keep(
        counted.groupBy(F.shiftright("pointer", offset).alias("doc")).agg(
            F.collect_list(F.struct("n", "key", "low", "total", start.alias("start"))).alias("wanted")
        ),
        "pointers",
    )
    inside = bitmap(rows.sparkSession, wanted.select(F.col("doc").alias("key")))
    shared = rows.sparkSession.sparkContext.broadcast(inside)

    def only(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array(held(batch.column(0).to_numpy(), shared.value)))

    found = map_arrow(rows, only, rows.schema).dropDuplicates()
    # A text has no more phrases than its words times their lengths.
    met = found.join(wanted, "doc").select("lang", "text", "wanted")

    def read(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for lang, text, pointers in zip(
                batch.column(0).to_pylist(),
                batch.column(1).cast(pa.large_binary()),
                batch.column(2).to_pylist(),
                strict=True,
            ):
                for p in pointers:
                    words = phrase_at(text.as_buffer(), p["start"], p["n"])
                    if words is not None:
                        out.append((p["n"], p["key"], lang, words, p["total"], p["low"]))
            columns = [list(c) for c in zip(*out, strict=True)] or [[]] * 6
            sizes, low = np.array(columns[0], np.int64), np.array(columns[5], np.int64)
            key, check = fingerprints(columns[3], sizes, columns[2], bits)
            own = salts(columns[2]).view(np.int64)
            key, check = np.where(sizes == 0, own, key), np.where(sizes == 0, own, check)
            same = (key == np.array(columns[1], np.int64)) & (check == low)
            kinds = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns[:5], kinds, strict=True)],
                ["n", "key", "lang", "phrase", "total"],
            ).filter(pa.array(same, pa.bool_()))

    return map_arrow(
        met, read, "n int, key long, lang string, phrase string, total long"
    ).dropDuplicates(["n", "key"])


def phrase_at(text: memoryview, start: int, n: int) -> str | None:
    """The n words that begin at a byte of a text, lower-case and with blanks between."""
    size = 64 * n
    while True:
        data = np.frombuffer(text, np.uint8)[start : start + size]
        word = _KIND[data] == _WORD
        first = np.flatnonzero(word & ~np.append(False, word[:-1]))
        last = np.flatnonzero(~word & np.append(False, word[:-1]))
        if len(last) >= n or start + size >= len(text):
            break
        size *= 4
    if len(first) < n:
        return None
    last = np.append(last, len(data))[:n]
    lowered = _LOWER[data].tobytes()
    words = [lowered[a:b] for a, b in zip(first[:n].tolist(), last.tolist(), strict=True)]
    try:
        return b" ".join(words).decode()
    except UnicodeDecodeError:  # a pointer meant for another text
        return None


def count_by_text(rows: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """``n``, ``lang``, ``phrase``, ``total`` of the phrases whose fingerprints are ``wanted``.

    The way for fingerprints that stand for more than one phrase: their occurrences are
    spelled out and counted as text.
    """
    lengths = [r["n"] for r in wanted.select("n").distinct().collect()]
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(rows.sparkSession, wanted))

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for words in words_of(batch.column(2)):
                made = Grams(words, langs, bits)
                for n in lengths:
                    at = made.starts(n)
                    key = made.key(at, n)
                    inside = held(key, shared.value)
                    at, key = at[inside], key[inside]
                    phrase = [words.spelled(a, n) for a in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), n, np.int32)),
                            pa.array(key),
                            pa.array([langs[r] for r in words.row[at].tolist()], pa.string()),
                            pa.array(phrase, pa.string()),
                        ],
                        ["n", "key", "lang", "phrase"],
                    )

    each = map_arrow(rows, emit, "n int, key long, lang string, phrase string")
    counts = each.groupBy("n", "key", "lang", "phrase").agg(F.count("*").alias("total"))
    return counts.join(wanted.select("n", "key"), ["n", "key"]).select("n", "lang", "phrase", "total")


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    bits: int = FULL,
) -> tuple[DataFrame, DataFrame]:
    """``n``, ``lang``, ``phrase``, ``total`` of all phrases and words with ``least`` occurrences.

    And ``lang``, ``words``: how many words a language has.
    """
    spark = docs.sparkSession
    rows = texts(docs, text_col, lang_col)
    often = F.col("total") >= least
    levels = [keep(frequent_keys(rows, range(1, 2), None, 1, least, bits), "words")]
    inner = 1
    for lengths in (range(2, 3), range(3, longest + 1)):
        if lengths and lengths[0] <= longest:
            known = bitmap(spark, levels[-1])
            found = frequent_keys(rows, lengths, known, inner, least, bits)
            levels.append(keep(found, "phrases"))
            inner = lengths[0]
    every = bitmap(spark, functools.reduce(DataFrame.unionByName, levels))
    counted = keep(
        count_grams(rows, every, longest, bits).where(often | (F.col("n") == 0)), "counted"
    )
    read = keep(read_phrases(rows, counted.where(~collided()), bits), "read-phrases")
    good = read.select("n", "lang", "phrase", "total")
    bad = keep(
        counted.select("n", "key").join(read.select("n", "key"), ["n", "key"], "left_anti"),
        "collided",
    )
    if not bad.isEmpty():
        again = count_by_text(rows, bad.where("n > 0"), bits).where(often)
        good = keep(good.unionByName(again), "all-phrases")
    totals = good.where("n = 0").select("lang", F.col("total").alias("words"))
    return good.where("n > 0"), totals


# --- scores ------------------------------------------------------------------------


def _parts(phrase: Column, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def score() -> Column:
    """floor(1000 a n / (l r)) in decimals, whose products have room for 38 digits."""
    return F.expr(
        "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(16,0)))"
        " div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
    )


def inside_longer(phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``most``: phrases within a longer frequent one, and its count at most."""
    lengths = F.expr("sequence(2, n - 1)")
    starts = F.expr("sequence(1, n - m + 1)")
    return (
        phrases.where(F.col("n") > 2)
        .withColumn("m", F.explode(lengths))
        .withColumn("at", F.explode(starts))
        .select("lang", _parts(F.col("phrase"), F.col("at"), F.col("m")).alias("phrase"), "total")
        .groupBy("lang", "phrase")
        .agg(F.max("total").alias("most"))
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    bits: int = FULL,
) -> DataFrame:
    """The ``top`` phrases of every language, by the score of their weakest cut.

    lang, rank, phrase, a (occurrences), l, r (those of the parts), n (words of the
    language) and score. A phrase within a longer one that occurs as often is left out.
    """
    found, totals = frequent_phrases(docs, text_col, lang_col, least, longest, bits)
    phrases = keep(found.where(F.col("n") > 1), "candidates")
    size = F.col("n")
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, n - 1)"))).select(
        "lang",
        "phrase",
        F.col("total").alias("a"),
        "k",
        _parts(F.col("phrase"), F.lit(1), F.col("k")).alias("left"),
        _parts(F.col("phrase"), F.col("k") + 1, size - F.col("k")).alias("right"),
    )
    parts = found.select("lang", "phrase", "total")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("total").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("total").alias("r"))
    scored = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(totals.withColumnRenamed("words", "n"), "lang")
        .withColumn("score", score())
    )
    weakest = (
        scored.groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    within = inside_longer(phrases)
    left_over = (
        weakest.join(within, ["lang", "phrase"], "left")
        .where(F.col("most").isNull() | (100 * F.col("most") < 100 * F.col("a")))
        .drop("most")
    )
    # A language may have any number of phrases: each part hands on its first ones.
    parts = phrases.count() // RANKED_AT_ONCE + 1
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts)).alias("part")
    within_part = Window.partitionBy("lang", "part").orderBy(*order)
    first = (
        left_over.select("*", part)
        .withColumn("rank", F.row_number().over(within_part))
        .where(F.col("rank") <= top)
    )
    return (
        first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
    )
