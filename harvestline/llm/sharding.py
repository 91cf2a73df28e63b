"""Shards of near equal bytes by sampled splitters.

Rows are ordered by a key: a digest of the text, then the id, so equal texts lie
side by side, in one shard unless they fill more than one. Keys are drawn with a
probability in proportion to their row's size, and quantiles of the sample part
the rows into ranges. Ranges that turn out to hold more than twice their share
of bytes or rows are sampled again and subdivided. Every range is then sorted by
itself; with the exact totals of the ranges before it, each row knows the bytes
and rows before it in all, which gives its shard and its place there.

Splitters and range totals pass through the driver: there are a fixed number a
shard, or one for ``RANGE_BYTES`` if that is more.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from harvestline.llm.common import Batches, appended, keep, map_arrow, with_columns, without

SHARDS = 40
ROW_BYTES = 16
RANGES_A_SHARD = 16
RANGE_BYTES = 128 << 20
DRAWS = 16  # sampled keys a range
OVERFULL = 2.0  # times the mean share
ROUNDS = 6
UNIT = 1 << 52
KEY = ("_hl_key", "_hl_id", "_hl_row")
Splitter = tuple[int, int, int]


def text_size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def text_key(text: str) -> Column:
    """First 60 bits of the text's MD5; null counts as empty."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def drawn(chance: Column, seed: int) -> Column:
    """True with the given chance, always alike for one row."""
    return F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(UNIT)) < chance * UNIT


def quantiles(keys: list[Splitter], parts: int) -> list[Splitter]:
    """``parts - 1`` keys that part the sample evenly, fewer if it is small."""
    keys = sorted(keys)
    return sorted({keys[len(keys) * p // parts] for p in range(1, parts)} if keys else ())


def range_of(splitters: list[Splitter], key: np.ndarray, id_: np.ndarray, row: np.ndarray):
    """Number of splitters at or below each key."""
    first = np.array([s[0] for s in splitters], dtype=np.int64)
    low, high = np.searchsorted(first, key, "left"), np.searchsorted(first, key, "right")
    for i in np.flatnonzero(low != high):
        low[i] = bisect_right(splitters, (key[i], id_[i], row[i]), low[i], high[i])
    return low


def add_ranges(df: DataFrame, splitters: list[Splitter], starts: np.ndarray | None = None):
    """``df`` with ``_hl_range``, and the bytes and rows before it if ``starts`` has them."""
    names = ["_hl_range"] if starts is None else ["_hl_range", "_hl_bytes", "_hl_rows"]
    shared = df.sparkSession.sparkContext.broadcast((splitters, starts))

    def rows(batches: Batches) -> Batches:
        held, before = shared.value
        for batch in batches:
            at = range_of(held, *(batch.column(k).to_numpy() for k in KEY))
            made = [at] if before is None else [at, before[0][at], before[1][at]]
            yield with_columns(
                batch, **{n: pa.array(m, pa.int64()) for n, m in zip(names, made, strict=True)}
            )

    return map_arrow(df, rows, appended(df, *[StructField(n, LongType()) for n in names]))


def range_totals(placed: DataFrame, count: int) -> np.ndarray:
    """Bytes and rows of each range, two rows of ``count`` numbers."""
    totals = np.zeros((2, count), dtype=np.int64)
    sums = placed.groupBy("_hl_range").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    for found in sums.toLocalIterator():
        totals[:, found[0]] = found.b, found.n
    return totals


def find_splitters(rows: DataFrame, parts: int, total: int) -> tuple[list[Splitter], np.ndarray]:
    """Splitters of about ``parts`` ranges, and the totals of the ranges."""
    chance = F.col("size") * (parts * DRAWS / max(1, total))
    sample = [tuple(r) for r in rows.where(drawn(chance, 0)).select(*KEY).collect()]
    splitters = quantiles(sample, parts)
    totals = range_totals(add_ranges(rows, splitters), len(splitters) + 1)
    for seed in range(1, ROUNDS):
        share = totals / np.maximum(1, totals.sum(axis=1, keepdims=True) / parts)
        load = np.where(totals[1] > 1, share.max(axis=0), 0)
        over = {int(r): int(np.ceil(load[r])) + 1 for r in np.flatnonzero(load > OVERFULL)}
        if not over:
            break
        # Half of the chance goes by bytes and half by rows, whichever made it overfull.
        each = {
            r: (n * DRAWS / 2 / max(1, int(totals[0][r])), n * DRAWS / 2 / int(totals[1][r]))
            for r, n in over.items()
        }
        rates = rows.sparkSession.createDataFrame(
            [(r, *x) for r, x in each.items()], "_hl_range long, by_byte double, by_row double"
        )
        again = add_ranges(rows, splitters).join(rates, "_hl_range")
        chance = F.col("size") * F.col("by_byte") + F.col("by_row")
        found: dict[int, list[Splitter]] = {}
        for r, *key in again.where(drawn(chance, seed)).select("_hl_range", *KEY).collect():
            found.setdefault(r, []).append(tuple(key))
        more = {s for r, keys in found.items() for s in quantiles(keys, over[r])}
        splitters = sorted({*splitters, *more})
        totals = range_totals(add_ranges(rows, splitters), len(splitters) + 1)
    return splitters, totals


def shard_at(before: Column, size: Column, shards: int, total: int) -> Column:
    """Shard that holds the middle byte of a row."""
    middle = (before * 2 + size) * shards
    share = F.call_function("div", middle, F.lit(2 * max(1, total)).cast("long"))
    return F.least(share, F.lit(shards - 1)).cast("int")


def shard(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``, its place there from 0.

    Shard sizes differ from the mean by at most one row's size at either end. A
    null text counts as empty. Equal and null ids, repeated rows and other
    columns are no matter; repeated rows are told apart by where they were
    read, and columns named as the new ones are replaced. An empty table stays
    empty, and few rows leave some shards empty.
    """
    docs = without(docs, "size", "shard", "slot", *KEY, "_hl_range", "_hl_bytes", "_hl_rows")
    names = docs.columns
    rows = keep(
        docs.withColumns(
            {
                "size": text_size(text_col),
                KEY[0]: text_key(text_col),
                KEY[1]: F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))),
                KEY[2]: F.monotonically_increasing_id(),
            }
        ),
        "sharded-rows",
    )
    narrow = rows.select("size", *KEY)
    count, total = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(1, min(count, max(shards * RANGES_A_SHARD, total // RANGE_BYTES)))
    splitters, totals = find_splitters(narrow, parts, total)
    starts = np.cumsum(totals, axis=1) - totals

    order = Window.partitionBy("_hl_range").orderBy(*KEY)
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("_hl_bytes") + running - F.col("size")
    place = F.col("_hl_rows") + F.row_number().over(order) - 1

    def placed(df: DataFrame) -> DataFrame:
        return add_ranges(df, splitters, starts).withColumns(
            {"shard": shard_at(before, F.col("size"), shards, total), "slot": place}
        )

    first = [0] * shards
    for found in placed(narrow).groupBy("shard").agg(F.min("slot")).collect():
        first[found[0]] = found[1]
    first_of = F.element_at(F.array(*[F.lit(f).cast("long") for f in first]), F.col("shard") + 1)
    return placed(rows).select(
        *[f"`{n}`" for n in names], "size", "shard", (F.col("slot") - first_of).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; a task writes a range, so a shard is written by many."""
    sharded.write.partitionBy("shard").parquet(path)
