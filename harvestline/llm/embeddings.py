"""Near-duplicate vectors by an exact pigeonhole join over subspaces.

Unit vectors with a cosine of at least ``threshold`` are at most
``2 - 2 * threshold`` apart in squared distance. They are turned by a fixed
rotation, which spreads the distance evenly over the coordinates, and cut into
blocks of about eight coordinates. In one block at least the squared distance
is at most the block's proportional share, so a range join within every block
finds all pairs; a pair is taken in the first such block only and then verified
on the whole vectors in double precision.

The range join of a block uses a grid over its first two coordinates. A vector
goes to every cell that it or a partner up to the block's radius above may own,
and a pair is handled in the cell of its larger coordinates. Cells are cut into
chunks of bounded size, and chunks are compared pairwise: no task gets a whole
cell, and no pairs leave a task, only link counts and the edges that join what is
linked.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestline.llm.common import Batches, keep, map_arrow
from harvestline.llm.graph import Forest, components

THRESHOLD = 0.98
BLOCK = 8  # coordinates a block
CHUNK = 512  # vectors compared with as many at once
CELL = ("label", "size", "block", "cx", "cy")
SLACK = 1e-9  # of the radius, far above rounding and far below any real distance
SEED = 7


@functools.cache
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation (or reflection) of ``size`` coordinates."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))[0]


def block_starts(size: int) -> np.ndarray:
    parts = np.array_split(np.arange(size), max(1, size // BLOCK))
    return np.array([p[0] for p in parts])


def block_budgets(size: int, threshold: float) -> np.ndarray:
    """Share of the squared distance of every block."""
    widths = np.diff([*block_starts(size), size])
    return (2 - 2 * threshold) * widths / size + SLACK


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def turned(units: np.ndarray) -> np.ndarray:
    """Rotated vectors; each row is summed by itself, so it is the same in any batch."""
    return np.einsum("ij,nj->ni", rotation(units.shape[1]), units)


def grid(coords: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and the highest cell of each coordinate."""
    low = np.floor(coords / (2 * radius)).astype(np.int64)
    return low, np.floor((coords + radius) / (2 * radius)).astype(np.int64)


def block_coords(points: np.ndarray, block: int) -> np.ndarray:
    """First two coordinates of a block; a block of one has zeros for the second."""
    starts = [*block_starts(points.shape[1]), points.shape[1]]
    found = points[:, starts[block] : starts[block + 1]][:, :2]
    return np.pad(found, ((0, 0), (0, 2 - found.shape[1])))


def cells_of(vectors: np.ndarray, threshold: float):
    """Columns row, block, cx, cy of all cells the vectors go to."""
    points = turned(unit(vectors))
    for block, budget in enumerate(block_budgets(vectors.shape[1], threshold)):
        low, high = grid(block_coords(points, block), np.sqrt(budget))
        for dx in (0, 1):
            for dy in (0, 1):
                there = np.ones(len(low), dtype=bool)
                there &= (high[:, 0] > low[:, 0]) if dx else True
                there &= (high[:, 1] > low[:, 1]) if dy else True
                row = np.flatnonzero(there)
                yield row, np.full(len(row), block), low[row, 0] + dx, low[row, 1] + dy


def linked_pairs(
    a: np.ndarray, b: np.ndarray, block: int, cell: tuple[int, int], same: bool, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of two chunks of vectors that this block and cell have to report."""
    ua, ub = unit(a), unit(b)
    pa_, pb = turned(ua), turned(ub)
    starts, budgets = block_starts(a.shape[1]), block_budgets(a.shape[1], threshold)
    span = slice(starts[block], [*starts, a.shape[1]][block + 1])
    x, y = pa_[:, span], pb[:, span]
    apart = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(apart <= budgets[block] + SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ca, _ = grid(block_coords(pa_, block), np.sqrt(budgets[block]))
    cb, _ = grid(block_coords(pb, block), np.sqrt(budgets[block]))
    for at in range(0, len(i), 1 << 15):
        p, q = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        here = (np.maximum(ca[p], cb[q]) == cell).all(axis=1)
        p, q = p[here], q[here]
        shares = np.add.reduceat((pa_[p] - pb[q]) ** 2, starts, axis=1) <= budgets
        first = shares.any(axis=1) & (shares.argmax(axis=1) == block)
        p, q = p[first], q[first]
        close = np.einsum("ij,ij->i", ua[p], ub[q]) >= threshold
        found.append((p[close], q[close]))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def usable(label: Column, vector: Column) -> Column:
    """True for rows that can have links."""
    fine = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    known = label.isNotNull() & vector.isNotNull() & fine
    return F.coalesce(known & F.exists(vector, lambda v: v != 0), F.lit(False))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    return np.split(flat, np.cumsum(lengths)[:-1])


def cells(nodes: DataFrame, threshold: float) -> DataFrame:
    """Every cell of every vector: node, label, size, block, cx, cy."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            node, label, vectors = batch.columns
            all_ = _vectors(vectors)
            sizes = np.array([len(v) for v in all_])
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                stack = np.stack([all_[k] for k in mine])
                for row, *cell in cells_of(stack, threshold):
                    where = pa.array(mine[row])
                    yield pa.RecordBatch.from_arrays(
                        [
                            node.take(where),
                            label.take(where),
                            *map(pa.array, (np.full(len(row), size), *cell)),
                        ],
                        ["node", *CELL],
                    )

    kind = nodes.schema["label"].dataType.simpleString()
    schema = f"node long, label {kind}, size long, block long, cx long, cy long"
    return map_arrow(nodes.select("node", "label", "vec"), rows, schema)


def chunks(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """The vectors of every cell in lists of about ``CHUNK``."""
    sizes = keep(
        placed.groupBy(*CELL).agg(F.ceil(F.count("*") / CHUNK).alias("parts")), "cell-sizes"
    )
    dealt = placed.join(sizes.where("parts > 1"), [*CELL], "left").select(
        "node",
        *CELL,
        F.coalesce(F.pmod(F.xxhash64("node"), "parts"), F.lit(0)).alias("chunk"),
    )
    return (
        dealt.join(nodes.select("node", "copies", "vec"), "node")
        .groupBy(*CELL, "chunk")
        .agg(F.collect_list(F.struct("node", "copies", "vec")).alias("rows"))
    )


def _chunk(rows: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    held = rows.values
    node, copies = (held.field(k).to_numpy(zero_copy_only=False) for k in ("node", "copies"))
    vectors = held.field("vec")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return node, copies, flat.reshape(len(node), -1)


def found_links(chunked: DataFrame, threshold: float) -> DataFrame:
    """Rows ``a``, ``b``, ``n``: an edge without ``n``, or a number of links without ``b``."""
    other = chunked.select(*CELL, F.col("chunk").alias("other"), F.col("rows").alias("there"))
    pairs = (
        chunked.join(other, [*CELL])
        .where(F.col("chunk") <= F.col("other"))
        .select(
            "block", "cx", "cy", (F.col("chunk") == F.col("other")).alias("same"), "rows", "there"
        )
    )

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            for block, cx, cy, same, mine, there in zip(*batch.columns, strict=True):
                na, wa, va = _chunk(mine)
                nb, wb, vb = _chunk(there)
                i, j = linked_pairs(
                    va, vb, block.as_py(), (cx.as_py(), cy.as_py()), same.as_py(), threshold
                )
                if not len(i):
                    continue
                counts = np.concatenate(
                    [np.bincount(i, wb[j], len(na)), np.bincount(j, wa[i], len(nb))]
                ).astype(np.int64)
                forest = Forest(len(na) + len(nb))
                if same.as_py():
                    forest.link(i, j)
                else:
                    forest.link(i, j + len(na))
                nodes = np.concatenate([na, nb])
                low, high = forest.edges()
                some = np.flatnonzero(counts)
                a = np.concatenate([nodes[low], nodes[some]])
                edge = np.arange(len(a)) < len(low)
                b = np.concatenate([nodes[high], nodes[some]])
                n = np.concatenate([counts[: len(low)] * 0, counts[some]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b, mask=~edge), pa.array(n, mask=edge)], ["a", "b", "n"]
                )

    return map_arrow(pairs, rows, "a long, b long, n long")


def near_duplicates(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: the id, ``n_links``, ``component_id``, ``kept``.

    Vectors are compared if their labels are equal and not null and they have
    equally many components. A vector that is null, empty or zero, or holds null
    or non-finite components, has no link. ``n_links`` counts rows, so each of
    ``k`` repeated rows has ``k - 1`` links to the others. ``component_id`` is the
    smallest id reachable, null ids passed over; a row without links has its own
    id, null included. ``kept`` tells if both ids are the same. Other columns are
    not carried.
    """
    rows = table.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec")
    )
    good = usable(F.col("label"), F.col("vec"))
    nodes = keep(
        rows.where(good)
        .groupBy("label", "vec")
        .agg(F.count("*").alias("copies"), F.min("id").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    placed = keep(cells(nodes, threshold), "cells")
    found = keep(found_links(keep(chunks(nodes, placed), "chunks"), threshold), "found")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b IS NOT NULL"))
    rooted = keep(
        nodes.join(keep(roots, "roots"), "node", "left")
        .join(keep(counts, "counts"), "node", "left")
        .select(
            "label",
            "vec",
            "first",
            F.coalesce("component", "node").alias("root"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        ),
        "rooted",
    )
    least = keep(rooted.groupBy("root").agg(F.min("first").alias("least")), "least")
    classes = keep(
        rooted.join(least, "root").select(
            F.col("label").alias("l"), F.col("vec").alias("v"), "n_links", "least"
        ),
        "classes",
    )
    same = (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v"))
    placed_rows = rows.join(classes, same, "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("l").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )
    return placed_rows.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
