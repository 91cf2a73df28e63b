"""A trie of conversation prefixes with totals of every subtree.

A node is a distinct sequence of first turns; its members are the conversations
that begin with it. Subtree totals are summed by bands of ``HEIGHT`` depths: a node
adds its own numbers to its ancestors within its band only, so it explodes to
``HEIGHT`` rows at most. The nodes at the top of the bands form a tree of their
own, ``HEIGHT`` times less deep, which is summed the same way, and its totals are
added to the ancestors in the band above. Rounds grow with the logarithm of the
longest conversation, to the base ``HEIGHT``.

No step needs a conversation, or the members of a node, in one place: turns are
numbered by range partitions whose counts are carried over, and a prefix is known
by the exclusive or of hashes of (place, turn) of 128 bits, which can be carried
over as well.

Cases: a null role or text is empty. Turns of equal number (null comes first) go by
the digest of role and text. Rows without a conversation id belong to none and are
left out. An empty table has no node, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.llm.common import Batches, keep, map_arrow

HEIGHT = 4
FAMILY = 20  # conversations of a family take their first turns from one of them
MOST_TAKEN = 3
IDS_IN_CHUNK = 512
NODE = ("depth", "k1", "k2")
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def lanes(place: Column, first: str = "t1", second: str = "t2") -> list[Column]:
    """128 bits that stand for a turn at a place, as two numbers to be added by exclusive or."""
    return [
        F.xxhash64(place.cast("long"), first, second).alias("x1"),
        F.xxhash64(F.lit(1), second, place.cast("long"), first).alias("x2"),
    ]


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, turn, two halves of the digest of role and text, and the words of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    half = [
        F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name)
        for at, name in ((1, "t1"), (17, "t2"))
    ]
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        digest.alias("digest"),
        *half,
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with ``part`` and ``nth``, their place among the turns of the conversation there.

    Parts hold rising ranges of (conversation, turn), so a conversation of any length
    spreads over many; a row number breaks up equal turns.
    """
    order = [
        F.col("conv_id").asc(),
        F.col("turn").asc_nulls_first(),
        F.col("digest").asc(),
        F.col("row").asc(),
    ]

    def rows(batches: Batches) -> Batches:
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(1).to_numpy()
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            nth = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv)))) + 1
            if last is not None and conv[0] == last:
                end = starts[1] if len(starts) > 1 else len(conv)
                nth[:end] += seen
            last, seen = conv[-1], int(nth[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nth, pa.int64())], [*batch.schema.names, "nth"]
            )

    placed = (
        turns.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "conv_id", "t1", "t2", "words")
    )
    return map_arrow(
        placed, rows, "part int, conv_id long, t1 long, t2 long, words long, nth long"
    )


def taken(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % (MOST_TAKEN + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations by part, and the length of each of those."""
    own = keep(numbered(turn_digests(turns)), "turns")
    counts = own.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part")
    parts = keep(
        counts.withColumns(
            {
                "before": F.sum("n").over(before) - F.col("n"),
                "total": F.sum("n").over(Window.partitionBy("conv_id")),
            }
        ),
        "parts",
    )
    places = parts.select("conv_id", "part", "before")
    # Donors: at most three turns of one conversation in twenty.
    heads = (
        own.where((F.col("conv_id") % FAMILY == 0) & (F.col("nth") <= MOST_TAKEN))
        .join(places.where(F.col("before") < MOST_TAKEN), ["conv_id", "part"])
        .select(
            F.col("conv_id").alias("family"),
            (F.col("before") + F.col("nth")).alias("place"),
            "t1",
            "t2",
            "words",
        )
        .where(F.col("place") <= MOST_TAKEN)
        .groupBy("family")
        .agg(F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "words"))).alias("heads"))
    )
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = keep(
        parts.where(F.col("before") == 0)
        .select("conv_id", "total", taken(F.col("conv_id")).alias("asked"), family.alias("family"))
        .join(heads, "family", "left")
        .select(
            "conv_id",
            "asked",
            F.slice(F.coalesce("heads", F.array()), F.lit(1), F.col("asked").cast("int")).alias("heads"),
            F.greatest(F.col("total") - F.col("asked"), F.lit(0)).alias("rest"),
        )
        .withColumn("given", F.size("heads").cast("long")),
        "conversations",
    )
    # By part, so that no conversation is one group; those that take turns at all move theirs.
    shifts = places.join(convs.select("conv_id", "asked", "given"), "conv_id").select(
        "conv_id", "part", "asked", (F.col("before") - F.col("asked")).alias("back"), "given"
    )
    rest = (
        own.join(shifts, ["conv_id", "part"])
        .withColumn("after", F.col("nth") + F.col("back"))
        .where(F.col("after") > 0)
        .select(
            "conv_id", "part", (F.col("after") + F.col("given")).alias("place"), "t1", "t2", "words"
        )
    )
    first = convs.select("conv_id", F.explode("heads").alias("h")).select(
        "conv_id", F.lit(-1).alias("part"), "h.place", "h.t1", "h.t2", "h.words"
    )
    lengths = convs.select("conv_id", (F.col("given") + F.col("rest")).alias("length"))
    return rest.unionByName(first), lengths


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for every prefix of every rebuilt conversation, the empty one included.

    ``k1``, ``k2`` stand for the prefix, ``x1``, ``x2`` for its last turn: the exclusive
    or of both is the prefix before it.
    """
    parts, lengths = rebuilt(turns)
    hashed = keep(
        parts.select("conv_id", "part", "place", "words", *lanes(F.col("place"))), "places"
    )
    within = Window.partitionBy("conv_id", "part").orderBy("place")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        hashed.groupBy("conv_id", "part")
        .agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
        .select(
            "conv_id",
            "part",
            *[F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"c{i}") for i in (1, 2)],
        )
    )
    running = hashed.withColumns({f"r{i}": F.bit_xor(f"x{i}").over(within) for i in (1, 2)})
    chained = running.join(carried, ["conv_id", "part"]).select(
        "conv_id",
        F.col("place").alias("depth"),
        *[F.col(f"r{i}").bitwiseXOR(F.col(f"c{i}")).alias(f"k{i}") for i in (1, 2)],
        "x1",
        "x2",
        "words",
    )
    zero = F.lit(0).cast("long")
    roots = lengths.select(
        "conv_id", *[zero.alias(c) for c in ("depth", "k1", "k2", "x1", "x2", "words")]
    )
    return (
        chained.unionByName(roots)
        .join(lengths, "conv_id")
        .withColumn("ends", F.col("depth") == F.col("length"))
        .drop("length")
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end in a node, in order, comma-joined.

    Ids are sorted by range and joined in chunks wherever they lie; the digest of a
    node then runs over its chunks one by one, since SHA-256 cannot be split.
    """
    by = [*NODE, "conv_id"]

    def chunks(batches: Batches) -> Batches:
        for batch in batches:
            node = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            ids = batch.column(3).to_numpy()
            new = np.append(True, (node[1:] != node[:-1]).any(axis=1)) if len(ids) else np.empty(0, bool)
            starts = np.flatnonzero(new)
            cuts = [
                at
                for start, end in zip(starts, np.append(starts[1:], len(ids)), strict=True)
                for at in range(start, end, IDS_IN_CHUNK)
            ]
            ends_ = [*cuts[1:], len(ids)]
            joined = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, ends_, strict=True)]
            picked = batch.take(pa.array(cuts, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(joined, pa.string())], [*by, "ids"]
            )

    def digests(batches: Batches) -> Batches:
        node, running = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [
                    *[pa.array([v], pa.int64()) for v in node],
                    pa.array([running.hexdigest()], pa.string()),
                ],
                [*NODE, "ends_sha256"],
            )

        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True)
            for *own, ids in rows:
                if own == node:
                    running.update(b"," + ids.encode())
                    continue
                if node is not None:
                    yield done()
                node, running = own, hashlib.sha256(ids.encode())
        if node is not None:
            yield done()

    schema = "depth long, k1 long, k2 long, conv_id long"
    cut = map_arrow(
        ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by),
        chunks,
        f"{schema}, ids string",
    )
    return map_arrow(
        cut.repartition(*NODE).sortWithinPartitions(*by),
        digests,
        "depth long, k1 long, k2 long, ends_sha256 string",
    )


def ancestors(paths: DataFrame, nodes: DataFrame, unit: int, height: int, above: bool) -> DataFrame:
    """Nodes with their ancestors in their own band, or in the one above it.

    Depths are multiples of ``unit``. A node finds its ancestors among the prefixes of its
    smallest member, which lie together by band, ``height`` of them at most.
    """
    band = F.floor(F.col("depth") / (unit * height))
    chains = (
        paths.where(F.col("depth") % unit == 0)
        .groupBy("conv_id", band.alias("band"))
        .agg(F.collect_list(F.struct(*NODE)).alias("chain"))
    )
    wanted = band - 1 if above else band
    if above:
        nodes = nodes.where(F.col("depth") > 0)
    return (
        nodes.withColumn("band", wanted)
        .join(chains, ["conv_id", "band"])
        .withColumn("up", F.explode("chain"))
        .where(F.col("up.depth") <= F.col("depth"))
    )


def subtree_totals(
    paths: DataFrame, nodes: DataFrame, deepest: int, height: int = HEIGHT, unit: int = 1
) -> DataFrame:
    """``leaves`` and ``saved`` of every node, summed over its subtree.

    ``nodes``: a node, its smallest member ``conv_id``, and its own ``leaves`` and
    ``saved``, at depths that are multiples of ``unit``.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    key = [F.col(f"up.{c}").alias(c) for c in NODE]
    within = ancestors(paths, nodes, unit, height, False).groupBy(*key).agg(*sums)
    if deepest < unit * height:
        return within
    within = keep(within, "band-totals")
    tops = nodes.where(F.col("depth") % (unit * height) == 0).select(*NODE, "conv_id")
    tops = tops.join(within, list(NODE))
    whole = subtree_totals(paths, tops, deepest, height, unit * height)
    whole = keep(tops.select(*NODE, "conv_id").join(whole, list(NODE)), "top-totals")
    below = ancestors(paths, whole, unit, height, True).groupBy(*key).agg(*sums)
    return within.unionByName(below).groupBy(*NODE).agg(*sums)


def prefix_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A row for every node: its smallest member and depth, which name it, and its numbers.

    ``parent_conv_id`` with ``depth`` - 1 names the parent. ``saved_tokens`` are the words
    that need not be read again if every prefix is read once.
    """
    paths = keep(prefixes(conversations), "prefixes")
    nodes = keep(
        paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.min("words").alias("words"),
            F.min("x1").alias("x1"),
            F.min("x2").alias("x2"),
        ),
        "nodes",
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    up = [
        (F.col("depth") - 1).alias("depth"),
        F.col("k1").bitwiseXOR(F.col("x1")).alias("k1"),
        F.col("k2").bitwiseXOR(F.col("x2")).alias("k2"),
    ]
    children = nodes.where(F.col("depth") > 0).groupBy(*up).agg(F.count("*").alias("n_children"))
    counted = keep(
        nodes.join(children, list(NODE), "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
        ),
        "counted",
    )
    own = counted.select(
        *NODE,
        "conv_id",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    steps = paths.select("conv_id", *NODE)
    totals = subtree_totals(steps, own, deepest, height)
    parents = nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id"))
    child = [c.alias(f"up_{n}") for c, n in zip(up, NODE, strict=True)]
    # A parent is one row; its many children are split by the skew join if need be.
    linked = (
        counted.select("*", *child)
        .join(
            parents.select(*[F.col(c).alias(f"up_{c}") for c in NODE], "parent_conv_id"),
            [f"up_{c}" for c in NODE],
            "left",
        )
        .select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children")
    )
    ends = end_digests(paths.where("ends"))
    return (
        linked.join(totals, list(NODE))
        .join(ends, list(NODE), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
