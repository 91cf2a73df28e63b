import math

import numpy as np
from pyspark.sql import functions as F

from harvestline.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def planted(size=24, groups=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(size)
        for k in range(g * 4):
            noise = rng.standard_normal(size) * (0.02 + 0.05 * (k % 4))
            rows.append((len(rows) * 3 % 101 + 1000 * g, (centre + noise).tolist(), g % 2))
    return rows


ODD = [
    (1, None, 0),
    (2, [0.0] * 24, 0),
    (3, [float("nan"), *[1.0] * 23], 0),
    (4, [None, *[1.0] * 23], 0),
    (5, [math.inf, *[1.0] * 23], 0),
    (6, [], 0),
    (7, [1.0] * 24, None),
    (8, [1.0] * 24, None),
    (9, [2.0] * 24, 1),
    (10, [1.0] * 24, 1),
    (11, [1.0] * 24, 0),
    (12, [1.0] * 3, 1),
    (13, [2.0] * 3, 1),
    (None, [1.0] * 24, 1),
    (30, [0.5], 1),
    (31, [0.7], 1),
]


def brute(rows):
    def usable(v, label):
        return label is not None and v and all(x is not None and abs(x) < math.inf for x in v) and any(v)

    vectors = [
        np.array(v, dtype=np.float32).astype(float) if usable(v, label) else None
        for _, v, label in rows
    ]
    n = len(rows)
    linked = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2]:
                if len(a) == len(b):
                    linked[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98
    label = list(range(n))
    for _ in range(n):
        for i, j in zip(*np.nonzero(linked), strict=True):
            label[i] = label[j] = min(label[i], label[j])
    least = {}
    for (vec_id, _, _), c in zip(rows, label, strict=True):
        if vec_id is not None:
            least[c] = min(vec_id, least.get(c, vec_id))
    return sorted(
        (str(r[0]), int(linked[i].sum()), str(least.get(label[i])), r[0] == least.get(label[i]))
        for i, r in enumerate(rows)
    )


def test_links_and_components_equal_brute_force(spark):
    rows = planted() + planted()[:7] + ODD
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("mine"))
    found = embeddings.near_duplicates(frame).collect()
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found)
    assert got == brute(rows)
    assert max(r.n_links for r in found) > 10


def test_blocks_hold_a_share_for_every_close_pair():
    rng = np.random.default_rng(0)
    a = embeddings.unit(rng.standard_normal((500, 65)))
    b = embeddings.unit(a + rng.standard_normal((500, 65)) * 0.02)
    close = (a * b).sum(1) >= 0.98
    gap = (embeddings.turned(a) - embeddings.turned(b)) ** 2
    shares = np.add.reduceat(gap, embeddings.block_starts(65), axis=1)
    assert close.sum() > 100
    assert (shares <= embeddings.block_budgets(65, 0.98)).any(axis=1)[close].all()


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
