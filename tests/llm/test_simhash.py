import random
import re

import xxhash
from pyspark.sql import functions as F

from harvestline.llm import simhash

from .helpers import docs, long_text

BASE = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf " * 20
ROWS = [
    (7, BASE),
    (3, BASE.upper()),
    (9, BASE + "again"),
    (9, BASE + "again"),
    (5, long_text(3000)),
    (6, long_text(3000, 1)),
    (11, "two words"),
    (12, "Two\tWORDS"),
    (20, None),
    (21, ""),
    (22, " \n\x0b "),
    (None, "two  words"),
    (None, "nothing like the rest of it"),
]


def brute_fingerprint(text, words=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    if not runs and found:
        runs = [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    ids = {}
    for (doc_id, _), c in zip(rows, label, strict=True):
        if doc_id is not None:
            ids[c] = min(doc_id, ids.get(c, doc_id))
    return [ids.get(c) for c in label], prints


def test_components_equal_brute_force(spark):
    found = simhash.near_duplicates(docs(spark, ROWS)).collect()
    components, prints = brute_components(ROWS)
    got = sorted(
        (str(r.doc_id), r.fingerprint & (1 << 64) - 1, str(r.component_id)) for r in found
    )
    want = sorted(
        (str(i), p, str(c)) for (i, _), p, c in zip(ROWS, prints, components, strict=True)
    )
    assert got == want


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("ab cd ef"))).first()
    assert row[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"ab cd ef", 42)


def test_all_pairs_within_the_radius_are_found(spark):
    centre = 0x0F0F_3C3C_55AA_1234
    near = [centre ^ (1 << a) ^ (1 << b) for a in range(0, 62, 5) for b in range(a, 62, 9)]
    far = [centre ^ 0b1110_0111 << 30, 0, 1 << 62]
    signed = [(v,) for v in {centre, *near, *far}]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    label = {v: v for (v,) in signed}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in edges:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    values = list(label)
    brute = {v: v for v in values}
    for _ in values:
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2:
                    brute[a] = brute[b] = min(brute[a], brute[b])
    assert {v: root(v) for v in values} == brute


def test_one_document_of_each_group_stays(spark):
    frame = docs(spark, ROWS).withColumn("component_id", F.lit("mine"))
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    components, _ = brute_components(ROWS)
    groups = {str(c) for c in components}
    assert ids == sorted(groups)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.keep_one(docs(spark, [])).count() == 0


def brute_kept(rows, words=5, similarity=0.8):
    sets = []
    for _, text in rows:
        found = (text or "").lower().split()
        runs = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}
        sets.append(runs or ({tuple(found)} if found else set()))
    label = list(range(len(rows)))
    links = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets)
        if i < j and (not a | b or len(a & b) >= similarity * len(a | b))
    ]
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return sorted(rows[min((k for k, c in enumerate(label) if c == g), key=lambda k: rows[k][0])][0] for g in set(label))


def near_copies(rng):
    rows = []
    for k in range(24):
        own = long_text(rng.randrange(60, 400), rng.randrange(10**6)).split()
        rows.append((100 * k + 1, " ".join(own)))
        for copy in range(2, 6):
            edited = [w if rng.random() > rng.choice([0.01, 0.02, 0.04]) else f"e{rng.random()}" for w in own]
            lines = [" ".join(edited[i : i + 7 + copy]) for i in range(0, len(edited), 7 + copy)]
            rows.append((100 * k + copy, "\n".join(lines)))
    rows += [(9001, "a b c d e f g h"), (9002, "x a b c d e f g h"), (9003, "a b c"), (9004, "A\nb c"), (9005, "")]
    rows += [(9006, " \n"), (9007, None), (9008, "a b c d")]
    return rows


def test_similar_texts_equal_brute_force_jaccard(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rows = near_copies(random.Random(5))
    frame = docs(spark, rows).withColumns({"key": F.lit("mine"), "n": F.lit(1)})
    kept = simhash.keep_one_similar(frame, words=5)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)
    assert len(brute_kept(rows)) < 100


def test_the_stage_drops_near_copies(spark):
    import corpus_pipeline

    rows = near_copies(random.Random(6))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_empty_table_of_sets(spark):
    assert simhash.keep_one_similar(docs(spark, [])).count() == 0


def test_rows_without_id_meet_one_set_each(spark):
    """Many null or equal ids: every set is read from one row, not from all of them."""
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(1000):
        words = base[:k % 50] + [f"v{k}"] + base[k % 50 :]
        rows.append((None if k % 2 else 7, " ".join(words)))
    frame = docs(spark, rows)
    placed = frame.selectExpr(
        "doc_id is null as none", "coalesce(doc_id, 0) as id", "xxhash64(text) as text_key", "text"
    )
    sets = simhash.add_sets(placed, "text", 5)
    told = sets.selectExpr("key", "struct(none, id, text_key) as place").dropDuplicates(["key"])
    assert told.count() == 1000
    assert simhash._sets_of(placed, told, "text", 5).count() == 1000
    kept = simhash.keep_one_similar(frame, words=5).collect()
    assert len(kept) == 1
