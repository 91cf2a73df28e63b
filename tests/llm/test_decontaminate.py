import random

import numpy as np
from pyspark.sql import functions as F

from harvestline.llm import decontaminate as dec

from .helpers import docs, long_text

ITEMS = "item_id long, text string"


def item(k, n=24):
    return " ".join(f"q{k}x{i}" for i in range(n))


def bench(spark, extra=()):
    rows = [(k, item(k)) for k in range(12)] + list(extra)
    return spark.createDataFrame(rows, ITEMS)


def edited(rng, text, share):
    words = text.split()
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = rng.choice(["", "other", words[i] + " more"])
    return " ".join(words)


def brute_score(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            best[i, j] = max(
                0,
                best[i - 1, j - 1] + (dec.MATCH if x == y else dec.MISMATCH),
                best[i - 1, j] + dec.GAP,
                best[i, j - 1] + dec.GAP,
            )
    return best.max()


def test_alignment_equals_the_recurrence():
    rng = np.random.default_rng(3)
    own = rng.integers(0, 6, 15).astype(np.uint32)
    texts = [rng.integers(0, 6, n).astype(np.uint32) for n in (1, 5, 20, 33)]
    assert dec.align(own, texts).tolist() == [brute_score(own, t) for t in texts]


def test_copies_and_edited_copies_are_found_and_nothing_else(spark):
    rng = random.Random(2)
    rows = [(i, long_text(200, i)) for i in range(40)]
    rows += [(100 + k, long_text(50, k) + " " + item(k).upper() + ". " + long_text(50)) for k in range(4)]
    rows += [(200 + k, long_text(80, k) + "\n" + edited(rng, item(4 + k), 0.12) + " end") for k in range(4)]
    rows += [(300 + k, "copy of " + item(9)) for k in range(60)] + [(400, item(1)[:20] + long_text(30))]
    rows += [(500, None), (501, ""), (502, "two words"), (None, item(2)), (None, item(2)), (100, rows[40][1])]
    rows += [(503, long_text(30_000) + " " + item(11) + " " + long_text(30_000))]
    frame = docs(spark, rows).withColumns({"item_id": F.lit("mine"), "score": F.lit(1)})
    items = bench(spark, [(50, None), (51, ""), (52, "two words"), (3, item(3))])
    found = dec.leaks(frame, items).collect()
    pairs = sorted((str(r.doc_id), r.item_id) for r in found)
    want = [(str(100 + k), k) for k in range(4)] + [(str(200 + k), 4 + k) for k in range(4)]
    want += [(str(300 + k), 9) for k in range(60)] + [("None", 2), ("503", 11)]
    assert pairs == sorted(want)
    assert all(dec.MIN_SIMILARITY <= r.similarity <= 1 for r in found)
    kept = dec.drop_leaks(frame, items)
    assert kept.columns == frame.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(str(i) for i, _ in rows if (str(i) not in {d for d, _ in want}))


def test_empty_tables(spark):
    rows = docs(spark, [(1, item(1))])
    none = spark.createDataFrame([], ITEMS)
    assert dec.leaks(rows, none).count() == 0
    assert dec.drop_leaks(rows, none).count() == 1
    assert dec.leaks(docs(spark, []), bench(spark)).count() == 0


def test_windows_hold_the_item_and_merge():
    assert dec.windows([100, 104], 20, 1000) == [(85, 139)]
    assert dec.windows([-5, 500], 20, 510) == [(0, 30), (485, 510)]


def test_all_texts_of_an_item_id_are_looked_for(spark):
    rows = [(k, long_text(40, k) + " " + item(k)) for k in range(6)]
    items = [(1, item(0)), (1, item(1)), (None, item(2)), (None, item(3)), (2, item(4)), (2, item(4)[:80])]
    found = dec.leaks(docs(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    got = sorted((r.doc_id, str(r.item_id), r.similarity) for r in found)
    want = [(0, "1", 1.0), (1, "1", 1.0), (2, "None", 1.0), (3, "None", 1.0), (4, "2", 1.0)]
    assert got == want


def test_short_items_in_many_documents_are_aligned(spark):
    rows = [(k, long_text(20, k) + " one two three " + long_text(9)) for k in range(8)]
    rows += [(20 + k, long_text(20, k) + " p q r other") for k in range(8)]
    rows += [(40, " ".join(f"u{k} six seven eight nine v{k}" for k in range(50)))]
    rows += [(50 + k, "a common start " + long_text(30, k)) for k in range(8)]
    texts = ["one two three", "p q r s t u", "six seven eight", "a common start of something else here"]
    items = spark.createDataFrame(list(enumerate(texts)), ITEMS)
    found = sorted((r.doc_id, r.item_id) for r in dec.leaks(docs(spark, rows), items).collect())
    assert found == [(k, 0) for k in range(8)] + [(20 + k, 1) for k in range(8)] + [(40, 2)]


def edited(rng, text, share):
    """A copy with words replaced, left out and put in."""
    out = []
    for word in text.split():
        draw = rng.random()
        if draw < share / 3:
            out.append(f"x{rng.randrange(10**6)}")
        elif draw < 2 * share / 3:
            continue
        else:
            out.append(word)
            if draw > 1 - share / 3:
                out.append(f"y{rng.randrange(10**6)}")
    return " ".join(out)


def test_recall_against_alignment_of_all_pairs(spark):
    """Items share stock phrases; copies are edited more and more."""
    rng = random.Random(9)
    stock = ["which of the following is true", "choose the best answer to the question"]
    texts = [
        f"{stock[k % 2]} " + " ".join(f"t{rng.randrange(900)}" for _ in range(rng.randrange(12, 45)))
        for k in range(40)
    ]
    rows = []
    for k in range(160):
        body = " ".join(f"t{rng.randrange(900)}" for _ in range(60)) + f" {stock[k % 2]}"
        if k < 110:
            copy = edited(rng, texts[k % 40], (k // 10) * 0.04)
            body = f"{body} {copy} " + " ".join(f"t{rng.randrange(900)}" for _ in range(30))
        rows.append((k, body))
    items = spark.createDataFrame(list(enumerate(texts)), ITEMS)
    found = {(r.doc_id, r.item_id): r.score for r in dec.leaks(docs(spark, rows), items).collect()}
    coded = [dec.codes(dec.words(t)) for t in texts]
    wanted = {}
    for i, body in rows:
        code = dec.codes(dec.words(body)).astype(np.int64)
        for j, own in enumerate(coded):
            score = int(dec.align(own, [code])[0])
            if score >= dec.MIN_SIMILARITY * dec.MATCH * len(own):
                wanted[i, j] = score
    assert len(wanted) > 70 and set(found) <= set(wanted)
    assert len(found) >= 0.9 * len(wanted)
    assert sum(found[p] == wanted[p] for p in found) >= 0.95 * len(found)


def test_stock_phrases_of_a_large_benchmark_make_few_candidates(spark, monkeypatch):
    """Candidates follow the copies, not items times documents."""
    made = {}
    keep = dec.keep

    def counted(df, name, *args):
        kept = keep(df, name, *args)
        made[name] = kept.count() if name == "candidates" else None
        return kept

    monkeypatch.setattr(dec, "keep", counted)
    phrase = "which of the following is"
    items = [(k, f"{phrase} " + " ".join(f"i{k}w{w}" for w in range(30))) for k in range(100)]
    rows = [(k, f"{phrase} " + long_text(20, k)) for k in range(300)]
    rows += [(1000 + k, long_text(5, k) + " " + items[k][1]) for k in range(50)]
    bench_ = spark.createDataFrame(items, ITEMS)
    found = {(r.doc_id, r.item_id) for r in dec.leaks(docs(spark, rows), bench_).collect()}
    assert found >= {(1000 + k, k) for k in range(50)}
    assert made["candidates"] < 200  # of 35,000 pairs
