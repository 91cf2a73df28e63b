import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from harvestline.llm import quality

from .helpers import docs, long_text

LABELS = "doc_id long, quality int, toxic int"
ODD_DOCS = [(9000, None), (9001, ""), (9002, long_text(40_000)), (None, "A!! B!!"), (None, None), (9003, "   \n")]
ODD_LABELS = [(9000, 1, 1), (9001, None, 0), (50000, 1, 1), (None, 1, 1), (9002, 0, None), (9003, 0, 0)]


def corpus(n=700):
    """Bad texts shout, repeat themselves or hold menus, in part or as a whole."""
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(n):
        good = int(rng.random() > 0.2)
        words = [f"w{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in rng.integers(0, 900, 50)]
        if not good:
            at = int(rng.integers(0, 25))
            if i % 3 == 0:
                words[at:] = [w.upper() + "!!" for w in words[at:]]
            elif i % 3 == 1:
                words[at:] = [words[at]] * (50 - at)
            else:
                words[at:] = [f"{w} |" for w in words[at:]]
        rows.append((i, " ".join(words)))
        labels.append((i, good, 0))
    return rows, labels


def fitted(spark, rows, labels, **how):
    frame = docs(spark, rows)
    return frame, quality.fit(frame, spark.createDataFrame(labels, LABELS), **how)


def test_held_out_texts_are_told_apart(spark):
    rows, labels = corpus()
    frame = docs(spark, rows + ODD_DOCS).withColumns({"Quality": F.lit("mine"), "good": F.lit(1)})
    model = quality.fit(frame, spark.createDataFrame(labels + labels[:50] + ODD_LABELS, LABELS))
    out = quality.add_scores(frame, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "good", "quality"]
    found = out.collect()
    assert len(found) == len(rows) + len(ODD_DOCS)
    assert all(0 <= r.quality <= 1 for r in found)
    truth = {i: g for i, g, _ in labels}
    held = [r for r in found if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.quality >= quality.THRESHOLD) == truth[r.doc_id] for r in held)
    assert len(held) > 100 and right >= 0.95 * len(held)
    empty = {r.quality for r in found if not (r.text or "").strip()}
    assert len(empty) == 1 and empty.pop() > 0.5


def brute_scores(model, texts):
    """All cosines in double precision, one text at a time."""
    vectors = model.project(pa.array(texts))
    out = []
    for v in vectors:
        cosine = np.array([float(v @ w) for w in model.vectors.astype(float)])
        near = sorted(range(len(cosine)), key=lambda j: -cosine[j])[: quality.NEIGHBOURS]
        vote = [max(cosine[j], 0) ** quality.SHARPNESS for j in near]
        good = sum(w * model.labels[j] for w, j in zip(vote, near, strict=True))
        out.append((good + quality.PRIOR_VOTES * model.prior) / (sum(vote) + quality.PRIOR_VOTES))
    return out


def test_votes_equal_brute_force(spark):
    rows, labels = corpus(300)
    frame, model = fitted(spark, rows, labels)
    texts = [t for _, t in rows[:80]]
    wanted = brute_scores(model, texts)
    close = np.isclose(model.scores(pa.array(texts)), wanted, atol=2e-3)
    assert close.mean() > 0.95  # neighbours that are equally far may take each other's place
    scored = {r.doc_id: r.quality for r in quality.add_scores(frame, model).collect()}
    assert np.allclose([scored[i] for i in range(80)], model.scores(pa.array(texts)), atol=1e-4)


def test_projection_keeps_as_much_as_the_exact_decomposition():
    rng = np.random.default_rng(4)
    dense = rng.random((60, 5)) @ rng.random((5, 40)) * (rng.random((60, 40)) < 0.5)
    text, at = np.nonzero(dense)
    main = quality.decompose(text, at, dense[text, at], dense.shape, 6)
    exact = np.linalg.svd(dense)[1][:6]
    assert np.allclose(main.T @ main, np.eye(6), atol=1e-9)
    assert np.linalg.norm(dense @ main) >= 0.995 * np.linalg.norm(exact)


def test_sums_of_rows_equal_a_dense_product():
    rng = np.random.default_rng(5)
    row, column = rng.integers(0, 30, 500), rng.integers(0, 20, 500)
    value, matrix = rng.random(500), rng.random((20, 7))
    dense = np.zeros((row.max() + 1, 20))
    np.add.at(dense, (row, column), value)
    assert np.allclose(quality.sums_of_rows(row, column, value, matrix, step=37), dense @ matrix)
    assert quality.sums_of_rows(row[:0], column[:0], value[:0], matrix).shape == (0, 7)


def test_shapes_and_terms():
    assert [quality.shape(w) for w in ("Word,", "IBM-360", "||", "é")] == ["Aa,", "A-0", "|", "a"]
    terms = {}
    for first, text, hashed, value in quality.text_terms(pa.array(["a a b", None, "", "a"])):
        for t, h, v in zip(text.tolist(), hashed.tolist(), value.tolist(), strict=True):
            terms.setdefault(first + t, {})[h] = v
    assert set(terms) == {0, 3}
    assert terms[0][quality.term("=a")] == np.sqrt(2 / 3)
    assert terms[0][quality.term(quality.REPEATED)] == np.sqrt(1 / 3)
    assert quality.term(quality.REPEATED) not in terms[3]


def test_repeated_ids_and_labels_of_two_minds(spark):
    rows, labels = corpus(200)
    again = rows + [(5, f"other text {k}") for k in range(300)]
    split = labels + [(i, 1 - g, 0) for i, g, _ in labels[:40]]
    frame, model = fitted(spark, again, split)
    taught = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5]
    assert len(model.labels) == len(taught)
    assert quality.add_scores(frame, model).count() == len(again)


def test_no_labels_and_no_rows(spark):
    frame, model = fitted(spark, [(1, "a b"), (2, None)], [])
    assert [r.quality for r in quality.add_scores(frame, model).collect()] == [0.5, 0.5]
    empty, model = fitted(spark, [], [(1, 1, 0)])
    assert quality.add_scores(empty, model).count() == 0


def test_bound_of_the_training_rows(spark):
    rows, labels = corpus(300)
    _, model = fitted(spark, rows, labels, max_train=100, dimensions=5)
    assert len(model.labels) == 100 and model.vectors.shape[1] <= 5
