import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from harvestline.llm import hmm

from .helpers import docs, long_text


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*lowered.encode().split(), None]


def brute_base(rows):
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    total, size = sum(counts.values()), len(counts)
    mass = total + 0.5 * (size + 1)
    return [
        (
            str(i),
            held_out(i),
            len(tokens(text)),
            sum(t in counts for t in tokens(text)),
            total,
            sum(math.log10((counts[t] + 0.5) / mass) for t in tokens(text)),
        )
        for i, text in rows
    ]


def rows_of(n=240):
    """Texts of two tongues that share no words but the last."""
    rng = np.random.default_rng(2)
    made = []
    for i in range(n):
        stem = "ab" if i % 2 else "xy"
        words = [f"{stem}{k % 40}" for k in rng.integers(0, 4000, 60) ** 2 // 1000]
        made.append((i, " ".join([*words, "END."])))
    return made


ODD = [(1000, None), (1001, ""), (1002, " \t\n"), (None, "ab1 xy1"), (None, "ab1 xy1"), (3, "ÄB Ab\x0bAB é"), (1004, long_text(30_000))]


def test_base_scores_equal_brute_force_and_held_out_texts_gain(spark):
    rows = rows_of() + ODD
    frame = docs(spark, rows).withColumns({"score": F.lit("mine"), "id": F.lit(0)})
    found = hmm.score(frame, iterations=5).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    want = sorted((*r[:5], round(r[5], 6)) for r in brute_base(rows))
    assert got == want
    plain = [r for r in found if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert len(plain) > 30
    assert sum(r.score for r in plain) > sum(r.base_score for r in plain) + 10 * len(plain)


def test_forward_recursion_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    emit = rng.random((hmm.CLASSES, hmm.STATES))
    move = rng.random((hmm.STATES, hmm.STATES))
    first = rng.random(hmm.STATES)
    model = hmm.Model(
        first / first.sum(),
        move / move.sum(axis=1, keepdims=True),
        emit / emit.sum(axis=0),
        np.full(hmm.CLASSES, -2.0),
    )
    for path in ([5], [7, 3000], [1, 2, 6000], [4, 4, 4, 0]):
        total = 0.0
        for states in itertools.product(range(hmm.STATES), repeat=len(path)):
            chance = model.first[states[0]]
            for a, b in itertools.pairwise(states):
                chance *= model.move[a, b]
            for state, class_ in zip(states, path, strict=True):
                chance *= model.emit[class_, state]
            total += chance
        column = pa.array([np.array(path, dtype="<i2").tobytes(), np.array([9], "<i2").tobytes()])
        assert math.isclose(hmm.gains(model, column)[0], math.log10(total) + 2 * len(path))


def test_expected_counts_add_up():
    plain = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    model = hmm.start_model(plain, 0.01)
    steps = np.array([[5, 9], [6, 8], [7, 0]], dtype=np.int16)
    first, moves, emits = hmm.expected(model, steps, np.array([3, 2]))
    assert np.isclose(first.sum(), 2)
    assert np.isclose(moves.sum(), 3)
    assert np.isclose(emits.sum(), 5)
    assert np.allclose(emits[[5, 9, 6, 8, 7]].sum(axis=1), 1)


def test_training_never_lowers_the_likelihood(spark):
    rng = np.random.default_rng(0)
    texts = [(rng.integers(2, 40, 50) + 60 * (i % 2)).astype("<i2").tobytes() for i in range(80)]
    frame = spark.createDataFrame([(bytearray(t),) for t in texts], "classes binary")
    plain = np.bincount(np.frombuffer(b"".join(texts), "<i2"), minlength=hmm.CLASSES) + 1e-9
    plain = plain / plain.sum()
    scores = [
        hmm.gains(hmm.baum_welch(frame, plain, 1e-6, n), pa.array(texts)).sum() for n in (0, 1, 2, 4)
    ]
    assert scores == sorted(scores)
    assert scores[-1] > 80 * 50 * 0.25


def test_chances_of_each_state_add_up_to_one():
    plain = np.random.default_rng(0).random(hmm.CLASSES)
    emit = hmm.start_model(plain / plain.sum(), 0.03).emit
    assert np.allclose(emit.sum(axis=0), 1)
    assert np.allclose(emit[hmm.UNKNOWN], 0.03)


def test_no_training_texts_and_no_rows(spark):
    lone = next(i for i in range(100) if held_out(i))
    (row,) = hmm.score(docs(spark, [(lone, "some words")]), iterations=1).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert (row.base_score, row.score) == (0.0, 0.0)
    assert hmm.score(docs(spark, []), iterations=1).count() == 0
