import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from harvestline.llm import collocations

from .helpers import long_text

DOCS = "doc_id long, text string, lang string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    often = {k: a for k, a in counts.items() if a >= least}
    out = {}
    for (lang, p), a in often.items():
        if len(p) == 1:
            continue
        inside = any(
            q[i : i + len(p)] == p
            for (other, q), b in often.items()
            if other == lang and len(q) > len(p) and 100 * b >= 100 * a
            for i in range(len(q) - len(p) + 1)
        )
        if inside:
            continue
        score, k = min(
            (1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k)
            for k in range(1, len(p))
        )
        row = (" ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score)
        out.setdefault(lang, []).append(row)
    result = []
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        result += [(lang, i + 1, *r) for i, r in enumerate(found[:top])]
    return sorted(result)


def found(spark, rows, **how):
    out = collocations.collocations(spark.createDataFrame(rows, DOCS), **how)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def corpus(n=60, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(30)] + ["Über", "naïve", " odd", "ÉTÉ", "x\x00y"]
    rows = []
    for i in range(n):
        text = []
        for _ in range(int(rng.integers(1, 60))):
            if rng.random() < 0.2:
                text.append("In The Event of fire")
            elif rng.random() < 0.1:
                text.append("new\tyork city")
            else:
                text.append(words[min(int(rng.exponential(7)), len(words) - 1)])
            text.append(rng.choice([" ", "  ", ", ", ".\n", "\t", ";", "\r\n"], p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]))
        rows.append((i, "".join(text), ["en", "de", None, "und"][i % 4]))
    return rows


ODD = [
    (None, None, None),
    (None, None, "en"),
    (1, "", "en"),
    (1, "...,,!", "en"),
    (2, "in the event of fire", "en"),
    (2, "in the event of fire", "en"),
]


def test_phrases_equal_brute_force(spark, monkeypatch):
    rows = corpus() + ODD
    assert found(spark, rows, least=8) == brute(rows, 8, 5, 2000)
    monkeypatch.setattr(collocations, "RANKED_AT_ONCE", 9)
    assert found(spark, rows, least=8, top=7) == brute(rows, 8, 5, 7)


@pytest.mark.parametrize("bits", [3, 9])
def test_collided_fingerprints_are_counted_by_text(spark, bits):
    rows = corpus(40, 4) + ODD
    assert found(spark, rows, least=5, longest=4, bits=bits) == brute(rows, 5, 4, 2000)


def test_a_small_bitmap_lets_more_through_and_changes_nothing(spark, monkeypatch):
    rows = corpus(30, 5)
    wanted = found(spark, rows, least=4)
    monkeypatch.setattr(collocations, "BITS_PER_ITEM", 1e-9)
    assert found(spark, rows, least=4) == wanted == brute(rows, 4, 5, 2000)


def test_long_texts_are_cut_behind_marks(monkeypatch):
    text = ("alpha beta, gamma delta epsilon. " * 50 + "no marks at all " * 40 + ". end").encode()
    column = pa.array([None, text.decode(), "a b", ""])

    def spelled():
        out = []
        for words in collocations.words_of(column):
            made = collocations.Grams(words, ["l"] * 4, 64)
            out += [
                (int(words.row[a]), int(words.start[a]), words.spelled(a, 1), int(k))
                for a, k in zip(made.starts(2), made.key(made.starts(2), 2), strict=True)
            ]
        return out

    whole = spelled()
    monkeypatch.setattr(collocations, "CHUNK", 100)
    assert spelled() == whole


def test_fingerprints_do_not_depend_on_the_place():
    column = pa.array(["one two three. two three", "zero two three"])

    def phrase_key(lang):
        return collocations.fingerprints(["two three"], np.array([2]), [lang])[0][0]

    (words,) = collocations.words_of(column)
    made = collocations.Grams(words, ["en", "en"], 64)
    keys = dict(zip(made.starts(2).tolist(), made.key(made.starts(2), 2).tolist(), strict=True))
    assert keys[1] == keys[3] == keys[6] == phrase_key("en")
    assert keys[1] != phrase_key("de")
    assert len(set(keys.values())) == 3


def test_very_long_text_and_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, "en"), (2, "a b", None)]) == []
    rows = [(1, long_text(40_000), "en"), (2, "yes no " * 20_000, "en")]
    assert found(spark, rows, least=3000) == brute(rows, 3000, 5, 2000)


def test_products_past_64_bits_are_exact(spark):
    frame = spark.createDataFrame(
        [(7 * 10**14, 10**15 - 1, 10**12 + 3, 9 * 10**14 + 1)], "a long, n long, l long, r long"
    )
    a, n, low, r = frame.first()
    assert frame.select(collocations.score()).first()[0] == 1000 * a * n // (low * r)


def test_clashing_column_names(spark):
    frame = spark.createDataFrame(
        [(1, "p q " * 9, "en", 1, 2, "z")], DOCS + ", n long, key long, phrase string"
    )
    assert collocations.collocations(frame, least=5).count() > 0
