import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harvestline.llm import packing

from .helpers import docs, long_text

ODD = [
    "A\x1cb c",
    "Don't STOP. It's here, ok?!",
    "<|endoftext|> x",
    "x<|EndOfText|>",
    "İstanbul é, é.   Ω;",
    "näive.a,b;c 3.14",
    "  ",
    "",
    None,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_vocabulary())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_remembered_words_give_the_ids_of_the_tokenizer(tokenizer):
    words = packing.Words(packing.default_vocabulary())
    for texts in (ODD, [t for t in ODD if "<|" not in (t or "")], [long_text(500)]):
        for got, text in zip(words.encode(pa.array(texts, pa.string())), texts, strict=True):
            assert got.tolist() == ids_of(tokenizer, text)[:-1]


def brute_cost(place, penalty, window):
    best = [0] + [None] * (len(place) - 1)
    for i in range(1, len(place)):
        costs = [
            best[j] + packing.padding(place[i] - place[j], window)
            for j in range(i)
            if place[i] - place[j] <= window
            and (
                place[i] - place[j] & (place[i] - place[j] - 1)
                or place[i] - place[j] >= 1 << packing.SHORTEST_POWER
            )
        ]
        costs += [
            best[j] + window - (place[i] - place[j])
            for j in range(i)
            if place[i] - place[j] <= window
        ]
        best[i] = min(costs) + penalty[i] + packing.SEQUENCE_COST
    return best[-1]


def test_cuts_cost_as_little_as_any():
    rng = random.Random(1)
    for _ in range(60):
        window = 512
        steps = [rng.choice([1, 7, 40, 128, 256, 500, 512]) for _ in range(rng.randint(1, 40))]
        place = np.cumsum([0, *steps]).tolist()
        penalty = [rng.choice([0, 16, 256]) for _ in place]
        cuts = packing.best_cuts(place, penalty, window)
        assert cuts[-1] == len(place) - 1
        cost, last = 0, 0
        for i in cuts:
            size = place[i] - place[last]
            assert size <= window
            short = size < 1 << packing.SHORTEST_POWER
            cost += window - size if short else packing.padding(size, window)
            cost += penalty[i] + packing.SEQUENCE_COST
            last = i
        assert cost == brute_cost(place, penalty, window)


def check(found, rows, tokenizer, window):
    by_text, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
        if r.start == 0:
            by_text[str(r.doc_id)].append(r.doc_tokens)
    assert sorted(x for own in by_text.values() for x in own) == sorted(
        len(ids_of(tokenizer, t)) for _, t in rows
    )
    stream = {}
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and len(r.ids) == 4 * r.length > 0
            at += r.length
            stream[str(r.doc_id), r.start] = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert at <= window
    return stream


def test_round_trip(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, long_text(9000)), (101, "word " * 5000)]
    frame = docs(spark, rows).withColumn("offset", F.lit("mine")).coalesce(1)
    found = packing.pack(frame).collect()
    stream = check(found, rows, tokenizer, packing.WINDOW)
    for doc_id, text in rows:
        parts = sorted((s, ids) for (d, s), ids in stream.items() if d == str(doc_id))
        assert [i for _, ids in parts for i in ids] == ids_of(tokenizer, text)
        assert [s for s, _ in parts] == np.cumsum([0, *[len(p) for _, p in parts]])[:-1].tolist()


def test_blocks_and_little_padding(spark, tokenizer, monkeypatch):
    rows = [(i % 90, " ".join(long_text(7, i * 31 + k) + "." for k in range(i % 60))) for i in range(300)]
    rows += [(None, "null id"), (None, "null id")]
    small = lambda: packing.pack(docs(spark, rows).coalesce(1), window=256)
    found = small().collect()
    check(found, rows, tokenizer, 256)
    filled = defaultdict(int)
    for r in found:
        filled[r.sequence_id] += r.length
    padding = sum(packing.padding(n, 256) for n in filled.values())
    assert padding < 0.08 * sum(filled.values())


def test_blocks_join_without_loss(tokenizer):
    words = packing.Words(packing.default_vocabulary())
    texts = [" ".join(long_text(9, i + k) + "." for k in range(20)) for i in range(40)]
    ids = words.encode(pa.array(texts))
    stream = packing.Stream(words.sentence_ends, 256, 10)
    made = []
    for key, own in enumerate(ids):
        stream.add(key, own)
        if stream.held >= 3000:
            made += stream.cut(final=False)
    made += stream.cut(final=True)
    for key, own in enumerate(ids):
        parts = [p for p in made if p[0] == key]
        assert np.concatenate([p[2] for p in parts]).tolist() == own.tolist()
    assert sorted({p[4] for p in made}) == list(range(10, 10 + len({p[4] for p in made})))


def test_crc_of_the_ids(spark):
    row = packing.pack(docs(spark, [(1, "hello")])).select("ids", F.crc32("ids").alias("c")).first()
    assert zlib.crc32(bytes(row.ids)) == row.c


def test_empty_table(spark):
    assert packing.pack(docs(spark, [])).count() == 0
