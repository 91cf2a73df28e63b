"""Quality scores by the votes of the labelled texts that are most alike.

Terms of a text are its words, their shapes (``Word,`` is ``Aa,``), words that repeat
the one before, and how large a share of the text a shape has. Terms tied to the label
are weighed by how much they tell, and the labelled texts are reduced to latent-semantic
vectors by a truncated singular value decomposition. Those vectors are broadcast;
every text is projected the same way, its cosine with all of them is computed in
blocks, and the ``NEIGHBOURS`` nearest vote, each by its similarity.

The labelled texts are at most ``MAX_TRAIN``, those with the smallest hash of their id, a
parameter; the number of terms follows from them. All texts are scored whole, in one
pass without a shuffle. A text without known terms, an empty or null one among
them, gets the share of good texts among the labelled ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from harvestline.llm.common import (
    Batches,
    appended,
    bucket_of_id,
    keep,
    map_arrow,
    slabs,
    split_words,
    with_columns,
    without,
)

FOLDS, HELD_FOLD = 5, 0
MAX_TRAIN = 16_000
LEAST_TEXTS = 5  # labelled texts a term must be in
LEAST_TIE = 4.0  # standard deviations from chance
SHARES = (1 / 64, 1 / 16, 1 / 4)  # of all words of a text
DIMENSIONS = 32
POWER_STEPS = 3
NEIGHBOURS = 15
SHARPNESS = 4  # votes count by this power of the cosine
PRIOR_VOTES = 0.25
BLOCK = 256  # texts whose cosines with all labelled ones are held at once
SLAB = 4 << 20
SEED = 13
THRESHOLD = 0.3
SCORE = "quality"


def shape(word: str) -> str:
    """Runs of capitals, letters and digits as A, a and 0; other characters as they are."""
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def term(name: str) -> int:
    return xxhash.xxh64_intdigest(name) - (1 << 63)


REPEATED = "repeated"


def _counted(text: np.ndarray, code: np.ndarray, codes: int) -> tuple[np.ndarray, ...]:
    """Each different (text, code) and how often it occurs."""
    pair, n = np.unique(text * max(1, codes) + code, return_counts=True)
    return pair // max(1, codes), pair % max(1, codes), n


def text_terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slab: the first text, and (text, term, value) for every term of its texts."""
    for first, texts in slabs(column, SLAB):
        words, ends = split_words(texts, lower=False)
        coded = words.dictionary_encode()
        code, unique = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        size = np.diff(ends)
        text = np.repeat(np.arange(len(texts)), size)
        shapes: dict[str, int] = {REPEATED: 0}
        shape_of = np.array([shapes.setdefault("^" + shape(w), len(shapes)) for w in unique], np.int64)
        again = np.zeros(len(code), bool)
        again[1:] = (code[1:] == code[:-1]) & (text[1:] == text[:-1])
        w_text, w_code, w_count = _counted(text, code, len(unique))
        s_text, s_code, s_count = _counted(
            np.append(text, text[again]),
            np.append(shape_of[code], np.zeros(again.sum(), np.int64)),
            len(shapes),
        )
        share = s_count / np.maximum(size[s_text], 1)
        names = list(shapes)
        out = [
            (w_text, _hashes("=" + w.lower() for w in unique)[w_code], np.sqrt(w_count / size[w_text])),
            (s_text, _hashes(names)[s_code], np.sqrt(share)),
        ]
        for least in SHARES:
            much = share >= least
            hashed = _hashes(f"{least:.4f} {n}" for n in names)
            out.append((s_text[much], hashed[s_code[much]], np.ones(much.sum())))
        yield first, *(np.concatenate(c) for c in zip(*out, strict=True))


def _hashes(names) -> np.ndarray:
    return np.array([term(n) for n in names], np.int64)


@dataclass
class Model:
    terms: np.ndarray  # hashes, rising
    projection: np.ndarray  # a row for each term
    vectors: np.ndarray  # labelled texts, of length one
    labels: np.ndarray
    prior: float

    def project(self, column: pa.Array) -> np.ndarray:
        """Latent-semantic vectors of texts, of length one or zero."""
        out = np.zeros((len(column), self.projection.shape[1]))
        for first, text, hashed, value in text_terms(column):
            at, there = found_at(self.terms, hashed)
            rows = sums_of_rows(text[there], at[there], value[there], self.projection)
            out[first : first + len(rows)] += rows
        return unit(out)

    def scores(self, column: pa.Array) -> np.ndarray:
        made = np.full(len(column), self.prior)
        if not len(self.labels):
            return made
        vectors = self.project(column).astype(np.float32)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(vectors), BLOCK):
            cosine = vectors[at : at + BLOCK] @ self.vectors.T
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            vote = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(float) ** SHARPNESS
            good = (vote * self.labels[near]).sum(axis=1) + PRIOR_VOTES * self.prior
            made[at : at + BLOCK] = good / (vote.sum(axis=1) + PRIOR_VOTES)
        return np.clip(made, 0, 1)


def found_at(terms: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash among the rising terms, and whether it is one of them."""
    if not len(terms):
        return np.zeros(len(hashed), np.int64), np.zeros(len(hashed), bool)
    at = np.minimum(np.searchsorted(terms, hashed), len(terms) - 1)
    return at, terms[at] == hashed


def sums_of_rows(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, matrix: np.ndarray, step: int = 1 << 17
) -> np.ndarray:
    """A sparse matrix, given by its cells, times a dense one; up to the last row with a cell."""
    out = np.zeros((int(row.max()) + 1 if len(row) else 0, matrix.shape[1]))
    order = np.argsort(row, kind="stable")
    for at in range(0, len(order), step):
        cells = order[at : at + step]
        rows = row[cells]
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        out[rows[starts]] += np.add.reduceat(value[cells, None] * matrix[column[cells]], starts)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 1e-12, length, 1.0)


def decompose(
    text: np.ndarray, at: np.ndarray, value: np.ndarray, shape_: tuple[int, int], dims: int
) -> np.ndarray:
    """The main right singular vectors of a sparse matrix, as columns, by subspace iteration."""
    dims = min(dims, *shape_)
    rng = np.random.default_rng(SEED)
    basis = rng.standard_normal((shape_[1], min(shape_[1], dims + 8)))

    def padded(rows: np.ndarray, count: int) -> np.ndarray:
        return np.vstack([rows, np.zeros((count - len(rows), rows.shape[1]))])

    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(basis)[0]
        across = padded(sums_of_rows(text, at, value, basis), shape_[0])
        basis = padded(sums_of_rows(at, text, value, across), shape_[1])
    basis = np.linalg.qr(basis)[0]
    across = padded(sums_of_rows(text, at, value, basis), shape_[0])
    _, _, turned = np.linalg.svd(across, full_matrices=False)
    return basis @ turned[:dims].T


def labelled_terms(texts: DataFrame) -> DataFrame:
    """``id``, ``good``, and the terms of every labelled text with their values."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            terms: list = [[] for _ in range(batch.num_rows)]
            values: list = [[] for _ in range(batch.num_rows)]
            for first, text, hashed, value in text_terms(batch.column(2)):
                order = np.argsort(text, kind="stable")
                edges = np.flatnonzero(np.append(True, np.diff(text[order]) != 0)) if len(order) else []
                for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
                    k = first + int(text[order[a]])
                    terms[k], values[k] = hashed[order[a:b]], value[order[a:b]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(terms, pa.list_(pa.int64())),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                ["id", "good", "terms", "values"],
            )

    return map_arrow(texts, rows, "id long, good int, terms array<long>, values array<double>")


def tied_terms(rows: DataFrame) -> DataFrame:
    """``term``, ``weight`` of terms tied to the label.

    The tie is the distance from the expected number of good texts in standard
    deviations, and so means the same at every share of good texts; the weight is
    the logarithm of how much more often the term is in texts of one label.
    """
    good, every = rows.agg(F.sum("good"), F.count("*")).first()
    good = good or 0
    bad = every - good
    share = good / max(1, every)
    counts = (
        rows.select("good", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("good").alias("with_good"), F.count("*").alias("texts"))
    )
    expected = F.col("texts") * share
    tie = F.abs(F.col("with_good") - expected) / F.sqrt(F.greatest(expected * (1 - share), F.lit(1e-9)))
    odds = F.log((F.col("with_good") + 0.5) / (good + 1)) - F.log(
        (F.col("texts") - F.col("with_good") + 0.5) / (bad + 1)
    )
    return counts.where((F.col("texts") >= LEAST_TEXTS) & (tie >= LEAST_TIE)).select(
        "term", F.abs(odds).alias("weight")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Model from the labelled texts outside the held-out fold.

    A text with several labels is good if half of them are 1; null labels and ids teach
    nothing, and of several texts of an id one counts. Without labelled texts every
    score is one half.
    """
    marks = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .where(bucket_of_id(id_col, FOLDS) != HELD_FOLD)
        .groupBy(F.col(id_col).alias("_label_id"))
        .agg((F.avg((F.col(label_col) == 1).cast("int")) >= 0.5).cast("int").alias("good"))
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(max_train)
    )
    marks = keep(marks, "labels")
    texts = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(marks, F.col("id") == F.col("_label_id"))
        .groupBy("id", "good")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    rows = keep(labelled_terms(texts.select(F.col("id").cast("long"), "good", "text")), "labelled")
    chosen = tied_terms(rows).toArrow().sort_by("term")
    terms, weights = chosen["term"].to_numpy(), chosen["weight"].to_numpy()
    table = _bounded(rows, terms, max_train)
    label = table["good"].to_numpy().astype(float)
    prior = (label.sum() + 0.5) / (len(label) + 1)
    hashed, values = (table[c].combine_chunks() for c in ("terms", "values"))
    size = pc.list_value_length(hashed).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(label)), size)
    at, there = found_at(terms, hashed.flatten().to_numpy())
    text, at = text[there], at[there]
    value = values.flatten().to_numpy()[there] * weights[at] if len(at) else np.empty(0)
    if not len(at):
        return Model(terms[:0], np.zeros((0, 1)), np.zeros((0, 1), np.float32), label[:0], prior)
    main = decompose(text, at, value, (len(label), len(terms)), dimensions)
    vectors = np.zeros((len(label), main.shape[1]))
    made = sums_of_rows(text, at, value, main)
    vectors[: len(made)] = made
    return Model(terms, main * weights[:, None], unit(vectors).astype(np.float32), label, prior)


def _bounded(rows: DataFrame, terms: np.ndarray, most: int) -> pa.Table:
    """At most ``most`` labelled texts by id, reduced to the terms of the model."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def reduce(batches: Batches) -> Batches:
        for batch in batches:
            hashed, values = batch.column(2), batch.column(3)
            inside = found_at(shared.value, hashed.flatten().to_numpy())[1]
            before = np.append(0, np.cumsum(inside))
            ends = hashed.offsets.to_numpy() - hashed.offsets[0].as_py()
            offsets = pa.array(before[ends], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.ListArray.from_arrays(offsets, hashed.flatten().filter(pa.array(inside))),
                    pa.ListArray.from_arrays(offsets, values.flatten().filter(pa.array(inside))),
                ],
                batch.schema.names,
            )

    return map_arrow(rows, reduce, rows.schema).orderBy("id").limit(most).toArrow()


def add_scores(
    docs: DataFrame, model: Model, text_col: str = "text", out: str = SCORE
) -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text; a column of that name is replaced."""
    docs = without(docs, out)
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            scores = shared.value.scores(batch.column(place))
            yield with_columns(batch, **{out: pa.array(scores)})

    return map_arrow(docs, rows, appended(docs, StructField(out, DoubleType())))
