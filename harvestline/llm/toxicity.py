"""Toxicity scores by a classifier that is fair to the groups a text mentions.

Features are words and word beginnings, counted once for each different word of
a text. A logistic regression is fitted on labelled texts. For every labelled text
that names a group, a counterfactual is made by naming another group of the same
sort instead; the fit is penalised by the square of the change in score (on the
logit scale), so naming a group does not count by itself.

The fit uses at most ``MAX_TRAIN`` labelled texts, those with the smallest hash
of their id: a parameter, with which the model is small, whatever the corpus. Features
are those tied to the label beyond chance, as many as there are. All texts are scored
whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
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
MAX_TRAIN = 30_000
LEAST_TEXTS = 3  # labelled texts a feature must be in
LEAST_TIE = 4.0  # standard deviations from chance; keeps words out that are common by accident
PREFIXES = (4, 5, 6)
SLAB = 1 << 20
KNOWN = 1 << 17  # words whose weights a task remembers at once
FAIRNESS = 5.0  # weight of the penalty on score changes
RIDGE = 3e-5
STEPS = 300
RATE = 0.05
THRESHOLD = 0.5
SCORE = "toxicity"

# Group terms by sort; a term is swapped for others of its row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "locals", "natives"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("ausländer", "einheimische", "flüchtlinge"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("étrangers", "immigrés", "réfugiés"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
    ("extranjeros", "inmigrantes", "refugiados"),
)
OTHERS = {
    term: [other for other in row if other != term]
    for row in IDENTITY_TERMS
    for term in row
}
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")


def bare(word: str) -> str:
    """A word without marks at either end, lower-case."""
    return (word if word.isalnum() else _EDGES.sub("", word)).lower()


def feature_hashes(word: str) -> list[int]:
    """Features of a word: itself, and each beginning shorter than it."""
    core = bare(word)
    if not core:
        return []
    names = ["=" + core, *[f"{n}{core[:n]}" for n in PREFIXES if len(core) > n]]
    return [xxhash.xxh64_intdigest(n) - (1 << 63) for n in names]


def bags(column: pa.Array) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    """Per slab: the first text, different words, and pairs (text, word), each once."""
    for first, texts in slabs(column, SLAB):
        words, ends = split_words(texts)
        coded = words.dictionary_encode()
        unique = coded.dictionary.to_pylist()
        text = np.repeat(np.arange(len(texts)), np.diff(ends))
        pairs = np.unique(text * max(1, len(unique)) + coded.indices.to_numpy())
        yield first, unique, pairs // max(1, len(unique)), pairs % max(1, len(unique))


@dataclass
class Model:
    features: np.ndarray  # hashes, rising
    weights: np.ndarray
    bias: float

    def logits(self, column: pa.Array) -> np.ndarray:
        """Logit of every text; null counts as empty."""
        result = np.full(len(column), self.bias)
        table = dict(zip(self.features.tolist(), self.weights.tolist(), strict=True))
        known: dict[str, float] = {}
        for first, unique, text, word in bags(column):
            if len(known) > KNOWN:
                known.clear()
            for w in unique:
                if w not in known:
                    known[w] = sum(table.get(h, 0.0) for h in feature_hashes(w))
            weight = np.array([known[w] for w in unique])
            if len(text):
                sums = np.bincount(text, weight[word])
                result[first : first + len(sums)] += sums
        return result


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def text_features(column: pa.Array) -> tuple[list[list[int]], ...]:
    """Feature hashes of every text, and those a counterfactual takes away and adds.

    Each group term of the text is replaced by one other of its row.
    """
    held, gone, came = ([[] for _ in range(len(column))] for _ in range(3))
    for first, unique, text, word in bags(column):
        own = [feature_hashes(w) for w in unique]
        cores = [bare(w) for w in unique]
        for k, w in zip((text + first).tolist(), word.tolist(), strict=True):
            held[k] += own[w]
            if others := OTHERS.get(cores[w]):
                other = others[xxhash.xxh64_intdigest(cores[w]) % len(others)]
                gone[k] += own[w]
                came[k] += feature_hashes(other)
    return held, gone, came


def labelled_features(texts: DataFrame) -> DataFrame:
    """``toxic``, ``held``, ``gone``, ``came`` of labelled texts, as feature hashes."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            hashes = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(x, hashes) for x in text_features(batch.column(0)))],
                ["toxic", "held", "gone", "came"],
            )

    schema = "toxic int, held array<long>, gone array<long>, came array<long>"
    return map_arrow(texts.select("text", "toxic"), rows, schema)


def chosen_features(rows: DataFrame) -> np.ndarray:
    """Hashes of the features tied to the label, and of all group terms.

    The tie is the distance from the expected number of toxic texts in standard
    deviations, so it means the same at every share of toxic texts.
    """
    each = rows.select("toxic", F.explode(F.array_distinct("held")).alias("h"))
    counts = each.groupBy("h").agg(
        F.sum("toxic").alias("with_one"), F.count("*").alias("texts")
    )
    ones, all_ = rows.agg(F.sum("toxic"), F.count("*")).first()
    share = (ones or 0) / max(1, all_)
    expected = F.col("texts") * share
    spread = F.sqrt(F.greatest(expected * (1 - share), F.lit(1e-9)))
    tie = F.abs(F.col("with_one") - expected) / spread
    found = (
        counts.where((F.col("texts") >= LEAST_TEXTS) & (tie >= LEAST_TIE))
        .select("h")
        .toArrow()["h"]
        .to_numpy()
    )
    terms = [h for term in OTHERS for h in feature_hashes(term)]
    return np.union1d(found, np.array(terms, dtype=np.int64))


class Sparse:
    """Counts by text and feature; only features of the model are held."""

    def __init__(self, features: np.ndarray, lists: pa.Array, sign: float = 1.0):
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy()
        text = np.repeat(np.arange(len(lists)), size.astype(np.int64))
        at = np.minimum(np.searchsorted(features, flat), max(0, len(features) - 1))
        there = features[at] == flat
        self.text, self.feature = text[there], at[there]
        self.value = np.full(len(self.text), sign)
        self.shape = len(lists), len(features)

    def plus(self, other: Sparse) -> Sparse:
        for name in ("text", "feature", "value"):
            both = np.concatenate([getattr(self, name), getattr(other, name)])
            setattr(self, name, both)
        return self

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, weights[self.feature] * self.value, self.shape[0])

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, errors[self.text] * self.value, self.shape[1])


def fit_rows(table: pa.Table, features: np.ndarray, fairness: float = FAIRNESS) -> Model:
    """Logistic regression with the counterfactual penalty, by Adam on all rows."""
    lists = {k: table[k].combine_chunks() for k in ("held", "gone", "came")}
    label = table["toxic"].to_numpy().astype(float)
    count = len(label)
    if not count:
        return Model(features[:0], np.empty(0), 0.0)
    x = Sparse(features, lists["held"])
    change = Sparse(features, lists["came"]).plus(Sparse(features, lists["gone"], -1.0))
    prior = (label.sum() + 0.5) / (count + 1)
    weights, bias = np.zeros(len(features)), float(np.log(prior / (1 - prior)))
    mean, square = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, STEPS + 1):
        error = sigmoid(x.times(weights) + bias) - label
        grad = x.back(error) / count + RIDGE * weights
        grad += 2 * fairness / count * change.back(change.times(weights))
        both = np.append(grad, error.mean())
        mean = 0.9 * mean + 0.1 * both
        square = 0.999 * square + 0.001 * both * both
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(features, weights, bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = MAX_TRAIN,
    fairness: float = FAIRNESS,
) -> Model:
    """Model from the labelled texts outside the held-out fold.

    A text is toxic if any of its labels is 1; null labels and ids teach nothing.
    Without labelled texts every score is one half.
    """
    marks = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .where(bucket_of_id(id_col, FOLDS) != HELD_FOLD)
        .groupBy(F.col(id_col).alias("_label_id"))
        .agg(F.max(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("toxic"))
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(max_train)
    )
    marks = keep(marks, "labels")
    texts = docs.select(F.col(id_col).alias("_text_id"), F.col(text_col).alias("text"))
    joined = texts.join(marks, texts["_text_id"] == marks["_label_id"]).select("text", "toxic")
    rows = keep(labelled_features(joined), "labelled")
    features = chosen_features(rows)
    return fit_rows(_bounded(rows, features, max_train), features, fairness)


def _bounded(rows: DataFrame, features: np.ndarray, most: int) -> pa.Table:
    """At most ``most`` labelled texts, reduced to the features of the model."""
    shared = rows.sparkSession.sparkContext.broadcast(features)

    def reduce(batches: Batches) -> Batches:
        wanted = pa.array(shared.value)
        for batch in batches:
            columns = [batch.column(0)]
            for lists in batch.columns[1:]:
                flat = lists.flatten()
                inside = pc.is_in(flat, wanted).to_numpy(zero_copy_only=False)
                before = np.append(0, np.cumsum(inside))
                ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                columns.append(
                    pa.ListArray.from_arrays(
                        pa.array(before[ends], pa.int32()), flat.filter(pa.array(inside))
                    )
                )
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(rows, reduce, rows.schema).limit(most).toArrow()


def add_scores(
    docs: DataFrame, model: Model, text_col: str = "text", out: str = SCORE
) -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text; a column of that name is replaced.

    A null or empty text gets the score of a text without features.
    """
    docs = without(docs, out)
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            scores = sigmoid(shared.value.logits(batch.column(place)))
            yield with_columns(batch, **{out: pa.array(scores)})

    return map_arrow(docs, rows, appended(docs, StructField(out, DoubleType())))


def drop_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``docs`` less the rows that score ``THRESHOLD`` or more, all columns kept."""
    model = fit(docs, labels, **how)
    scored = add_scores(docs, model, how.get("text_col", "text"), "_hl_toxicity")
    return scored.where(F.col("_hl_toxicity") < THRESHOLD).drop("_hl_toxicity")
