"""Text scores of a unigram model and of a hidden Markov model over it.

A word is emitted by a latent state in two steps: the state emits the word's
class, and the class the word in proportion to the unigram model. Classes are few
and fixed in number: one for each of the ``TOP`` most frequent words, one for
each of ``SUFFIXES`` hashed word ends, one for the end of a text and one for
unknown words. So the Baum-Welch counts of a task are a table of fixed size,
whatever the corpus, and the score of a text is exact: its unigram score plus what
the scaled forward recursion over its classes gains on independent classes.

Word counts are exact and never in one place. Texts are put into slabs, as places in
the slab's list of different words; those words are joined with the counts and brought
back to the slab, where the places find theirs. Nothing that grows with the vocabulary
is broadcast, and no text is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from harvestline.llm.common import (
    Batches,
    bucket_of_id,
    drop,
    importable,
    keep,
    map_arrow,
    slabs,
    split_words,
)

SLAB = 8 << 20  # bytes of text
FOLDS, HELD_FOLD = 5, 1
STATES = 8
TOP = 2000
SUFFIXES = 4096
SUFFIX_BYTES = 3
UNKNOWN, END = 0, 1
FIRST_TOP = 2
FIRST_SUFFIX = FIRST_TOP + TOP
CLASSES = FIRST_SUFFIX + SUFFIXES
ITERATIONS = 5
STAY = 0.98  # first chance to stay in a state
PRIOR = 300.0  # pseudo-counts of a state, spread as the unigram model has its classes
SEED = 5
TRAINED_AT_ONCE = 1 << 19  # tokens; their states are held for the way back
SCORED_AT_ONCE = 1 << 22
PART = 2048  # longest run of tokens that is trained on as one
FIXED_POINT = 1 << 16  # counts are summed as whole numbers, so in any order alike
END_TOKEN = xxhash.xxh64_intdigest(b" end of text ") - (1 << 63)  # a word has no blank


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def suffix_class(word: bytes) -> int:
    return FIRST_SUFFIX + zlib.crc32(word[-SUFFIX_BYTES:]) % SUFFIXES


# --- words and their counts ---------------------------------------------------


ENCODED = (
    StructField("slab", LongType()),
    StructField("index", BinaryType()),
    StructField("tokens", ArrayType(LongType())),
    StructField("suffixes", ArrayType(IntegerType())),
    StructField("counts", ArrayType(LongType())),
)


def encoded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts by slab, each as the places of its words in the word list of the slab.

    A slab is about ``SLAB`` bytes of text. It has a row for each text, with ``index``
    (32-bit), and one with its different ``tokens``, their suffix classes and training counts.
    So a text is split into words once, and no text is shuffled.
    """
    held = F.coalesce(bucket_of_id(id_col, FOLDS) == HELD_FOLD, F.lit(False))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held_out")
    )
    schema = StructType([rows.schema["id"], rows.schema["held_out"], *ENCODED])

    def encode(batches: Batches) -> Batches:
        slab = TaskContext.get().partitionId() << 36
        for batch in batches:
            for first, texts in slabs(batch.column(1), SLAB):
                slab += 1
                own = batch.slice(first, len(texts))
                held = own.column(2).to_numpy(zero_copy_only=False)
                words, ends = split_words(texts)
                coded = words.dictionary_encode()
                unique = [w.encode() for w in coded.dictionary.to_pylist()]
                place = coded.indices.to_numpy().astype("<i4")
                trains = np.repeat(~held, np.diff(ends))
                count = np.append(
                    np.bincount(place[trains], minlength=len(unique)), (~held).sum()
                )
                index = [place[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                lists = (
                    [[*map(word_hash, unique), END_TOKEN]],
                    [[*map(suffix_class, unique), END]],
                    [count],
                )
                nulls = len(texts)
                columns = [
                    pa.concat_arrays([own.column(0), pa.nulls(1, own.column(0).type)]),
                    pa.concat_arrays([own.column(2), pa.array([False])]),
                    pa.repeat(pa.scalar(slab, pa.int64()), nulls + 1),
                    pa.array([*index, None], pa.binary()),
                    *[
                        pa.concat_arrays([pa.nulls(nulls, pa.list_(t)), pa.array(x, pa.list_(t))])
                        for x, t in zip(lists, (pa.int64(), pa.int32(), pa.int64()), strict=True)
                    ],
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_arrow(rows, encode, schema)


def slab_words(slabs_: DataFrame) -> DataFrame:
    """``slab``, ``place``, ``token``, ``suffix``, ``n``: different words and their training counts."""
    each = F.posexplode(F.arrays_zip("tokens", "suffixes", "counts")).alias("place", "word")
    return slabs_.where("tokens IS NOT NULL").select("slab", each).select(
        "slab",
        "place",
        F.col("word.tokens").alias("token"),
        F.col("word.suffixes").alias("suffix"),
        F.col("word.counts").alias("n"),
    )


def vocabulary(words: DataFrame) -> DataFrame:
    """``token``, ``c``, ``class`` of every word, also of those only in held-out texts."""
    counts = keep(
        words.groupBy("token").agg(F.sum("n").alias("c"), F.max("suffix").alias("suffix")),
        "word-counts",
    )
    top = counts.where((F.col("c") > 0) & (F.col("token") != END_TOKEN))
    found = top.orderBy(F.desc("c"), "token").select("token").limit(TOP).collect()
    own = counts.sparkSession.createDataFrame(
        [(t, FIRST_TOP + i) for i, (t,) in enumerate(found)], "token long, own int"
    )
    class_ = F.when(F.col("c") == 0, UNKNOWN).otherwise(F.coalesce("own", "suffix"))
    return keep(
        counts.join(F.broadcast(own), "token", "left").select("token", "c", class_.alias("class")),
        "vocabulary",
    )


SEQUENCES = (
    StructField("held_out", BooleanType()),
    StructField("n_tokens", LongType()),
    StructField("n_known", LongType()),
    StructField("log_counts", DoubleType()),
    StructField("classes", BinaryType()),
)


def sequences(slabs_: DataFrame, words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per text its class sequence (16-bit), token counts and sum of log10(c + 0.5)."""
    texts = slabs_.where("index IS NOT NULL").select("id", "held_out", "slab", "index")
    known = words.select(F.col("slab").alias("word_slab"), "place", "token")
    known = known.join(vocab, "token").drop("token")
    importable(texts.sparkSession)

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right["place"].to_numpy()
        count, class_ = np.zeros(len(place), np.int64), np.zeros(len(place), "<i2")
        count[place], class_[place] = right["c"].to_numpy(), right["class"].to_numpy()
        logs, known_ = np.log10(count + 0.5), count > 0
        end = np.full(1, len(place) - 1, "<i4")
        out = []
        for index in left["index"].to_pylist():
            at = np.append(np.frombuffer(index, "<i4"), end)
            out.append((len(at), known_[at].sum(), logs[at].sum(), class_[at].tobytes()))
        tokens, known_tokens, log_counts, classes = zip(*out, strict=True)
        return pa.table(
            {
                "id": left["id"],
                "held_out": left["held_out"],
                "n_tokens": pa.array(tokens, pa.int64()),
                "n_known": pa.array(known_tokens, pa.int64()),
                "log_counts": pa.array(log_counts, pa.float64()),
                "classes": pa.array(classes, pa.binary()),
            }
        )

    schema = StructType([texts.schema["id"], *SEQUENCES])
    return (
        texts.groupBy("slab").cogroup(known.groupBy("word_slab")).applyInArrow(rows, schema)
    )


# --- the model ------------------------------------------------------------------


@dataclass
class Model:
    first: np.ndarray  # chance of a state at the start
    move: np.ndarray  # from state, to state
    emit: np.ndarray  # of a class, by class and state
    plain: np.ndarray  # log10 of the class chances of the unigram model


def with_unknown(emit: np.ndarray, unknown: float) -> np.ndarray:
    """Class chances of every state, with that of unknown words set.

    Training texts have no unknown word. The share of words seen once among all
    tokens tells how often a new text has one (Good-Turing).
    """
    emit = emit.copy()
    emit[UNKNOWN] = 0
    emit *= (1 - unknown) / np.maximum(emit.sum(axis=0), 1e-300)
    emit[UNKNOWN] = unknown
    return emit


def start_model(plain: np.ndarray, unknown: float) -> Model:
    """Alike states, each with its own fixed disturbance of the unigram chances."""
    noise = np.random.default_rng(SEED).normal(0, 0.5, (CLASSES, STATES))
    emit = plain[:, None] * np.exp(noise)
    other = (1 - STAY) / max(1, STATES - 1)
    move = np.where(np.eye(STATES) > 0, STAY, other)
    with np.errstate(divide="ignore"):
        logs = np.log10(plain)
    return Model(np.full(STATES, 1 / STATES), move, with_unknown(emit, unknown), logs)


def in_parts(column: pa.Array) -> list[np.ndarray]:
    """Class sequences to train on; one of over ``PART`` tokens counts as several."""
    held = [np.frombuffer(b, dtype="<i2") for b in column.to_pylist()]
    return [h[i : i + PART] for h in held for i in range(0, len(h), PART)]


def lanes(held: list[np.ndarray], at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of like length side by side: their places, class by step and text, lengths."""
    order = sorted(range(len(held)), key=lambda i: -len(held[i]))
    while order:
        longest = len(held[order[0]])
        count = max(1, at_once // longest)
        part, order = order[:count], order[count:]
        steps = np.zeros((longest, len(part)), dtype=np.int16)
        for lane, i in enumerate(part):
            steps[: len(held[i]), lane] = held[i]
        yield np.array(part), steps, np.array([len(held[i]) for i in part])


def forward(model: Model, steps: np.ndarray, size: np.ndarray, every: np.ndarray | None = None):
    """Scale factors by step and text; states after each step go to ``every`` if given.

    Texts come longest first, so those still running are the first ones.
    """
    running = np.searchsorted(-size, -np.arange(len(steps)), side="left")
    scale = np.ones(steps.shape)
    state = np.broadcast_to(model.first, (steps.shape[1], STATES))
    for t, n in enumerate(running):
        state = state[:n] if t == 0 else state[:n] @ model.move
        state = state * model.emit[steps[t, :n]]
        total = state.sum(axis=1)
        state /= total[:, None]
        scale[t, :n] = total
        if every is not None:
            every[t, :n] = state
    return scale, running


def expected(model: Model, steps: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Baum-Welch counts of one batch: starts, moves, emissions by class and state."""
    alpha = np.zeros((*steps.shape, STATES))
    scale, running = forward(model, steps, size, alpha)
    after = np.zeros_like(alpha)  # emission times backward value, over the scale
    back = np.ones((steps.shape[1], STATES))
    beta = np.zeros_like(alpha)
    for t in range(len(steps) - 1, -1, -1):
        n = running[t]
        beta[t, :n] = back[:n]
        step = back[:n] * model.emit[steps[t, :n]] / scale[t, :n, None]
        after[t, :n] = step
        back[:n] = step @ model.move.T
    gamma = (alpha * beta).reshape(-1, STATES)
    moves = model.move * (alpha[:-1].reshape(-1, STATES).T @ after[1:].reshape(-1, STATES))
    flat = steps.ravel()
    emits = np.stack(
        [np.bincount(flat, gamma[:, k], minlength=CLASSES) for k in range(STATES)], axis=1
    )
    return gamma[: steps.shape[1]].sum(axis=0), moves, emits


def counts_of(trained: DataFrame, model: Model) -> np.ndarray:
    """Baum-Welch counts over all texts: a flat table of starts, moves and emissions.

    Each task adds up its own and hands on one row a non-zero cell.
    """
    shared = trained.sparkSession.sparkContext.broadcast(model)
    cells = STATES + STATES * STATES + CLASSES * STATES

    def rows(batches: Batches) -> Batches:
        total = np.zeros(cells)
        for batch in batches:
            for _, steps, size in lanes(in_parts(batch.column(0)), TRAINED_AT_ONCE):
                found = expected(shared.value, steps, size)
                total += np.concatenate([f.ravel() for f in found])
        whole = np.rint(total * FIXED_POINT).astype(np.int64)
        some = np.flatnonzero(whole)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(whole[some])], ["cell", "n"])

    sums = map_arrow(trained.select("classes"), rows, "cell long, n long")
    table = np.zeros(cells)
    found = sums.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table[found["cell"].to_numpy()] = found["n"].to_numpy() / FIXED_POINT
    return table


def baum_welch(
    trained: DataFrame, plain: np.ndarray, unknown: float, iterations: int = ITERATIONS
) -> Model:
    """Model trained on the class sequences.

    ``plain`` has the unigram class chances, ``unknown`` is the chance of an unknown word.
    """
    model = start_model(plain, unknown)
    for _ in range(iterations):
        table = counts_of(trained, model)
        first, move, emit = np.split(table, [STATES, STATES + STATES * STATES])
        move, emit = move.reshape(STATES, STATES), emit.reshape(CLASSES, STATES)
        emit = emit + PRIOR * plain[:, None]
        model = Model(
            (first + 1) / (first + 1).sum(),
            (move + 1) / (move + 1).sum(axis=1, keepdims=True),
            with_unknown(emit, unknown),
            model.plain,
        )
    return model


def gains(model: Model, column: pa.Array) -> np.ndarray:
    """What each class sequence gains in log10 on independent classes."""
    result = np.zeros(len(column))
    held = [np.frombuffer(b, dtype="<i2") for b in column.to_pylist()]
    for part, steps, size in lanes(held, SCORED_AT_ONCE):
        scale, _ = forward(model, steps, size)
        plain = np.where(np.arange(len(steps))[:, None] < size, model.plain[steps], 0.0)
        result[part] = np.log10(scale).sum(axis=0) - plain.sum(axis=0)
    return result


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", iterations: int = ITERATIONS
) -> DataFrame:
    """One row per input row: the id and the scores of its text.

    ``held_out`` texts teach nothing. ``n_tokens``: words and one end; ``n_known``:
    those with training counts; ``train_tokens``: all training tokens;
    ``base_score``: log10 probability by the smoothed unigram model; ``score``: by
    the hidden Markov model. A null text counts as empty, a null id is not held
    out. Without training texts every token is the unknown one, and both scores
    are those of a certain event. Other columns are not carried.
    """
    places = keep(encoded(docs, id_col, text_col), "encoded")
    words = slab_words(places)
    vocab = vocabulary(words)
    coded = keep(sequences(places, words, vocab), "sequences")
    drop(places)

    seen = F.when(F.col("c") > 0, 1).otherwise(0)
    once = F.when(F.col("c") == 1, 1).otherwise(0)
    classes = vocab.where("c > 0").groupBy("class").agg(
        F.sum("c").alias("c"), F.sum(seen).alias("v"), F.sum(once).alias("once")
    ).collect()
    total, size = sum(r.c for r in classes), sum(r.v for r in classes)
    mass = total + 0.5 * (size + 1)
    plain = np.zeros(CLASSES)
    plain[UNKNOWN] = 0.5 / mass
    for r in classes:
        plain[r["class"]] = (r.c + 0.5 * r.v) / mass

    unknown = (sum(r.once for r in classes) + 0.5) / (total + 1) if total else 1.0
    model = baum_welch(coded.where("NOT held_out"), plain, unknown, iterations)
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            names = batch.schema.names
            tokens = batch.column("n_tokens").to_numpy()
            base = batch.column("log_counts").to_numpy() - tokens * np.log10(mass)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in range(4)],
                    pa.repeat(pa.scalar(int(total), pa.int64()), len(tokens)),
                    pa.array(base),
                    pa.array(base + gains(shared.value, batch.column("classes"))),
                ],
                [*names[:4], "train_tokens", "base_score", "score"],
            )

    schema = StructType(
        [
            StructField("id", coded.schema["id"].dataType),
            *SEQUENCES[:3],
            StructField("train_tokens", LongType()),
            StructField("base_score", DoubleType()),
            StructField("score", DoubleType()),
        ]
    )
    return map_arrow(coded, rows, schema).withColumnRenamed("id", id_col)
