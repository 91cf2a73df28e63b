"""Small frames with the awkward cases that every operator has to stand."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=DOCS):
    """Documents of (id, text) pairs; the other columns are filled in."""
    full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, schema)


def long_text(words: int, seed: int = 0) -> str:
    return " ".join(f"w{(i * 7919 + seed) % 9973}" for i in range(words))
