"""Personal data in whole texts: spans with kind and score, in SQL functions only.

Patterns propose spans, checksums and ranges confirm them, and words just before
a span raise or lower its score. Spans of the base kinds (email, ip, card, phone)
stay whatever their score; of the added kinds (iban, ssn) those with a score of
``MIN_SCORE`` stay.

The places of all matches come from splitting the text at them: a match starts
after all pieces and matches before it. A character that a pattern can only start
with is never tried in the middle of a run, and loops give nothing back, so the
time is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestline.llm.common import without

SPANS = "pii"
MIN_SCORE = 0.5
CONTEXT = 40  # characters before a span that are looked at
NEAR, FAR = 0.3, -0.3  # what context words add
BLOCK = 512  # numbers summed at once by running_totals
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _fold(text: Column, start: int, step: Callable[[Column, Column, Column], Column]) -> Column:
    """``step(state, character, index)`` over the characters of a short text."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(text)),
        F.lit(start),
        lambda state, i: step(state, F.substr(text, i, F.lit(1)), i),
    )


def luhn(digits: Column) -> Column:
    """True if the last digit is the Luhn check digit of the others."""
    size = F.length(digits)

    def step(state: Column, digit: Column, i: Column) -> Column:
        value = digit.cast("int")
        twice = value * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return state + F.when((size - i) % 2 == 1, doubled).otherwise(value)

    return _fold(digits, 0, step) % 10 == 0


def mod97(account: Column) -> Column:
    """Remainder of an account number with letters as 10 to 35, its head moved to the end."""
    plain = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(state: Column, char: Column, _: Column) -> Column:
        letter = F.ascii(char) - 55
        digit = F.ascii(char) - 48
        return F.when(char < "A", (state * 10 + digit) % 97).otherwise((state * 100 + letter) % 97)

    return _fold(moved, 0, step)


@dataclass(frozen=True)
class Kind:
    name: str
    mark: str  # every text with a span matches it, and it is quick to look for
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    near: str
    far: str = r"\b(example|sample|dummy|version|isbn|invoice|order)\b"


def _between(size: Column, low: int, high: int) -> Column:
    return size.between(low, high)


BASE = (
    Kind(
        "email",
        "@",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
        lambda v: F.lit(True),
        0.9,
        r"\b(e-?mail|mail|contact|write)\b",
    ),
    Kind(
        "ip",
        ".",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        0.6,
        r"\b(ip|host|server|address|ping)\b",
    ),
    Kind(
        "card",
        "",
        r"[0-9](?:[\x20-]?[0-9]){13,}+",
        lambda v: _between(F.length(_digits(v)), 14, 19) & luhn(_digits(v)),
        0.7,
        r"\b(card|visa|mastercard|credit|pay(?:ment)?)\b",
    ),
    Kind(
        "phone",
        "+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda v: _between(F.length(_digits(v)), 10, 15),
        0.6,
        r"\b(phone|tel|call|mobile|fax)\b",
    ),
)
ADDED = (
    Kind(
        "iban",
        "",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
        r"(?![A-Za-z0-9])",
        lambda v: mod97(v) == 1,
        0.9,
        r"\b(iban|account|bank|konto|cuenta|compte)\b",
    ),
    Kind(
        "ssn",
        "-",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda v: F.lit(True),
        0.4,
        r"\b(ssn|social|security)\b",
    ),
)
KINDS = (*BASE, *ADDED)


def running_totals(values: Column) -> Column:
    """Sums of the first 1, 2, ... numbers of an array that is not empty.

    In blocks, as an array that grows by one copies itself every time.
    """

    def sums(items: Column, start: Column) -> Column:
        grown = F.aggregate(
            items, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        )
        return F.slice(grown, F.lit(2), F.size(items))

    zero = F.lit(0).cast("long")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)),
    )
    of_blocks = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, x: acc + x))
    starts = F.concat(F.array(zero), sums(of_blocks, zero))
    return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), sums))


def _spans(kind: Kind, rank: int, pieces: Column, found: Column, starts: Column) -> Column:
    """Valid spans of one kind, with their scores."""
    parts = F.arrays_zip(
        found.alias("value"),
        F.slice(pieces, F.lit(1), F.size(found)).alias("before"),
        starts.alias("start"),
    )

    def span(part: Column) -> Column:
        before = F.lower(F.right(part["before"], F.lit(CONTEXT)))
        near = F.when(before.rlike(kind.near), NEAR).otherwise(0.0)
        far = F.when(before.rlike(kind.far), FAR).otherwise(0.0)
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(kind.score) + near + far))
        return F.struct(
            part["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (part["start"] + F.length(part["value"])).alias("end"),
            F.lit(kind.name).alias("kind"),
            part["value"].alias("value"),
            F.round(score, 2).alias("score"),
        )

    spans = F.transform(F.filter(parts, lambda p: kind.valid(p["value"])), span)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= MIN_SCORE)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = SPANS) -> DataFrame:
    """``docs`` with an array of spans by start, then kind as listed.

    A span has ``start`` and ``end`` in code points (end exclusive), ``rank`` (the
    kind's number), ``kind``, ``value`` and ``score``. Matches of one kind do not
    overlap, those of two kinds may. A null or empty text has none. Rows are
    independent, so repeated rows have equal spans; a column named like the new
    one is replaced.
    """
    # Each step is a projection of its own, so no pattern runs twice.
    names = {k.name: [f"_hl_{k.name}_{part}" for part in ("found", "pieces", "starts")] for k in KINDS}
    docs = without(docs, out, *[n for own in names.values() for n in own])
    kept = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    none = F.array().cast("array<string>")

    found = docs.select(
        "*",
        *[
            F.when(text.contains(k.mark), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)))
            .otherwise(none)
            .alias(names[k.name][0])
            for k in KINDS
        ],
    )
    split = found.select(
        "*",
        *[
            F.when(F.size(names[k.name][0]) > 0, F.split(text, k.pattern, -1))
            .otherwise(none)
            .alias(names[k.name][1])
            for k in KINDS
        ],
    )

    def starts(found: Column, pieces: Column) -> Column:
        count = F.size(found)
        earlier = F.concat(F.array(F.lit("")), F.slice(found, F.lit(1), count - 1))
        steps = F.zip_with(
            F.slice(pieces, F.lit(1), count),
            earlier,
            lambda p, m: (F.length(p) + F.length(m)).cast("long"),
        )
        return F.when(count > 0, running_totals(steps)).otherwise(F.array().cast("array<bigint>"))

    placed = split.select(
        "*",
        *[
            starts(F.col(names[k.name][0]), F.col(names[k.name][1])).alias(names[k.name][2])
            for k in KINDS
        ],
    )
    spans = [
        _spans(k, rank, F.col(pieces), F.col(found), F.col(at))
        for rank, k in enumerate(KINDS)
        for found, pieces, at in [names[k.name]]
    ]
    return placed.select(*kept, F.sort_array(F.concat(*spans)).alias(out))


def is_base(span: Column) -> Column:
    return span["rank"] < len(BASE)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined with commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
