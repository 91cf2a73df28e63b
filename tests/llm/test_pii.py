import random
import re

from pyspark.sql import functions as F

from harvestline.llm import pii

from .helpers import docs, long_text

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p.lstrip("0")[:4] or 0) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    return sorted(
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    )


def base_spans(row):
    return [(s.start, s.rank, s.end, s.kind) for s in row[pii.SPANS] if s.rank < len(pii.BASE)]


def noise(rng):
    parts = ["a@b.c", "_d@e.f", "@", ".", "1.2.3.4", ".5.6.7.8", "256", "4111 1111 1111 1111", "-",
             "+1 (202) 555-0147", "+", "x", "é", "𝒳", " ", "\n", "0049", "5500-0000-0000-0004", "a.b"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(4)
    texts = [noise(rng) for _ in range(1500)]
    texts += ["a@b.cc_d@e.f@g.h", "1.2.3.4.5.6.7.8", "1" * 40, "9" * 5000 + ".1.1.1", None, ""]
    texts += ["mail " + long_text(2000) + " 𝒳 me@x.org " * 1200, "a" * 50_000 + "@", "a." * 30_000]
    texts += ["x@" + "y." * 20_000 + "z"]
    rows = [(i, t) for i, t in enumerate(texts)]
    for row in pii.find_pii(docs(spark, rows)).collect():
        assert base_spans(row) == brute(row.text), row.doc_id


def test_added_kinds_need_a_checksum_or_context(spark):
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00 is mine"),
        (2, "IBAN DE89 3704 0044 0532 0130 01 is not"),
        (3, "social security 123-45-6789"),
        (4, "part 123-45-6789"),
        (5, "card 4111111111111111 and version 4111111111111111"),
    ]
    found = {r.doc_id: [(s.kind, s.value) for s in r[pii.SPANS]] for r in pii.find_pii(docs(spark, rows)).collect()}
    assert found[1] == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert ("iban", "DE89 3704 0044 0532 0130 01") not in found[2]
    assert found[3] == [("ssn", "123-45-6789")]
    assert found[4] == []
    scores = [s.score for r in pii.find_pii(docs(spark, rows[4:])).collect() for s in r[pii.SPANS]]
    assert scores == [1.0, 0.4]


def test_repeated_rows_clashing_columns_and_no_rows(spark):
    rows = [(None, "a@b.c"), (None, "a@b.c")]
    frame = docs(spark, rows).withColumns({"PII": F.lit(1), "_hl_ip_found": F.lit(2)})
    found = pii.find_pii(frame)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "pii"]
    assert [len(r[pii.SPANS]) for r in found.collect()] == [1, 1]
    assert pii.find_pii(docs(spark, [])).count() == 0


def test_spelling(spark):
    row = pii.find_pii(docs(spark, [(1, "+49 30 1234567 a@b.c")])).select(
        pii.spelled(F.col(pii.SPANS)).alias("s"), pii.count_kind(F.col(pii.SPANS), "email").alias("n")
    ).first()
    assert (row.s, row.n) == ("phone:0:14,email:15:20", 1)


def test_running_totals_over_several_blocks(spark):
    row = spark.range(1).select(
        pii.running_totals(F.transform(F.sequence(F.lit(1), F.lit(1300)), lambda x: x.cast("long"))).alias("t")
    ).first()
    assert row.t == [n * (n + 1) // 2 for n in range(1, 1301)]
