import random

from pyspark.sql import functions as F

from harvestline.llm import line_dedup

from .helpers import docs, long_text


def brute(rows):
    """Line by line against every line before it."""
    def place(doc_id, pos):
        return doc_id is None, doc_id or 0, pos

    lines = [
        (place(i, pos), frozenset(line.lower().split()))
        for i, text in rows
        if text is not None
        for pos, line in enumerate(text.split("\n"))
    ]

    def goes(at, own):
        return bool(own) and any(
            p < at and 5 * len(own & other) >= 4 * len(own | other) for p, other in lines if other
        )

    made = []
    for i, text in rows:
        if text is None:
            made.append((str(i), "None", 0, 0))
            continue
        split = text.split("\n")
        kept = [
            line for pos, line in enumerate(split) if not goes(place(i, pos), frozenset(line.lower().split()))
        ]
        made.append((str(i), "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(made)


def check(spark, rows):
    found = line_dedup.dedup_lines(docs(spark, rows)).collect()
    got = sorted((str(r.doc_id), str(r.text), r.n_lines, r.n_removed) for r in found)
    assert got == brute(rows)
    return got


def near_copies(rng, n=60):
    base = [f"t{k}" for k in range(25)]
    made = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(25)] = f"edit{rng.randrange(200)}"
        lines = [" ".join(words), " ".join(rng.sample(["a", "b", "c", "d", "e", "f"], rng.randint(1, 6)))]
        made.append((i * 3, "\n".join(lines)))
    return made


def test_equal_to_brute_force(spark):
    rng = random.Random(5)
    rows = near_copies(rng)
    rows += [
        (500, None),
        (501, ""),
        (502, "\n\n \n"),
        (503, "A b\tC\x0bd\nd c b a\n\nA  B"),
        (503, "A b\tC\x0bd\nd c b a\n\nA  B"),
        (504, "ends with a line feed\n"),
        (None, "Null id line here\nd c b a"),
        (None, "Null id line here\nother words of it"),
        (505, long_text(4000) + "\n" + long_text(3990)),
        (506, long_text(3500)),
        (507, "one\none two three four five\none two three four"),
    ]
    got = check(spark, rows)
    assert sum(r[3] for r in got) > 60


def test_one_line_in_very_many_documents(spark):
    rows = [(i, f"The very common line of all\nown {i} words{i} here{i} now{i}") for i in range(800)]
    got = check(spark, rows)
    assert sum(r[3] for r in got) == 799


def test_columns_stay_and_no_rows(spark):
    frame = docs(spark, [(2, "x y"), (1, "X Y")]).withColumns(
        {"N_Lines": F.lit("mine"), "words": F.lit(1), "s": F.lit(2), "none": F.lit(3)}
    )
    found = line_dedup.dedup_lines(frame)
    assert found.columns == [*docs(spark, []).columns, "words", "s", "none", "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.words) for r in found.collect()) == [(1, "X Y", 1), (2, "", 1)]
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_prefixes_are_stored_as_one_row_a_line(spark):
    lines = ["one two three four five six seven eight nine ten", "one two three", "alone"]
    distinct = spark.createDataFrame(list(enumerate(lines)), "s long, line string")
    prefix = line_dedup.prefixes(distinct, line_dedup.bucket_classes(distinct))
    assert [(r.s, r.n, len(r.words)) for r in prefix.orderBy("s").collect()] == [
        (0, 10, 3), (1, 3, 1), (2, 1, 1)
    ]
    each = line_dedup.each_word(prefix).where("s = 0").orderBy("i").collect()
    assert [r.i for r in each] == [0, 1, 2] and sorted(r.word for r in each) == [r.word for r in each]


def test_long_bitmaps_keep_matches_and_drop_others(spark):
    base = [f"w{k}" for k in range(300)]
    lines = [" ".join(base), " ".join(base[:-30] + [f"x{k}" for k in range(30)]), " ".join(f"o{k}" for k in range(300))]
    held = spark.createDataFrame(list(enumerate(lines)), "s long, line string")
    prefix = {r.s: r.bits for r in line_dedup.prefixes(held, line_dedup.bucket_classes(held)).collect()}
    assert (prefix[0] ^ prefix[2]).bit_count() <= 300 + 300 - 2 * 267
    pairs = spark.createDataFrame([(1, 0), (2, 0), (2, 1)], "s long, t long")
    assert [(r.s, r.t) for r in line_dedup._close(pairs, held).collect()] == [(1, 0)]


def test_text_is_stored_before_lines_are_shuffled_by_place(spark):
    found = line_dedup.lines(line_dedup._texts(docs(spark, [(1, "b a\nc"), (0, "c\nb a d")]), "doc_id", "text"))
    distinct = line_dedup.distinct_lines(found)
    assert "Exchange" not in distinct._jdf.queryExecution().executedPlan().toString()
    assert [r.line for r in distinct.orderBy("s").collect()] == ["c", "b a d", "b a"]


def test_slices_of_prefix_words_make_all_pairs(spark):
    rows = [(0, 4, 7, [2, 3]), (1, 4, 7, [2, 9]), (2, 4, 7, [5, 3]), (3, 4, 7, [8])]
    prefix = spark.createDataFrame(rows, "s long, n int, bits long, words array<long>")
    made = [line_dedup._met_in_slice(prefix, prefix, k).collect() for k in range(line_dedup.SLICES)]
    assert sorted({(r.s, r.t) for part in made for r in part}) == [(1, 0)]
    assert all(line_dedup.SLICES > 1 and len(part) <= 1 for part in made)


def test_candidates_do_not_grow_with_common_words(spark, monkeypatch):
    rng = random.Random(7)
    lines = [" ".join(rng.sample([f"v{k}" for k in range(6000)], 150)) for _ in range(160)]
    asked = []

    def counted(pairs, distinct, verified=line_dedup._verified):
        asked.append(pairs.count())
        return verified(pairs, distinct)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    edited = lines[3].split()[:140] + [f"x{k}" for k in range(10)]
    got = check(spark, list(enumerate([*lines, " ".join(edited)])))
    assert [r[0] for r in got if r[3]] == ["160"]
    assert 1 <= sum(asked) < len(lines) ** 2 / 20


def test_lines_at_the_threshold_meet(spark):
    rng = random.Random(11)
    vocabulary = [f"u{k}" for k in range(60)]
    made = []
    for n in [*range(1, 24), 40, 45, 50]:
        for _ in range(6):
            own = rng.sample(vocabulary, n)
            less = rng.randint(0, n // 5)
            left = rng.sample(own, n - less)
            most = max(k for k in range(n) if 5 * len(left) >= 4 * (n + k)) if 5 * len(left) >= 4 * n else 0
            made += [own, left + [f"n{rng.randrange(10**6)}" for _ in range(rng.choice([most, most + 1]))]]
    rows = [(i, "\t ".join(words) + "\r") for i, words in enumerate(made)]
    got = check(spark, rows)
    assert sum(r[3] for r in got) > 60


def test_stretches_of_neighbours_meet_where_they_begin(spark):
    rows = [(0, [7, 8, 9]), (1, [7, 8, 9]), (2, [6, 8, 9]), (3, [8, 5, 9])]
    prefix = spark.createDataFrame([(s, 50, 0, words) for s, words in rows], "s long, n int, bits long, words array<long>")
    met = line_dedup._with_before(line_dedup.each_word(prefix), prefix.where("s = 1").select("s"), prefix.withColumn("half", F.lit(0).cast("long")))
    assert {r.s for r in met.where("matched").collect()} == {1}
    found = [r for k in range(line_dedup.SLICES) for r in line_dedup._met_in_slice(met, met, k).collect()]
    assert sorted((r.s, r.t) for r in found) == [(1, 0), (2, 0), (2, 1), (3, 0), (3, 0), (3, 1), (3, 1), (3, 2), (3, 2)]


def stages_seen(monkeypatch):
    """Names of the tables kept and dropped, in order."""
    seen = []

    def kept(frame, name, keep=line_dedup.keep):
        made = keep(frame, name)
        made.named = name
        seen.append(("keep", name))
        return made

    def dropped(*frames, drop=line_dedup.drop):
        seen.extend(("drop", frame.named) for frame in frames)
        drop(*frames)

    monkeypatch.setattr(line_dedup, "keep", kept)
    monkeypatch.setattr(line_dedup, "drop", dropped)
    return seen


def test_prefixes_are_gone_before_texts_are_shuffled(spark, monkeypatch):
    seen = stages_seen(monkeypatch)
    check(spark, near_copies(random.Random(3), 20))
    assert seen.index(("drop", "prefixes")) < seen.index(("keep", "asked-lines"))


def test_texts_and_keys_of_all_lines_are_not_sorted_for_joins(spark, monkeypatch):
    plans = {}

    def kept(frame, name, keep=line_dedup.keep):
        plans[name] = frame._jdf.queryExecution().executedPlan().toString()
        return keep(frame, name)

    monkeypatch.setattr(line_dedup, "keep", kept)
    check(spark, near_copies(random.Random(4), 20))
    for name, sorted_ in [("asked-lines", "s#"), ("shared", "word#"), ("removed-lines", "k1#")]:
        assert "ShuffledHashJoin" in plans[name] and f"SortMergeJoin [{sorted_}" not in plans[name]


def test_fate_holds_lines_that_may_go_alone(spark, monkeypatch):
    fates = []

    def kept(frame, name, keep=line_dedup.keep):
        made = keep(frame, name)
        if name == "fate":
            fates.append(made.count())
        return made

    monkeypatch.setattr(line_dedup, "keep", kept)
    check(spark, [(1, "a b c\nonly here"), (2, "a b c\nhere alone, once"), (3, "p q r s t"), (4, "p q r s t u")])
    assert fates == [2]


def test_codes_are_plain_numbers_and_blanks_are_no_words(spark):
    distinct = spark.createDataFrame([(0, "  a  b "), (1, "b a"), (2, "b b a a")], "s long, line string")
    prefix = line_dedup.prefixes(distinct, line_dedup.bucket_classes(distinct))
    assert prefix.schema["chain"].dataType.containsNull is False
    got = [(r.n, r.bits, r.half, r.words, r.chain) for r in prefix.orderBy("s").collect()]
    assert got[0][0] == 2 and got[0] == got[1] == got[2]
    pairs = line_dedup.each_word(line_dedup.neighbours(prefix)).orderBy("s", "i").collect()
    assert len({r.word for r in pairs}) == len(pairs) / 3


def test_lower_case_ends_with_the_line(spark):
    check(spark, [(1, "\u039f\u03a3\n\u0391 x"), (2, "\u03bf\u03c2\n\u0130 y"), (3, "\u039f\u03a3\u0391 z\n\u039f\u03a3")])
