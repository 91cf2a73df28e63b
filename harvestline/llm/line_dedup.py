"""Removal of lines that repeat an earlier line, by an exact set-similarity join.

A line is its set of lower-case words. Two lines match if the Jaccard similarity
of their sets is at least 4/5, and a line goes if any line before it matches, in
order of document id and place, whether that line stays or not.

Equal lines are counted once, at their first place. The words of a line are
ordered by rarity, and each is taken together with the next one (the last with an
end). Of two lines with n and m words, c of them common, each word that is not common
parts one such pair of neighbours at most, so they share 3c - n - m of them or more;
and lines that match share one of their first 2/5 n + 1 (their prefixes). A single
word is shared by ever more lines as they become more; two rare words that are also
neighbours hardly are, but in near copies. Lines that meet there are cut by length, by
the place of the shared neighbours and by bitmaps of the words (all never lose a match),
then verified on the words themselves. First each line is held against the
first line that has the same neighbours: of a large group of near copies nearly
all find a match there, without pairs among them. Those that found none are then
held against all earlier lines with the same neighbours.

Rarity is the number of words in different lines that fall into a bucket of
hashes. The number of buckets is fixed, so the constant that goes to all tasks
is too; any order gives the same result. SQL functions only.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.llm.common import drop, keep, without

PART, WHOLE = 4, 5  # the least similarity, as a fraction
BUCKETS = 1 << 17
CLASS_BITS = 6
CLASSES, STEPS = 1 << CLASS_BITS, 3
SPACES, BLANK = "\t\x0b\x0c\r", " "
LINE = "\n"
PLACE = ("none", "id", "pos")
LINES, REMOVED = "n_lines", "n_removed"
LONGS = 4  # of 64 bits each, in the bitmaps that are held against pairs
SLICES = 3  # of the prefixes, joined one after the other to hold less on disk at once
END = -1  # no code of a word is negative


def ceil_div(a: Column, b: int) -> Column:
    return F.call_function("div", a + (b - 1), F.lit(b)).cast("int")


def words(line: Column) -> Column:
    """Different words of a line of ``lines``, which has blanks for any other white space."""
    return F.array_distinct(F.array_remove(F.split(line, BLANK), ""))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_ = F.col(id_col)
    return docs.select(
        id_.isNull().alias("none"),
        F.coalesce(id_.cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("doc_key"),
        F.col(text_col).alias("text"),
    )


def lines(texts: DataFrame) -> DataFrame:
    """All lines with words, lower-case, white space as blanks: their place and a hash of 128 bits."""
    blanks = F.col("text")
    for space in SPACES:
        blanks = F.replace(blanks, F.lit(space), F.lit(BLANK))
    other = functools.reduce(Column.__or__, [F.contains("text", F.lit(space)) for space in SPACES])
    plain = F.when(other, blanks).otherwise(F.col("text"))
    # Lowered as a whole: no letter's lower case depends on what is beyond a line feed.
    each = texts.select(
        "none", "id", "doc_key", F.posexplode(F.split(F.lower(plain), LINE)).alias("pos", "line")
    )
    return each.where(F.trim("line") != "").withColumns(
        {"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(1), F.col("line"))}
    )


def distinct_lines(found: DataFrame) -> DataFrame:
    """Different lines, numbered ``s`` in order of their first place, and how many ``times`` they occur."""
    grouped = found.groupBy("k1", "k2").agg(
        F.min(F.struct(*PLACE)).alias("first"),
        F.any_value("line").alias("line"),
        F.count("*").alias("times"),
    )
    # Stored first: the shuffles by hash and by place would both hold every line at once.
    grouped = keep(grouped, "grouped-lines")
    ordered = grouped.repartitionByRange("first").sortWithinPartitions("first")
    distinct = keep(ordered.withColumn("s", F.monotonically_increasing_id()), "distinct-lines")
    drop(grouped)
    return distinct


def bucket_classes(distinct: DataFrame) -> Column:
    """How common the words of every bucket of word hashes are, a class a bucket.

    A constant array of ``BUCKETS`` numbers; the counts, one a bucket, pass through the driver.
    Classes rise with the logarithm of the count.
    """
    bucket = F.hash("w").bitwiseAND(F.lit(BUCKETS - 1))
    each = distinct.select(F.explode(F.split("line", BLANK)).alias("w"))
    found = each.groupBy(bucket.alias("b")).count().toArrow()
    counts = np.zeros(BUCKETS)
    counts[found["b"].to_numpy()] = found["count"].to_numpy()
    classes = np.minimum(CLASSES - 1, STEPS * np.log2(1 + counts)).astype(int)
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<int>")


def prefixes(distinct: DataFrame, classes: Column) -> DataFrame:
    """The rarest words of each line, in order: ``s``, ``words``, the rarest pairs of words next
    to each other in that order as a ``chain`` of words, and of all its words the
    number ``n`` and the bitmap, of which every word flips one bit. ``half`` are the bits flipped
    by every second word: it and what it leaves of ``bits`` are a bitmap of twice the length.

    A word stands for itself by its hash, the class of its bucket in front, so that
    the order of the numbers is that of rarity.
    """

    def code(word: Column) -> Column:
        # Never null, so that codes are sorted as plain numbers.
        class_ = F.coalesce(F.get(classes, F.hash(word).bitwiseAND(F.lit(BUCKETS - 1))), F.lit(0))
        return F.shiftleft(class_.cast("long"), 63 - CLASS_BITS).bitwiseOR(
            F.shiftrightunsigned(F.xxhash64(word), CLASS_BITS + 1)
        )

    def flip(bits: Column, c: Column) -> Column:
        one = F.lit(1).cast("long")
        return bits.bitwiseXOR(
            F.call_function("shiftleft", one, c.bitwiseAND(F.lit(63)).cast("int"))
        )

    def flip_half(bits: Column, c: Column) -> Column:
        second = F.shiftright(c, 6).bitwiseAND(F.lit(1))
        return bits.bitwiseXOR(
            F.call_function("shiftleft", second, c.bitwiseAND(F.lit(63)).cast("int"))
        )

    # Blanks in a row leave empty words, which only a few lines have to look for.
    split = F.split("line", BLANK)
    full = F.when(
        F.startswith("line", F.lit(BLANK)) | F.endswith("line", F.lit(BLANK)) | F.contains("line", F.lit(2 * BLANK)),
        F.array_remove(split, ""),
    ).otherwise(split)
    coded = distinct.select(
        # One row from one: the codes are used several times and made once.
        "s",
        F.explode(F.array(F.array_distinct(F.sort_array(F.transform(full, code))))).alias("codes"),
    )
    n = F.size("codes")
    kept = n - ceil_div(n * PART, WHOLE) + 1
    paired = F.call_function("div", n * (2 * (WHOLE - PART)), F.lit(WHOLE)).cast("int") + 1
    ended = F.concat("codes", F.array(F.lit(END).cast("long")))
    return coded.select(
        "s",
        n.alias("n"),
        F.aggregate("codes", F.lit(0).cast("long"), flip).alias("bits"),
        F.aggregate("codes", F.lit(0).cast("long"), flip_half).alias("half"),
        F.slice("codes", F.lit(1), kept).alias("words"),
        F.slice(ended, F.lit(1), paired + 1).alias("chain"),
    )


def neighbours(prefix: DataFrame) -> DataFrame:
    """The lines with the chain of their neighbours in the place of their prefix words."""
    return prefix.select("s", "n", "bits", "half", "chain")


def each_word(prefix: DataFrame) -> DataFrame:
    """A row for each word of the prefixes (or hash of neighbours): ``word``, its place ``i``, the line.

    About twenty a line, so they are made where they are joined; a table that has only
    some of them, as rows, is taken as it is.
    """
    if "words" in prefix.columns:
        return prefix.select("s", "n", "bits", F.posexplode("words").alias("i", "word"))
    if "chain" not in prefix.columns:
        return prefix.select("s", "n", "bits", "i", "word", "before", "half")
    # Hashed here, in rows: Spark compiles that, but not functions of elements.
    rarer = F.slice("chain", F.lit(1), F.size("chain") - 1)
    each = prefix.select("s", "n", "bits", "chain", F.posexplode(rarer).alias("i", "rarer"))
    both = F.xxhash64("rarer", F.get("chain", F.col("i") + 1))
    return each.select("s", "n", "bits", "i", both.alias("word"))


def _in_slice(prefix: DataFrame, part: int) -> DataFrame:
    return each_word(prefix).where(F.pmod(F.col("word"), F.lit(SLICES)) == part)


def _may_match(a: str, b: str) -> Column:
    """Length and bitmap filters for two lines that meet.

    Lines that match differ in at most so many words, and each differing bit takes
    a word that differs: words of both flip the same bit in both.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    alike = F.least(n, m) * WHOLE >= F.greatest(n, m) * PART
    differ = F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits")))
    return alike & (differ <= n + m - 2 * _needed(n, m))


def _needed(n: Column, m: Column) -> Column:
    """Words that lines of ``n`` and ``m`` words that match have in common at least."""
    return ceil_div((n + m) * PART, PART + WHOLE)


def _in_place(a: str, b: str) -> Column:
    """Whether enough words may be in common, if these are the first neighbours that two lines share.

    Between any two common words before them is a word that is not common, in one line or the
    other, so that of the words before at most a third of both are common.
    """
    n, m, i, j = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.i"), F.col(f"{b}.i")
    return i + j >= 3 * (_needed(n, m) - F.least(n - i, m - j))


def _close(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Those of the pairs that long bitmaps of their lines leave; they never lose a match.

    The bitmap that goes with every prefix word is full in long lines. This one is made
    for the lines of the pairs only, and is held against each pair once, before the texts are.
    """
    each = held.select("s", F.explode(words(F.col("line"))).alias("w"))
    each = each.select("s", F.xxhash64("w").alias("h"))
    one = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int")
    )
    part = F.shiftright("h", 6).bitwiseAND(F.lit(LONGS - 1))
    bits = [F.coalesce(F.bit_xor(F.when(part == k, one)), F.lit(0)) for k in range(LONGS)]
    marks = each.groupBy("s").agg(F.array(*bits).alias("bits"), F.count("*").alias("n"))
    marks = keep(marks, "marks")
    a, b = marks.alias("a"), marks.select(F.col("s").alias("t"), "bits", "n").alias("b")
    both = pairs.join(a.hint("merge"), "s").join(b.hint("merge"), "t")
    n, m = F.col("a.n"), F.col("b.n")
    differ = sum(
        F.bit_count(F.col("a.bits")[k].bitwiseXOR(F.col("b.bits")[k])) for k in range(LONGS)
    )
    close = both.where(differ <= n + m - 2 * _needed(n, m))
    close = keep(close.select("s", "t"), "close-pairs")
    drop(marks)
    return close


def _verified(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """Lines ``s`` of the pairs ``s``, ``t`` that are similar enough."""
    asked = keep(pairs.select("s").union(pairs.select("t")).distinct(), "asked")
    # Held by hash, as each id is there once: the texts of all lines need not be sorted.
    held = distinct.select("s", "line").join(asked.hint("shuffle_hash"), "s", "left_semi")
    held = keep(held.withColumn("n", F.size(words(F.col("line")))), "asked-lines")
    close = _close(pairs, held)
    other = held.select(F.col("s").alias("t"), F.col("line").alias("other"), F.col("n").alias("m"))
    both = (
        close.join(held.hint("merge"), "s")
        .join(other.hint("merge"), "t")
    )
    common = F.array_intersect(words(F.col("line")), words(F.col("other")))
    sizes = keep(both.select("s", "n", "m", F.size(common).alias("shared")), "overlaps")
    alike = F.col("shared") * WHOLE >= (F.col("n") + F.col("m") - F.col("shared")) * PART
    matched = keep(sizes.where(alike).select("s").distinct(), "matched")
    drop(asked, held, close, sizes, pairs)
    return matched


def matched_lines(distinct: DataFrame) -> DataFrame:
    """Lines ``s`` that match another line whose first place is earlier."""
    prefix = keep(neighbours(prefixes(distinct, bucket_classes(distinct))), "prefixes")
    shared = [_shared_in_slice(prefix, part) for part in range(SLICES)]
    halves = keep(prefix.select("s", "half"), "halves")
    drop(prefix)  # before the texts of all lines are shuffled
    every = functools.reduce(DataFrame.union, shared)
    pairs = keep(every.where("near").select("s", F.col("first").alias("t")).distinct(), "first-pairs")
    matched = _verified(pairs, distinct)

    # The first line has been held against all others that it meets here.
    others = _with_before(every.where("lines > 2"), matched, halves)
    found = [_met_in_slice(others.where("NOT matched"), others, part) for part in range(SLICES)]
    drop(halves, others, *shared)
    pairs = keep(functools.reduce(DataFrame.union, found).distinct(), "pairs")
    drop(*found)
    return matched.union(_verified(pairs, distinct)).distinct()


def _shared_in_slice(prefix: DataFrame, part: int) -> DataFrame:
    """Rows of ``each_word`` whose word an earlier line has too, with the ``first`` of these ``lines``.

    ``near`` says whether a line may match the first one.
    """
    every = _in_slice(prefix, part)
    first = every.groupBy("word").agg(F.min("s").alias("first"), F.count("*").alias("lines"))
    first = keep(first.where("lines > 1"), "first-lines")
    of_first = prefix.select(F.col("s").alias("first"), "n", "bits")
    known = first.join(of_first.hint("merge"), "first")
    # Held by hash, as each word is there once: the rows of all lines need not be sorted.
    met = every.alias("a").join(known.alias("b").hint("shuffle_hash"), "word")
    near = _may_match("a", "b")
    shared = met.where(F.col("s") != F.col("first")).select("word", "s", "i", "a.n", "a.bits", "first", "lines", near.alias("near"))
    shared = keep(shared, "shared")
    drop(first)
    return shared


def _halves_close() -> Column:
    """The bitmap filter, with the bitmaps of twice the length."""
    n, m = F.col("a.n"), F.col("b.n")
    half = F.col("a.half").bitwiseXOR(F.col("b.half"))
    rest = half.bitwiseXOR(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
    return F.bit_count(half) + F.bit_count(rest) <= n + m - 2 * _needed(n, m)


def _with_before(rows: DataFrame, matched: DataFrame, prefix: DataFrame) -> DataFrame:
    """The rows of ``each_word`` with the word ``before`` and the ``half`` of the same line, and
    if it is ``matched``.

    Lines that share a stretch of neighbours meet where it begins; after that, both have
    the same word before.
    """
    halves = prefix.select("s", F.lit(-2).alias("i"), "half")
    marks = matched.select("s", F.lit(-1).alias("i"))
    both = rows.select("s", "n", "bits", "i", "word")
    for of_line in (halves, marks):
        both = both.unionByName(of_line, allowMissingColumns=True)
    line = Window.partitionBy("s").orderBy("i")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumns(
        {
            "before": F.lag("word").over(line),
            "half": F.first("half").over(so_far),
            "matched": F.max(F.col("i") == -1).over(so_far),
        }
    )
    return keep(both.where("i >= 0"), "others")


def _met_in_slice(later: DataFrame, prefix: DataFrame, part: int) -> DataFrame:
    """Pairs ``s``, ``t`` of a line of ``later`` and any before it that meet at a word of the slice."""
    a, b = _in_slice(later, part), _in_slice(prefix, part)
    met = a.alias("a").join(b.alias("b").hint("merge"), "word")
    near = (F.col("b.s") < F.col("a.s")) & _may_match("a", "b") & _in_place("a", "b")
    if "before" in a.columns:
        near &= F.coalesce(F.col("a.before") != F.col("b.before"), F.lit(True)) & _halves_close()
    near = met.where(near)
    pairs = near.select(F.col("a.s").alias("s"), F.col("b.s").alias("t"))
    return keep(pairs.distinct(), "slice-pairs")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, ``n_lines`` and ``n_removed``.

    Lines end at a line feed; lines without words always stay. Documents whose ids
    are equal count as one place, so repeated rows leave each other alone and are
    treated alike; null ids come last. A document may be left with an empty text,
    rows are never dropped. A null text stays null, with no lines. The id must be
    a whole number. Other columns stay; any named like a new one is replaced.
    """
    docs = without(docs, LINES, REMOVED, "_hl_none", "_hl_id", "_hl_key", "_hl_gone", "_hl_lines")
    texts = _texts(docs, id_col, text_col)
    distinct = distinct_lines(lines(texts))
    matched = matched_lines(distinct)
    fate = distinct.select("s", "k1", "k2", "first", "times").join(
        matched.withColumn("matched", F.lit(True)).hint("merge"), "s", "left"
    )
    # A line that occurs once and matches none before it stays wherever it is.
    fate = keep(fate.where("matched OR times > 1").drop("s", "times"), "fate")
    drop(distinct)
    gone = (
        lines(texts)
        .drop("line")
        .join(fate.hint("shuffle_hash"), ["k1", "k2"])
        .where((F.struct(*PLACE) > F.col("first")) | F.col("matched"))
        .groupBy("none", "id", "doc_key")
        .agg(F.collect_set("pos").alias("_hl_gone"))
    )
    gone = keep(gone, "removed-lines")
    drop(fate)
    gone = gone.withColumnsRenamed(
        {"none": "_hl_none", "id": "_hl_id", "doc_key": "_hl_key"}
    )
    held = docs.withColumns(
        {
            "_hl_none": F.col(id_col).isNull(),
            "_hl_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
            "_hl_key": F.xxhash64(F.coalesce(text_col, F.lit(""))),
        }
    ).join(gone.hint("merge"), ["_hl_none", "_hl_id", "_hl_key"], "left")
    # One row from one: named within a function of an element, the text would be split for each.
    held = held.select("*", F.explode(F.array(F.split(F.col(text_col), LINE))).alias("_hl_lines"))
    every = F.sequence(F.lit(0), F.size("_hl_lines") - 1)
    stay = F.transform(
        F.array_except(every, F.col("_hl_gone")), lambda p: F.element_at("_hl_lines", p + 1)
    )
    text = F.when(F.col("_hl_gone").isNull(), F.col(text_col)).otherwise(F.array_join(stay, LINE))
    return held.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size("_hl_lines")).alias(LINES),
        F.coalesce(F.size("_hl_gone"), F.lit(0)).alias(REMOVED),
    )
