import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from harvestline.llm import sharding

from .helpers import docs, long_text


def brute(rows, shards):
    """Shard of every row: that of its middle byte in the order of digest and id."""
    def key(row):
        digest = hashlib.md5((row[1] or "").encode()).hexdigest()
        return int(digest[:15], 16), row[0] is not None, row[0] or 0

    total = sum(16 + len((t or "").encode()) for _, t in rows)
    before, made = 0, []
    for doc_id, text in sorted(rows, key=key):
        size = 16 + len((text or "").encode())
        made.append((str(doc_id), size, min(shards - 1, (2 * before + size) * shards // (2 * total))))
        before += size
    return sorted(made)


def check(found, rows, shards):
    assert sorted((str(r.doc_id), r.size, r.shard) for r in found) == brute(rows, shards)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_equal_brute_force(spark):
    rows = [(i, long_text(i % 50, i)) for i in range(500)]
    rows += [(1000 + i, "a copy é") for i in range(400)] + [(None, None), (None, ""), (5, "x")]
    frame = docs(spark, rows).withColumns({"Shard": F.lit("mine"), "size": F.lit(1.5)})
    found = sharding.shard(frame, shards=7)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "shard", "slot"]
    found = found.collect()
    check(found, rows, 7)
    bytes_ = defaultdict(int)
    for r in found:
        bytes_[r.shard] += r.size
    assert max(bytes_.values()) - min(bytes_.values()) < 2 * max(r.size for r in found)


def test_repeated_rows_and_a_very_long_text(spark):
    rows = [(1, "same")] * 300 + [(2, long_text(50_000))]
    check(sharding.shard(docs(spark, rows), shards=4).collect(), rows, 4)


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "DRAWS", 1)
    rows = [(i, "") for i in range(3000)] + [(9000 + i, long_text(400, i)) for i in range(60)]
    frame = docs(spark, rows).withColumns(
        {
            "size": sharding.text_size("text"),
            sharding.KEY[0]: sharding.text_key("text"),
            sharding.KEY[1]: F.col("doc_id"),
            sharding.KEY[2]: F.lit(0).cast("long"),
        }
    )
    total = frame.agg(F.sum("size")).first()[0]
    splitters, totals = sharding.find_splitters(frame.select("size", *sharding.KEY), 20, total)
    assert splitters == sorted(set(splitters))
    assert totals.sum(axis=1).tolist() == [total, len(rows)]
    assert totals[1].max() <= 2 * len(rows) / 20 * 2


def test_few_rows_and_none(spark):
    check(sharding.shard(docs(spark, [(1, "a")])).collect(), [(1, "a")], 40)
    assert sharding.shard(docs(spark, [])).count() == 0


def test_written_shards_read_back(spark, tmp_path):
    rows = [(i, long_text(5, i)) for i in range(50)]
    sharding.write_shards(sharding.shard(docs(spark, rows), shards=3), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
