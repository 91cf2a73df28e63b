"""Upserts into stored keyed tables."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from harvestline.operators import keyed
from harvestline.sources import folders

ROWS = "key string, epoch long, value double"


def table(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).drop(keyed.BUCKET).collect())


def stamps(path):
    found = glob.glob(f"{path}/{keyed.BUCKET}=*/*.parquet")
    return {f: os.stat(f).st_mtime_ns for f in found}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "kv")


def test_only_touched_buckets_are_written(spark, path):
    current = spark.range(20_000).select(
        F.concat(F.col("id"), F.lit("_2015-01-01")).alias("key"),
        F.lit(0).cast("long").alias("epoch"),
        F.col("id").cast("double").alias("value"),
    )
    keyed.write_kv(current, path)
    before = stamps(path)
    updates = table(spark, [(f"{i}_2015-01-01", 1, -1.0) for i in range(0, 20_000, 1000)])
    keyed.upsert_stored(spark, path, updates, ["epoch"])
    after = stamps(path)
    entity = keyed.key_entity(F.col("key"))
    touched = {r[0] for r in updates.select(keyed.bucket_of(entity, keyed.BUCKETS)).collect()}
    kept = {f for f in before if after.get(f) == before[f]}
    changed = {int(f.split(f"{keyed.BUCKET}=")[1].split("/")[0]) for f in before.keys() - kept}
    assert changed == touched and len(touched) < 25
    assert {int(f.split(f"{keyed.BUCKET}=")[1].split("/")[0]) for f in after} == set(range(64))
    wanted = keyed.kv_upsert(current, updates, ["key"], ["epoch"])
    assert content(spark, path) == sorted(tuple(r) for r in wanted.collect())
    assert not [n for n in os.listdir(path) if n in (keyed.READY, keyed.STAGED, keyed.INCOMING)]


def test_stored_upsert_equals_the_operator_over_many_batches(spark, path):
    draw = random.Random(3)
    held = table(spark, [])
    for batch in range(4):
        rows = [
            (f"{draw.randrange(30)}_2015-01-0{draw.randint(1, 3)}", draw.randint(0, 3), float(batch * 100 + i))
            for i in range(40)
        ]
        one = table(spark, list({(k, e): (k, e, v) for k, e, v in rows}.values()))
        keyed.upsert_stored(spark, path, one, ["epoch"], buckets=8)
        held = table(spark, [tuple(r) for r in keyed.kv_upsert(held, one, ["key"], ["epoch"]).collect()])
        assert content(spark, path) == sorted(tuple(r) for r in held.collect())


def test_null_keys_empty_updates_and_repeats(spark, path):
    keyed.upsert_stored(spark, path, table(spark, [("1_a", 0, 1.0), (None, 0, 2.0)]), ["epoch"])
    keyed.upsert_stored(spark, path, table(spark, []), ["epoch"])
    for _ in range(2):
        keyed.upsert_stored(spark, path, table(spark, [(None, 1, 3.0), ("2_a", 0, None)]), ["epoch"])
    found = {tuple(r) for r in spark.read.parquet(path).drop(keyed.BUCKET).collect()}
    assert found == {("1_a", 0, 1.0), (None, 1, 3.0), ("2_a", 0, None)}


def test_a_run_that_fails_before_the_swap_leaves_the_old_state(spark, path):
    keyed.upsert_stored(spark, path, table(spark, [(f"{i}_a", 0, 1.0) for i in range(50)]), ["epoch"])
    before = content(spark, path)
    bad = table(spark, [("1_a", 1, 5.0)]).withColumn(
        "value", F.when(F.rand() < 2, F.raise_error(F.lit("lost"))).otherwise(F.col("value")).cast("double")
    )
    with pytest.raises(Exception, match="lost"):
        keyed.upsert_stored(spark, path, bad, ["epoch"])
    assert content(spark, path) == before
    keyed.upsert_stored(spark, path, table(spark, [("1_a", 1, 6.0)]), ["epoch"])
    assert ("1_a", 1, 6.0) in content(spark, path) and len(content(spark, path)) == 50


def test_a_run_that_fails_in_the_swap_is_finished_by_the_next(spark, path, monkeypatch):
    first = table(spark, [(f"{i}_a", 0, 1.0) for i in range(200)])
    second = table(spark, [(f"{i}_a", 1, 2.0) for i in range(100)])
    keyed.upsert_stored(spark, path, first, ["epoch"])
    moved = []

    def failing(session, old, new):
        if keyed.READY in old:
            moved.append(new)
            if len(moved) > 5:
                raise OSError("driver lost")
        rename(session, old, new)

    rename = folders.rename
    monkeypatch.setattr(folders, "rename", failing)
    with pytest.raises(OSError, match="driver lost"):
        keyed.upsert_stored(spark, path, second, ["epoch"])
    monkeypatch.undo()
    assert keyed.READY in os.listdir(path)
    keyed.finish_upsert(spark, path)
    wanted = keyed.kv_upsert(first, second, ["key"], ["epoch"])
    assert content(spark, path) == sorted(tuple(r) for r in wanted.collect())
