"""Streams against the batch operators."""

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException

from harvestline import schemas
from harvestline.operators.cleaning import clean_stream
from harvestline.operators.weather import daily_summary
from harvestline.sources import files
from harvestline.streaming import daily, spool

HEAD = "county_id,date,temp_c,precip_mm\n"
FIRST = HEAD + "1,2015-01-01,10,1\n1,2015-01-01,99,-1\n,2015-01-01,5,1\n2,,5,1\n"
SECOND = HEAD + "1,2015-01-01,20,2\n2,2015-01-02,,\n"


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


@pytest.fixture
def folders(tmp_path):
    return {n: str(tmp_path / n) for n in ("inbox", "target", "checkpoint", "archive")}


def drain(spark, folders, mode="complete", **options):
    incoming = daily.stream_observations(spark, folders["inbox"], **options)
    query = daily.start_daily(incoming, folders["target"], folders["checkpoint"], output_mode=mode)
    daily.run(query)
    return query


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_stream_equals_batch_over_restarts(spark, folders, mode):
    put(folders["inbox"], "a.csv", FIRST)
    put(folders["inbox"], "empty.csv", HEAD)
    drain(spark, folders, mode)
    first = daily.read_latest(spark, folders["target"])
    assert rows(first.select("key", "avg_temp", "record_count")) == [("1_2015-01-01", 10.0, 2)]
    # The same day in a second file adds to the stored counts.
    put(folders["inbox"], "b.csv", SECOND)
    drain(spark, folders, mode)
    streamed = daily.read_latest(spark, folders["target"]).drop("key", "run", "epoch")
    latest = daily.read_latest(spark, folders["target"], complete=mode == "complete")
    assert rows(latest.drop("key", "run", "epoch").na.fill(-1)) == rows(streamed.na.fill(-1))
    batch = daily_summary(clean_stream(files.read_observations(spark, folders["inbox"])))
    assert rows(streamed.na.fill(-1)) == rows(batch.na.fill(-1))
    assert (1, "2015-01-01", 15.0, 3.0, 3) in rows(streamed)


OTHER_ORDER = "date,county_id,temp_c,precip_mm\n2015-01-01,1,10,1\n"
SWAPPED = "county_id,date,precip_mm,temp_c\n1,2015-01-01,10,1\n"


@pytest.mark.parametrize("text", [OTHER_ORDER, SWAPPED])
def test_a_header_of_another_order_stops_the_stream(spark, folders, text):
    put(folders["inbox"], "a.csv", FIRST)
    put(folders["inbox"], "b.csv", text)
    with pytest.raises(Exception, match="CSV header does not conform"):
        drain(spark, folders)


@pytest.mark.parametrize("text", [OTHER_ORDER, SWAPPED])
def test_a_header_of_another_order_stops_the_relay(spark, folders, text):
    put(folders["inbox"], "a.csv", text)
    incoming = spool.stream_spool(spark, folders["inbox"])
    with pytest.raises(StreamingQueryException):
        daily.run(spool.start_relay(incoming, folders["target"], folders["checkpoint"]))
    assert not glob.glob(f"{folders['target']}/*.csv")


def test_versions_and_replayed_epochs(spark, folders):
    batch = spark.createDataFrame([(1, "2015-01-01", 1.0, 2.0, 3)], schemas.DAILY_SUMMARY)
    sink = daily.upsert_batch(folders["target"])
    for epoch in (0, 1, 2, 3, 3):
        sink(batch, epoch)
    for complete in (False, True):
        kept = daily.read_versions(spark, folders["target"], complete=complete)
        assert sorted(r.epoch for r in kept.collect()) == [1, 2, 3]
    daily.compact(spark, folders["target"], folders["archive"], 1)
    assert [r.epoch for r in daily.read_versions(spark, folders["archive"]).collect()] == [3]


def test_nothing_is_stored_before_the_first_batch(spark, folders):
    assert daily.read_latest(spark, folders["target"]).isEmpty()


def test_at_most_so_many_files_a_batch(spark, folders):
    for i in range(5):
        put(folders["inbox"], f"{i}.csv", HEAD + f"{i},2015-01-01,10,1\n")
    query = drain(spark, folders, max_files=2)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert daily.read_latest(spark, folders["target"]).count() == 5


def test_sink_errors_end_the_query(spark, folders, monkeypatch):
    put(folders["inbox"], "a.csv", FIRST)

    def broken(*_):
        def write(batch, epoch):
            raise RuntimeError("sink is down")

        return write

    monkeypatch.setattr(daily, "upsert_batch", broken)
    with pytest.raises(Exception, match="sink is down"):
        drain(spark, folders)


def test_run_stops_after_its_time(spark, folders):
    put(folders["inbox"], "a.csv", FIRST)
    incoming = daily.stream_observations(spark, folders["inbox"])
    query = daily.start_daily(
        incoming, folders["target"], folders["checkpoint"], interval_seconds=1
    )
    daily.run(query, 8)
    assert not query.isActive
    assert daily.read_latest(spark, folders["target"]).count() == 1


def test_relay_takes_each_file_once_and_cuts_files(spark, folders):
    put(folders["inbox"], "a.csv", HEAD + "1,2015-01-01,10,1\n" * 1200)
    put(folders["inbox"], "b.csv", HEAD + "2,2015-01-01,10,1\n" * 10)
    for _ in range(2):
        incoming = spool.stream_spool(spark, folders["inbox"], folders["archive"])
        query = spool.start_relay(incoming, folders["target"], folders["checkpoint"])
        daily.run(query)
    assert files.read_observations(spark, folders["target"]).count() == 1210
    sizes = [len(open(f).readlines()) - 1 for f in glob.glob(f"{folders['target']}/part-*.csv")]
    assert max(sizes) <= 500 and sum(sizes) == 1210


def test_relayed_files_are_summed_in_few_batches(spark, folders):
    lines = "".join(f"{i},2015-01-01,10,1\n" for i in range(1, 41))
    put(folders["inbox"], "a.csv", HEAD + lines)
    incoming = spool.stream_spool(spark, folders["inbox"])
    daily.run(spool.start_relay(incoming, folders["archive"], folders["checkpoint"] + "1", rows=1))
    assert len(glob.glob(f"{folders['archive']}/part-*.csv")) == 40
    incoming = daily.stream_relayed(spark, folders["archive"])
    daily.run(daily.start_daily(incoming, folders["target"], folders["checkpoint"] + "2"))
    assert daily.read_latest(spark, folders["target"]).count() == 40
    epochs = glob.glob(f"{folders['target']}/run=0/epoch=*")
    assert [os.path.basename(e) for e in epochs] == ["epoch=0"]


def test_counters(spark, folders):
    put(folders["inbox"], "a.csv", HEAD + "1,2015-01-01,10,1\n" * 7)
    put(folders["inbox"], "b.csv", HEAD + "1,2015-01-01,10,1\n" * 5)
    incoming = spool.stream_spool(spark, folders["inbox"], max_files=1)
    query = spool.start_relay(incoming, folders["target"], folders["checkpoint"])
    daily.run(query)
    counted = spool.ingest_counters(spark, folders["target"], folders["checkpoint"])
    assert rows(counted) == [(2, 12)]


def test_a_new_checkpoint_is_newer_and_complete_keeps_three(spark, folders):
    for name, temp in (("old", 10), ("new", 30)):
        inbox, checkpoint = folders["inbox"] + name, folders["checkpoint"] + name
        for i in range(5 if name == "old" else 1):
            put(inbox, f"{i}.csv", HEAD + f"1,2015-01-01,{temp},1\n")
        for _ in range(2):  # the second start finds nothing to do
            incoming = daily.stream_observations(spark, inbox, max_files=1)
            query = daily.start_daily(incoming, folders["target"], checkpoint, output_mode="complete")
            daily.run(query)
    for complete in (False, True):
        (latest,) = daily.read_latest(spark, folders["target"], complete).collect()
        assert (latest.run, latest.epoch, latest.avg_temp) == (1, 0, 30.0)
    left = glob.glob(f"{folders['target']}/run=0/epoch=*")
    assert sorted(os.path.basename(f) for f in left) == ["epoch=2", "epoch=3", "epoch=4"]


def test_finished_files_are_archived(spark, folders):
    for name in ("a.csv", "b.csv", "c.csv"):
        put(folders["inbox"], name, FIRST)
        incoming = spool.stream_spool(spark, folders["inbox"], folders["archive"])
        query = spool.start_relay(incoming, folders["target"], folders["checkpoint"])
        daily.run(query)
    archived = glob.glob(f"{folders['archive']}/**/*.csv", recursive=True)
    left = glob.glob(f"{folders['inbox']}/*.csv")
    assert len(archived) + len(left) == 3
    assert archived
