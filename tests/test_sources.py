"""Files and tables written and read back."""

import datetime as dt
import glob
import os
from types import SimpleNamespace

import pytest

from harvestline import schemas
from harvestline.session import scratch_path, scratch_root
from harvestline.sources import files, tables


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*(order or frame.columns)).collect()]


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


def test_observations_with_junk_cells(spark, tmp_path):
    path = put(tmp_path / "w.csv", "county_id,date,temp_c,precip_mm\n1,2015-01-01,3,0\nx,,,7\n")
    assert rows(files.read_observations(spark, path), "precip_mm") == [
        (1, "2015-01-01", 3.0, 0.0),
        (None, None, None, 7.0),
    ]


def test_fao_file_is_latin_1_and_read_by_column_name(spark, tmp_path):
    path = put(
        tmp_path / "fao.csv",
        "Year,Flag,Area,Item,Element,Value\n2015,A,Côte d'Ivoire,Wheat,Yield,12.5\n,,X,Y,Z,bad\n",
        "iso-8859-1",
    )
    assert rows(files.read_fao(spark, path)) == [
        ("Côte d'Ivoire", "Wheat", "Yield", 2015, 12.5),
        ("X", "Y", "Z", None, None),
    ]


def test_inventory_with_ragged_header(spark, tmp_path):
    path = put(
        tmp_path / "inv.csv",
        "USAF, WBAN ,CTRY,LAT, LON,BEGIN,END \n725300,94846,US,+41.995,-87.9,19461001,20250101\n"
        "000001,99999,US, ,x,n/a,20250101\n",
    )
    listed = files.read_inventory(spark, path)
    assert listed.columns == ["USAF", "WBAN", "CTRY", "LAT", "LON", "BEGIN", "END"]
    assert rows(listed) == [
        ("000001", "99999", "US", None, None, None, 20250101),
        ("725300", "94846", "US", 41.995, -87.9, 19461001, 20250101),
    ]


def test_station_files(spark, tmp_path):
    head = "STATION,DATE,LATITUDE,LONGITUDE,NAME,TEMP,PRCP\n"
    put(
        tmp_path / "2015" / "72530094846.csv",
        head
        + "7,2015-01-01,41.9,-87.9,A,32.0,0.00G\n7,2015-01-02,41.9,-87.9,A,9999.9,0.10\n"
        + "7,2015-01-03,41.9,-87.9,A,abc,0.10\n7,2015-01-04,41.9,-87.9,A,50.0,99.99\n",
    )
    put(tmp_path / "2016" / "00000199999.csv", head + "1,2016-01-01,1,2,B,50,1.2.3\n")
    put(tmp_path / "2016" / "00000299999.csv", "")
    got = files.read_station_files(spark, str(tmp_path))
    assert rows(got) == [
        ("72530094846", "2015-01-01", "41.9", "-87.9", 0.0, 0.0),
        ("72530094846", "2015-01-04", "41.9", "-87.9", 10.0, 0.0),
    ]


def test_station_columns_go_by_the_header_of_their_file(spark, tmp_path):
    put(tmp_path / "1.csv", "DATE,LATITUDE,LONGITUDE,TEMP,PRCP\n2015-01-01,1,2,50.0,0.10\n")
    put(tmp_path / "2.csv", "PRCP,TEMP,\"DATE\",X,LONGITUDE,LATITUDE\n0.10,50.0,2015-01-01,x,2,1\n")
    got = files.read_station_files(spark, str(tmp_path))
    assert rows(got) == [(s, "2015-01-01", "1", "2", 10.0, 2.54) for s in ("1", "2")]
    put(tmp_path / "3.csv", "DATE,TEMP\n2015-01-01,50.0\n")
    with pytest.raises(ValueError, match="1 files without the columns"):
        files.read_station_files(spark, str(tmp_path))
    assert files.read_station_files(spark, str(tmp_path), skip_bad_files=True).count() == 2


def test_observations_in_another_column_order_are_an_error(spark, tmp_path):
    path = put(tmp_path / "o.csv", "county_id,date,precip_mm,temp_c\n1,2015-01-01,2.0,30.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_observations(spark, path).collect()


def test_every_payload_is_read_or_rejected(spark):
    texts = [(1, '[{"current":{}}]'), (2, '[{"current":{"temp'), (3, None), (4, "[]"), (5, "x")]
    frame = spark.createDataFrame(texts, "id int, body string")
    assert [r.id for r in files.parse_live_weather(frame, "body", "id").collect()] == [1]
    assert sorted(r.id for r in files.rejected_payloads(frame, "body").collect()) == [2, 3, 4, 5]


def test_readings_and_rejects_come_from_one_pass(spark, tmp_path):
    texts = [
        (1, '[{"current":{"temperature_2m":1.5}},null]'), (2, "[{"), (3, None), (4, "[]"),
        (5, '{"current":{}}'), (5, '{"current":{}}'),
    ]
    spark.createDataFrame(texts, "id int, body string").write.parquet(str(tmp_path / "in"))
    frame = spark.read.parquet(str(tmp_path / "in"))
    both = files.payload_rows(frame, "body", "id")
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    both.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    rejects = stored.filter("position IS NULL")
    assert rows(rejects.select("id")) == rows(files.rejected_payloads(frame, "body").select("id"))
    found = files.readings(stored.filter("position IS NOT NULL"), "id")
    assert rows(found) == rows(files.parse_live_weather(frame, "body", "id"))
    assert len(rows(found)) == 4


def test_payload_defaults(spark):
    texts = [
        (1, '[{"current":{"temperature_2m":1.234,"precipitation":0.5}},{"current":{}}]'),
        (2, '{"current":{"temperature_2m":null,"precipitation":null}}'),
        (3, '{"other":1}'),
    ]
    frame = spark.createDataFrame(texts, "id int, body string")
    assert rows(files.parse_live_weather(frame, "body", "id")) == [
        (1, 0, 1.23, 0.5), (1, 1, 20.0, 0.0), (2, 0, 20.0, 0.0), (3, 0, 20.0, 0.0),
    ]


def test_live_observations_go_to_their_regions(spark):
    body = '[{"current":{"temperature_2m":1.0,"precipitation":2.0}},{"current":{}},{}]'
    frame = spark.createDataFrame(
        [(body, [4, 2], "2015-01-01")], "payload string, county_ids array<int>, date string"
    )
    assert rows(files.live_observations(frame), "temp_c", "county_id") == [
        (4, "2015-01-01", 1.0, 2.0),
        (None, "2015-01-01", 20.0, 0.0),
        (2, "2015-01-01", 20.0, 0.0),
    ]


def test_ordered_export_continues_over_files(spark, tmp_path):
    frame = spark.range(5000).selectExpr("cast(5000 - id as int) county_id", "2015 year")
    path = str(tmp_path / "out")
    files.export_csv(frame.orderBy("county_id", "year"), path, header=True)
    seen = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        lines = open(name).read().splitlines()
        assert lines[0] == "county_id,year"
        seen += [int(line.split(",")[0]) for line in lines[1:]]
    assert seen == sorted(seen) and len(seen) == 5000


def test_headerless_export(spark, tmp_path):
    frame = spark.createDataFrame([(1, "Maize", 2015)], "county_id int, crop string, year int")
    path = str(tmp_path / "out")
    files.export_csv(frame, path)
    assert [r.value for r in spark.read.text(path).collect()] == ["1,Maize,2015"]


def test_batches_hold_at_most_500_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_batches(spark.range(1200).coalesce(1), path)
    sizes = [len(open(f).read().splitlines()) - 1 for f in glob.glob(f"{path}/part-*")]
    assert sorted(sizes) == [200, 500, 500]


def test_documents_are_replaced(spark, tmp_path):
    path = str(tmp_path / "cv")
    for rmse in (2.0, 1.5):
        document = spark.createDataFrame([(20, 4, rmse, True)], schemas.CV_RESULTS)
        files.write_documents(document, path)
    assert rows(files.read_documents(spark, path, "cv_results")) == [(20, 4, 1.5, True)]


def test_document_upsert_keeps_other_keys(spark, tmp_path):
    path = str(tmp_path / "meta")
    for kind, signature in (("forest", "a"), ("other", "b"), ("forest", "c")):
        document = spark.createDataFrame([(kind, signature)], schemas.MODEL_METADATA)
        files.upsert_documents(document, path, "type")
    assert rows(files.read_documents(spark, path, "model_metadata")) == [
        ("forest", "c"), ("other", "b"),
    ]


def test_warehouse_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "orc")
    for temp in (1.0, 2.0):
        frame = spark.createDataFrame(
            [(1, dt.date(2015, 1, 1), temp, 0.0, 0.0)], schemas.WEATHER_INDICES
        )
        tables.write_indices(frame, "indices_test", path)
    assert tables.table_exists(spark, "indices_test")
    assert not tables.table_exists(spark, "no_such_table")
    assert rows(tables.read_indices(spark, "indices_test"))[0][2] == 2.0
    assert glob.glob(f"{path}/*.orc")


def test_jdbc_options(spark):
    plain = tables.JdbcTable("jdbc:postgresql://db/x", "t", "u", "p")
    assert "partitionColumn" not in plain.read_options()
    assert plain.write_options()["truncate"] == "false"
    assert plain.write_options(truncate=True)["truncate"] == "true"
    ranged = tables.JdbcTable(
        "jdbc:postgresql://db/x", "t", "u", "p",
        partition_column="county_id", lower_bound=1, upper_bound=100, partitions=16,
    )
    assert {
        k: v for k, v in ranged.read_options().items() if "art" in k or "Bound" in k
    } == {
        "partitionColumn": "county_id", "lowerBound": "1", "upperBound": "100",
        "numPartitions": "16",
    }
    assert tables.jdbc_writer(spark.range(1), plain) is not None


def test_scratch_paths_lie_in_the_shared_folder(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(root) and one != two


class UnsetSession:
    """A session on some master whose checkpoint folder is not set."""

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default=None: default)


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(UnsetSession("spark://host:7077"))


def test_a_local_session_may_use_a_local_folder():
    root = scratch_root(UnsetSession("local[2]"))
    assert os.path.isdir(root) and scratch_root(UnsetSession("local[2]")) == root
