"""Model and end-to-end jobs."""

import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from harvestline import schemas
from harvestline.functions.geometry import RasterGrid
from harvestline.ml import yield_model
from harvestline.operators.metrics import regression_metrics
from harvestline.plans import jobs
from harvestline.sources import files


@pytest.fixture(scope="module")
def training(spark, tmp_path_factory):
    draw = random.Random(5)
    rows = []
    for county in range(30):
        for year in range(2010, 2016):
            ndvi, rain = draw.random(), draw.uniform(100, 900)
            for crop, base in (("Maize", 9.0), ("Maize ", 8.0), ("Wheat", 3.0)):
                if crop == "Maize " and county % 2:
                    continue
                rows.append(
                    (county, year, ndvi, ndvi + 0.1, rain, 15.0, 2000.0, crop,
                     base + 2 * ndvi + rain / 900, draw.randint(5000, 50000))
                )
    path = str(tmp_path_factory.mktemp("training") / "t")
    spark.createDataFrame(
        rows,
        "county_id int, year int, mean_ndvi double, max_ndvi double, annual_precip double, "
        "mean_temp double, annual_gdd double, crop string, yield_mt_ha double, area_ha int",
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def trained(training):
    return yield_model.train(training, use_cross_validation=False)


def test_features_are_numbers_and_crops_but_the_last(trained, training):
    names = yield_model.feature_names(trained.encoder)
    assert names == [*yield_model.NUMERIC_FEATURES, "crop_Maize", "crop_Wheat"]
    vector = trained.encoder.transform(training).first().features
    assert vector.size == len(names) == trained.forest.numFeatures


def test_forest_has_the_fixed_size(trained):
    assert trained.forest.getNumTrees == 35
    assert trained.forest.getOrDefault("maxDepth") == 6


def test_importance_table(trained):
    table = {r.feature: r.importance for r in yield_model.importance_table(trained).collect()}
    errors = {n: table.pop(n) for n in ("_model_rmse", "_model_r2")}
    assert sum(table.values()) == pytest.approx(1.0)
    assert errors["_model_r2"] > 0.8
    assert errors["_model_rmse"] == pytest.approx(trained.metrics.first().rmse)


def test_metrics_equal_the_library_evaluator(trained, training):
    scored = yield_model.predict_all(trained, training)
    ours = regression_metrics(scored, "actual_yield", "predicted_yield").first()
    for name, value in (("rmse", ours.rmse), ("r2", ours.r2)):
        evaluator = RegressionEvaluator(
            labelCol="actual_yield", predictionCol="predicted_yield", metricName=name
        )
        assert evaluator.evaluate(scored) == pytest.approx(value)
    assert scored.count() == training.count()


def test_cross_validation_covers_the_grid(spark, training, monkeypatch):
    monkeypatch.setattr(yield_model, "TREE_GRID", (2, 3))
    monkeypatch.setattr(yield_model, "DEPTH_GRID", (1, 4))
    table = yield_model.cv_table(yield_model.train(training).cross_validation)
    rows = table.collect()
    assert {(r.numTrees, r.maxDepth) for r in rows} == {(2, 1), (2, 4), (3, 1), (3, 4)}
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].avg_rmse == min(r.avg_rmse for r in rows)


def test_prefixes_of_a_forest(training):
    """All trees are the library's own forest; fewer are the mean of the first ones."""
    data = yield_model.with_label(yield_model.encoder().fit(training).transform(training))
    few, rest = data.filter("county_id < 6"), data.filter("county_id >= 6")
    model = yield_model.forest(12, 4).fit(rest)
    found = yield_model.prefix_errors(model, few, (3, 7, 12))
    evaluator = RegressionEvaluator(labelCol="label", metricName="rmse")
    assert found[12] == pytest.approx(evaluator.evaluate(model.transform(few)), rel=1e-9)
    rows = few.select("features", "label").collect()
    for k in (3, 7):
        errors = [
            sum(tree.predict(r.features) for tree in model.trees[:k]) / k - r.label for r in rows
        ]
        wanted = (sum(e * e for e in errors) / len(errors)) ** 0.5
        assert found[k] == pytest.approx(wanted, rel=1e-9)


def test_grid_errors_equal_separate_forests_of_most_trees(training, monkeypatch):
    monkeypatch.setattr(yield_model, "TREE_GRID", (3, 6))
    monkeypatch.setattr(yield_model, "DEPTH_GRID", (3,))
    data = yield_model.with_label(yield_model.encoder().fit(training).transform(training))
    folds = data.select(
        "features", "label", (F.col("county_id") % yield_model.FOLDS).alias("fold")
    ).persist()
    grid = {p.trees: p.rmse for p in yield_model.cross_validate(folds, 4)}
    evaluator = RegressionEvaluator(labelCol="label", metricName="rmse")
    alone = [
        evaluator.evaluate(
            yield_model.forest(6, 3).fit(folds.filter(F.col("fold") != k)).transform(folds.filter(F.col("fold") == k))
        )
        for k in range(yield_model.FOLDS)
    ]
    assert grid[6] == pytest.approx(sum(alone) / len(alone), rel=1e-9)
    assert set(grid) == {3, 6}
    folds.unpersist()


def test_one_forest_a_fold_gives_all_depths(training, monkeypatch):
    """The errors of each depth are those of forests grown to that depth."""
    monkeypatch.setattr(yield_model, "TREE_GRID", (3, 6))
    monkeypatch.setattr(yield_model, "DEPTH_GRID", (2, 4, 7))
    data = yield_model.with_label(yield_model.encoder().fit(training).transform(training))
    folds = data.select(
        "features", "label", (F.col("county_id") % yield_model.FOLDS).alias("fold")
    ).persist()
    grown, forest = [], yield_model.forest
    monkeypatch.setattr(yield_model, "forest", lambda *size: grown.append(size) or forest(*size))
    grid = {(p.trees, p.depth): p.rmse for p in yield_model.cross_validate(folds, 4)}
    assert grown == [(6, 7)] * yield_model.FOLDS
    evaluator = RegressionEvaluator(labelCol="label", metricName="rmse")
    for depth in (2, 4, 7):
        alone = [
            evaluator.evaluate(
                forest(6, depth).fit(folds.filter(F.col("fold") != k)).transform(folds.filter(F.col("fold") == k))
            )
            for k in range(yield_model.FOLDS)
        ]
        assert grid[6, depth] == pytest.approx(sum(alone) / len(alone), rel=1e-9)
    folds.unpersist()


def test_too_little_data_falls_back_to_one_fit(training):
    few = training.filter("county_id = 1 and year < 2012")
    assert yield_model.train(few).cross_validation is None


def test_no_data_is_an_error(training):
    with pytest.raises(yield_model.NoTrainingData):
        yield_model.train(training.filter("county_id < 0"))


def test_batch_and_training_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(yield_model, "TREE_GRID", (2,))
    monkeypatch.setattr(yield_model, "DEPTH_GRID", (2, 3))
    out = str(tmp_path)
    days = spark.range(10 * 730).select(
        (F.col("id") % 10).cast("int").alias("county_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), F.floor(F.col("id") / 10).cast("int")).alias(
            "date"
        ),
        (F.col("id") % 47 - 5).cast("double").alias("temp_c"),
        (F.col("id") % 7).cast("double").alias("precip_mm"),
    )
    samples = days.filter("dayofyear(date) % 16 = 1").select(
        "county_id", "date", (F.col("temp_c") / 50).alias("ndvi")
    )
    table = jobs.run_batch(spark, days, samples, out)
    assert table.count() == 10 * 2 * 23
    harvest = spark.range(20).selectExpr(
        "cast(id % 10 as int) county_id", "if(id % 3 = 0, 'Maize', 'Wheat') crop",
        "cast(2015 + id div 10 as int) year", "cast(id as decimal(10,4)) yield_mt_ha",
        "100 area_ha",
    )
    assert jobs.run_training(spark, table, harvest, out)
    assert files.read_documents(spark, f"{out}/cv_results", "cv_results").count() == 2
    scores = files.read_documents(spark, f"{out}/yield_predictions", "yield_predictions")
    assert scores.count() == 20
    # Unchanged inputs are not trained on again, changed ones are.
    assert not jobs.run_training(spark, table, harvest, out)
    changed = harvest.withColumn("yield_mt_ha", F.col("yield_mt_ha") + 1)
    assert jobs.run_training(spark, table, changed, out)


def test_ingest_jobs(spark, tmp_path):
    square = [[[(-98.0, 38.0), (-97.0, 38.0), (-97.0, 39.0), (-98.0, 39.0), (-98.0, 38.0)]]]
    boundaries = spark.createDataFrame(
        [("IND", "Iowa", 0, square), ("USA", "Arkansas", 1, None), ("USA", "Kansas", 2, square)],
        f"country string, name string, ord int, geom {schemas.MULTIPOLYGON.simpleString()}",
    )
    counties = jobs.build_counties(jobs.target_regions(spark), boundaries)
    outlines = {r.name: r.geom for r in counties.collect()}
    assert len(outlines) == 5
    assert outlines["Kansas"][0][0][0].x == -98.0
    assert outlines["Iowa"][0][0][0].x == -94.0

    year = tmp_path / "2015"
    year.mkdir()
    head = "DATE,LATITUDE,LONGITUDE,TEMP,PRCP\n"
    (year / "00000199999.csv").write_text(head + "2015-01-01,42.0,-93.5,50.0,0.1\n")
    (year / "00000299999.csv").write_text(head + "2015-01-01,38.5,-98.0,68.0,0.0\n")
    (tmp_path / "inv.csv").write_text(
        "USAF,WBAN,CTRY,LAT,LON,BEGIN,END\n000001,99999,US,42.0,-93.5,19900101,20200101\n"
        "000002,99999,US,38.5,-98.0,19900101,20200101\n"
    )
    listed = files.read_inventory(spark, str(tmp_path / "inv.csv"))
    selected = jobs.select_stations(listed, ["US"], range(2015, 2020))
    assert selected.count() == 2
    consolidated = jobs.consolidate_stations(spark, str(year), selected)
    observed = jobs.prepare_weather(consolidated, counties)
    got = {r.county_id: r.temp_c for r in observed.collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 10.0, 4: 20.0, 5: 20.0}

    fao = spark.createDataFrame(
        [
            ("United States of America", "Maize (corn)", "Yield", 2015, 100000.0),
            ("United States of America", "Green corn (maize)", "Yield", 2015, 50000.0),
            ("France", "Wheat", "Yield", 2015, 1.0),
        ],
        schemas.FAO_LONG,
    )
    stored = spark.createDataFrame([], schemas.CROP_YIELDS)
    harvest = jobs.prepare_yields(fao, counties, stored)
    assert {(r.county_id, r.crop, r.year) for r in harvest.collect()} == {
        (i, "Maize", 2015) for i in range(1, 6)
    }
    assert jobs.prepare_yields(fao, counties, stored, years=[2014]).count() == 0
    again = jobs.prepare_yields(fao, counties, harvest)
    assert again.count() == 5

    grid = RasterGrid(x_min=-12_000_000.0, y_max=6_000_000.0, tile_size=8_000_000.0, pixels=200)
    lines = spark.range(100).selectExpr(
        "concat('f', id % 2) file", "0 tile_h", "0 tile_v", "date'2015-01-01' date",
        "cast(id as int) line", "array_repeat(5000, 200) raw",
    )
    nothing = spark.createDataFrame([], "file string")
    samples = jobs.prepare_ndvi(lines, counties, nothing, grid)
    assert {(r.county_id, r.ndvi) for r in samples.collect()} == {(i, 0.5) for i in range(1, 6)}
    assert samples.count() == 5
    half = jobs.prepare_ndvi(lines, counties, lines.filter("file = 'f0'"), grid)
    assert half.count() <= samples.count()

    named = lines.select(
        F.expr("concat('M.A201500', 1 + line % 2, '.h00v00.x')").alias("file"), "line", "raw"
    ).union(lines.selectExpr("'undated.h00v00.x'", "line", "raw"))
    paths = str(tmp_path / "samples"), str(tmp_path / "seen")
    for rows in (named.filter("file NOT LIKE '%A2015002%'"), named, named):
        found = jobs.ingest_rasters(spark, rows, counties, *paths, grid)
    assert {(r.county_id, str(r.date)) for r in found.collect()} == {
        (i, f"2015-01-0{d}") for i in range(1, 6) for d in (1, 2)
    }
    assert found.count() == 10


def test_monitoring_job(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text("county_id,date,temp_c,precip_mm\n1,2015-01-01,10,1\n")
    where = [str(tmp_path / n) for n in ("inbox", "relayed", "target", "checkpoints")]
    assert [r.avg_temp for r in jobs.run_monitoring(spark, *where).collect()] == [10.0]
    (inbox / "b.csv").write_text("county_id,date,temp_c,precip_mm\n1,2015-01-01,20,1\n")
    latest = jobs.run_monitoring(spark, *where, interval_seconds=1, duration_seconds=12)
    assert [r.avg_temp for r in latest.collect()] == [15.0]
