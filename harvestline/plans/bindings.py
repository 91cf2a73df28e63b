"""Views that give the driver tables the shape of the operators' inputs.

Every view covers the whole of its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.functions.calendar import composite_date
from harvestline.functions.geometry import (
    REGION_CENTRES,
    RasterGrid,
    as_multi,
    box_polygon,
    point,
)
from harvestline.functions.keys import station_id
from harvestline.functions.numeric import stable_round
from harvestline.operators.stations import parse_inventory

# Toy grid of the raster view: 64 x 64 pixel tiles, one unit a pixel.
VIEW_GRID = RasterGrid(x_min=0.0, y_max=256.0, tile_size=64.0, pixels=64)

# Item texts that stand in for the crops in part names.
VIEW_CROPS = {"Maize": "ring", "Wheat": "red", "Soybean": "rod"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _int(c: str) -> Column:
    return F.col(c).cast("int")


def _day(c: str) -> Column:
    return F.col(c).cast("date")


def obs(spark: SparkSession, d: str) -> DataFrame:
    """Daily weather, temperatures and rainfall beyond the cleaning bounds included."""
    return keyed_obs(spark, d).drop("order", "line")


def keyed_obs(spark: SparkSession, d: str) -> DataFrame:
    """The same with the key of each row."""
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order"),
        F.col("l_linenumber").alias("line"),
        _int("l_suppkey").alias("county_id"),
        _day("l_shipdate").alias("date"),
        (F.col("l_quantity") * 2 - 45).alias("temp_c"),
        F.round(F.col("l_discount") * 100 - 2, 2).alias("precip_mm"),
    )


def ndvi_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples of other composites than the weather; every seventh line is off the grid."""
    day = _day("l_shipdate")
    return table(spark, d, "lineitem").select(
        _int("l_suppkey").alias("county_id"),
        F.when(F.col("l_linenumber") == 7, day)
        .otherwise(composite_date(F.date_add(day, 200)))
        .alias("date"),
        F.lit(0).alias("pixel_x"),
        F.lit(0).alias("pixel_y"),
        (F.col("l_tax") * 10).alias("ndvi"),
    )


def yields(spark: SparkSession, d: str) -> DataFrame:
    """Yields to four decimals, in whole-number arithmetic."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return (
        table(spark, d, "lineitem")
        .withColumn("cents", cents)
        .groupBy(
            _int("l_suppkey").alias("county_id"),
            F.col("l_returnflag").alias("crop"),
            F.year("l_shipdate").alias("year"),
        )
        .agg(
            (F.expr("sum(cents) div (count(1) * 100)") / 10000.0).alias("yield_mt_ha"),
            F.sum("l_quantity").cast("int").alias("area_ha"),
        )
    )


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Naive predictions: the mean yield of the crop."""
    actual = yields(spark, d)
    mean = actual.groupBy("crop").agg(
        stable_round(F.avg("yield_mt_ha"), 4).alias("predicted_yield")
    )
    return actual.join(mean, "crop").select(
        "county_id", "crop", "year", F.col("yield_mt_ha").alias("actual_yield"), "predicted_yield"
    )


def counties(spark: SparkSession, d: str) -> DataFrame:
    """Regions with an L-shaped outline of one to four units on quarter degrees."""
    outline = [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]
    x0 = (F.col("s_suppkey") * 37 % 1440) / 4.0 - 180
    y0 = (F.col("s_suppkey") * 53 % 720) / 4.0 - 90
    unit = (F.col("s_suppkey") % 4 + 1) / 4.0
    shell = F.array(*[point(x0 + unit * dx, y0 + unit * dy) for dx, dy in outline])
    nation = table(spark, d, "nation")
    return (
        table(spark, d, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _int("s_suppkey").alias("county_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("country"),
            as_multi(F.array(shell)).alias("geom"),
        )
    )


def named_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions named after known ones; every tenth keeps a name nobody knows."""
    known = F.array(*[F.lit(n) for n in REGION_CENTRES])
    return table(spark, d, "supplier").select(
        _int("s_suppkey").alias("county_id"),
        F.when(F.col("s_suppkey") % 10 == 0, F.col("s_name"))
        .otherwise(known[_int("s_nationkey")])
        .alias("name"),
    )


def stream_obs(spark: SparkSession, d: str) -> DataFrame:
    """Weather as it comes in: dates are text, a third of the readings is too hot."""
    return table(spark, d, "events").select(
        _int("user_id").alias("county_id"),
        _day("ts").cast("string").alias("date"),
        F.col("value").alias("temp_c"),
        (F.col("value") - 5).alias("precip_mm"),
    )


def _station(key: Column) -> tuple[Column, Column]:
    return F.lpad(key.cast("string"), 6, "0"), F.lit("99999")


def inventory(spark: SparkSession, d: str) -> DataFrame:
    """Raw station inventory: blanks in the header and the ids, some bad positions."""
    key = F.col("c_custkey")
    usaf, wban = _station(key)
    bad = key % 50 == 7
    lat = (key * 7919 % 180001) / 1000.0 - 90
    lon = (key * 104729 % 360001) / 1000.0 - 180
    nation = table(spark, d, "nation")
    return (
        table(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(usaf, F.lit(" ")).alias("USAF"),
            F.concat(F.lit(" "), wban).alias(" WBAN"),
            F.concat(F.lit("C"), F.col("n_regionkey")).alias("CTRY "),
            F.when(bad, F.lit("")).otherwise(lat.cast("string")).alias(" LAT"),
            lon.cast("string").alias("LON"),
            ((1940 + key % 80) * 10000 + 101 + key % 3).cast("string").alias("BEGIN"),
            F.when(key % 91 == 5, F.lit("n/a"))
            .otherwise(((2000 + key % 21) * 10000 + 1231).cast("string"))
            .alias(" END "),
        )
    )


def stations(spark: SparkSession, d: str) -> DataFrame:
    """Stations with a position, under their id."""
    return (
        parse_inventory(inventory(spark, d))
        .dropna(subset=["LAT", "LON"])
        .select(
            station_id(F.col("USAF"), F.col("WBAN")).alias("station_id"),
            F.col("CTRY").alias("country"),
            F.col("LAT").alias("lat"),
            F.col("LON").alias("lon"),
        )
    )


def region_centres(spark: SparkSession, d: str) -> DataFrame:
    """Region positions; two of the seven country codes have no station."""
    key = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        key.cast("int").alias("county_id"),
        F.concat(F.lit("C"), key % 7).alias("country"),
        ((key * 3571 % 180001) / 1000.0 - 90).alias("lat"),
        ((key * 91283 % 360001) / 1000.0 - 180).alias("lon"),
    )


def station_obs(spark: SparkSession, d: str) -> DataFrame:
    """Observations by station; a few stations are in no inventory."""
    usaf, wban = _station(F.col("o_custkey") + 3)
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(usaf, wban).alias("station_id"),
        _day("o_orderdate").alias("date"),
        (F.col("o_totalprice") / 10000.0).alias("temp_c"),
        F.lit(0.5).alias("precip_mm"),
    )


def station_places(spark: SparkSession, d: str) -> DataFrame:
    """Observations that repeat the position of their station, not always the same."""
    supplier = table(spark, d, "supplier")
    nation = table(spark, d, "nation")
    return (
        table(spark, d, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("S"), F.col("n_nationkey")).alias("station_id"),
            F.concat(F.lit("C"), F.col("n_regionkey")).alias("country"),
            (F.col("n_nationkey") + F.col("l_linenumber") / 4.0).alias("lat"),
            (F.col("n_nationkey") * 2.0).alias("lon"),
        )
    )


def station_text(spark: SparkSession, d: str) -> DataFrame:
    """Readings as station files have them: codes for missing, flags, junk."""
    q, percent = _int("l_quantity"), F.round(F.col("l_discount") * 100).cast("int")
    line = F.col("l_linenumber").cast("string")
    temp = (
        F.when(q == 50, F.lit("9999.9"))
        .when(q == 49, F.lit("abc"))
        .otherwise(F.concat((q * 2).cast("string"), F.lit("."), line))
    )
    prcp = (
        F.when(percent == 0, F.lit(""))
        .when(percent == 1, F.lit("99.99"))
        .when(percent == 2, F.lit("-0.1"))
        .when(percent == 3, F.lit("90"))
        .when(percent == 4, F.lit("89.99"))
        .when(percent == 5, F.lit("1.2.3"))
        .otherwise(F.concat(F.lit("0."), line, F.lit("5G")))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        _day("l_shipdate").cast("string").alias("DATE"),
        F.lit("41.5").alias("LATITUDE"),
        F.lit("-93.5").alias("LONGITUDE"),
        temp.alias("TEMP"),
        prcp.alias("PRCP"),
        F.col("l_extendedprice").alias("Value"),
    )


def fao(spark: SparkSession, d: str) -> DataFrame:
    """Crop statistics in long form."""
    part = table(spark, d, "part")
    return (
        table(spark, d, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("NATION_"), F.col("l_suppkey") % 25).alias("Area"),
            F.initcap("p_name").alias("Item"),
            F.when(F.col("l_linestatus") == "F", F.lit("Yield"))
            .when(F.col("l_returnflag") == "N", F.lit("Area harvested"))
            .otherwise(F.lit("Stocks"))
            .alias("Element"),
            F.year("l_shipdate").alias("Year"),
            F.col("l_extendedprice").alias("Value"),
        )
    )


def raster_files(spark: SparkSession, d: str) -> DataFrame:
    """File names in every form the date and tile parsers meet."""
    day, key = _day("o_orderdate"), F.col("o_orderkey")
    tile = F.concat(
        F.lit(".h"),
        F.lpad((F.col("o_custkey") % 36).cast("string"), 2, "0"),
        F.lit("v"),
        F.lpad((key % 18).cast("string"), 2, "0"),
        F.lit(".061.tif"),
    )
    ordinal = F.concat(F.year(day), F.lpad(F.dayofyear(day).cast("string"), 3, "0"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 0, F.concat(F.lit("MOD13Q1.A"), ordinal, tile))
        .when(key % 4 == 1, F.concat(F.lit("x_"), day.cast("string"), F.lit(".tif")))
        .when(key % 4 == 2, F.concat(F.lit("x_"), F.date_format(day, "yyyyMMdd"), tile))
        .otherwise(F.lit("x.tif"))
        .alias("file"),
    )


def raster_lines(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as raster lines: 256 rows of two tiles a date, then the next date."""
    n = F.col("vec_id")
    raw = F.transform(
        "embedding",
        lambda e: F.when(F.round(e.cast("double") * 10000).cast("int") < -2000, F.lit(-3000))
        .otherwise(F.round(e.cast("double") * 10000).cast("int")),
    )
    return table(spark, d, "embeddings").select(
        F.floor(n / 256 % 2).cast("int").alias("tile_h"),
        F.floor(n % 256 / 64).cast("int").alias("tile_v"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.floor(n / 512).cast("int") * 16).alias(
            "date"
        ),
        (n % 64).cast("int").alias("line"),
        raw.alias("raw"),
    )


def raster_zones(spark: SparkSession, d: str) -> DataFrame:
    """Rectangles over the raster, one per nation; some reach over tile borders."""
    key = F.col("n_nationkey")
    west, south = (key * 37 % 100) + 0.25, (key * 53 % 200) + 0.25
    east, north = west + 5 + key % 40, south + 5 + key * 3 % 50
    return table(spark, d, "nation").select(
        key.alias("county_id"),
        as_multi(box_polygon(west, south, east, north)).alias("geom"),
        west.alias("min_x"),
        south.alias("min_y"),
        east.alias("max_x"),
        north.alias("max_y"),
    )


def payloads(spark: SparkSession, d: str) -> DataFrame:
    """Live-weather payloads: lists, single objects, missing and null readings."""
    k = F.get_json_object("props", "$.k")
    form = F.col("event_id") % 4
    full = F.concat(
        F.lit('{"current": {"temperature_2m": '), k, F.lit('.5, "precipitation": '), k, F.lit("}}")
    )
    return table(spark, d, "events").select(
        "event_id",
        F.when(form == 0, full)
        .when(form == 1, F.concat(F.lit("["), full, F.lit(', {"current": {}}]')))
        .when(form == 2, F.lit('[{"current": {"precipitation": 1.25}}]'))
        .otherwise(F.lit('[{"current": {"temperature_2m": null, "precipitation": null}}]'))
        .alias("payload"),
    )


def match_targets(spark: SparkSession, d: str) -> DataFrame:
    """Region names to look up: whole, inner, first-word and hopeless ones."""
    key, part = F.col("s_suppkey"), table(spark, d, "part")
    words = F.split("p_name", " ")
    return (
        table(spark, d, "supplier")
        .join(part, key == F.col("p_partkey"))
        .select(
            key.cast("int").alias("county_id"),
            F.concat(F.lit("C"), key % 3).alias("country"),
            F.when(key % 4 == 0, F.upper("p_name"))
            .when(key % 4 == 1, F.substring(words[1], 1, 3))
            .when(key % 4 == 2, F.concat(words[1], F.lit(" zone")))
            .otherwise(F.lit("qqq"))
            .alias("name"),
        )
    )


def match_names(spark: SparkSession, d: str) -> DataFrame:
    """Part names as boundaries, each in three countries with orders of their own."""
    part = table(spark, d, "part").select(
        F.initcap("p_name").alias("name"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("c"), "p_partkey"
    )
    return part.select(
        F.concat(F.lit("C"), "c").alias("country"),
        "name",
        (F.col("p_partkey") * 7 % (10 + F.col("c")) * 1000000 + F.col("p_partkey")).alias("ord"),
    )
