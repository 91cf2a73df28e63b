"""Weather stations: inventory filters, ranking, nearest station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.functions.numeric import coerce_double, coerce_int
from harvestline.operators.cleaning import require, trim_columns
from harvestline.operators.keyed import first_per_key

UNKNOWN_COUNTRY = "??"
ANY_COUNTRY = "*"

# Cells have sides of 45 degrees, 45/16, 45/256 and 45/4096. Inventory coordinates
# have three decimals, so the smallest cell holds at most 11 x 11 places.
LEVELS = 4
SHRINK = 16
SMALLEST_CELL = 45.0 / SHRINK ** (LEVELS - 1)


def parse_inventory(inventory: DataFrame) -> DataFrame:
    """Inventory with trimmed column names and numbers where they are numbers."""
    return trim_columns(inventory).withColumns(
        {
            "LAT": coerce_double(F.col("LAT")),
            "LON": coerce_double(F.col("LON")),
            "BEGIN": coerce_int(F.col("BEGIN")),
            "END": coerce_int(F.col("END")),
        }
    )


def active_stations(inventory: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Stations with a position that report over the whole span of years.

    The end bound is the last day of the span or the newest END in the
    inventory, whichever is earlier.
    """
    newest = inventory.agg(F.max("END")).scalar()
    covered = inventory.filter(
        (F.col("BEGIN") <= first_year * 10000 + 101)
        & (F.col("END") >= F.least(F.lit(last_year * 10000 + 1231), newest))
    )
    return require(covered, "LAT", "LON")


def top_stations(stations: DataFrame, n: int = 10) -> DataFrame:
    """Per country the ``n`` stations with the largest END - BEGIN.

    The difference is of yyyymmdd numbers, not of days; ties go by station id.
    """
    ranked = Window.partitionBy("CTRY").orderBy(F.desc("duration"), F.asc("station_id"))
    return (
        stations.withColumn("duration", F.col("END") - F.col("BEGIN"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= n)
    )


def station_country(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Observations with the country of their station, ``??`` where unlisted.

    Of a station that is listed twice the first country by name counts.
    """
    listed = stations.select("station_id", F.col("CTRY").alias("country"))
    countries = first_per_key(require(listed, "country"), ["station_id"], ["country"])
    return obs.join(countries, "station_id", "left").withColumn(
        "country", F.coalesce("country", F.lit(UNKNOWN_COUNTRY))
    )


def unique_stations(obs: DataFrame) -> DataFrame:
    """One row per station.

    Duplicates collapse in a hash aggregate before the few distinct positions
    of a station are ordered.
    """
    places = obs.select("station_id", "country", "lat", "lon").distinct()
    return first_per_key(places, ["station_id"], ["country", "lat", "lon"])


def _square(c: Column) -> Column:
    return c * c


def _cell(side: float) -> dict[str, Column]:
    return {
        "row": F.floor((F.col("lat") + 90) / side),
        "col": F.floor((F.col("lon") + 180) / side),
    }


def _with_parent(boxes: DataFrame) -> DataFrame:
    return boxes.withColumns(
        {
            "parent_row": F.floor(F.col("row") / SHRINK),
            "parent_col": F.floor(F.col("col") / SHRINK),
        }
    )


def nearest_station(regions: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest station of every region, by squared degree distance.

    ``regions``: county_id, country (station code), lat, lon.
    ``stations``: station_id, country, lat, lon.
    A region whose country has no station searches all of them. Equal distances
    go to the lowest station id.

    Exact without pairing regions and stations: stations are summed up into
    boxes over cells of four sizes. From the largest cells down, each step keeps
    only the boxes that may still hold the nearest station (their closest point
    is no farther than the farthest point of some other box). A country has at
    most 45 of the largest cells, and stations on one spot count once.
    """
    station_set = stations.withColumn("country", F.explode(F.array("country", F.lit(ANY_COUNTRY))))
    places = station_set.groupBy("country", "lat", "lon").agg(
        F.min("station_id").alias("station_id")
    )
    known = stations.select("country").distinct().withColumn("known", F.lit(True))
    origin = regions.join(known, "country", "left").select(
        "county_id",
        F.when(F.col("known"), F.col("country")).otherwise(ANY_COUNTRY).alias("country"),
        F.col("lat").alias("rlat"),
        F.col("lon").alias("rlon"),
    )

    placed = places.withColumns(_cell(SMALLEST_CELL))
    levels = [
        placed.groupBy("country", "row", "col").agg(
            F.min("lat").alias("south"),
            F.max("lat").alias("north"),
            F.min("lon").alias("west"),
            F.max("lon").alias("east"),
        )
    ]
    for _ in range(LEVELS - 1):
        levels.append(_merge_boxes(levels[-1]))

    boxes = levels.pop()
    frontier = _closest_boxes(origin.join(boxes, "country"))
    for boxes in reversed(levels):
        parents = frontier.withColumnsRenamed({"row": "parent_row", "col": "parent_col"})
        inner = parents.join(_with_parent(boxes), ["country", "parent_row", "parent_col"])
        frontier = _closest_boxes(inner.drop("parent_row", "parent_col"))

    distance = _square(F.col("rlat") - F.col("lat")) + _square(F.col("rlon") - F.col("lon"))
    candidates = frontier.join(placed, ["country", "row", "col"]).select(
        "county_id", "station_id", distance.alias("distance")
    )
    return first_per_key(candidates, ["county_id"], ["distance", "station_id"])


def _merge_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes of the next larger cells."""
    return (
        _with_parent(boxes)
        .groupBy("country", F.col("parent_row").alias("row"), F.col("parent_col").alias("col"))
        .agg(
            F.min("south").alias("south"),
            F.max("north").alias("north"),
            F.min("west").alias("west"),
            F.max("east").alias("east"),
        )
    )


def _closest_boxes(pairs: DataFrame) -> DataFrame:
    """Per region the boxes that may hold its nearest station."""

    def gap(low, value, high):
        return F.greatest(F.col(low) - F.col(value), F.lit(0.0), F.col(value) - F.col(high))

    def reach(low, value, high):
        return F.greatest(F.abs(F.col(value) - F.col(low)), F.abs(F.col(value) - F.col(high)))

    nearest = _square(gap("south", "rlat", "north")) + _square(gap("west", "rlon", "east"))
    farthest = _square(reach("south", "rlat", "north")) + _square(reach("west", "rlon", "east"))
    bound = F.min(farthest).over(Window.partitionBy("county_id"))
    return (
        pairs.withColumns({"_nearest": nearest, "_bound": bound})
        .filter(F.col("_nearest") <= F.col("_bound"))
        .drop("_nearest", "_bound", "south", "north", "west", "east")
    )


def assign_observations(obs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Observations of a station, once for every region mapped to it.

    The mapping has one row per region. Hand in a stored one, whose true size
    decides if it is broadcast.
    """
    return obs.join(mapping.select("county_id", "station_id"), "station_id").select(
        "county_id", "date", "temp_c", "precip_mm"
    )
