"""Zonal statistics of raster lines.

A raster stays one row per line: ``(tile_h, tile_v, date, line, raw array)``.
Zones are turned into runs of columns per line once, whatever the number of
dates. Lines outside every zone fall out in the join, and only pixels inside a
zone are ever unpacked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.functions.geometry import MODIS_GRID, RasterGrid, ring_edges
from harvestline.functions.numeric import NDVI_NODATA, NDVI_SCALE, scale_ndvi, stable_round


def raster_pixels(lines: DataFrame) -> DataFrame:
    """Every pixel as a row, ``pixel_x`` counting from 0."""
    return lines.select(
        *[c for c in lines.columns if c not in ("raw", "line")],
        F.col("line").alias("pixel_y"),
        F.posexplode("raw").alias("pixel_x", "raw"),
    )


def scaled_pixels(
    lines: DataFrame, nodata: int = NDVI_NODATA, scale: float = NDVI_SCALE
) -> DataFrame:
    return raster_pixels(lines).withColumn("ndvi", scale_ndvi(F.col("raw"), nodata, scale))


def zones_in_tile(zones: DataFrame, grid: RasterGrid = MODIS_GRID) -> DataFrame:
    """Tiles whose square meets the envelope of a zone; touching counts.

    ``zones``: county_id, min_x, min_y, max_x, max_y on the grid's plane. Tiles
    are computed from the envelope, so no pair of zone and tile is tried.
    """

    def span(low, high):
        first = F.ceil(low / grid.tile_size) - 1
        return F.sequence(first, F.floor(high / grid.tile_size))

    across = span(F.col("min_x") - grid.x_min, F.col("max_x") - grid.x_min)
    down = span(grid.y_max - F.col("max_y"), grid.y_max - F.col("min_y"))
    return zones.select("county_id", F.explode(across).alias("tile_h"), down.alias("down")).select(
        "county_id", F.col("tile_h").cast("int"), F.explode("down").alias("tile_v")
    ).withColumn("tile_v", F.col("tile_v").cast("int"))


def zone_runs(zones: DataFrame, grid: RasterGrid = MODIS_GRID) -> DataFrame:
    """Columns of each raster line whose pixel centre lies in a zone.

    ``zones``: county_id, geom on the grid's plane. Result: county_id, tile_h,
    tile_v, line, first (column), n (columns). Every edge is cut with the line
    centres it crosses; between the first and second, third and fourth ... cut
    of a line the zone is inside, which leaves holes out. Left and bottom edges
    are inside, right and top edges are not.
    """
    size = grid.pixel_size
    edges = zones.select(
        "county_id",
        F.explode(
            F.flatten(
                F.transform(
                    "geom", lambda polygon: F.flatten(F.transform(polygon, lambda r: ring_edges(r)))
                )
            )
        ).alias("e"),
    ).select(
        "county_id",
        ((F.col("e.a.x") - grid.x_min) / size - 0.5).alias("ax"),
        ((grid.y_max - F.col("e.a.y")) / size - 0.5).alias("ay"),
        ((F.col("e.b.x") - grid.x_min) / size - 0.5).alias("bx"),
        ((grid.y_max - F.col("e.b.y")) / size - 0.5).alias("by"),
    )
    above = F.floor(F.least("ay", "by")) + 1
    below = F.floor(F.greatest("ay", "by"))
    cuts = (
        edges.filter(above <= below)
        .withColumn("row", F.explode(F.sequence(above, below)))
        .select(
            "county_id",
            "row",
            (
                F.col("ax")
                + (F.col("row") - F.col("ay"))
                * (F.col("bx") - F.col("ax"))
                / (F.col("by") - F.col("ay"))
            ).alias("cut"),
        )
    )
    # A group holds the cuts of one zone with one line: a few, set by its shape.
    along = Window.partitionBy("county_id", "row").orderBy("cut")
    runs = (
        cuts.withColumns({"nth": F.row_number().over(along), "next": F.lead("cut").over(along)})
        .filter(F.col("nth") % 2 == 1)
        .select(
            "county_id",
            "row",
            F.ceil("cut").alias("start"),
            F.ceil("next").alias("stop"),
        )
        .filter(F.col("start") < F.col("stop"))
    )
    n = F.lit(grid.pixels)
    tile_h = F.sequence(F.floor(F.col("start") / n), F.floor((F.col("stop") - 1) / n))
    split = runs.select(
        "county_id",
        F.floor(F.col("row") / n).cast("int").alias("tile_v"),
        F.pmod("row", n).cast("int").alias("line"),
        "start",
        "stop",
        F.explode(tile_h).alias("h"),
    )
    left = F.greatest(F.col("start") - F.col("h") * n, F.lit(0))
    right = F.least(F.col("stop") - F.col("h") * n, n)
    return split.select(
        "county_id",
        F.col("h").cast("int").alias("tile_h"),
        "tile_v",
        "line",
        left.cast("int").alias("first"),
        (right - left).cast("int").alias("n"),
    )


def line_covers(zones: DataFrame, grid: RasterGrid = MODIS_GRID) -> DataFrame:
    """Runs of columns that the same zones cover, of a raster line in one row.

    ``covers``: first, n, zones (ids, rising). Runs of one line do not overlap, so they
    hold each pixel once. A row has as many as zones cross the line, times two.
    """
    run = F.struct("county_id", "first", (F.col("first") + F.col("n")).alias("stop"))
    lines = (
        zone_runs(zones, grid)
        .groupBy("tile_h", "tile_v", "line")
        .agg(F.collect_list(run).alias("runs"))
        .withColumn(
            "cuts",
            F.array_sort(F.array_distinct(F.concat(F.col("runs.first"), F.col("runs.stop")))),
        )
    )

    def cover(first: Column, at: Column) -> Column:
        stop = F.get("cuts", at + 1)
        over = F.filter("runs", lambda r: (r["first"] <= first) & (r["stop"] >= stop))
        ids = F.array_sort(F.transform(over, lambda r: r["county_id"]))
        return F.struct(first.alias("first"), (stop - first).alias("n"), ids.alias("zones"))

    every = F.transform("cuts", cover)  # the last cut has no stop and so no zones
    return lines.select(
        "tile_h",
        "tile_v",
        "line",
        F.filter(every, lambda c: F.size(c["zones"]) > 0).alias("covers"),
    )


def covered_pixels(
    lines: DataFrame, zones: DataFrame, grid: RasterGrid = MODIS_GRID
) -> DataFrame:
    """Pixels inside any zone, once each, with the ids of the zones that cover them."""
    met = lines.join(line_covers(zones, grid), ["tile_h", "tile_v", "line"]).select(
        "tile_h", "tile_v", "date", "raw", F.explode("covers").alias("cover")
    )
    return met.select(
        F.col("cover.zones").alias("zones"),
        "tile_h",
        "tile_v",
        "date",
        F.explode(F.slice("raw", F.col("cover.first") + 1, F.col("cover.n"))).alias("raw"),
    )


def zonal_stats(
    lines: DataFrame,
    zones: DataFrame,
    grid: RasterGrid = MODIS_GRID,
    nodata: int = NDVI_NODATA,
    scale: float = NDVI_SCALE,
) -> DataFrame:
    """Mean, minimum, maximum and count of valid pixels per zone, tile and date.

    Sums are of whole numbers and exact. A zone without a valid pixel on a tile
    has no row. The per-tile means feed ``zonal_ndvi`` as samples. A line meets
    its zones in one row, so the join does not multiply the raster. Pixels are summed by
    the set of zones that cover them, and those sums by zone: a pixel is read once,
    however many zones overlap.
    """
    place = ["tile_h", "tile_v", "date"]
    by_cover = (
        covered_pixels(lines, zones, grid)
        .filter(F.col("raw") != nodata)
        .groupBy("zones", *place)
        .agg(
            F.sum("raw").alias("raw_sum"),
            F.count("raw").alias("pixel_count"),
            F.min("raw").alias("raw_min"),
            F.max("raw").alias("raw_max"),
        )
    )
    return (
        by_cover.withColumn("county_id", F.explode("zones"))
        .groupBy("county_id", *place)
        .agg(
            F.sum("raw_sum").alias("raw_sum"),
            F.sum("pixel_count").alias("pixel_count"),
            F.min("raw_min").alias("raw_min"),
            F.max("raw_max").alias("raw_max"),
        )
        .select(
            "county_id",
            "tile_h",
            "tile_v",
            "date",
            stable_round(F.col("raw_sum") / F.col("pixel_count") / scale, 4).alias("ndvi"),
            (F.col("raw_min") / scale).alias("min_ndvi"),
            (F.col("raw_max") / scale).alias("max_ndvi"),
            "pixel_count",
        )
    )
