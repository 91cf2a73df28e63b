"""Polygons and rasters against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from harvestline.functions import geometry
from harvestline.functions.geometry import RasterGrid
from harvestline.operators import raster
from harvestline.schemas import MULTIPOLYGON

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
TRIANGLE = [(10.0, 0.0), (13.0, 0.0), (10.0, 6.0), (10.0, 0.0)]
GRID = RasterGrid(x_min=0.0, y_max=32.0, tile_size=16.0, pixels=16)


def shapes(spark, *geoms):
    rows = [(i, g) for i, g in enumerate(geoms)]
    schema = f"county_id int, geom {MULTIPOLYGON.simpleString()}"
    return spark.createDataFrame(rows, schema)


def evaluate(spark, geom, expression):
    return shapes(spark, geom).select(expression(F.col("geom"))).first()[0]


def inside(geom, x, y):
    odd = False
    for polygon in geom:
        for ring in polygon:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                    odd = not odd
    return odd


def test_centroid_weighs_parts_and_holes(spark):
    plain = evaluate(spark, [[SQUARE]], geometry.centroid)
    assert (plain.x, plain.y) == (2.0, 2.0)
    holed = evaluate(spark, [[SQUARE, HOLE]], geometry.centroid)
    assert holed.x == pytest.approx((16 * 2 - 1 * 1.5) / 15)
    two = evaluate(spark, [[SQUARE], [TRIANGLE]], geometry.centroid)
    assert two.x == pytest.approx((16 * 2 + 9 * 11) / 25)
    assert two.y == pytest.approx((16 * 2 + 9 * 2) / 25)
    flat = evaluate(spark, [[[(0.0, 0.0), (2.0, 0.0), (0.0, 0.0)]]], geometry.centroid)
    assert flat.y == 0.0


def test_bounds_and_text(spark):
    box = evaluate(spark, [[SQUARE], [TRIANGLE]], geometry.bounds)
    assert tuple(box) == (0.0, 0.0, 13.0, 6.0)
    text = evaluate(spark, [[[(-93.5, 42.0), (0.25, 1e7), (-93.5, 42.0)]]], geometry.to_wkt)
    assert text == "MULTIPOLYGON (((-93.5 42, 0.25 1E7, -93.5 42)))"


def test_known_and_unknown_fallback_boxes(spark):
    names = spark.createDataFrame([("Iowa",), ("Atlantis",)], "name string")
    boxes = names.select(geometry.bounds(geometry.fallback_polygon(F.col("name")))).collect()
    assert [tuple(b[0]) for b in boxes] == [(-94.0, 41.5, -93.0, 42.5), (-0.5, -0.5, 0.5, 0.5)]


def test_half_open_edges(spark):
    points = [(0.0, 1.0), (4.0, 1.0), (1.0, 0.0), (1.0, 4.0), (1.5, 1.5), (3.0, 3.0), (9.0, 9.0)]
    frame = shapes(spark, [[SQUARE, HOLE]]).crossJoin(
        spark.createDataFrame(points, "x double, y double")
    )
    tested = frame.select("x", "y", geometry.contains_point(F.col("geom"), F.col("x"), F.col("y")))
    got = {(r[0], r[1]): r[2] for r in tested.collect()}
    assert got == {p: inside([[SQUARE, HOLE]], *p) for p in points}
    assert got[(0.0, 1.0)] and got[(1.0, 0.0)]
    assert not (got[(4.0, 1.0)] or got[(1.0, 4.0)] or got[(1.5, 1.5)])


def test_tile_corner_and_index(spark):
    names = spark.createDataFrame([("MOD13Q1.A2024337.h10v05.061.tif",), ("x.tif",)], "f string")
    located = names.select(geometry.tile_index(F.col("f")).alias("t")).select(
        "t.h", "t.v", geometry.tile_affine(F.col("t.h"), F.col("t.v")).alias("a")
    )
    hit, miss = located.collect()
    assert (hit.h, hit.v) == (10, 5)
    assert hit.a.x_min == pytest.approx(-20015109.354 + 10 * 1111950.5196666666)
    assert hit.a.y_max == pytest.approx(10007554.677 - 5 * 1111950.5196666666)
    assert hit.a.pixel_size == pytest.approx(231.65635826)
    assert miss.h is None and miss.a.x_min is None


def random_lines(seed):
    draw = random.Random(seed)
    lines, pixels = [], {}
    for h in range(2):
        for v in range(2):
            for day in (dt.date(2020, 1, 1), dt.date(2020, 1, 17)):
                for line in range(16):
                    raw = [draw.choice([-3000, draw.randint(-2000, 10000)]) for _ in range(16)]
                    lines.append((f"{h}{v}{day}", h, v, day, line, raw))
                    for i, value in enumerate(raw):
                        centre = (h * 16 + i + 0.5, 32 - (v * 16 + line + 0.5))
                        pixels[(h, v, day, *centre)] = value
    return lines, pixels


LINE_SCHEMA = "file string, tile_h int, tile_v int, date date, line int, raw array<int>"

ZONES = [
    [[[(1.0, 1.0), (30.0, 3.5), (20.0, 31.0), (5.25, 20.0), (1.0, 1.0)]]],
    [[[(4.0, 4.0), (4.0, 28.0), (28.0, 28.0), (28.0, 4.0), (4.0, 4.0)],
      [(10.5, 10.5), (20.5, 10.5), (15.5, 22.5), (10.5, 10.5)]]],
    [[[(0.5, 0.5), (8.5, 0.5), (8.5, 8.5), (0.5, 8.5), (0.5, 0.5)]],
     [[(17.2, 17.2), (17.4, 17.2), (17.4, 17.4), (17.2, 17.4), (17.2, 17.2)]]],
    [[[(-20.0, -20.0), (-10.0, -20.0), (-10.0, -10.0), (-20.0, -20.0)]]],
    [[[(-5.0, -5.0), (50.0, -5.0), (50.0, 50.0), (-5.0, 50.0), (-5.0, -5.0)]]],
]


def test_zonal_stats_equal_brute_force(spark):
    lines, pixels = random_lines(1)
    frame = spark.createDataFrame(lines, LINE_SCHEMA)
    got = {
        (r.county_id, r.tile_h, r.tile_v, r.date): (r.ndvi, r.min_ndvi, r.max_ndvi, r.pixel_count)
        for r in raster.zonal_stats(frame, shapes(spark, *ZONES), GRID).collect()
    }
    expected = {}
    for (h, v, day, x, y), raw in pixels.items():
        for i, geom in enumerate(ZONES):
            if raw != -3000 and inside(geom, x, y):
                expected.setdefault((i, h, v, day), []).append(raw)
    assert set(got) == set(expected)
    for key, values in expected.items():
        mean, low, high, count = got[key]
        assert mean == pytest.approx(sum(values) / len(values) / 10000, abs=5.1e-5)
        assert (low, high, count) == (min(values) / 10000, max(values) / 10000, len(values))


def test_zone_without_valid_pixel_has_no_row(spark):
    lines = [("f", 0, 0, dt.date(2020, 1, 1), n, [-3000] * 16) for n in range(16)]
    frame = spark.createDataFrame(lines, LINE_SCHEMA)
    assert raster.zonal_stats(frame, shapes(spark, ZONES[-1]), GRID).isEmpty()


def test_tiles_of_an_envelope_touching_counts(spark):
    zones = spark.createDataFrame(
        [(1, 2.0, 2.0, 5.0, 5.0), (2, 10.0, 10.0, 16.0, 17.0), (3, 0.0, 0.0, 32.0, 32.0)],
        "county_id int, min_x double, min_y double, max_x double, max_y double",
    )
    got = {tuple(r) for r in raster.zones_in_tile(zones, GRID).collect()}
    expected = set()
    for zone, x0, y0, x1, y1 in [tuple(r) for r in zones.collect()]:
        for h in range(-1, 4):
            for v in range(-1, 4):
                west, north = h * 16, 32 - v * 16
                if x0 <= west + 16 and x1 >= west and y0 <= north and y1 >= north - 16:
                    expected.add((zone, h, v))
    assert got == expected


def test_pixels_of_a_line(spark):
    frame = spark.createDataFrame(
        [("f", 0, 0, dt.date(2020, 1, 1), 3, [-3000, 5000])], LINE_SCHEMA
    )
    got = [(r.pixel_y, r.pixel_x, r.raw, r.ndvi) for r in raster.scaled_pixels(frame).collect()]
    assert got == [(3, 0, -3000, None), (3, 1, 5000, 0.5)]


def test_nested_zones_read_every_pixel_once(spark):
    rings = [(float(k), 32.0 - k) for k in range(10)]
    nested = [
        [[[(a, a), (b, a), (b, b), (a, b), (a, a)]]] for a, b in rings
    ] + ZONES
    lines, pixels = random_lines(2)
    frame = spark.createDataFrame(lines, LINE_SCHEMA)
    zones = shapes(spark, *nested)
    held = [p for p in pixels if any(inside(g, *p[3:]) for g in nested)]
    assert raster.covered_pixels(frame, zones, GRID).count() == len(held)
    got = {
        (r.county_id, r.tile_h, r.tile_v, r.date): (r.min_ndvi, r.max_ndvi, r.pixel_count)
        for r in raster.zonal_stats(frame, zones, GRID).collect()
    }
    expected = {}
    for (h, v, day, x, y), raw in pixels.items():
        for i, geom in enumerate(nested):
            if raw != -3000 and inside(geom, x, y):
                expected.setdefault((i, h, v, day), []).append(raw)
    assert got == {
        key: (min(v) / 10000, max(v) / 10000, len(v)) for key, v in expected.items()
    }
