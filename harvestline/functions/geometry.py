"""Polygons as nested arrays: multipolygon > polygons > rings > points.

Rings are closed (last point equals the first); the first ring of a polygon is
its shell, the others are holes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371007.181

# Approximate centre (lon, lat) of known agricultural regions.
REGION_CENTRES = {
    "Iowa": (-93.5, 42.0),
    "Illinois": (-89.4, 40.0),
    "Indiana": (-86.3, 39.8),
    "Nebraska": (-99.8, 41.5),
    "Kansas": (-98.5, 38.5),
    "Punjab": (75.3, 31.0),
    "Madhya Pradesh": (78.0, 23.5),
    "Maharashtra": (75.7, 19.7),
    "Uttar Pradesh": (80.9, 27.0),
    "Rajasthan": (73.5, 27.0),
    "Mato Grosso": (-55.0, -12.5),
    "Goiás": (-49.5, -15.9),
    "Paraná": (-51.5, -24.5),
    "São Paulo": (-48.5, -22.5),
    "Minas Gerais": (-44.5, -18.5),
    "Henan": (113.5, 34.0),
    "Shandong": (117.0, 36.5),
    "Heilongjiang": (127.0, 47.0),
    "Jiangsu": (119.5, 33.0),
    "Anhui": (117.0, 32.0),
    "Uasin Gishu": (35.3, 0.5),
    "Trans Nzoia": (34.9, 1.0),
    "Nakuru": (36.1, -0.3),
    "Nyandarua": (36.4, -0.2),
    "Bungoma": (34.6, 0.6),
}


@dataclass(frozen=True)
class RasterGrid:
    """Square tiles laid out from the upper left corner, ``pixels`` a side.

    The defaults are the fixed values of the global sinusoidal tiling.
    """

    x_min: float = -20015109.354
    y_max: float = 10007554.677
    tile_size: float = 1111950.5196666666
    pixels: int = 4800

    @property
    def pixel_size(self) -> float:
        return self.tile_size / self.pixels


MODIS_GRID = RasterGrid()


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_polygon(west: Column, south: Column, east: Column, north: Column) -> Column:
    """One-ring polygon of a rectangle, clockwise from its upper left corner."""
    corners = [(west, north), (east, north), (east, south), (west, south), (west, north)]
    return F.array(F.array(*[point(x, y) for x, y in corners]))


def as_multi(polygon: Column) -> Column:
    """Multipolygon of a single polygon."""
    return F.array(polygon)


def fallback_polygon(name: Column, half: float = 0.5) -> Column:
    """One-degree box around a known region centre, around (0, 0) for others."""
    lon = F.coalesce(_centre(name, 0), F.lit(0.0))
    lat = F.coalesce(_centre(name, 1), F.lit(0.0))
    return as_multi(box_polygon(lon - half, lat - half, lon + half, lat + half))


def _centre(name: Column, axis: int) -> Column:
    entries = [F.lit(v) for k, c in REGION_CENTRES.items() for v in (k, c[axis])]
    return F.try_element_at(F.create_map(*entries), name)


def ring_points(geom: Column) -> Column:
    """All points of a multipolygon in one array."""
    return F.flatten(F.flatten(geom))


def bounds(geom: Column) -> Column:
    """Envelope as ``struct(min_x, min_y, max_x, max_y)``."""
    points = ring_points(geom)
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )


def ring_edges(ring: Column) -> Column:
    """Segments of a closed ring as ``array<struct(a: point, b: point)>``."""
    n = F.size(ring)
    return F.zip_with(
        F.slice(ring, 1, n - 1),
        F.slice(ring, 2, n - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )


def _ring_moments(ring: Column) -> Column:
    """Unsigned area and first moments of a ring, relative to its first point."""
    origin = ring[0]

    def step(acc, e):
        ax, ay = e["a"]["x"] - origin["x"], e["a"]["y"] - origin["y"]
        bx, by = e["b"]["x"] - origin["x"], e["b"]["y"] - origin["y"]
        cross = ax * by - bx * ay
        return F.struct(
            (acc["area"] + cross / 2).alias("area"),
            (acc["mx"] + (ax + bx) * cross / 6).alias("mx"),
            (acc["my"] + (ay + by) * cross / 6).alias("my"),
        )

    def absolute(acc):
        sign = F.signum(acc["area"])
        area = F.abs(acc["area"])
        return F.struct(
            area.alias("area"),
            (sign * acc["mx"] + area * origin["x"]).alias("mx"),
            (sign * acc["my"] + area * origin["y"]).alias("my"),
        )

    return F.aggregate(ring_edges(ring), _zero_moments(), step, absolute)


def _zero_moments() -> Column:
    return F.struct(*[F.lit(0.0).alias(n) for n in ("area", "mx", "my")])


def centroid(geom: Column) -> Column:
    """Area-weighted centre as ``struct(x, y)``; holes count negative.

    A shape without area falls back to the mean of its points.
    """
    signed = F.flatten(
        F.transform(
            geom,
            lambda polygon: F.transform(
                polygon,
                lambda ring, i: F.struct(
                    F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign"),
                    _ring_moments(ring).alias("m"),
                ),
            ),
        )
    )
    total = F.aggregate(
        signed,
        _zero_moments(),
        lambda acc, r: F.struct(
            *[(acc[n] + r["sign"] * r["m"][n]).alias(n) for n in ("area", "mx", "my")]
        ),
    )
    return point(
        F.coalesce(F.try_divide(total["mx"], total["area"]), _mean_of(geom, "x")),
        F.coalesce(F.try_divide(total["my"], total["area"]), _mean_of(geom, "y")),
    )


def _mean_of(geom: Column, axis: str) -> Column:
    points = ring_points(geom)
    total = F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p[axis])
    return F.try_divide(total, F.size(points).cast("double"))


def contains_point(geom: Column, x: Column, y: Column) -> Column:
    """Even-odd test of one point; left and bottom edges are inside.

    ``try_divide`` keeps horizontal edges from failing: they never pass the
    first condition, but ``and`` need not short-circuit.
    """
    edges = F.flatten(
        F.transform(
            geom, lambda polygon: F.flatten(F.transform(polygon, lambda ring: ring_edges(ring)))
        )
    )

    def toggles(e):
        a, b = e["a"], e["b"]
        crossing = a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return F.coalesce(((a["y"] > y) != (b["y"] > y)) & (x < crossing), F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda inside, e: inside != toggles(e))


def to_sinusoidal(lon: Column, lat: Column, radius: float = EARTH_RADIUS_M) -> Column:
    """Metres on the sinusoidal plane as ``struct(x, y)``."""
    return point(
        F.lit(radius) * F.radians(lon) * F.cos(F.radians(lat)), F.lit(radius) * F.radians(lat)
    )


def project_geometry(geom: Column) -> Column:
    """Multipolygon with every vertex moved to the sinusoidal plane."""
    return F.transform(
        geom,
        lambda polygon: F.transform(
            polygon, lambda ring: F.transform(ring, lambda p: to_sinusoidal(p["x"], p["y"]))
        ),
    )


def _number_text(value: Column) -> Column:
    """Number without a trailing ``.0``."""
    return F.regexp_replace(value.cast("string"), r"\.0($|E)", "$1")


def to_wkt(geom: Column) -> Column:
    """Well-known text of a multipolygon."""

    def bracket(parts):
        return F.concat(F.lit("("), F.array_join(parts, ", "), F.lit(")"))

    def ring_text(ring):
        return bracket(
            F.transform(
                ring, lambda p: F.concat_ws(" ", _number_text(p["x"]), _number_text(p["y"]))
            )
        )

    polygons = F.transform(
        geom, lambda polygon: bracket(F.transform(polygon, lambda ring: ring_text(ring)))
    )
    return F.concat(F.lit("MULTIPOLYGON "), bracket(polygons))


def geojson_geometry(geom: Column) -> Column:
    """Geometry member of a GeoJSON feature."""
    coordinates = F.transform(
        geom,
        lambda polygon: F.transform(
            polygon, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
        ),
    )
    return F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))


def tile_index(name: Column) -> Column:
    """``struct(h, v)`` from ``.hHHvVV.`` in a file name, NULL members without it."""
    pattern = r"\.h(\d{2})v(\d{2})\."
    return F.struct(
        F.regexp_extract(name, pattern, 1).try_cast("int").alias("h"),
        F.regexp_extract(name, pattern, 2).try_cast("int").alias("v"),
    )


def tile_affine(h: Column, v: Column, grid: RasterGrid = MODIS_GRID) -> Column:
    """Upper left corner and pixel size of a tile."""
    return F.struct(
        (F.lit(grid.x_min) + h * F.lit(grid.tile_size)).alias("x_min"),
        (F.lit(grid.y_max) - v * F.lit(grid.tile_size)).alias("y_max"),
        F.lit(grid.pixel_size).alias("pixel_size"),
    )
