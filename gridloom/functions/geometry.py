"""Geometry as Catalyst-visible columns.

A geometry is the struct

    geom: STRUCT<type: STRING,
                 parts: ARRAY<ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>>>

part -> ring (or line) -> vertex. A point is one part with one one-vertex
ring, a line one part with one ring, a polygon one part whose first ring is the
shell and the rest holes. Every function here returns a ``Column`` built from
higher-order functions (``transform``, ``zip_with``, ``aggregate``), so the
work stays in the JVM and runs wherever the row is; nothing is pulled into
Python. Coordinates are planar (EPSG:3857 units), as in the reference's SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(VERTEX)
GEOMETRY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(RING))),
    ]
)

# Spherical mercator radius and the web-mercator world edge.
EARTH_RADIUS_M = 6378137.0
WORLD_EDGE = math.pi * EARTH_RADIUS_M  # 20037508.342789244

POLYGONAL = ("Polygon", "MultiPolygon")
LINEAL = ("LineString", "MultiLineString")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- builders

def vertex(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def make_geom(type_name: str | Column, parts) -> Column:
    t = F.lit(type_name) if isinstance(type_name, str) else type_name
    return F.struct(t.alias("type"), _c(parts).alias("parts"))


def point_geom(x, y) -> Column:
    return make_geom("Point", F.array(F.array(F.array(vertex(x, y)))))


def line_geom(vertices) -> Column:
    """LineString from an ARRAY<STRUCT<x,y>> column."""
    return make_geom("LineString", F.array(F.array(_c(vertices))))


def polygon_geom(rings) -> Column:
    """Polygon from ARRAY<ARRAY<STRUCT<x,y>>> (shell first, then holes)."""
    return make_geom("Polygon", F.array(_c(rings)))


# ---------------------------------------------------------------- basic accessors

def geometry_type(g) -> Column:
    """G5 ST_GeometryType without the ST_ prefix."""
    return _c(g).getField("type")


def all_vertices(g) -> Column:
    return F.flatten(F.flatten(_c(g).getField("parts")))


def num_vertices(g) -> Column:
    return F.size(all_vertices(g))


def bbox(g) -> dict[str, Column]:
    """G7/G8 envelope as four columns."""
    vs = all_vertices(g)
    return {
        "minx": F.array_min(F.transform(vs, lambda p: p["x"])),
        "miny": F.array_min(F.transform(vs, lambda p: p["y"])),
        "maxx": F.array_max(F.transform(vs, lambda p: p["x"])),
        "maxy": F.array_max(F.transform(vs, lambda p: p["y"])),
    }


def with_bbox(df, geom_col: str = "geom"):
    return df.withColumns(bbox(geom_col))


# ---------------------------------------------------------------- measures

def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def _legs(ring: Column, f) -> Column:
    n = F.size(ring)
    return F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), f)


def ring_length(ring: Column) -> Column:
    return _sum(_legs(ring, lambda a, b: F.sqrt((b["x"] - a["x"]) ** 2 + (b["y"] - a["y"]) ** 2)))


def ring_signed_area(ring: Column) -> Column:
    """Shoelace; positive for counter-clockwise rings."""
    return _sum(_legs(ring, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])) / 2.0


def part_area(rings: Column) -> Column:
    """|shell| minus |holes|."""
    return _sum(
        F.transform(
            rings,
            lambda r, i: F.when(i == 0, F.abs(ring_signed_area(r))).otherwise(-F.abs(ring_signed_area(r))),
        )
    )


def area(g) -> Column:
    """G1 ST_Area: polygons only, 0 for points and lines."""
    g = _c(g)
    return F.when(
        g["type"].isin(*POLYGONAL), _sum(F.transform(g["parts"], part_area))
    ).otherwise(F.lit(0.0))


def length(g) -> Column:
    """G2 ST_Length: planar length of lines, 0 for polygons and points."""
    g = _c(g)
    return F.when(
        g["type"].isin(*LINEAL),
        _sum(F.transform(g["parts"], lambda p: _sum(F.transform(p, ring_length)))),
    ).otherwise(F.lit(0.0))


def perimeter(g) -> Column:
    """G3 ST_Perimeter: sum of ring lengths of polygons, 0 otherwise."""
    g = _c(g)
    return F.when(
        g["type"].isin(*POLYGONAL),
        _sum(F.transform(g["parts"], lambda p: _sum(F.transform(p, ring_length)))),
    ).otherwise(F.lit(0.0))


def is_closed(g) -> Column:
    """G4 ST_IsClosed: every line / ring ends where it starts."""
    g = _c(g)
    return F.forall(
        g["parts"],
        lambda p: F.forall(
            p,
            lambda r: (F.element_at(r, 1)["x"] == F.element_at(r, -1)["x"])
            & (F.element_at(r, 1)["y"] == F.element_at(r, -1)["y"]),
        ),
    )


def pg_int(x) -> Column:
    """P15 ``double::integer`` as PostgreSQL does it (round half to even)."""
    return F.bround(_c(x), 0).cast("int")


# ---------------------------------------------------------------- G9 point on surface

def _largest_part(g: Column) -> Column:
    scored = F.transform(g["parts"], lambda p, i: F.struct(part_area(p).alias("a"), (-i).alias("o"), p.alias("p")))
    return F.array_max(scored)["p"]


def _scan_y(rings: Column) -> Column:
    ys = F.array_sort(F.array_distinct(F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))))
    k = F.size(ys)
    gaps = F.zip_with(
        F.slice(ys, F.lit(1), k - 1),
        F.slice(ys, F.lit(2), k - 1),
        lambda a, b: F.struct((b - a).alias("gap"), (-a).alias("o"), ((a + b) / 2.0).alias("y")),
    )
    return F.array_max(gaps)["y"]


def _crossings(rings: Column, y0: Column) -> Column:
    return F.array_sort(F.flatten(F.transform(rings, lambda r: F.filter(_legs(r, lambda a, b: F.when(
        (a["y"] > y0) != (b["y"] > y0), a["x"] + (y0 - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]))),
        lambda v: v.isNotNull()))))


def _widest_run_mid(xs: Column) -> Column:
    nruns = F.floor(F.size(xs) / 2).cast("int")
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(nruns - 1, F.lit(0))),
        lambda j: F.struct(
            (F.element_at(xs, 2 * j + 2) - F.element_at(xs, 2 * j + 1)).alias("w"),
            (-F.element_at(xs, 2 * j + 1)).alias("o"),
            ((F.element_at(xs, 2 * j + 1) + F.element_at(xs, 2 * j + 2)) / 2.0).alias("x"),
        ),
    )
    return F.when(nruns > 0, F.array_max(runs)["x"])


def with_point_on_surface(df, geom: str = "geom", x: str = "px", y: str = "py"):
    """G9 as staged columns: a point strictly inside each polygon.

    Scan at the middle of the widest gap between consecutive distinct vertex
    heights of the largest part (so no vertex lies on the scan line); the edges
    crossing it give sorted x-crossings; inside runs are (x0,x1), (x2,x3)...;
    take the middle of the widest run (leftmost on ties). Points give
    themselves, lines their middle vertex. Each stage is its own column so the
    scan height and crossings are computed once per row, not once per edge.
    """
    g = F.col(geom)
    first_line = F.element_at(F.element_at(g["parts"], 1), 1)
    mid_vertex = F.element_at(first_line, F.floor((F.size(first_line) + 1) / 2).cast("int"))
    out = df.withColumn("_pos_r", F.when(g["type"].isin(*POLYGONAL), _largest_part(g)))
    out = out.withColumn("_pos_y", _scan_y(F.col("_pos_r")))
    out = out.withColumn("_pos_x", _widest_run_mid(_crossings(F.col("_pos_r"), F.col("_pos_y"))))
    poly = g["type"].isin(*POLYGONAL)
    out = out.withColumn(x, F.when(poly, F.col("_pos_x")).when(g["type"].isin(*LINEAL), mid_vertex["x"])
                         .otherwise(F.element_at(first_line, 1)["x"]))
    out = out.withColumn(y, F.when(poly, F.when(F.col("_pos_x").isNotNull(), F.col("_pos_y")))
                         .when(g["type"].isin(*LINEAL), mid_vertex["y"]).otherwise(F.element_at(first_line, 1)["y"]))
    return out.drop("_pos_r", "_pos_y", "_pos_x")


# ---------------------------------------------------------------- projections

def lonlat_to_mercator(lon, lat) -> tuple[Column, Column]:
    """G17 EPSG:4326 -> EPSG:3857 (spherical mercator)."""
    x = _c(lon) * (math.pi / 180.0) * EARTH_RADIUS_M
    y = F.log(F.tan(F.lit(math.pi / 4.0) + _c(lat) * (math.pi / 360.0))) * EARTH_RADIUS_M
    return x, y


def reproject_geom(g) -> Column:
    """G17 over every vertex of a lon/lat geometry."""
    g = _c(g)

    def _v(p):
        x, y = lonlat_to_mercator(p["x"], p["y"])
        return vertex(x, y)

    return make_geom(
        g["type"],
        F.transform(g["parts"], lambda part: F.transform(part, lambda r: F.transform(r, _v))),
    )


def clamp_lat(lat, limit: float = 85.06) -> Column:
    return F.greatest(F.lit(-limit), F.least(F.lit(limit), _c(lat)))


# Fixed value: the earth radius (km) used by the track length tool.
HAVERSINE_RADIUS_KM = 6371.0088


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    """G20 great-circle distance in km."""
    rad = math.pi / 180.0
    dlat = (_c(lat2) - _c(lat1)) * rad
    dlon = (_c(lon2) - _c(lon1)) * rad
    a = F.sin(dlat / 2) ** 2 + F.cos(_c(lat1) * rad) * F.cos(_c(lat2) * rad) * F.sin(dlon / 2) ** 2
    return 2 * HAVERSINE_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


# ---------------------------------------------------------------- G18 clip to a box

def _bind(value: Column, f) -> Column:
    """Evaluate ``value`` once and hand it to ``f`` as a lambda variable, so an
    expression used several times is not copied into the tree each time."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _clip_ring_half(ring: Column, inside, cross) -> Column:
    """One Sutherland-Hodgman pass of a closed ring against a half plane."""
    def one(r):
        out = F.flatten(
            _legs(
                r,
                lambda a, b: F.when(inside(a) & inside(b), F.array(b))
                .when(inside(a) & ~inside(b), F.array(cross(a, b)))
                .when(~inside(a) & inside(b), F.array(cross(a, b), b))
                .otherwise(F.array().cast(RING)),
            )
        )
        return _bind(out, lambda o: F.when(F.size(o) > 0, F.concat(F.slice(o, -1, 1), o)).otherwise(o))
    return _bind(ring, one)


def clip_ring_to_box(ring, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    def xcut(x0):
        return lambda a, b: vertex(F.lit(float(x0)), a["y"] + (x0 - a["x"]) * (b["y"] - a["y"]) / (b["x"] - a["x"]))

    def ycut(y0):
        return lambda a, b: vertex(a["x"] + (y0 - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]), F.lit(float(y0)))

    r = _c(ring)
    r = _bind(r, lambda v: _clip_ring_half(v, lambda p: p["x"] >= xmin, xcut(xmin)))
    r = _bind(r, lambda v: _clip_ring_half(v, lambda p: p["x"] <= xmax, xcut(xmax)))
    r = _bind(r, lambda v: _clip_ring_half(v, lambda p: p["y"] >= ymin, ycut(ymin)))
    r = _bind(r, lambda v: _clip_ring_half(v, lambda p: p["y"] <= ymax, ycut(ymax)))
    return r


def clip_polygon_to_box(g, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """G18 for polygons: clip every ring, drop rings that vanish (< 4 vertices)."""
    g = _c(g)
    parts = F.transform(
        g["parts"],
        lambda p: F.filter(
            F.transform(p, lambda r: clip_ring_to_box(r, xmin, ymin, xmax, ymax)),
            lambda r: F.size(r) >= 4,
        ),
    )
    return make_geom(g["type"], F.filter(parts, lambda p: F.size(p) > 0))


def point_in_box(x, y, xmin, ymin, xmax, ymax) -> Column:
    return (_c(x) >= xmin) & (_c(x) <= xmax) & (_c(y) >= ymin) & (_c(y) <= ymax)


# ---------------------------------------------------------------- G16

_MULTI = {"Point": "MultiPoint", "LineString": "MultiLineString", "Polygon": "MultiPolygon"}


def to_multi(g) -> Column:
    """G16 ST_Multi: single geometries become their multi type (parts unchanged)."""
    g = _c(g)
    mt = F.coalesce(F.create_map(*[x for k, v in _MULTI.items() for x in (F.lit(k), F.lit(v))])[g["type"]],
                    g["type"])
    return make_geom(mt, g["parts"])


def polygon_parts(g) -> Column:
    """G16 ST_CollectionExtract(g, 3) + ST_Multi: the polygonal parts as a
    MultiPolygon (empty for points and lines)."""
    g = _c(g)
    parts = F.when(g["type"].isin(*POLYGONAL), g["parts"]).otherwise(F.array().cast(T.ArrayType(T.ArrayType(RING))))
    return make_geom("MultiPolygon", parts)
