"""Queries for C2 (significance), C8 (ladders), S2 (way assembly), S3 (relations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.assemble import relation_members
from gridloom.operators.ladder import Rung, ladder_rings
from gridloom.operators.assemble import vertex_rows
from gridloom.operators.simplify import significance, significance_of_lines
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import lines, query
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import SPREAD_ROWS, Tables, spread

LKEY = ["fid", "part", "ring"]


def dp_sql(src: str) -> str:
    """CTEs computing Douglas-Peucker significance over ``src(gid, seq, x, y)``.

    Produces ``dp_sig(gid, seq, sig, protect)``; sig NULL at the end points.
    """
    return f"""
dp_ends AS (SELECT gid, min(seq) AS s0, max(seq) AS s1 FROM {src} GROUP BY gid),
dp_seg(gid, a, b, psig, side) AS (
  SELECT gid, s0, s1, CAST('inf' AS DOUBLE), -1 FROM dp_ends
  UNION ALL
  SELECT gid, CASE WHEN side = 0 THEN a ELSE m END, CASE WHEN side = 0 THEN m ELSE b END, sig, side
  FROM (SELECT gid, a, b, m, least(d, psig) AS sig,
               row_number() OVER (PARTITION BY gid, a ORDER BY d DESC, m) AS rn
        FROM (SELECT *, sqrt((x - (ax + t*dx))*(x - (ax + t*dx)) + (y - (ay + t*dy))*(y - (ay + t*dy))) AS d
              FROM (SELECT *, CASE WHEN dx*dx + dy*dy = 0 THEN 0.0
                                   ELSE least(1.0, greatest(0.0, ((x - ax)*dx + (y - ay)*dy) / (dx*dx + dy*dy)))
                              END AS t
                    FROM (SELECT s.gid, s.a, s.b, s.psig, w.seq AS m, w.x, w.y, pa.x AS ax, pa.y AS ay,
                                 pb.x - pa.x AS dx, pb.y - pa.y AS dy
                          FROM dp_seg s
                          JOIN {src} pa ON pa.gid = s.gid AND pa.seq = s.a
                          JOIN {src} pb ON pb.gid = s.gid AND pb.seq = s.b
                          JOIN {src} w ON w.gid = s.gid AND w.seq > s.a AND w.seq < s.b) l1) l2) l3) l4,
       (SELECT unnest([0, 1]) AS side) sd
  WHERE rn = 1),
dp_raw AS (
  SELECT v.gid, v.seq, s.psig AS sig
  FROM {src} v LEFT JOIN (SELECT gid, b, psig FROM dp_seg WHERE side = 0) s ON s.gid = v.gid AND s.b = v.seq),
dp_closed AS (
  SELECT gid FROM (SELECT gid, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1,
                          arg_max(y, seq) AS y1 FROM {src} GROUP BY gid) WHERE x0 = x1 AND y0 = y1),
dp_sig AS (
  SELECT r.gid, r.seq, r.sig,
         coalesce(r.sig IS NOT NULL AND r.gid IN (SELECT gid FROM dp_closed)
                  AND row_number() OVER (PARTITION BY r.gid ORDER BY r.sig DESC NULLS LAST, r.seq) <= 2, FALSE)
           AS protect
  FROM dp_raw r)"""


@query("generalize_significance", "WITH RECURSIVE " + OF.WAY_NODES.strip() + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """
SELECT gid AS fid, CAST(seq AS INTEGER) AS seq, round(sig, 4) AS sig FROM dp_sig""")
def q_significance(spark, d):
    """C2 per-vertex significance, all lines of a batch together."""
    s = significance_of_lines(lines(Tables(spark, d)))
    return s.select("fid", F.col("seq").cast("int").alias("seq"),
                    F.when(F.col("sig") != F.lit(float("inf")), F.round("sig", 4)).alias("sig"))


@query("generalize_significance_rounds", "WITH RECURSIVE " + OF.WAY_NODES.strip() + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """
SELECT gid AS fid, CAST(seq AS INTEGER) AS seq, round(sig, 4) AS sig FROM dp_sig""")
def q_significance_rounds(spark, d):
    """C2 over vertex rows, through the distributed rounds."""
    s = significance(vertex_rows(lines(Tables(spark, d))), ["fid", "part", "ring"])
    return s.select("fid", F.col("seq").cast("int").alias("seq"),
                    F.when(F.col("sig") != F.lit(float("inf")), F.round("sig", 4)).alias("sig"))


# roads ladder (tolerance, filter over the base table's attributes and length)
_MINOR6 = "('path', 'track', 'footway', 'bridleway', 'service', 'cycleway')"
# Rung, tolerance and filter
ROAD_RUNGS = [
    (15, 3, "(service <= 1) OR (length > 50)"),
    (14, 5, f"rank <= 15 OR bridge OR (subclass IN {_MINOR6} AND length > 100)"),
    (13, 10, f"rank <= 15 OR bridge OR (subclass IN {_MINOR6} AND length > 200)"),
    (12, 20, "rank <= 11 OR bridge OR (subclass = 'path' AND bicycle >= 3) OR "
             "(subclass IN ('track', 'service', 'cycleway') AND length > 500) OR "
             "(subclass IN ('living_street', 'pedestrian', 'residential', 'unclassified') AND length > 200)"),
    (11, 50, "rank <= 10"),
    (10, 100, "rank <= 4"),
    (9, 200, "rank <= 3"),
    (8, 400, "rank <= 3"),
]


def roads_base(t: Tables):
    """Ways with their attributes and base length (measured below the join so
    rung filters read a column, not a copy of the length expression)."""
    ln = lines(t).withColumn("length", G.length("geom"))
    return ln.join(FX.way_attrs(t), "fid")


def _ladder_out(lv):
    """Per (gen, fid): kept vertices and the simplified length."""
    w = lv.groupBy("gen", "fid").agg(
        F.count("*").cast("int").alias("nv"),
        F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("_v"),
    )
    geom = G.line_geom(F.transform("_v", lambda p: G.vertex(p["x"], p["y"])))
    return w.select(F.col("gen").cast("int").alias("gen"), "fid", "nv",
                    F.round(G.length(geom), 3).alias("length"))


@query("ladder_roads", "WITH RECURSIVE " + ",\n".join([OF.WAY_NODES.strip(), OF.WAY_ATTRS.strip()]) + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
base AS (SELECT a.*, l.length FROM way_attrs_r a JOIN (
  SELECT fid, sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS length
  FROM (SELECT fid, x, y, lead(x) OVER (PARTITION BY fid ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY fid ORDER BY seq) AS ny FROM line_verts) GROUP BY fid) l USING (fid)),
rungs AS (""" + "\n  UNION ALL ".join(
    f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, fid FROM base WHERE {cond}" for g, tol, cond in ROAD_RUNGS
) + """),
kept AS (SELECT r.gen, r.fid, v.seq, v.x, v.y FROM rungs r JOIN line_verts v ON v.fid = r.fid
         JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect)
SELECT CAST(gen AS INTEGER) AS gen, fid, CAST(count(*) AS INTEGER) AS nv, round(sum(CASE WHEN nx IS NULL THEN 0
       ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END), 3) AS length
FROM (SELECT gen, fid, x, y, lead(x) OVER (PARTITION BY gen, fid ORDER BY seq) AS nx,
             lead(y) OVER (PARTITION BY gen, fid ORDER BY seq) AS ny FROM kept)
GROUP BY gen, fid""")
def q_ladder_roads(spark, d):
    """C8 roads ladder: 8 rungs from one significance pass (in-row per way)."""
    t = Tables(spark, d)
    base = roads_base(t)
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in ROAD_RUNGS]
    lr = ladder_rings(base, rungs)  # ways have one part and one line
    return lr.select(F.col("gen").cast("int").alias("gen"), "fid", F.size("verts").cast("int").alias("nv"),
                     F.round(G.ring_length(F.col("verts")), 3).alias("length"))


# Rung, tolerance and filter
LANDUSE_RUNGS = [(14, 5, "area > 1000"), (13, 10, "area > 2000")]


# Rungs (gen, tolerance, filter) of the other area and line tables
LANDCOVER_RUNGS = [(14, 5, "area > 1000"), (13, 10, "area > 2000")]
BUILDING_RUNGS = [(14, 5, "area > 80")]
BATHYMETRY_RUNGS = [(4, 2000, "TRUE"), (3, 8000, "TRUE")]
TRANSPORTATION_RUNGS = [(12, 20, "length > 50"), (10, 50, "length > 100"), (8, 100, "length > 200")]
LABEL_RUNGS = [(15, ["city", "town"]), (14, ["city"]), (13, ["city", "hamlet"]), (12, ["hamlet"]), (11, ["hamlet"]),
               (10, ["village", "suburb", "hamlet"]), (8, ["town", "village", "suburb", "hamlet"])]  # subclasses left out


def _rung_sql(rungs, key: str) -> str:
    return "rungs AS (" + "\n  UNION ALL ".join(
        f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, {key} FROM base WHERE {cond}" for g, tol, cond in rungs) + ")"


def _area_ladder_sql(rungs) -> str:
    return "WITH RECURSIVE " + OF.POLY.strip() + """,
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM poly_verts),""" + dp_sql("dp_in") + ",\n" + """
ring_area AS (
  SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
  FROM (SELECT osm_id, ring, seq, x, y,
               lead(x) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS ny FROM poly_verts)
  WHERE nx IS NOT NULL GROUP BY osm_id, ring),
base AS (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ring_area GROUP BY osm_id),
""" + _rung_sql(rungs, "osm_id") + """
SELECT CAST(r.gen AS INTEGER) AS gen, r.osm_id AS fid, CAST(count(*) AS INTEGER) AS nv
FROM rungs r JOIN poly_verts v ON v.osm_id = r.osm_id
JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect
GROUP BY r.gen, r.osm_id"""


def _by_gen(spark, ladder, tag: str):
    """The ladder written by rung and read back; a rung is a pruned scan."""
    from gridloom.plans.q_io import _scratch
    path = _scratch(spark, tag)
    ladder.write.partitionBy("gen").parquet(path)
    rungs = spark.read.schema(ladder.schema).parquet(path).select("gen", "fid", F.size("verts").alias("_n"))
    # nearly every row is a group of its own, so the tasks that sum them up follow the rows
    rungs = spread(rungs, "gen", "fid", rows=5 * SPREAD_ROWS)
    return rungs.groupBy("gen", "fid").agg(F.sum("_n").cast("int").alias("nv")).select(
        F.col("gen").cast("int").alias("gen"), "fid", "nv")


def _area_ladder(spark, d, rungs, tag: str):
    p = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom")
    base = p.withColumn("area", G.area("geom"))
    return _by_gen(spark, ladder_rings(base, [Rung(g, tol, F.expr(c)) for g, tol, c in rungs]), tag)


@query("ladder_landuse", _area_ladder_sql(LANDUSE_RUNGS))
def q_ladder_landuse(spark, d):
    return _area_ladder(spark, d, LANDUSE_RUNGS, "landuse")


@query("ladder_landcover", _area_ladder_sql(LANDCOVER_RUNGS))
def q_ladder_landcover(spark, d):
    return _area_ladder(spark, d, LANDCOVER_RUNGS, "landcover")


@query("ladder_buildings", _area_ladder_sql(BUILDING_RUNGS))
def q_ladder_buildings(spark, d):
    return _area_ladder(spark, d, BUILDING_RUNGS, "buildings")


@query("ladder_bathymetry", _area_ladder_sql(BATHYMETRY_RUNGS))
def q_ladder_bathymetry(spark, d):
    return _area_ladder(spark, d, BATHYMETRY_RUNGS, "bathymetry")


@query("ladder_transportation", "WITH RECURSIVE " + OF.WAY_NODES.strip() + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
base AS (
  SELECT fid, sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS length
  FROM (SELECT fid, x, y, lead(x) OVER (PARTITION BY fid ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY fid ORDER BY seq) AS ny FROM line_verts) GROUP BY fid),
""" + _rung_sql(TRANSPORTATION_RUNGS, "fid") + """
SELECT CAST(r.gen AS INTEGER) AS gen, r.fid, CAST(count(*) AS INTEGER) AS nv
FROM rungs r JOIN line_verts v ON v.fid = r.fid JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq
WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect GROUP BY r.gen, r.fid""")
def q_ladder_transportation(spark, d):
    base = lines(Tables(spark, d)).withColumn("length", G.length("geom"))
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in TRANSPORTATION_RUNGS]
    return _by_gen(spark, ladder_rings(base, rungs), "transportation")


@query("ladder_label", OF.with_(OF.LABEL) + "\n" + "\nUNION ALL ".join(
    f"SELECT CAST({g} AS INTEGER) AS gen, osm_id FROM label_pts WHERE subclass NOT IN ({', '.join(repr(x) for x in out)})"
    for g, out in LABEL_RUNGS))
def q_ladder_label(spark, d):
    """The seven label rungs, each a filter on the subclass, as one table by rung."""
    lab = FX.label_points(Tables(spark, d))
    gens = F.array(*[F.when(~F.col("subclass").isin(*out), F.lit(g)) for g, out in LABEL_RUNGS])
    return lab.select(F.explode(F.filter(gens, lambda g: g.isNotNull())).alias("gen"), "osm_id")


@query("assemble_ways", OF.with_(OF.WAY_NODES) + """
SELECT fid, CAST(count(*) AS INTEGER) AS nv,
       CAST(sum((seq + 1) * x) AS BIGINT) AS wx, CAST(sum((seq + 1) * y) AS BIGINT) AS wy,
       CAST(arg_min(x, seq) AS BIGINT) AS x0, CAST(arg_max(y, seq) AS BIGINT) AS y1
FROM line_verts GROUP BY fid""")
def q_assemble(spark, d):
    ln = lines(Tables(spark, d))
    v = F.col("geom.parts")[0][0]
    idx = F.transform(v, lambda p, i: (i + 1) * p["x"])
    idy = F.transform(v, lambda p, i: (i + 1) * p["y"])
    return ln.select(
        "fid", F.col("nv").cast("int").alias("nv"),
        F.aggregate(idx, F.lit(0.0), lambda a, b: a + b).cast("bigint").alias("wx"),
        F.aggregate(idy, F.lit(0.0), lambda a, b: a + b).cast("bigint").alias("wy"),
        F.element_at(v, 1)["x"].cast("bigint").alias("x0"),
        F.element_at(v, -1)["y"].cast("bigint").alias("y1"),
    )


@query("relation_members", OF.with_(OF.WAY_NODES) + """,
rel AS (SELECT o_custkey AS relation_id, o_orderkey AS member_ref,
               CASE WHEN o_custkey % 4 = 0 THEN 'multipolygon' ELSE 'route' END AS type,
               CASE WHEN o_custkey % 3 = 1 THEN 'hiking' ELSE 'bicycle' END AS route,
               CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'C' || CAST(o_custkey % 17 AS VARCHAR) END AS ref
        FROM orders)
SELECT r.relation_id, r.member_ref AS fid, r.route, r.ref, CAST(count(*) AS INTEGER) AS nv
FROM rel r JOIN line_verts v ON v.fid = r.member_ref
WHERE r.type = 'route' AND r.route = 'bicycle'
GROUP BY r.relation_id, r.member_ref, r.route, r.ref""")
def q_relation_members(spark, d):
    t = Tables(spark, d)
    m = relation_members(FX.route_relations(t), lines(t))
    m = m.where(F.col("route") == "bicycle")
    return m.select("relation_id", "fid", "route", "ref", F.col("nv").cast("int").alias("nv"))


# waterarea ladder: gen14/13 from the base, gen12..8 from gen13 -- their filters
# read the area of the gen13 geometry (the source rung), not the base area
# Rung, tolerance and filter
WATERAREA_BASE_RUNGS = [(14, 5, "area > 1000"), (13, 10, "area > 2000")]
WATERAREA_CASCADE = [(12, 20, "area13 > 5000"), (11, 50, "area13 > 50000"), (10, 100, "area13 > 200000"),
                     (9, 200, "area13 > 2000000"), (8, 250, "area13 > 5000000")]


def _rings_area(lr):
    """(gen, fid, part, ring, verts) -> (gen, fid, area): shell minus holes."""
    a = F.abs(G.ring_signed_area(F.col("verts")))
    return lr.groupBy("gen", "fid").agg(F.sum(F.when(F.col("ring") == 0, a).otherwise(-a)).alias("area"))


def _with_area13(base):
    """Adds ``area13``, the area of the gen13 rung."""
    a13 = _rings_area(ladder_rings(base, [Rung(13, 10.0)])).select("fid", F.col("area").alias("area13"))
    # Spark takes the geometries for as small as the file they are made from, and would send them whole through the driver
    return base.join(a13.hint("merge"), "fid")


@query("ladder_waterarea", "WITH RECURSIVE " + OF.POLY.strip() + """,
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM poly_verts),""" + dp_sql("dp_in") + """,
k13 AS (SELECT v.osm_id, v.ring, v.seq, v.x, v.y FROM poly_verts v
        JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
        WHERE s.sig IS NULL OR s.sig > 10 OR s.protect),
ra13 AS (SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
         FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM k13
               WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL GROUP BY osm_id, ring),
a13 AS (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area13 FROM ra13 GROUP BY osm_id),
ra AS (SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
       FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts
             WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL GROUP BY osm_id, ring),
base AS (SELECT b.osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area, any_value(a13.area13) AS area13
         FROM ra b JOIN a13 USING (osm_id) GROUP BY b.osm_id),
rungs AS (""" + "\n  UNION ALL ".join(
    f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, osm_id FROM base WHERE {c}"
    for g, tol, c in WATERAREA_BASE_RUNGS + WATERAREA_CASCADE) + """)
SELECT CAST(r.gen AS INTEGER) AS gen, r.osm_id AS fid, CAST(count(*) AS INTEGER) AS nv
FROM rungs r JOIN poly_verts v ON v.osm_id = r.osm_id
JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect
GROUP BY r.gen, r.osm_id""")
def q_ladder_waterarea(spark, d):
    """C8 cascaded ladder: gen12..8 simplify the gen13 copy (equal to simplifying
    the base at the larger tolerance) and filter on the gen13 area."""
    p = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom")
    base = p.withColumn("area", G.area("geom"))
    base = _with_area13(base)
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in WATERAREA_BASE_RUNGS + WATERAREA_CASCADE]
    lr = ladder_rings(base, rungs)
    return lr.groupBy("gen", "fid").agg(F.sum(F.size("verts")).cast("int").alias("nv")).select(
        F.col("gen").cast("int").alias("gen"), "fid", "nv")


def waterarea_rungs(spark, d):
    """(gen, fid, part, ring, verts) of every waterarea rung (cascaded filters)."""
    p = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom")
    base = p.withColumn("area", G.area("geom"))
    base = _with_area13(base)
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in WATERAREA_BASE_RUNGS + WATERAREA_CASCADE] + [Rung(0, -1.0)]
    return ladder_rings(base, rungs)
