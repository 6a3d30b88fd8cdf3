"""World layers: S19 bathymetry / lakes unions, U1+P8+T7 water bands, S21 size report."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G
from gridloom.functions.geometry import WORLD_EDGE
from gridloom.functions.tiles import TILE_EXTENT
from gridloom.operators import attributes as A
from gridloom.operators.ladder import Rung, ladder_rings
from gridloom.operators.unions import typed_union
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import NAME_SQL, lines, query
from gridloom.plans.q_generalize import dp_sql
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

# The bathymetry sources in union order, with their depths.
BATHYMETRY_SOURCES = [("k_200", 200), ("j_1000", 1000), ("i_2000", 2000), ("h_3000", 3000), ("g_4000", 4000),
                      ("f_5000", 5000), ("e_6000", 6000), ("d_7000", 7000), ("c_8000", 8000), ("b_9000", 9000),
                      ("a_10000", 10000)]
LAKE_SOURCES = ["ne_10m_lakes", "ne_10m_lakes_europe"]

BATHY_SCHEMA = T.StructType([T.StructField("depth", T.IntegerType()), T.StructField("src_key", T.LongType())])


def bathymetry_sources(t: Tables):
    """One DataFrame per source file (suppliers spread over the 11 sources)."""
    s = t.supplier
    n = len(BATHYMETRY_SOURCES)
    return [s.where(F.col("s_suppkey") % n == i).select(F.lit(depth).alias("depth"), F.col("s_suppkey").alias("src_key"))
            for i, (_, depth) in enumerate(BATHYMETRY_SOURCES)]


@query("bathymetry_union", "WITH u AS (" + "\nUNION ALL ".join(
    f"SELECT {i} AS src, s_suppkey AS src_key, {depth} AS depth FROM supplier WHERE s_suppkey % "
    f"{len(BATHYMETRY_SOURCES)} = {i}" for i, (_, depth) in enumerate(BATHYMETRY_SOURCES)) + """)
SELECT row_number() OVER (ORDER BY src, src_key) AS gid, CAST(depth AS INTEGER) AS depth, src_key FROM u""")
def q_bathymetry(spark, d):
    """Typed union of the 11 bathymetry sources, serial gid in load order."""
    return typed_union(bathymetry_sources(Tables(spark, d)), BATHY_SCHEMA, "src_key").select(
        "gid", "depth", "src_key")


LAKE_SCHEMA = T.StructType([
    T.StructField("name_de", T.StringType()), T.StructField("name_en", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("featurecla", T.StringType()),
    T.StructField("scalerank", T.LongType()), T.StructField("min_zoom", T.DoubleType()),
    T.StructField("min_label", T.DoubleType()), T.StructField("src_key", T.LongType()),
])


def lake_sources(t: Tables):
    c = t.customer
    k = F.col("c_custkey")
    base = c.select(
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("See "), (k % 97).cast("string"))).alias("name_de"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("")).alias("name_en"),
        F.concat(F.lit("Lake "), (k % 97).cast("string")).alias("name"),
        F.when(k % 4 == 0, F.lit("Reservoir")).otherwise(F.lit("Lake")).alias("featurecla"),
        (k % 10).alias("scalerank"), (k % 8).cast("double").alias("min_zoom"),
        ((k % 8) + 1.5).alias("min_label"), k.alias("src_key"))
    return [base.where(k % 2 == i) for i in range(len(LAKE_SOURCES))]


@query("lakes_union", """WITH u AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 1 END AS src, c_custkey AS src_key,
         CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'See ' || CAST(c_custkey % 97 AS VARCHAR) END AS name_de,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '' END AS name_en,
         'Lake ' || CAST(c_custkey % 97 AS VARCHAR) AS name,
         CASE WHEN c_custkey % 4 = 0 THEN 'Reservoir' ELSE 'Lake' END AS featurecla,
         c_custkey % 10 AS scalerank, CAST(c_custkey % 8 AS DOUBLE) AS min_zoom
  FROM customer)
SELECT gid, name, subclass, scalerank, minzoom, z, src_key FROM (
  SELECT row_number() OVER (ORDER BY src, src_key) AS gid, """ + NAME_SQL + """ AS name, featurecla AS subclass,
         scalerank, min_zoom AS minzoom, src_key FROM u) n, (SELECT unnest(range(0, 17)) AS z) zs
WHERE minzoom <= z""")
def q_lakes(spark, d, zooms=(0, 16)):
    """S19 lakes union + the ``world.lakes`` layer gate (minzoom <= z, P9) at the zooms from, to."""
    u = typed_union(lake_sources(Tables(spark, d)), LAKE_SCHEMA, "src_key")
    u = u.select("gid", A.name_fallback().alias("name"), F.col("featurecla").alias("subclass"), "scalerank",
                 F.col("min_zoom").alias("minzoom"), "src_key")
    z = u.withColumn("z", F.explode(F.sequence(F.lit(zooms[0]), F.lit(zooms[1]))))
    return z.where(F.col("minzoom") <= F.col("z")).select("gid", "name", "subclass", "scalerank", "minzoom",
                                                          F.col("z").cast("long").alias("z"), "src_key")


# water bands: zoom -> table (z2..z8 rungs, then simplified, then full)
# Fixed values
WATER_BANDS = [(0, 2, 2), (2, 3, 3), (3, 4, 4), (4, 5, 5), (5, 6, 6), (6, 7, 7), (7, 8, 8), (8, 9, 9), (9, 99, 99)]


def band_tolerance(gen: int) -> float:
    """One pixel of the 4096 tile grid at the rung's zoom; -1 = full detail, every vertex."""
    return -1.0 if gen >= 99 else (2.0 * WORLD_EDGE / (2 ** gen)) / TILE_EXTENT


@query("water_bands", "WITH RECURSIVE " + OF.POLY.strip() + """,
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM poly_verts),""" + dp_sql("dp_in") + """,
water AS (SELECT osm_id FROM poly_base),
bands AS (""" + "\n  UNION ALL ".join(
    f"SELECT {z} AS z, CAST({band_tolerance(g)!r} AS DOUBLE) AS tol" for lo, hi, g in WATER_BANDS
    for z in range(lo, min(hi, 17))) + """)
SELECT CAST(b.z AS INTEGER) AS z, v.osm_id, CAST(count(*) AS INTEGER) AS nv
FROM water w JOIN poly_verts v ON v.osm_id = w.osm_id
JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq, bands b
WHERE s.sig IS NULL OR s.sig > b.tol OR s.protect
GROUP BY b.z, v.osm_id""")
def q_water_bands(spark, d, zooms=(0, 16)):
    """U1 + P8 + T7: the ``world.water`` layer's nine zoom bands as one
    significance pass and one rung per band (tolerance = a tile pixel), at the zooms from, to."""
    p = FX.polygons(Tables(spark, d))
    p = p.select(F.col("osm_id").alias("fid"), "geom")
    rungs = [Rung(z, band_tolerance(g)) for lo, hi, g in WATER_BANDS for z in range(max(lo, zooms[0]), min(hi, zooms[1] + 1))]
    lr = ladder_rings(p, rungs)
    return lr.groupBy("gen", "fid").agg(F.sum(F.size("verts")).cast("int").alias("nv")).select(
        F.col("gen").cast("int").alias("z"), F.col("fid").alias("osm_id"), "nv")


@query("size_report", OF.with_(OF.POI, OF.LABEL, OF.WAY_NODES, OF.POLY) + """
SELECT 'poi' AS "table", count(*) AS n_rows, count(*) AS n_vertices FROM poi
UNION ALL SELECT 'label', count(*), count(*) FROM label_pts
UNION ALL SELECT 'roads', count(DISTINCT fid), count(*) FROM line_verts
UNION ALL SELECT 'polygons', count(DISTINCT osm_id), count(*) FROM poly_verts""")
def q_size_report(spark, d):
    """Rows and vertices per feature table (the database-size print)."""
    t = Tables(spark, d)
    poi = FX.poi_points(t).agg(F.lit("poi").alias("table"), F.count("*").alias("n_rows"),
                               F.count("*").alias("n_vertices"))
    lab = FX.label_points(t).agg(F.lit("label").alias("table"), F.count("*").alias("n_rows"),
                                 F.count("*").alias("n_vertices"))
    rd = lines(t).agg(F.lit("roads").alias("table"), F.count("*").alias("n_rows"),
                      F.sum(G.num_vertices("geom")).cast("long").alias("n_vertices"))
    pl = FX.polygons(t).agg(F.lit("polygons").alias("table"), F.count("*").alias("n_rows"),
                            F.sum(G.num_vertices("geom")).cast("long").alias("n_vertices"))
    return poi.unionByName(lab).unionByName(rd).unionByName(pl)
