"""Border dump (S7) -> border ladder (C2/C8) -> world.admin zoom bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators.ladder import Rung, ladder_rings
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import lines, query
from gridloom.plans.q_generalize import dp_sql
from gridloom.plans.q_io import _scratch
from gridloom.sources.tables import Tables
from gridloom.sources.tsv import coords_text, read_borders, write_borders

# Rung, tolerance and filter
BORDER_RUNGS = [(14, 5, "admin_level <= 6"), (12, 10, "admin_level <= 6"), (10, 50, "admin_level <= 6"),
                (8, 100, "admin_level <= 4"), (6, 1000, "admin_level <= 4"), (4, 10000, "admin_level <= 2"),
                (2, 10000000, "admin_level <= 2")]


def border_rows(t: Tables):
    """Border dump rows built from the assembled ways (the job's input file)."""
    ln = lines(t)
    k = F.col("fid")
    return ln.select(k.alias("osm_id"), (k % 10 + 1).cast("int").alias("admin_level"),
                     (k % 2 == 0).alias("dividing_line"), (k % 7 == 0).alias("disputed"),
                     (k % 5 == 0).alias("maritime"), coords_text("geom").alias("geometry"))


@query("border_ladder", "WITH RECURSIVE " + OF.WAY_NODES.strip() + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
base AS (SELECT DISTINCT fid, CAST(fid % 10 + 1 AS INTEGER) AS admin_level, (fid % 5 = 0) AS maritime
         FROM line_verts),
rungs AS (""" + "\n  UNION ALL ".join(
    f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, fid, admin_level, maritime FROM base WHERE {c}"
    for g, tol, c in BORDER_RUNGS) + """)
SELECT CAST(r.gen AS INTEGER) AS gen, r.fid AS osm_id, r.admin_level, r.maritime, CAST(count(*) AS INTEGER) AS nv
FROM rungs r JOIN line_verts v ON v.fid = r.fid JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq
WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect
GROUP BY r.gen, r.fid, r.admin_level, r.maritime""")
def q_border_ladder(spark, d):
    """Borders dumped as TSV and read back with the declared schema (S7), then
    the border ladder: one significance pass, seven filtered rungs."""
    path = _scratch(spark, "borders")
    write_borders(border_rows(Tables(spark, d)), path)
    b = read_borders(spark, path).withColumnRenamed("osm_id", "fid")
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in BORDER_RUNGS]
    lr = ladder_rings(b, rungs)  # one line per border
    out = lr.select("gen", "fid", F.size("verts").cast("int").alias("nv"))
    out = out.join(b.select("fid", "admin_level", "maritime"), "fid")
    return out.select(F.col("gen").cast("int").alias("gen"), F.col("fid").alias("osm_id"), "admin_level",
                      "maritime", "nv")
