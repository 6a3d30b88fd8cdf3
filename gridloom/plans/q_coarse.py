"""C7 coarse water query."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.areaclip import cut_by_grid
from gridloom.operators.closing import rasterize, row_runs
from gridloom.operators.coarse import blur_threshold, blurred, contour, kernel_offsets, slice_by_grid
from gridloom.operators.outline import sweep, to_polygons
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import query
from gridloom.plans.clip_sql import clip_rings_sql
from gridloom.plans.q_closing import trace_sql
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

CELL, GRID_N = 100.0, 16
_K = kernel_offsets()
_KDX = "[" + ", ".join(str(dx) for dx, _, _ in _K) + "]"
_KDY = "[" + ", ".join(str(dy) for _, dy, _ in _K) + "]"
_KW = "[" + ", ".join(repr(w) for _, _, w in _K) + "]"


@query("coarse_water", OF.with_(OF.POLY, f"""
wpoly AS (SELECT osm_id FROM poly_base),
edges AS (SELECT osm_id, x, y, nx, ny FROM (
            SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts
            WHERE osm_id IN (SELECT osm_id FROM wpoly)
            WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL),
bb AS (SELECT osm_id, min(y) AS miny, max(y) AS maxy FROM poly_verts WHERE osm_id IN (SELECT osm_id FROM wpoly)
       GROUP BY osm_id),
rws AS (SELECT osm_id, unnest(generate_series(CAST(floor(miny / {CELL}) AS BIGINT),
                                              CAST(floor(maxy / {CELL}) AS BIGINT))) AS cy FROM bb),
xs AS (SELECT r.osm_id, r.cy, e.x + ((r.cy + 0.5) * {CELL} - e.y) * (e.nx - e.x) / (e.ny - e.y) AS xc
       FROM rws r JOIN edges e USING (osm_id)
       WHERE (e.y > (r.cy + 0.5) * {CELL}) <> (e.ny > (r.cy + 0.5) * {CELL})),
runs AS (SELECT osm_id, cy, xc, (row_number() OVER (PARTITION BY osm_id, cy ORDER BY xc) - 1) // 2 AS run FROM xs),
rr AS (SELECT osm_id, cy, min(xc) AS l, max(xc) AS r FROM runs GROUP BY osm_id, cy, run),
cells AS (SELECT DISTINCT cy, unnest(generate_series(CAST(ceil(l / {CELL} - 0.5) AS BIGINT),
                                                    CAST(ceil(r / {CELL} - 0.5) AS BIGINT) - 1)) AS cx FROM rr),
k AS (SELECT unnest({_KDX}) AS dx, unnest({_KDY}) AS dy, unnest({_KW}) AS w),
sh AS (SELECT cx + dx AS cx, cy + dy AS cy, sum(w) AS share FROM cells, k GROUP BY cx + dx, cy + dy),
low AS (SELECT cx, cy FROM sh WHERE 255 + (0 - 255) * share < 128)""") + f"""
SELECT CAST(floor(cx / {GRID_N}) AS BIGINT) AS gx, CAST(floor(cy / {GRID_N}) AS BIGINT) AS gy, count(*) AS n_cells
FROM low GROUP BY 1, 2""")
def q_coarse_water(spark, d):
    """Water polygons rasterized at 100 m cells, blurred (5x5 kernel),
    kept under level 128, sliced into 16x16-cell grid pieces (C7, J6)."""
    p = FX.polygons(Tables(spark, d))
    cells = rasterize(p.select(F.col("osm_id").alias("fid"), "geom"), CELL).select("cx", "cy").distinct()
    low = slice_by_grid(blur_threshold(cells), GRID_N)
    return low.groupBy(F.col("gx").cast("long").alias("gx"), F.col("gy").cast("long").alias("gy")).agg(
        F.count("*").alias("n_cells"))


# ---------------------------------------------------------------- contour polygons of the rungs z2 to z8

# a rung's cells are twice as wide as the next one's, as its zoom asks for half the detail
WATER_RUNGS = {rung: 50.0 * 2 ** (8 - rung) for rung in range(2, 9)}


def _rung_sql(rung: int, cell: float) -> str:
    return f"""
  SELECT DISTINCT {rung} AS rung, cy, unnest(generate_series(CAST(ceil(l / {cell} - 0.5) AS BIGINT), CAST(ceil(r / {cell} - 0.5) AS BIGINT) - 1)) AS cx
  FROM (SELECT cy, min(xc) AS l, max(xc) AS r FROM (
    SELECT osm_id, cy, xc, (row_number() OVER (PARTITION BY osm_id, cy ORDER BY xc) - 1) // 2 AS run FROM (
      SELECT r.osm_id, r.cy, e.x + ((r.cy + 0.5) * {cell} - e.y) * (e.nx - e.x) / (e.ny - e.y) AS xc
      FROM (SELECT osm_id, unnest(generate_series(CAST(floor(miny / {cell}) AS BIGINT), CAST(floor(maxy / {cell}) AS BIGINT))) AS cy FROM bb) r
      JOIN edges e USING (osm_id) WHERE (e.y > (r.cy + 0.5) * {cell}) <> (e.ny > (r.cy + 0.5) * {cell})))
    GROUP BY osm_id, cy, run)"""


_CONTOUR_SQL = "WITH RECURSIVE " + OF.POLY.strip() + f""",
edges AS (SELECT osm_id, x, y, nx, ny FROM (
            SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL),
bb AS (SELECT osm_id, min(y) AS miny, max(y) AS maxy FROM poly_verts GROUP BY osm_id),
cells AS ({" UNION ALL ".join(_rung_sql(r, c) for r, c in WATER_RUNGS.items())}),
kern AS (SELECT unnest({_KDX}) AS dx, unnest({_KDY}) AS dy, unnest({_KW}) AS w),
vals AS (SELECT rung, cx + dx AS cx, cy + dy AS cy, 255 + (0 - 255) * sum(w) AS value FROM cells, kern GROUP BY rung, cx + dx, cy + dy),
low AS (SELECT rung, cx, cy FROM vals WHERE value < 128),""" + trace_sql("low", "rung") + """,
-- each side lies between a low cell and one that isn't
pairs AS (
  SELECT ring, k, key, ax - CASE WHEN d IN (1, 2) THEN 1 ELSE 0 END AS cx, ay - CASE WHEN d IN (2, 3) THEN 1 ELSE 0 END AS cy,
         CASE d WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS dx, CASE d WHEN 0 THEN -1 WHEN 2 THEN 1 ELSE 0 END AS dy FROM ring_sides),
crossed AS (
  SELECT p.ring, p.k, p.key, p.cx + 0.5 + (128 - a.value) / (coalesce(b.value, 255.0) - a.value) * p.dx AS x,
         p.cy + 0.5 + (128 - a.value) / (coalesce(b.value, 255.0) - a.value) * p.dy AS y
  FROM pairs p JOIN vals a ON a.rung = p.key AND a.cx = p.cx AND a.cy = p.cy
  LEFT JOIN vals b ON b.rung = p.key AND b.cx = p.cx + p.dx AND b.cy = p.cy + p.dy),
widths AS (""" + " UNION ALL ".join(f"SELECT {r} AS rung, CAST({c} AS DOUBLE) AS cell" for r, c in WATER_RUNGS.items()) + """),
contour AS (SELECT c.ring, c.k, c.key AS rung, c.x * w.cell AS x, c.y * w.cell AS y, w.cell FROM crossed c JOIN widths w ON w.rung = c.key)"""


def _contours(spark, d):
    """(fid = rung, ring, shell, verts) of every rung, in units of the map."""
    polys = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom")
    runs = None
    for rung, cell in WATER_RUNGS.items():
        own = row_runs(polys, cell).withColumn("fid", F.lit(rung))
        runs = own if runs is None else runs.unionByName(own)
    cells = sweep(runs).select("fid", "cy", F.explode(F.sequence("c0", "c1")).alias("cx"))
    rings = contour(blurred(cells, ("fid",)))
    cell = F.element_at(F.array(*[F.lit(c) for _, c in sorted(WATER_RUNGS.items())]), F.col("fid") - min(WATER_RUNGS) + 1)
    return rings.select("fid", "ring", "shell", F.transform("verts", lambda v: G.vertex(v["x"] * cell, v["y"] * cell)).alias("verts"))


@query("coarse_water_contour", _CONTOUR_SQL + """,
legs AS (SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny
         FROM contour WINDOW w AS (PARTITION BY ring ORDER BY k))
SELECT CAST(rung AS INTEGER) AS rung, count(*) AS n_vertices, round(sum(x * ny - nx * y) / 2.0, 1) AS area,
       string_agg(CAST(round(x * 100) AS BIGINT) || ' ' || CAST(round(y * 100) AS BIGINT), ',' ORDER BY round(x * 100), round(y * 100)) AS vertices
FROM legs GROUP BY rung, ring""")
def q_coarse_water_contour(spark, d):
    """The level-128 contour of the blurred water raster of every rung z2 to z8, ring by ring; holes have a negative area."""
    rings = _contours(spark, d)
    points = F.array_sort(F.transform(F.slice("verts", F.lit(1), F.size("verts") - 1), lambda v: F.struct(F.round(v["x"] * 100).cast("bigint").alias("x"), F.round(v["y"] * 100).cast("bigint").alias("y"))))
    return rings.select(F.col("fid").alias("rung"), (F.size("verts") - 1).cast("bigint").alias("n_vertices"), F.round(G.ring_signed_area(F.col("verts")), 1).alias("area"),
                        F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["x"], p["y"])), ",").alias("vertices"))


@query("coarse_water_slices", _CONTOUR_SQL + f""",
spans AS (SELECT rung, ring, any_value(cell) * {GRID_N} AS side, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy FROM contour GROUP BY rung, ring),
squares AS (
  SELECT *, row_number() OVER () AS k FROM (
    SELECT *, unnest(generate_series(CAST(floor(miny / side) AS BIGINT), CAST(floor(maxy / side) AS BIGINT))) AS gy FROM (
      SELECT *, unnest(generate_series(CAST(floor(minx / side) AS BIGINT), CAST(floor(maxx / side) AS BIGINT))) AS gx FROM spans))),
cut_in AS (
  SELECT s.k, c.ring, c.k AS seq, c.x, c.y, s.gx * side AS x0, (s.gx + 1) * side AS x1, s.gy * side AS y0, (s.gy + 1) * side AS y1
  FROM squares s JOIN contour c ON c.ring = s.ring),""" + clip_rings_sql("cut_in") + """
SELECT CAST(s.rung AS INTEGER) AS rung, s.gx, s.gy, round(sum(x * ny - nx * y) / 2.0, 1) AS area
FROM clipped c JOIN squares s USING (k) GROUP BY s.rung, s.gx, s.gy HAVING round(sum(x * ny - nx * y) / 2.0, 1) <> 0""")
def q_coarse_water_slices(spark, d):
    """The contour polygons of every rung cut by a grid of 16 x 16 cells."""
    polys = to_polygons(_contours(spark, d)).select(F.col("fid").alias("rung"), F.col("geom.parts").alias("parts"))
    # one row a part: a rung's water is dealt out over the cluster
    cut = cut_by_grid(polys.select("rung", F.explode("parts").alias("p")).select("rung", F.array("p").alias("parts"), F.element_at(F.array(*[F.lit(c * GRID_N) for _, c in sorted(WATER_RUNGS.items())]), F.col("rung") - min(WATER_RUNGS) + 1).alias("side")), "side")
    area = F.sum(G.area(G.make_geom("MultiPolygon", "parts")))
    return cut.groupBy("rung", "gx", "gy").agg(F.round(area, 1).alias("area")).where("area <> 0")
