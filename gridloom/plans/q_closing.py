"""C3 closing rungs of the landuse and landcover ladders: closing(gen13) at each rung's tolerance."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.closing import disk_offsets, row_runs
from gridloom.operators.outline import closed_runs, outline, simplified, sweep, to_polygons
from gridloom.operators.simplify import simplified_lines
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import query
from gridloom.plans.q_generalize import dp_sql
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

SRC_TOL = 10.0
RADIUS = 2  # 2 * tol in cells of side tol
CLOSED_AREAS = 5000  # areas whose closing is one task's work
# Rung -> tolerance and smallest area of the source (gen13); landcover's gen8 differs by its area
CLOSING_RUNGS = {"gen12": (20.0, 5000.0), "gen11": (50.0, 50000.0), "gen10": (100.0, 200000.0),
                 "gen9": (150.0, 2000000.0), "gen8": (200.0, 4000000.0), "landcover_gen8": (200.0, 5000000.0)}
LARGE = 4.0  # stand-in for the large areas that the coarse rungs need: the test areas enlarged
_OFFS = disk_offsets(RADIUS)
_DX = "[" + ", ".join(str(dx) for dx, _ in _OFFS) + "]"
_DY = "[" + ", ".join(str(dy) for _, dy in _OFFS) + "]"


def _closed_sql(tol: float, min_area: float, scale: float, only: str = "TRUE") -> str:
    return "WITH RECURSIVE " + OF.POLY.strip() + f""",
pv AS (SELECT osm_id, ring, seq, x * {scale} AS x, y * {scale} AS y FROM poly_verts WHERE {only}),""" + """
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM pv),""" + dp_sql("dp_in") + f""",
g13 AS (SELECT v.osm_id, v.ring, v.seq, v.x, v.y FROM pv v
        JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
        WHERE s.sig IS NULL OR s.sig > {SRC_TOL} OR s.protect),
edges AS (SELECT osm_id, ring, x, y, nx, ny FROM (
            SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM g13
            WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL),
ra AS (SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a FROM edges GROUP BY osm_id, ring),
src AS (SELECT osm_id FROM ra GROUP BY osm_id HAVING sum(CASE WHEN ring = 0 THEN a ELSE -a END) > {min_area}),
bb AS (SELECT osm_id, min(y) AS miny, max(y) AS maxy FROM g13 WHERE osm_id IN (SELECT osm_id FROM src)
       GROUP BY osm_id),
rws AS (SELECT osm_id, unnest(generate_series(CAST(floor(miny / {tol}) AS BIGINT),
                                              CAST(floor(maxy / {tol}) AS BIGINT))) AS cy FROM bb),
xs AS (SELECT r.osm_id, r.cy, e.x + ((r.cy + 0.5) * {tol} - e.y) * (e.nx - e.x) / (e.ny - e.y) AS xc
       FROM rws r JOIN edges e USING (osm_id)
       WHERE (e.y > (r.cy + 0.5) * {tol}) <> (e.ny > (r.cy + 0.5) * {tol})),
runs AS (SELECT osm_id, cy, xc, (row_number() OVER (PARTITION BY osm_id, cy ORDER BY xc) - 1) // 2 AS run FROM xs),
rr AS (SELECT osm_id, cy, min(xc) AS l, max(xc) AS r FROM runs GROUP BY osm_id, cy, run),
cells AS (SELECT osm_id, cy, unnest(generate_series(CAST(ceil(l / {tol} - 0.5) AS BIGINT),
                                                    CAST(ceil(r / {tol} - 0.5) AS BIGINT) - 1)) AS cx FROM rr),
offs AS (SELECT unnest({_DX}) AS dx, unnest({_DY}) AS dy),
dil AS (SELECT DISTINCT osm_id, cx + dx AS cx, cy + dy AS cy FROM cells, offs),
ero AS (SELECT osm_id, cx - dx AS cx, cy - dy AS cy FROM dil, offs),
closed AS (SELECT osm_id, cx, cy FROM ero GROUP BY osm_id, cx, cy HAVING count(*) = {len(_OFFS)})"""


def _counts_sql(tol: float, min_area: float, scale: float) -> str:
    return _closed_sql(tol, min_area, scale) + f""",
nr AS (SELECT osm_id, count(*) AS n_raster FROM cells GROUP BY osm_id),
nc AS (SELECT osm_id, count(*) AS n_closed FROM closed GROUP BY osm_id)
SELECT nr.osm_id AS fid, nr.n_raster, coalesce(nc.n_closed, 0) AS n_closed,
       CAST(coalesce(nc.n_closed, 0) * {tol * tol} AS DOUBLE) AS area
FROM nr LEFT JOIN nc USING (osm_id)"""


def trace_sql(cells: str, key: str) -> str:
    """CTEs walking the outlines of ``cells`` (key, cx, cy): ``ring_sides`` (ring, k, key, ax, ay, d) in order, one walk a ring.

    A walk begins at every corner that can be a ring's lowest left one and stops at a lower one, so one is left of each ring.
    """
    return f"""
sides AS (
  SELECT c.{key} AS key, c.cx AS ax, c.cy AS ay, c.cx + 1 AS ex, c.cy AS ey, 0 AS d FROM {cells} c ANTI JOIN {cells} n ON n.{key} = c.{key} AND n.cx = c.cx AND n.cy = c.cy - 1
  UNION ALL
  SELECT c.{key}, c.cx + 1, c.cy, c.cx + 1, c.cy + 1, 1 FROM {cells} c ANTI JOIN {cells} n ON n.{key} = c.{key} AND n.cx = c.cx + 1 AND n.cy = c.cy
  UNION ALL
  SELECT c.{key}, c.cx + 1, c.cy + 1, c.cx, c.cy + 1, 2 FROM {cells} c ANTI JOIN {cells} n ON n.{key} = c.{key} AND n.cx = c.cx AND n.cy = c.cy + 1
  UNION ALL
  SELECT c.{key}, c.cx, c.cy + 1, c.cx, c.cy, 3 FROM {cells} c ANTI JOIN {cells} n ON n.{key} = c.{key} AND n.cx = c.cx - 1 AND n.cy = c.cy),
ahead AS (
  SELECT e.*, o.d AS nd FROM sides e JOIN sides o ON o.key = e.key AND o.ax = e.ex AND o.ay = e.ey AND (o.d - e.d + 4) % 4 <> 2
  QUALIFY row_number() OVER (PARTITION BY e.key, e.ax, e.ay, e.d ORDER BY CASE (o.d - e.d + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) = 1),
walk(key, sx, sy, sd, k, ax, ay, d, ex, ey, nd) AS (
  SELECT a.key, a.ax, a.ay, a.d, 0, a.ax, a.ay, a.d, a.ex, a.ey, a.nd FROM ahead a
  JOIN ahead p ON p.key = a.key AND p.ex = a.ax AND p.ey = a.ay AND p.nd = a.d AND ((p.d = 3 AND a.d = 0) OR (p.d = 2 AND a.d = 1))
  UNION ALL
  SELECT w.key, w.sx, w.sy, w.sd, w.k + 1, a.ax, a.ay, a.d, a.ex, a.ey, a.nd
  FROM walk w JOIN ahead a ON a.key = w.key AND a.ax = w.ex AND a.ay = w.ey AND a.d = w.nd
  WHERE NOT (w.ex = w.sx AND w.ey = w.sy AND w.nd = w.sd) AND (w.ey > w.sy OR (w.ey = w.sy AND w.ex >= w.sx))),
ring_ids AS (
  SELECT key, sx, sy, sd, row_number() OVER () AS ring FROM (
    SELECT DISTINCT key, sx, sy, sd FROM walk WHERE ex = sx AND ey = sy AND nd = sd)),
ring_sides AS (
  SELECT r.ring, w.k, w.key, w.ax, w.ay, w.d, w.sx, w.sy, lag(w.d) OVER (PARTITION BY r.ring ORDER BY w.k) AS was
  FROM walk w JOIN ring_ids r ON r.key = w.key AND r.sx = w.sx AND r.sy = w.sy AND r.sd = w.sd),
ring_corners AS (
  SELECT ring, key, ax AS x, ay AS y, row_number() OVER (PARTITION BY ring ORDER BY k) - 1 AS seq FROM ring_sides WHERE was IS NULL OR was <> d),
ring_closed AS (
  SELECT ring, key, x, y, seq FROM ring_corners
  UNION ALL SELECT ring, key, arg_min(x, seq), arg_min(y, seq), max(seq) + 1 FROM ring_corners GROUP BY ring, key),
ring_areas AS (
  SELECT ring, key, sum(x * ny - nx * y) / 2.0 AS area FROM (
    SELECT ring, key, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM ring_closed WINDOW w AS (PARTITION BY ring ORDER BY seq))
  WHERE nx IS NOT NULL GROUP BY ring, key),
ring_shells AS (
  SELECT ring, ring AS shell FROM ring_areas WHERE area > 0
  UNION ALL
  SELECT h.ring, arg_min(s.ring, s.area) FROM ring_areas h
  JOIN ring_ids i ON i.ring = h.ring
  JOIN ring_areas s ON s.key = h.key AND s.area > 0
  WHERE h.area < 0 AND (SELECT count(*) FROM ring_sides e WHERE e.ring = s.ring AND e.ax < i.sx
                        AND ((e.d = 1 AND e.ay = i.sy) OR (e.d = 3 AND e.ay = i.sy + 1))) % 2 = 1
  GROUP BY h.ring)"""


def _rings_sql(tol: float, min_area: float, scale: float, only: str = "TRUE") -> str:
    """Up to ``left_over`` (ring, seq, x, y, nx, ny), the simplified outlines."""
    return _closed_sql(tol, min_area, scale, only) + "," + trace_sql("closed", "osm_id") + f""",
dq_in AS (SELECT ring AS gid, seq, x * {tol} AS x, y * {tol} AS y FROM ring_closed),""" + dp_sql("dq_in").replace("dp_", "dq_") + f""",
left_over AS (
  SELECT v.gid AS ring, v.seq, v.x, v.y, lead(v.x) OVER w AS nx, lead(v.y) OVER w AS ny
  FROM dq_in v JOIN dq_sig s ON s.gid = v.gid AND s.seq = v.seq
  WHERE s.sig IS NULL OR s.sig > {tol} OR s.protect WINDOW w AS (PARTITION BY v.gid ORDER BY v.seq))"""


def _outline_sql(tol: float, min_area: float, scale: float) -> str:
    return _rings_sql(tol, min_area, scale) + f"""
SELECT a.key AS fid, CAST(i.sx * {tol} AS DOUBLE) AS x, CAST(i.sy * {tol} AS DOUBLE) AS y,
       CAST(p.sx * {tol} AS DOUBLE) AS shell_x, CAST(p.sy * {tol} AS DOUBLE) AS shell_y, r.shell <> r.ring AS hole,
       count(*) AS n_vertices, CAST(coalesce(sum(l.x * l.ny - l.nx * l.y), 0) / 2.0 AS DOUBLE) AS area,
       string_agg(CAST(l.x AS BIGINT) || ' ' || CAST(l.y AS BIGINT), ',' ORDER BY l.seq) AS vertices
FROM left_over l JOIN ring_areas a USING (ring) JOIN ring_ids i USING (ring) JOIN ring_shells r USING (ring) JOIN ring_ids p ON p.ring = r.shell
GROUP BY ALL"""


def gen13(polygons):
    """(fid, geom) simplified by 10, the source of the closed rungs."""
    return simplified_lines(polygons, SRC_TOL).select("fid", G.make_geom("Polygon", "parts").alias("geom"))


def closing_tasks(t: Tables) -> int:
    """Tasks that close the areas: a run becomes twice its disk's rows there, whatever it takes in a shuffle."""
    return max(1, -(-t.part.count() // CLOSED_AREAS))  # Parquet: read from the footers


def _source_runs(spark, d, tol: float, min_area: float, scale: float):
    """Row runs at cells of ``tol`` of the gen13 areas (DP 10) above ``min_area``."""
    g13 = gen13(FX.grown_polygons(Tables(spark, d), scale))
    return sweep(row_runs(g13.where(G.area("geom") > min_area), tol))


def closed_rungs(source, rungs: dict[int, tuple[float, float]], tasks: int | None = None):
    """(gen, fid, parts) of all closed rungs {gen: (tolerance, smallest area)} of gen13 areas (fid, geom), closed and traced together.

    A feature's copies of the rungs are told apart by one number, 32 fid + gen; each counts in cells of its own.
    """
    runs = None
    for gen, (tol, area) in rungs.items():
        own = row_runs(source.where(G.area("geom") > area), tol).withColumn("fid", F.col("fid") * 32 + gen)
        runs = own if runs is None else runs.unionByName(own)
    tol = F.element_at(F.create_map(*[x for gen, (t, _) in rungs.items() for x in (F.lit(gen), F.lit(float(t)))]), F.col("gen"))
    rings = outline(closed_runs(sweep(runs), RADIUS, tasks=tasks), 1.0).withColumn("gen", F.col("fid").bitwiseAND(F.lit(31)).cast("int"))
    rings = rings.withColumn("tol", tol)
    rings = simplified(rings.withColumn("verts", F.transform("verts", lambda v: G.vertex(v["x"] * F.col("tol"), v["y"] * F.col("tol")))), F.col("tol"))
    polys = to_polygons(rings.select("fid", "ring", "shell", "verts"))
    return polys.select(F.col("fid").bitwiseAND(F.lit(31)).cast("int").alias("gen"), F.shiftright("fid", 5).alias("fid"), F.col("geom.parts").alias("parts"))


def _closing(tol: float, min_area: float, scale: float):
    def run(spark, d):
        runs = _source_runs(spark, d, tol, min_area, scale)
        cells = F.sum(F.col("c1") - F.col("c0") + 1)
        nr = runs.groupBy("fid").agg(cells.alias("n_raster"))
        nc = closed_runs(runs, RADIUS, tasks=closing_tasks(Tables(spark, d))).groupBy("fid").agg(cells.alias("n_closed"))
        out = nr.join(nc, "fid", "left").withColumn("n_closed", F.coalesce("n_closed", F.lit(0)))
        return out.select("fid", "n_raster", "n_closed", (F.col("n_closed") * (tol * tol)).alias("area"))

    run.__doc__ = f"C3: gen13 geometry (DP 10) of more than {min_area:g} square metres, closed by 2 x {tol:g} at cells of {tol:g}."
    return run


def _outline(tol: float, min_area: float, scale: float):
    def run(spark, d):
        closed = closed_runs(_source_runs(spark, d, tol, min_area, scale), RADIUS, tasks=closing_tasks(Tables(spark, d)))
        rings = outline(closed, tol)
        start = F.element_at("verts", 1)
        own = rings.select("fid", "ring", "shell", "verts", start["x"].alias("x"), start["y"].alias("y"))
        shells = own.where("ring = shell").select(F.col("ring").alias("shell"), F.col("x").alias("shell_x"), F.col("y").alias("shell_y"))
        out = simplified(own.join(shells, "shell"), tol)
        text = F.array_join(F.transform("verts", lambda v: F.concat_ws(" ", v["x"].cast("bigint"), v["y"].cast("bigint"))), ",")
        return out.select("fid", "x", "y", "shell_x", "shell_y", (F.col("ring") != F.col("shell")).alias("hole"), F.size("verts").cast("bigint").alias("n_vertices"),
                          G.ring_signed_area(F.col("verts")).alias("area"), text.alias("vertices"))

    run.__doc__ = f"C3 with geometry: the rings of that closing, traced and simplified by {tol:g}."
    return run


for _name, (_tol, _area) in CLOSING_RUNGS.items():
    _scale = LARGE if _area >= 2000000.0 else 1.0
    query(f"closing_{_name}", _counts_sql(_tol, _area, _scale))(_closing(_tol, _area, _scale))
    query(f"closing_outline_{_name}", _outline_sql(_tol, _area, _scale))(_outline(_tol, _area, _scale))
