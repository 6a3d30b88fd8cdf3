"""DuckDB twin of cutting rings at boxes: four half planes, one after the other."""

from __future__ import annotations

_PASSES = [("x", ">=", "x0"), ("x", "<=", "x1"), ("y", ">=", "y0"), ("y", "<=", "y1")]


def clip_rings_sql(src: str, out: str = "clipped") -> str:
    """CTEs: rings ``src(k, ring, seq, x, y, x0, x1, y0, y1)`` without closing vertex -> ``out(k, ring, seq, x, y, nx, ny)``.

    A ring that falls apart stays one here, joined along the box; its signed area is that of its pieces.
    """
    ctes, last = [], src
    for i, (axis, op, line) in enumerate(_PASSES):
        other = "y" if axis == "x" else "x"
        ctes.append(f"""
{out}_n{i} AS (
  SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny
  FROM {last} WINDOW w AS (PARTITION BY k, ring ORDER BY seq)),
{out}_c{i} AS (
  SELECT k, ring, row_number() OVER (PARTITION BY k, ring ORDER BY seq, o) AS seq,
         CASE WHEN o = 0 THEN {line} ELSE n{axis} END AS {axis},
         CASE WHEN o = 0 THEN {other} + ({line} - {axis}) / (n{axis} - {axis}) * (n{other} - {other}) ELSE n{other} END AS {other}, x0, x1, y0, y1
  FROM {out}_n{i}, (SELECT unnest([0, 1]) AS o) os
  WHERE (o = 0 AND ({axis} {op} {line}) <> (n{axis} {op} {line})) OR (o = 1 AND n{axis} {op} {line}))""")
        last = f"{out}_c{i}"
    ctes.append(f"""
{out} AS (
  SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny
  FROM {last} WINDOW w AS (PARTITION BY k, ring ORDER BY seq))""")
    return ",".join(ctes)
