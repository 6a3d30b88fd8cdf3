"""T1-T5 tile arithmetic as Column expressions (XYZ scheme, y grows south)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.geometry import WORLD_EDGE, lonlat_to_mercator

# The tile grid extent of the served layers and the local map's tile buffer.
TILE_EXTENT = 4096
LOCAL_TILE_BUFFER = 256


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tile_size(z) -> Column:
    """Width of a tile at zoom z, in 3857 units."""
    return F.lit(2.0 * WORLD_EDGE) / F.pow(F.lit(2.0), _c(z))


def tile_bounds(z="z", x="x", y="y") -> dict[str, Column]:
    """T1 (z,x,y) -> mercator bounds."""
    s = tile_size(z)
    minx = F.lit(-WORLD_EDGE) + _c(x) * s
    maxy = F.lit(WORLD_EDGE) - _c(y) * s
    return {"tminx": minx, "tminy": maxy - s, "tmaxx": minx + s, "tmaxy": maxy}


def pixel_to_meters(z, px, py, tile_px: int = 256) -> tuple[Column, Column]:
    """T2 pixel coordinates at zoom z -> mercator metres."""
    res = tile_size(z) / tile_px
    return _c(px) * res - WORLD_EDGE, F.lit(WORLD_EDGE) - _c(py) * res


def cover_ranges(z, minx, miny, maxx, maxy, buffer_frac: float = 0.0) -> dict[str, Column]:
    """T3 index ranges of the tiles at zoom z whose (buffered) bounds meet the box.

    Touching counts as meeting; ranges are widened by one tile at exact
    boundaries and clamped to the grid, the exact test comes after the join.
    """
    s = tile_size(z)
    b = s * buffer_frac
    n = F.pow(F.lit(2.0), _c(z)).cast("long") - 1
    x0 = F.ceil((_c(minx) - b + WORLD_EDGE) / s) - 1
    x1 = F.floor((_c(maxx) + b + WORLD_EDGE) / s)
    y0 = F.ceil((F.lit(WORLD_EDGE) - _c(maxy) - b) / s) - 1
    y1 = F.floor((F.lit(WORLD_EDGE) - _c(miny) + b) / s)

    def clamp(v):
        return F.least(n, F.greatest(F.lit(0).cast("long"), v.cast("long")))

    return {"x0": clamp(x0), "x1": clamp(x1), "y0": clamp(y0), "y1": clamp(y1)}


BLOCK = 64  # side of a block of tiles
WIDE = 64   # features that meet more blocks are dealt out again, block by block


def _block(c: str) -> Column:
    return F.floor(F.col(c) / F.lit(BLOCK))


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows with ranges of tiles -> one row (_bx, _by) for each block that they meet."""
    rows = rows.withColumn("_bx", F.explode(F.sequence(_block("x0"), _block("x1"))))
    return rows.withColumn("_by", F.explode(F.sequence(_block("y0"), _block("y1"))))


def explode_blocks(df: DataFrame, z, buffer_frac: float = 0.0) -> DataFrame:
    """Rows with bbox columns -> one row for each block of BLOCK x BLOCK tiles that covers them: ``block`` (bx, by), dealt out by it."""
    r = cover_ranges(z, "minx", "miny", "maxx", "maxy", buffer_frac)
    out = _blocked(df.withColumn("z", _c(z).cast("int")).withColumns(r)).repartition("z", "_bx", "_by")
    return out.withColumn("block", F.struct(F.col("_bx").alias("bx"), F.col("_by").alias("by"))).drop("_bx", "_by", *r)


def explode_cover(df: DataFrame, z, buffer_frac: float = 0.0, seeds: DataFrame | None = None) -> DataFrame:
    """Rows with bbox columns -> one row per covering tile (z, x, y).

    Ranges explode by blocks of BLOCK x BLOCK tiles first. With ``seeds`` (z, x, y) only
    blocks with a wanted tile go on, cut to the range of these tiles; a superset of
    the wanted tiles comes out. Without, the blocks of a feature that meets many (a
    world-wide box at a high zoom) are spread over the cluster before the tiles explode.
    """
    r = cover_ranges(z, "minx", "miny", "maxx", "maxy", buffer_frac)
    out = df.withColumn("z", _c(z).cast("int")).withColumns(r)
    low = {f"{c}0": F.greatest(F.col(f"{c}0"), F.col(f"_b{c}") * BLOCK) for c in "xy"}
    high = {f"{c}1": F.least(F.col(f"{c}1"), F.col(f"_b{c}") * BLOCK + BLOCK - 1) for c in "xy"}

    if seeds is not None:
        wanted = seeds.groupBy(F.col("z").cast("int").alias("_z"), _block("x").alias("_wx"), _block("y").alias("_wy")).agg(
            *[f(c).alias(f"_{n}{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))])
        met = _blocked(out)
        met = met.join(wanted, (met["z"] == wanted["_z"]) & (met["_bx"] == wanted["_wx"]) & (met["_by"] == wanted["_wy"]))
        cut = {f"{c}0": F.greatest(low[f"{c}0"], F.col(f"_min{c}")) for c in "xy"} | {
            f"{c}1": F.least(high[f"{c}1"], F.col(f"_max{c}")) for c in "xy"}
        out = met.withColumns(cut).where("x0 <= x1 and y0 <= y1").select(*out.columns)
    else:
        count = (_block("x1") - _block("x0") + 1) * (_block("y1") - _block("y0") + 1)
        wide = _blocked(out.where(count > WIDE)).repartition("z", "_bx", "_by")
        out = out.where(count <= WIDE).unionByName(wide.withColumns(low | high).drop("_bx", "_by"))
    out = out.withColumn("x", F.explode(F.sequence("x0", "x1")))
    out = out.withColumn("y", F.explode(F.sequence("y0", "y1")))
    return out.drop("x0", "x1", "y0", "y1")


def bbox_meets_tile(buffer_frac: float = 0.0) -> Column:
    """G7 ``geometry && tile_bbox`` with the tile widened by the buffer."""
    tb = tile_bounds()
    b = tile_size("z") * buffer_frac
    return (
        (F.col("maxx") >= tb["tminx"] - b) & (F.col("minx") <= tb["tmaxx"] + b)
        & (F.col("maxy") >= tb["tminy"] - b) & (F.col("miny") <= tb["tmaxy"] + b)
    )


STEP = 1 << 17  # segments and tiles that tile_segments works on at once, but for what one segment meets


def tile_segments(rows: DataFrame, buffer_frac: float = 0.0, verts: str = "verts", block: str | None = None) -> DataFrame:
    """Rows (z, verts) -> one row for each segment of the line in each (buffered) tile that it meets.

    ``verts`` gives way to x, y of the tile and seq, x1, y1, x2, y2 in the tile's integer coordinates (0 to
    TILE_EXTENT, y grows south, the buffer beyond); seq is the segment's place in the line.
    Segments outside are left out, so a line that leaves the tile and comes back has a gap. ``block`` names a
    column of (bx, by) as :func:`explode_blocks` makes it: only tiles of that block; null: all. It is not kept.

    Each segment meets the tiles around its own box, all segments of an Arrow batch together: as
    functions over a row's array they are interpreted one by one, and as columns their code is too large to be compiled.
    """
    keep = [f for f in rows.schema.fields if f.name not in (verts, block)]
    schema = T.StructType([*keep, T.StructField("x", T.LongType()), T.StructField("y", T.LongType()),
                           *(T.StructField(n, T.IntegerType()) for n in ("seq", "x1", "y1", "x2", "y2"))])

    def column(part, name):
        return part.column(part.schema.get_field_index(name))

    def sizes(part):
        return column(part, verts).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

    def counted(n):
        """Which one, and its place there, for ``n`` things of each."""
        of = np.repeat(np.arange(len(n)), n)
        return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)

    def met(part):
        """Segments (row, seq, ax, ay, dx, dy), their ranges of tiles, and of each row: tile size and box."""
        size = sizes(part)
        flat = column(part, verts).flatten()
        vx, vy = (flat.field(k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in ("x", "y"))  # null: NaN
        z = column(part, "z").to_numpy(zero_copy_only=False).astype(np.float64)
        s, n = 2.0 * WORLD_EDGE / np.exp2(z), np.exp2(z).astype(np.int64) - 1
        full = np.flatnonzero(size)
        heads = (np.cumsum(size) - size)[full]
        box = np.full((4, len(size)), np.nan)
        for k, (v, f) in enumerate(((vx, np.fmin), (vx, np.fmax), (vy, np.fmin), (vy, np.fmax))):
            if len(full):
                box[k, full] = f.reduceat(v, heads)
        row, seq = counted(np.maximum(size - 1, 0))
        at = (np.cumsum(size) - size)[row] + seq
        own = ~np.isnan(box).any(axis=0)[row]  # a line without a box meets nothing
        row, seq, at = row[own], seq[own], at[own]
        ax, ay = vx[at], vy[at]
        dx, dy = vx[at + 1] - ax, vy[at + 1] - ay
        limits = []
        for v, lo, hi, name in ((vx, box[0], box[1], "bx"), (vy, box[2], box[3], "by")):
            # the segment's own range; where an end is null, the line's
            none = np.isnan(v[at]) | np.isnan(v[at + 1])
            lo = np.where(none, lo[row], np.minimum(v[at], v[at + 1]))
            hi = np.where(none, hi[row], np.maximum(v[at], v[at + 1]))
            more = s[row] * buffer_frac + 1e-9 * WORLD_EDGE  # wider than any rounding; the tests below are exact
            lo, hi = (lo, hi) if name == "bx" else (-hi, -lo)
            first = np.clip(np.ceil((lo - more + WORLD_EDGE) / s[row]) - 1, 0, n[row]).astype(np.int64)
            last = np.clip(np.floor((hi + more + WORLD_EDGE) / s[row]), 0, n[row]).astype(np.int64)
            if block is not None:
                b = column(part, block).flatten()[("bx", "by").index(name)]
                b, free = b.fill_null(0).to_numpy(zero_copy_only=False)[row], b.is_null().to_numpy(zero_copy_only=False)[row]
                first, last = (np.where(free, first, np.maximum(first, b * BLOCK)),
                               np.where(free, last, np.minimum(last, b * BLOCK + BLOCK - 1)))
            limits.append((first, np.maximum(last - first + 1, 0)))
        return (row, seq, ax, ay, dx, dy), limits, s, box

    def cut(part, segments, limits, s, box):
        (x0, nx), (y0, ny) = limits
        of, k = counted(nx * ny)
        x, y = x0[of] + k // ny[of], y0[of] + k % ny[of]
        row, seq, ax, ay, dx, dy = (v[of] for v in segments)
        s = s[row]
        b, minx, maxy = s * buffer_frac, -WORLD_EDGE + x * s, WORLD_EDGE - y * s
        w, e, south, north = minx - b, minx + s + b, maxy - s - b, maxy + b

        def span(a, d, lo, hi):
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                first, last = (lo - a) / d, (hi - a) / d
            up, down = d > 0, d < 0
            enter = np.where(up, first, np.where(down, last, np.where((a < lo) | (a > hi), 2.0, 0.0)))
            return enter, np.where(up, last, np.where(down, first, 1.0))

        (ex, lx), (ey, ly) = span(ax, dx, w, e), span(ay, dy, south, north)
        t0, t1 = np.maximum(np.maximum(0.0, ex), ey), np.minimum(np.minimum(1.0, lx), ly)
        box = box[:, row]
        good = np.flatnonzero((t0 <= t1) & (box[1] >= w) & (box[0] <= e) & (box[3] >= south) & (box[2] <= north))
        row, seq, x, y, s, minx, maxy, t0, t1, ax, ay, dx, dy = (v[good] for v in (row, seq, x, y, s, minx, maxy, t0, t1, ax, ay, dx, dy))

        def local(v):
            v, none = np.floor(v / s * TILE_EXTENT + 0.5), np.isnan(v)
            return pa.array(np.where(none, 0.0, v).astype(np.int32), mask=none)

        made = [local(v) for t in (t0, t1) for v in (ax + t * dx - minx, maxy - (ay + t * dy))]
        own = part.select([f.name for f in keep]).take(pa.array(row))
        return pa.RecordBatch.from_arrays([*own.columns, pa.array(x), pa.array(y), pa.array(seq.astype(np.int32)), *made], names=schema.names)

    def steps(n):
        """Bounds of stretches that hold about STEP of ``n`` things together."""
        step = np.cumsum(n) // STEP
        return [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), len(n)]

    def run(batches):
        for batch in batches:
            bounds = steps(sizes(batch))
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                part = batch.slice(lo, hi - lo)
                segments, limits, s, box = met(part)
                inner = steps(limits[0][1] * limits[1][1])
                for i, j in zip(inner[:-1], inner[1:]):
                    if j > i:
                        yield cut(part, [v[i:j] for v in segments], [(f[i:j], n[i:j]) for f, n in limits], s, box)

    return rows.mapInArrow(run, schema)


def lonlat_box(min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> dict[str, Column]:
    """Seed bounds in lon/lat -> mercator bbox columns."""
    x0, y0 = lonlat_to_mercator(F.lit(min_lon), F.lit(min_lat))
    x1, y1 = lonlat_to_mercator(F.lit(max_lon), F.lit(max_lat))
    return {"minx": x0, "miny": y0, "maxx": x1, "maxy": y1}


def descendants(tiles: DataFrame, zmax: int) -> DataFrame:
    """T5 (z,x,y) -> itself and all descendants down to ``zmax``."""
    t = tiles.select("z", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(zmax) - F.col("z"))).alias("dz"))
    t = t.withColumn("k", F.pow(F.lit(2), F.col("dz")).cast("long"))
    zero = F.lit(0).cast("long")
    t = t.select((F.col("z") + F.col("dz")).alias("z"), "x", "y", "k",
                 F.explode(F.sequence(zero, F.col("k") - 1)).alias("_ox"))
    t = t.select("z", "y", "k", (F.col("x").cast("long") * F.col("k") + F.col("_ox")).alias("x"))
    t = t.select("z", "x", "y", "k", F.explode(F.sequence(zero, F.col("k") - 1)).alias("_oy"))
    t = t.select("z", "x", (F.col("y").cast("long") * F.col("k") + F.col("_oy")).alias("y"))
    return t.distinct()


def parse_tile_list(lines: DataFrame, col: str = "value") -> DataFrame:
    """S22 text lines ``z/x/y`` -> (z, x, y)."""
    p = F.split(F.trim(F.col(col)), "/")
    return lines.where(F.trim(F.col(col)) != "").select(
        p[0].cast("int").alias("z"), p[1].cast("long").alias("x"), p[2].cast("long").alias("y"))
