"""C7 coarse water: rasterize, blur with a 5x5 kernel, contour at 128, slice by grid.

The reference burns water as 0 into a 255 background, blurs with a
normalized 5x5 kernel and keeps the area under level 128. Only cells within two
cells of water can drop under 128, so the blur is computed sparsely: every
water cell votes its kernel weight onto its 25 neighbours (explode + partial
``sum``); a cell is coarse water when 255 * (1 - water share) < 128. The grid
slicing (one clipping pass per grid id in the reference) is one
equi-key: the grid slice of a cell is (cx // n, cy // n).

``contour`` traces the level itself (marching squares): wherever a cell under the level lies beside one
that isn't, the line crosses between their centres, at the place that the two values give. These crossings
are the sides of the low cells' outline, and are linked into rings by the same rule (``outline.trace``); at a saddle the
line goes on around the same low cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.outline import EAST, NORTH, SOUTH, WEST, nested, trace

# The blur kernel rows (normalized by their sum).
KERNEL = [
    [0.0036630037, 0.0146520147, 0.0256410256, 0.0146520147, 0.0036630037],
    [0.0146520147, 0.0586080586, 0.0952380952, 0.0586080586, 0.0146520147],
    [0.0256410256, 0.0952380952, 0.1501831502, 0.0952380952, 0.0256410256],
    [0.0146520147, 0.0586080586, 0.0952380952, 0.0586080586, 0.0146520147],
    [0.0036630037, 0.0146520147, 0.0256410256, 0.0146520147, 0.0036630037],
]
LEVEL = 128
BURN_LAND, BURN_WATER = 255, 0


def kernel_offsets() -> list[tuple[int, int, float]]:
    total = sum(sum(r) for r in KERNEL)
    return [(dx - 2, dy - 2, KERNEL[dy][dx] / total) for dy in range(5) for dx in range(5)]


def blurred(water_cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """distinct water cells (keys, cx, cy) -> (keys, cx, cy, value) of all cells that the kernel carries water to."""
    arr = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(w).alias("w"))
                    for dx, dy, w in kernel_offsets()])
    votes = water_cells.select(*keys, "cx", "cy", F.explode(arr).alias("_k")).select(
        *keys, (F.col("cx") + F.col("_k.dx")).alias("cx"), (F.col("cy") + F.col("_k.dy")).alias("cy"),
        F.col("_k.w").alias("w"))
    share = votes.groupBy(*keys, "cx", "cy").agg(F.sum("w").alias("share"))
    value = BURN_LAND + (BURN_WATER - BURN_LAND) * F.col("share")
    return share.select(*keys, "cx", "cy", value.alias("value"))


def blur_threshold(water_cells: DataFrame) -> DataFrame:
    """distinct water cells (cx, cy) -> cells under the contour level, with value."""
    return blurred(water_cells).where(F.col("value") < LEVEL)


BLOCK = 6  # cells of a block's side, as a power of two


def contour(values: DataFrame, level: float = LEVEL) -> DataFrame:
    """(fid, ring, shell, verts) in cells: where the values (fid, cx, cy, value) cross the level, land values elsewhere."""
    def side(ax, ay, bx, by, d, nx, ny):
        named = zip(("ax", "ay", "bx", "by", "dir", "nx", "ny"), (*(F.col("cx") + ax, F.col("cy") + ay, F.col("cx") + bx, F.col("cy") + by), F.lit(d), F.col("cx") + nx, F.col("cy") + ny))
        return F.struct(*[c.alias(n) for n, c in named])

    around = F.array(side(0, 0, 1, 0, EAST, 0, -1), side(1, 0, 1, 1, NORTH, 1, 0), side(1, 1, 0, 1, WEST, 0, 1), side(0, 1, 0, 0, SOUTH, -1, 0))
    low = values.where(F.col("value") < level).select("fid", "cx", "cy", "value", F.explode(around).alias("s")).select("fid", "cx", "cy", "value", "s.*")
    beside = values.select("fid", F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("value").alias("_v"))
    met = low.join(beside, ["fid", "nx", "ny"], "left").withColumn("_v", F.coalesce("_v", F.lit(float(BURN_LAND)))).where(F.col("_v") >= level)
    share = (level - F.col("value")) / (F.col("_v") - F.col("value"))
    block = F.shiftleft(F.shiftright("cy", BLOCK), 32) + F.shiftright("cx", BLOCK)
    edges = met.select("fid", block.alias("block"), *[F.col(c).cast("bigint").alias(c) for c in ("ax", "ay", "bx", "by", "dir")],
                       (F.col("cx") + 0.5 + share * (F.col("nx") - F.col("cx"))).alias("px"), (F.col("cy") + 0.5 + share * (F.col("ny") - F.col("cy"))).alias("py"))
    return nested(trace(edges, corners=False))


def slice_by_grid(cells: DataFrame, n: int) -> DataFrame:
    """Cells -> (gx, gy) grid slices (one key, not one pass per slice)."""
    return cells.select(F.floor(F.col("cx") / n).alias("gx"), F.floor(F.col("cy") / n).alias("gy"), "cx", "cy",
                        "value")
