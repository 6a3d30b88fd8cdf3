"""C8 ladder builder: many generalized rungs of one table in one plan.

A rung is (gen, tolerance, filter). The filter is evaluated once per feature
(on the *source* geometry's measures and attributes, as the reference does),
giving each feature the list of rungs it belongs to; for each of them the ring keeps
the vertices whose significance (C2) is above the rung's tolerance. A negative tolerance
keeps every vertex (full detail). The result is ONE table with a ``gen`` column, meant to be
written ``partitionBy("gen")`` so a zoom's rung is a partition-pruned scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rung:
    gen: int
    tol: float
    condition: Column | None = None  # None = TRUE


def rung_membership(features: DataFrame, rungs: list[Rung], fid: str = "fid") -> DataFrame:
    """(fid, gen, tol) for every rung whose filter the feature passes."""
    return features.select(fid, F.explode(rung_array(rungs)).alias("_r")).select(
        fid, F.col("_r.gen").alias("gen"), F.col("_r.tol").alias("tol"))


def rung_array(rungs: list[Rung]) -> Column:
    """The rungs a feature passes, as ARRAY<STRUCT<gen, tol>> (filters on the
    feature row: source measures and attributes)."""
    tagged = F.array(*[
        F.when(r.condition if r.condition is not None else F.lit(True),
               F.struct(F.lit(r.gen).alias("gen"), F.lit(float(r.tol)).alias("tol")))
        for r in rungs
    ])
    return F.filter(tagged, lambda s: s.isNotNull())


def ladder_rings(features: DataFrame, rungs: list[Rung], fid: str = "fid") -> DataFrame:
    """Every rung of every ring as rows (gen, fid, part, ring, verts).

    Significance, ring guard and the per-rung vertex filter all work on the ring's
    own row: no shuffle, and one path for rings of every length.
    """
    from gridloom.operators.simplify import with_significance

    # no filter on the rung list here: a pushed-down filter would copy the rung
    # conditions (and the measures they read) into the scan; an empty list
    # simply explodes to nothing below
    f = features.select(fid, "geom", rung_array(rungs).alias("_rungs"))
    rings = f.select(fid, "_rungs", F.posexplode("geom.parts").alias("part", "_rs")).select(
        fid, "_rungs", "part", F.posexplode("_rs").alias("ring", "_r"))
    per = with_significance(rings).select(fid, "part", "ring", "_r", "_sig", "_prot", F.explode("_rungs").alias("_g"))
    kept = F.transform(
        F.filter(F.arrays_zip(F.col("_r").alias("v"), F.col("_sig").alias("s"),
                              F.sequence(F.lit(0), F.size("_r") - 1).alias("i")),
                 lambda z: (z["s"] > F.col("_g.tol")) | F.array_contains(F.col("_prot"), z["i"])),
        lambda z: z["v"])
    return per.select(F.col("_g.gen").alias("gen"), fid, "part", "ring", kept.alias("verts"))
