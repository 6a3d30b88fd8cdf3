"""Zoom ranges asked for, beyond those that the registered queries seed."""

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the plans in their order)
from gridloom.plans import q_layers, q_tiles, q_world


def by_zoom(df):
    return {r.z: r.n for r in df.groupBy("z").agg(F.count("*").alias("n")).collect()}


def test_bands_above_the_registered_zooms(spark, sf_dir):
    water = q_world.q_water_bands(spark, sf_dir, zooms=(9, 14))
    got = {}
    for r in water.collect():
        got.setdefault(r.z, {})[r.osm_id] = r.nv
    assert set(got) == set(range(9, 15)) and all(v == got[9] for v in got.values())  # full detail from 9 on
    lakes = by_zoom(q_world.q_lakes(spark, sf_dir, zooms=(7, 14)))
    assert set(lakes) == set(range(7, 15)) and len(set(lakes.values())) == 1  # every lake has minzoom 7 or less
    assert set(by_zoom(q_layers.q_admin_bands(spark, sf_dir, zooms=(13, 14)))) == {13, 14}  # rung 14 is served


def test_points_at_all_zooms(spark, sf_dir):
    assert set(by_zoom(q_tiles.q_tile_topk(spark, sf_dir, zooms=(7, 14)))) == set(range(7, 15))
    assert set(by_zoom(q_tiles.q_tile_cover(spark, sf_dir, zooms=(0, 14)))) == set(range(15))
    assert set(by_zoom(q_layers.q_places(spark, sf_dir, zooms=(0, 14)))) == set(range(15))
