"""Stand-in map inputs derived from the driver tables.

Each builder only reshapes driver rows into the input schema an operator
expects (points, node lists, rings, tags, track points); none of them does any
operator work. Geometry is integer-valued so the DuckDB oracles can rebuild the
same inputs with plain arithmetic (see ``gridloom.plans.oracle_fixtures``).
The rules are documented in FIXTURES.md part B.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions.rules import FEATURE_TABLES, ENUMS
from gridloom.sources.tables import SPREAD_ROWS, Tables, spread

GRID = 20011  # side of the fixture square, in 3857 units

POI_PAIRS = [(k, v) for _, k, vs in FEATURE_TABLES["poi_points"][1] for v in vs]
ROAD_VALUES = FEATURE_TABLES["roads_temp"][1][0][2]
PLACE_VALUES = FEATURE_TABLES["label_points"][1][0][2]
LANDUSE_PAIRS = [(s, k, v) for s, k, vs in FEATURE_TABLES["landuse_import"][1] for v in vs]
WATER_PAIRS = [(k, v) for _, k, vs in FEATURE_TABLES["waterarea"][1] for v in vs]


def _pick(values: list, idx) -> F.Column:
    """values[idx] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def _mod(c, n):
    return F.col(c) % n


# ---------------------------------------------------------------- points

def poi_points(t: Tables) -> DataFrame:
    """POI points: one per customer."""
    k = F.col("c_custkey")
    idx = (k * 7 + F.col("c_nationkey")) % len(POI_PAIRS)
    return spread(t.customer).select(
        k.alias("osm_id"),
        ((k * 7919 + k * k * 31) % GRID).cast("double").alias("x"),
        ((k * 104729 + k * k * 17) % GRID).cast("double").alias("y"),
        _pick([p[0] for p in POI_PAIRS], idx).alias("class"),
        _pick([p[1] for p in POI_PAIRS], idx).alias("subclass"),
        F.when(k % 3 == 0, F.lit("")).when(k % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("DE "), "c_name"))
        .alias("name_de"),
        F.when(k % 2 == 0, F.lit("")).when(k % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("EN "), "c_name"))
        .alias("name_en"),
        F.when(k % 5 == 0, F.lit("")).when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.floor("c_acctbal").cast("int").alias("ele"),
        (k % 2).cast("int").alias("access"),
        (k % 3).cast("int").alias("parking"),
        F.when(k % 7 == 0, 1).otherwise(0).alias("subway"),
        F.when(k % 3 == 0, 1).otherwise(0).alias("religion"),
    )


def label_points(t: Tables) -> DataFrame:
    """Place labels: one per customer, names repeat every 200 keys."""
    k = F.col("c_custkey")
    return spread(t.customer).select(
        k.alias("osm_id"),
        ((k * 15485863) % GRID).cast("double").alias("x"),
        ((k * 32452843) % GRID).cast("double").alias("y"),
        F.lit("place").alias("class"),
        _pick(PLACE_VALUES, k).alias("subclass"),
        F.when(k % 3 == 0, F.concat(F.lit("LD"), (k % 150).cast("string"))).otherwise(F.lit("")).alias("name_de"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.lit("")).alias("name_en"),
        F.concat(F.lit("L"), (k % 200).cast("string")).alias("name"),
        (k % 3000).cast("int").alias("ele"),
        F.when(k % 13 == 0, F.lit(None)).otherwise((k % 50) * 100).cast("int").alias("pop"),
    )


# ---------------------------------------------------------------- ways (node lists)

def way_nodes(t: Tables) -> DataFrame:
    """One node row per line item: (fid, ordering keys, x, y). Unordered."""
    o = t.orders.select("o_orderkey")
    # dealt by way in tasks of bounded size, which the join and the assembly keep
    li = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey", rows=5 * SPREAD_ROWS)
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return j.select(
        F.col("o_orderkey").alias("fid"),
        F.col("l_linenumber").alias("k1"),
        F.col("l_partkey").alias("k2"),
        F.col("l_suppkey").alias("k3"),
        ((F.col("o_orderkey") * 7919) % GRID + F.col("l_partkey") % 997).cast("double").alias("x"),
        ((F.col("o_orderkey") * 104729) % GRID + (F.col("l_suppkey") * 37) % 991).cast("double").alias("y"),
    )


def way_attrs(t: Tables) -> DataFrame:
    """Road-like attributes per order (fid = o_orderkey)."""
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    return t.orders.select(
        k.alias("fid"),
        F.lit("highway").alias("class"),
        _pick(ROAD_VALUES, k).alias("subclass"),
        (k % 2 == 0).alias("oneway"),
        (k % 6).cast("int").alias("tracktype"),
        (k % 3).cast("int").alias("service"),
        (k % 4).cast("int").alias("bicycle"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(k % 7).cast("int").alias("scale"),
        (k % 10 == 1).alias("tunnel"),
        (k % 9 == 0).alias("bridge"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(k % 5 - 2).cast("int").alias("layer"),
        F.when(k % 3 == 0, F.concat(F.lit("A "), (k % 100).cast("string")))
        .when(k % 3 == 1, F.lit("B")).otherwise(F.lit(None)).alias("ref"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("RD"), (c % 40).cast("string"))).alias("name_de"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("")).alias("name_en"),
        F.concat(F.lit("R"), (c % 40).cast("string")).alias("name"),
        F.when(k % 8 == 0, F.lit("summer_toboggan")).when(k % 8 == 1, F.lit(None)).otherwise(F.lit(""))
        .alias("attraction"),
        _pick(["river", "canal", "stream", "ditch"], k % 4).alias("water_subclass"),
    ).withColumn("rank", F.coalesce(F.array_position(F.array(*[F.lit(v) for v in ENUMS["rank"]]), F.col("subclass"))
                                    .cast("int"), F.lit(0)))


def route_relations(t: Tables) -> DataFrame:
    """Route relations: one per customer, members = that customer's orders (as ways)."""
    c = F.col("o_custkey")
    return t.orders.select(
        c.alias("relation_id"),
        F.col("o_orderkey").alias("member_ref"),
        F.lit("w").alias("member_type"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("backward")).otherwise(F.lit("")).alias("member_role"),
        F.when(c % 3 == 0, F.lit("bicycle")).when(c % 3 == 1, F.lit("hiking")).otherwise(F.lit("bicycle"))
        .alias("route"),
        F.when(c % 4 == 0, F.lit("multipolygon")).otherwise(F.lit("route")).alias("type"),
        F.when(c % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), (c % 17).cast("string"))).alias("ref"),
        F.concat(F.lit("Route "), (c % 23).cast("string")).alias("rname"),
    )


# ---------------------------------------------------------------- polygons

def _octagon_params(df: DataFrame) -> DataFrame:
    """Centre, radius, corner cut and hole half-side as their own columns, so
    the vertex expressions below reference columns instead of repeating the
    arithmetic (keeps generated code small)."""
    k, sz = F.col("p_partkey"), F.col("p_size")
    return df.withColumns({
        "_cx": (k * 7919) % GRID, "_cy": (k * 104729) % GRID,
        "_r": sz * 10, "_c": sz * 3, "_h": sz,
    })


def polygon_rings() -> F.Column:
    """Integer octagon (radius 10*size, corner cut 3*size); square hole of
    half-side size when key % 7 = 0. Shell counter-clockwise, hole clockwise.
    Needs the columns of :func:`_octagon_params`."""
    cx, cy, r, c, h = (F.col(n) for n in ("_cx", "_cy", "_r", "_c", "_h"))
    shell = F.array(
        G.vertex(cx - r + c, cy - r), G.vertex(cx + r - c, cy - r), G.vertex(cx + r, cy - r + c),
        G.vertex(cx + r, cy + r - c), G.vertex(cx + r - c, cy + r), G.vertex(cx - r + c, cy + r),
        G.vertex(cx - r, cy + r - c), G.vertex(cx - r, cy - r + c), G.vertex(cx - r + c, cy - r),
    )
    hole = F.array(
        G.vertex(cx - h, cy - h), G.vertex(cx - h, cy + h), G.vertex(cx + h, cy + h),
        G.vertex(cx + h, cy - h), G.vertex(cx - h, cy - h),
    )
    return F.when(F.col("p_partkey") % 7 == 0, F.array(shell, hole)).otherwise(F.array(shell))


def polygons(t: Tables) -> DataFrame:
    """One polygon per part, with landuse- and water-like attributes."""
    k = F.col("p_partkey")
    return _octagon_params(spread(t.part)).select(
        k.alias("osm_id"),
        G.polygon_geom(polygon_rings()).alias("geom"),
        F.col("p_type").alias("ptype"),
        F.col("p_brand").alias("brand"),
        _pick([p[0] for p in LANDUSE_PAIRS], k).alias("submap"),
        _pick([p[1] for p in LANDUSE_PAIRS], k).alias("class"),
        _pick([p[2] for p in LANDUSE_PAIRS], k).alias("subclass"),
        _pick([p[1] for p in WATER_PAIRS], k).alias("water_subclass"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("PD"), (k % 90).cast("string"))).alias("name_de"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("")).alias("name_en"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("P"), (k % 90).cast("string"))).alias("name"),
        (k % 900).cast("int").alias("ele"),
        F.when(k % 3 == 0, F.lit("paved")).otherwise(F.lit("")).alias("surface"),
    )


def grown_polygons(t: Tables, scale: float) -> DataFrame:
    """(fid, geom) of the polygons enlarged about the origin: stand-ins for the large areas of coarse rungs."""
    grown = F.transform("geom.parts", lambda p: F.transform(p, lambda r: F.transform(r, lambda v: G.vertex(v["x"] * scale, v["y"] * scale))))
    return polygons(t).select(F.col("osm_id").alias("fid"), G.make_geom("Polygon", grown).alias("geom"))


# ---------------------------------------------------------------- tagged elements

def elements(t: Tables) -> DataFrame:
    """Tagged OSM-like elements, one per event; tags map built from the event."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    tag_pairs = [
        ("kind", F.col("event_type")),
        ("k", k),
        ("highway", F.when(e % 26 < 22, _pick(ROAD_VALUES, e % 26)).when(e % 26 == 22, F.lit("bus_stop"))),
        ("bicycle", F.when(e % 10 == 0, F.lit("designated")).when(e % 10 == 1, F.lit("yes"))),
        ("name", F.when(e % 4 != 0, F.concat(F.lit("N"), (e % 50).cast("string")))),
        ("name:de", F.when(e % 8 == 1, F.concat(F.lit("ND"), (e % 30).cast("string")))),
        ("mtb:scale", F.when(e % 6 == 0, (e % 7).cast("string")).when(e % 6 == 1, F.concat(F.lit("S"), (e % 3)
                                                                                            .cast("string")))),
        ("bridge", F.when(e % 9 == 0, F.lit("yes")).when(e % 9 == 1, F.lit("no"))),
        ("tunnel", F.when(e % 11 == 0, F.lit("true"))),
        ("oneway", F.when(e % 7 == 0, F.lit("1")).when(e % 7 == 1, F.lit("-1"))),
        ("layer", F.when(e % 17 == 0, F.lit("x")).when(e % 3 == 0, (e % 5 - 2).cast("string"))),
        ("tracktype", F.when(e % 5 == 0, F.concat(F.lit("grade"), (e % 7).cast("string")))),
        ("service", F.when(e % 13 == 0, F.lit("driveway")).when(e % 13 == 1, F.lit("alley"))),
        ("amenity", F.when(e % 12 == 0, F.lit("pub")).when(e % 12 == 1, F.lit("bench"))),
        ("tourism", F.when(e % 15 == 0, F.lit("hotel"))),
        ("landuse", F.when(e % 14 == 0, F.lit("military")).when(e % 14 == 1, F.lit("residential"))
         .when(e % 14 == 2, F.lit("forest"))),
        ("military", F.when(e % 21 == 0, F.lit("danger_area"))),
        ("leisure", F.when(e % 19 == 0, F.lit("nature_reserve")).when(e % 19 == 1, F.lit("park"))),
        ("building", F.when(e % 16 == 0, F.lit("yes")).when(e % 16 == 1, F.lit("house"))),
        ("entrance", F.when(e % 18 == 0, F.lit("main"))),
        ("place", F.when(e % 20 == 0, _pick(PLACE_VALUES, F.floor((e % 100) / 20)))),
        ("ele", F.when(e % 2 == 0, (e % 2000).cast("string")).when(e % 23 == 1, F.lit("12m"))),
        ("railway", F.when(e % 29 < 5, _pick(["rail", "tram", "subway", "funicular", "light_rail"], e % 29))),
        ("attraction", F.when(e % 31 == 0, F.lit("summer_toboggan")).when(e % 31 == 1, F.lit(""))),
        ("usage", F.when(e % 37 == 0, F.lit("main")).when(e % 37 == 1, F.lit("tourism"))),
    ]
    tags = F.map_filter(
        F.map_from_arrays(
            F.array(*[F.lit(kk) for kk, _ in tag_pairs]),
            F.array(*[v.cast("string") for _, v in tag_pairs]),
        ),
        lambda _k, v: v.isNotNull(),
    )
    gtype = _pick(["point", "linestring", "polygon"], e % 3)
    return t.events.select(e.alias("id"), gtype.alias("geom_type"), tags.alias("tags"))


# ---------------------------------------------------------------- tracks

def track_points(t: Tables) -> DataFrame:
    """GPS points; one track per user. Unordered; the track tools order them."""
    e = F.col("event_id")
    return t.events.select(
        F.col("user_id").alias("track_id"),
        e.alias("point_id"),
        F.col("ts").alias("time"),
        (F.lit(10.0) + ((e * 31) % 1000) / 1000.0).alias("lon"),
        (F.lit(48.0) + ((e * 17) % 1000) / 1000.0).alias("lat"),
        F.col("value").alias("ele"),
        F.when(e % 4 == 0, F.lit(None)).otherwise(60 + e % 100).cast("double").alias("hr"),
    )


def _bind(value, f):
    return F.element_at(F.transform(F.array(value), f), 1)


def faulty_polygons(t: Tables) -> DataFrame:
    """Octagons with injected faults (for the validity report): vertices 2 and
    3 swapped (a bow-tie crossing) when key % 11 = 0, vertex 4 repeated when
    key % 13 = 0, the closing vertex dropped when key % 17 = 0."""
    k = F.col("p_partkey")

    def fault(r):
        v = [F.element_at(r, i) for i in range(1, 10)]
        s1 = F.when(k % 11 == 0, F.array(v[0], v[2], v[1], *v[3:])).otherwise(r)
        return _bind(s1, lambda a: _bind(
            F.when(k % 13 == 0, F.concat(F.slice(a, 1, 4), F.slice(a, 4, 6))).otherwise(a),
            lambda b: F.when(k % 17 == 0, F.slice(b, F.lit(1), F.size(b) - 1)).otherwise(b)))

    ring = _bind(F.element_at(polygon_rings(), 1), fault)
    return _octagon_params(spread(t.part)).select(k.alias("osm_id"), G.polygon_geom(F.array(ring)).alias("geom"))
