"""Route tagged elements into typed feature tables.

The tags are in the element's row, and the rules are a few groups (key, values)
for each table, so routing happens in the row: for every (table, sub-mapping) of the element's
geometry type the first group whose key has one of the values wins. One scan,
no join, no shuffle, and no key by which elements could be mixed up (nodes and
ways share ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions.rules import ENUMS, FEATURE_TABLES, REJECT_REGEXP, TABLE_COLUMNS, TRUE_WORDS, \
    WAYZORDER_HIGHWAY_RANK, WAYZORDER_RAILWAY


def match_rules(elements: DataFrame, tables: dict | None = None) -> DataFrame:
    """M1/M2/M3/M4: the element rows with (table, submap, class, subclass) -- first rule wins.

    ``elements`` has geom_type and tags MAP<STRING,STRING>; an element comes once for
    each (table, sub-mapping) that it matches. For ``relation_member`` tables the
    caller passes member rows with geom_type = 'relation_member'.
    """
    tables = FEATURE_TABLES if tables is None else tables
    routes = []
    for table, (gtype, groups) in tables.items():
        for submap in dict.fromkeys(g[0] for g in groups):
            hits = []
            for _, key, values in (g for g in groups if g[0] == submap):
                value = F.col("tags")[key]
                fits = value.isNotNull() if values is None else value.isin(*values)
                hits.append(F.when(fits, F.struct(F.lit(key).alias("class"), value.alias("subclass"))))
            first = F.coalesce(*hits)
            routes.append(F.when((F.col("geom_type") == gtype) & first.isNotNull(), F.struct(
                F.lit(table).alias("table"), F.lit(submap).alias("submap"), first.alias("hit"))))
    matched = F.filter(F.array(*routes), lambda r: r.isNotNull())
    rows = elements.select("*", F.explode(matched).alias("_r"))
    return rows.select(*elements.columns, "_r.table", "_r.submap", "_r.hit.class", "_r.hit.subclass")


def extract(tags: Column, kind: str, key: str) -> Column:
    """M7/M8 typed column from a tag."""
    v = tags[key]
    if kind == "string":
        return F.coalesce(v, F.lit(""))
    if kind == "integer":
        return v.try_cast("int")
    if kind == "bool":
        return F.coalesce(F.lower(v).isin(*TRUE_WORDS), F.lit(False))
    if kind == "wayzorder":
        return wayzorder(tags)
    if kind.startswith("enumerate:"):
        values = ENUMS[kind.split(":", 1)[1]]
        return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in values]), v).cast("int"), F.lit(0))
    raise ValueError(kind)


def feature_table(matches: DataFrame, table: str, id_col: str = "id", columns: list | None = None) -> DataFrame:
    """One typed feature table from the rows of :func:`match_rules`: typed columns
    extracted, reject filters applied (M5). A table without column list is an error.

    ``area`` (polygons with a geometry column ``geom``) is the geometry's area, else NULL.
    """
    if columns is None and table not in TABLE_COLUMNS:
        raise ValueError(f"no columns are known for table {table}")
    cols = TABLE_COLUMNS[table] if columns is None else columns
    rows = matches.where(F.col("table") == table)
    for key, pattern in REJECT_REGEXP.get(table, {}).items():
        rows = rows.where(~F.coalesce(F.col("tags")[key].rlike(pattern), F.lit(False)))
    out = [F.col(id_col).alias("osm_id"), "submap", "class", "subclass"]
    for name, kind, key in cols:
        if kind == "area":
            value = G.area("geom") if "geom" in matches.columns else F.lit(None).cast("double")
        else:
            value = extract(F.col("tags"), kind, key)
        out.append(value.alias(name))
    gone = (id_col, "geom_type", "tags", "table", "submap", "class", "subclass")
    return rows.select(*out, *[c for c in matches.columns if c not in gone])


def wayzorder(tags: Column) -> Column:
    """M9 ``wayzorder``: draw order score of a highway / railway way."""
    ranks = F.create_map(*[x for k, v in WAYZORDER_HIGHWAY_RANK.items() for x in (F.lit(k), F.lit(v))])
    hw = F.coalesce(ranks[tags["highway"]], F.lit(0))
    rw = F.when(tags["railway"].isNotNull(), F.lit(WAYZORDER_RAILWAY)).otherwise(F.lit(0))
    layer = F.coalesce(tags["layer"].try_cast("int"), F.lit(0)) * 10
    tunnel = F.when(F.lower(tags["tunnel"]).isin(*TRUE_WORDS), F.lit(-10)).otherwise(F.lit(0))
    bridge = F.when(F.lower(tags["bridge"]).isin(*TRUE_WORDS), F.lit(10)).otherwise(F.lit(0))
    return (hw + rw + layer + tunnel + bridge).cast("int")
