"""Row-wise attribute operators (P1-P17): filters, fallbacks, regex parts.

All are Column expressions, so Catalyst pushes the filters into scans and
keeps the projections inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geometry import pg_int


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_not_false(cond) -> Column:
    """SQL ``cond IS NOT FALSE`` (TRUE or NULL)."""
    return ~_c(cond).eqNullSafe(F.lit(False))


def is_not_true(cond) -> Column:
    """P5 SQL ``cond IS NOT TRUE`` (FALSE or NULL)."""
    return ~_c(cond).eqNullSafe(F.lit(True))


def name_fallback(de="name_de", en="name_en", name="name") -> Column:
    """Name:de, else name:en, else name -- with the three-valued tests.

    ``(name_de <> '') IS NOT FALSE`` is TRUE for a NULL name_de, so a NULL
    there is returned as is; only ``''`` falls through to the next language.
    """
    de, en, name = _c(de), _c(en), _c(name)
    return F.when(is_not_false(de != ""), de).when(is_not_false(en != ""), en).otherwise(name)


def filter_project(df: DataFrame, columns: list | None = None, condition: Column | str | None = None) -> DataFrame:
    """P1/P2 ``filter(source, target, columns, filter)``: columns default to
    the geometry only, the filter to TRUE."""
    if condition is not None:
        df = df.where(condition if isinstance(condition, Column) else F.expr(condition))
    cols = ["geom"] + list(columns or [])
    return df.select(*cols)


def ref_prefix(ref="ref") -> Column:
    """P14 ``substring(ref from '\\w+')``: first word, NULL when none."""
    return F.regexp_substr(_c(ref), F.lit(r"\w+"))


def ref_number(ref="ref") -> Column:
    """P14 ``substring(ref from '\\d+')``: first digit run, NULL when none."""
    return F.regexp_substr(_c(ref), F.lit(r"\d+"))


def null_default(c, default=0) -> Column:
    """P13 ``CASE WHEN c IS NULL THEN default ELSE c END``."""
    return F.coalesce(_c(c), F.lit(default))


def as_pg_int(c) -> Column:
    """P15 ``::integer`` of a double (PostgreSQL rounds half to even)."""
    return pg_int(c)
