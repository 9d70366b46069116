"""Filling nulls. Every filled column gets a flag that says which values were filled."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lakeops.operators.quantiles import exact_quantiles

CATEGORY = "category:"
RULES = ("drop", "mean", "median", "zero", "mode")


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """One row: the most frequent value, the smallest one on a tie. Counted per value first;
    the ``mode`` aggregate would keep all values in one buffer."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc(col)).limit(1).select(col)


def _known(df: DataFrame, col: str) -> Column:
    """The value, with NaN as a gap."""
    kind = df.schema[col].dataType
    return F.nanvl(F.col(col), F.lit(None).cast(kind)) if isinstance(kind, (DoubleType, FloatType)) else F.col(col)


def impute(df: DataFrame, rules: Mapping[str, str], exact: bool = False) -> DataFrame:
    """Apply one rule per column: ``drop``, ``mean``, ``median``, ``zero``, ``mode`` or
    ``category:<text>``. ``<column>_imputed`` is true where a value was filled. NaN is a gap like null.

    Rows are dropped first, so the fill values describe the rows that stay. Means and medians
    turn whole-number columns into doubles. All means and sketched medians are one aggregate row;
    a mode, or an exact median, takes an aggregate of its own.
    """
    for c, rule in rules.items():
        if rule not in RULES and not rule.startswith(CATEGORY):
            raise ValueError(f"unknown rule {rule!r} for {c}")
    dropped = [c for c, rule in rules.items() if rule == "drop"]
    if dropped:
        df = df.na.drop(subset=dropped)
    known = {c: _known(df, c) for c, rule in rules.items() if rule != "drop"}
    sketched = {
        c: F.avg(known[c]) if rule == "mean" else F.percentile_approx(known[c], F.lit(0.5), F.lit(10000))
        for c, rule in rules.items()
        if rule == "mean" or (rule == "median" and not exact)
    }
    row = df.agg(F.struct(*[agg.alias(c) for c, agg in sketched.items()]).alias("fill")).scalar() if sketched else None
    clean = df.withColumns(known)
    filled, flags = {}, {}
    for c, value in known.items():
        rule, dtype = rules[c], df.schema[c].dataType
        if c in sketched:
            fill = row[c]
        elif rule == "median":
            fill = exact_quantiles(clean, c, [0.5]).scalar()
        elif rule == "mode":
            fill = mode_of(clean, c).scalar()
        elif rule == "zero":
            fill = F.lit(0).cast(dtype)
        else:
            fill = F.lit(rule.removeprefix(CATEGORY))
        flags[f"{c}_imputed"] = value.isNull()
        filled[c] = F.coalesce(value, fill)
    return df.withColumns({**flags, **filled})
