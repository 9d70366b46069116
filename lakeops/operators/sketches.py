"""Profiles that can be updated: sketches of bounded size, kept per load or partition and merged later.

A KLL sketch answers ranks and quantiles, an HLL sketch counts distinct values; both merge without the rows,
so a profile of all loads reads one small row a load. Errors are known: ``rank_bound`` of the size of a
KLL sketch, ``rank_errors`` compares estimates with the true ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.quantiles import quantile_name

#: Size of a KLL sketch, and the logarithm of the number of registers of an HLL sketch.
KLL, HLL = 200, 12


def rank_bound(k: int = KLL) -> float:
    """Error of a rank, as a share of the rows, that a KLL sketch keeps to in 99 of 100 cases."""
    # fixed values: fit of the published error table of the sketch
    return 2.296 / k**0.9723


def _number(column: str) -> Column:
    """NaN is a gap."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None))


def sketch(
    df: DataFrame, values: Sequence[str], distinct: Sequence[str] = (), by: Sequence[str] = (), k: int = KLL
) -> DataFrame:
    """One row per group and column: ``rows, present, low, high, total``, and the sketches ``kll`` and ``hll``.

    One pass; each task sends its sketches on. ``total`` is a decimal sum, so it merges to the same digit in any
    order; it is null where an amount does not fit. Columns of ``values`` are numbers, those of ``distinct`` anything.
    """
    aggs, entries = [F.count(F.lit(1)).alias("_rows")], []
    names = list(dict.fromkeys([*values, *distinct]))
    for i, name in enumerate(names):
        number = name in values
        aggs.append(F.count(_number(name) if number else F.col(f"`{name}`")).alias(f"_n{i}"))
        if number:
            exact = _number(name).try_cast("decimal(38,10)")
            fits = F.count_if(_number(name).isNotNull() & exact.isNull()) == 0
            aggs += [F.min(_number(name)).alias(f"_lo{i}"), F.max(_number(name)).alias(f"_hi{i}")]
            aggs += [F.when(fits, F.try_sum(exact)).alias(f"_sum{i}"), F.kll_sketch_agg_double(_number(name), k).alias(f"_kll{i}")]
        if name in distinct:
            aggs.append(F.hll_sketch_agg(F.col(f"`{name}`").cast("string"), HLL).alias(f"_hll{i}"))

        def pick(have: bool, part: str, kind: str) -> Column:
            return (F.col(f"_{part}{i}") if have else F.lit(None)).cast(kind)

        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("present"),
                pick(number, "lo", "double").alias("low"),
                pick(number, "hi", "double").alias("high"),
                pick(number, "sum", "decimal(38,10)").alias("total"),
                pick(number, "kll", "binary").alias("kll"),
                pick(name in distinct, "hll", "binary").alias("hll"),
            )
        )
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*entries)))


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``sketch`` for coarser groups, from the sketches alone."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        # one part whose amounts did not fit spoils the total
        F.when(F.count_if(F.col("total").isNull() & (F.col("present") > 0)) == 0, F.try_sum("total")).cast("decimal(38,10)").alias("total"),
        F.when(F.count("kll") > 0, F.kll_merge_agg_double("kll")).alias("kll"),
        F.when(F.count("hll") > 0, F.hll_union_agg("hll")).alias("hll"),
    )


def read(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows, gaps, range, mean, estimated quantiles and distinct values of each sketched column.

    A column without values has null quantiles. ``rank_error`` is the bound for a sketch of the usual size.
    """
    some = F.col("kll").isNotNull() & (F.col("present") > 0)
    # an empty sketch has no quantiles to ask for
    quantile = {
        quantile_name(p): F.when(some, F.kll_sketch_get_quantile_double(F.when(some, F.col("kll")), F.lit(float(p)))) for p in probs
    }
    return sketches.select(
        *by,
        "column",
        "rows",
        (F.col("rows") - F.col("present")).alias("missing"),
        "low",
        "high",
        F.try_divide(F.col("total").cast("double"), "present").alias("mean"),
        *[c.alias(n) for n, c in quantile.items()],
        F.when(F.col("hll").isNotNull(), F.hll_sketch_estimate("hll")).alias("distinct_values"),
        F.lit(rank_bound()).alias("rank_error"),
    )


def rank_errors(df: DataFrame, sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``column, p, estimate, rank_error, bound`` of every quantile of sketches without groups, by the rows themselves.

    The true rank of an estimate is any share between that of the rows below it and that of the rows up to
    it; the error is the distance of p from that range. One pass over the rows for all columns.
    """
    names = [quantile_name(p) for p in probs]
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(n).alias("estimate")) for p, n in zip(probs, names)])
    asked = read(sketches, probs).where(F.col(names[0]).isNotNull()).select("column", F.inline(pairs))
    columns = [r.column for r in sketches.where("kll is not null").select("column").distinct().collect()]
    each = F.array(*[F.struct(F.lit(c).alias("column"), _number(c).alias("value")) for c in columns])
    counted = df.select(F.inline(each)).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy("column").agg(F.sum("n").alias("size"))
    # few questions a column: every counted value is held against them
    held = counted.join(F.broadcast(asked), "column")
    below = held.groupBy("column", "p", "estimate").agg(
        F.sum(F.when(F.col("value") < F.col("estimate"), F.col("n")).otherwise(0)).alias("under"),
        F.sum(F.when(F.col("value") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("upto"),
    )
    low, high = F.col("under") / F.col("size"), F.col("upto") / F.col("size")
    error = F.greatest(low - F.col("p"), F.col("p") - high, F.lit(0.0))
    return below.join(sizes, "column").select("column", "p", "estimate", error.alias("rank_error"), F.lit(rank_bound()).alias("bound"))
