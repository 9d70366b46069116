"""Missing-value profiles and statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeops.functions import parse
from lakeops.operators import columns, profile, quantiles
from lakeops.operators.combine import union_all
from lakeops.sources.tables import read_parquet
from lakeops.suite import standins
from lakeops.suite.registry import money, query
from lakeops.suite.standins import rank_fits, with_ctes

AT = dt.datetime(2025, 1, 2, 3, 4, 5)
# all columns of the stand-in listings
CHECKED = (
    "id", "host_id", "city", "is_berlin", "price", "availability_365", "neighbourhood_cleansed", "latitude",
    "longitude", "room_type", "minimum_nights", "number_of_reviews", "review_scores_rating", "host_is_superhost",
    "instant_bookable", "bathrooms_text", "amenities", "last_scraped",
)


def _each(columns_: tuple[str, ...], table: str, tail: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, {tail.format(m=f'(count(*) - count({c}))')} FROM {table}" for c in columns_
    )


@query(
    f"""{with_ctes("listings", "sparse")}, filled AS (SELECT * FROM sparse WHERE
      {" OR ".join(f"{c} IS NOT NULL" for c in CHECKED)})
    {_each(CHECKED, "filled", "count(*) AS total_rows, {m} AS missing_count, {m} / count(*) * 100 AS missing_percent")}"""
)
def missing_profile(spark, sf):
    stamped = columns.add_load_timestamp(standins.sparse(spark, sf), AT)
    return profile.missing_profile(stamped, ["load_timestamp"]).where("column <> 'load_timestamp'")


@query(
    f"""{with_ctes("listings")} {_each(CHECKED, "listings",
      "count(*) AS total_rows, {m} AS missing_count, round({m} * 100 / count(*), 2) AS missing_percent")}"""
)
def missing_report(spark, sf):
    return profile.missing_report(standins.listings(spark, sf))


@query(
    f"""{with_ctes("listings")}
    {_each(CHECKED, "listings", "{m} AS missing_count, {m} / count(*) AS missing_rate")}"""
)
def missing_rate(spark, sf):
    return profile.missing_rate(standins.listings(spark, sf))


@query(
    f"""{with_ctes("listings")} SELECT
      {", ".join(f"(count(*) - count({c})) / count(*) AS {c}" for c in CHECKED)} FROM listings"""
)
def missing_rate_wide(spark, sf):
    return profile.missing_rate(standins.listings(spark, sf), wide=True)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
ORDER_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")


def _described(df):
    """The text table of ``describe`` with its numbers as numbers, to compare by value."""
    numbers = {c: F.round(F.col(c).try_cast("double"), 4) for c in ORDER_NUMBERS}
    return df.withColumns(numbers)


def _describe_sql(name: str, number: str, text: str) -> str:
    cells = [
        (f"round(CAST({number} AS DOUBLE), 4)" if c in ORDER_NUMBERS else text).format(c=c) + f" AS {c}"
        for c in ORDER_COLUMNS
    ]
    return f"SELECT '{name}' AS summary, {', '.join(cells)} FROM orders"


@query(
    " UNION ALL ".join(
        [
            _describe_sql("count", "count({c})", "CAST(count({c}) AS VARCHAR)"),
            _describe_sql("mean", "avg({c})", "CAST(NULL AS VARCHAR)"),
            _describe_sql("stddev", "stddev_samp({c})", "CAST(NULL AS VARCHAR)"),
            _describe_sql("min", "min({c})", "min({c})"),
            _describe_sql("max", "max({c})", "max({c})"),
        ]
    )
)
def describe_orders(spark, sf):
    return _described(profile.describe(read_parquet(spark, sf, "orders")))


QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
@query(
    " UNION ALL ".join(
        [
            _describe_sql("count", "count({c})", "CAST(count({c}) AS VARCHAR)"),
            _describe_sql("mean", "avg({c})", "CAST(NULL AS VARCHAR)"),
            _describe_sql("stddev", "stddev_samp({c})", "CAST(NULL AS VARCHAR)"),
            _describe_sql("min", "min({c})", "min({c})"),
            _describe_sql("max", "max({c})", "max({c})"),
            *[_describe_sql(q, "1", "CAST(NULL AS VARCHAR)").replace("FROM orders", "") for q in QUARTILES],
        ]
    )
)
def summary_orders(spark, sf):
    """The whole summary; of a sketched quartile, whether its rank is within the sketch's error (1)."""
    orders = read_parquet(spark, sf, "orders")
    whole = _described(profile.summary(orders))
    numbers = whole.where(F.col("summary").isin(*QUARTILES))
    wide = numbers.groupBy().pivot("summary", list(QUARTILES)).agg(*[F.first(c).alias(c) for c in ORDER_NUMBERS])
    held = orders.select(*ORDER_NUMBERS, F.struct(*[F.lit(0)]).alias("_")).withColumns(
        {f"{q}_{c}": wide.select(F.col(f"`{q}_{c}`")).scalar() for q in QUARTILES for c in ORDER_NUMBERS}
    )
    ranks = held.agg(*[rank_fits(c, f"`{q}_{c}`", p).alias(f"{q}_{c}") for q, p in QUARTILES.items() for c in ORDER_NUMBERS])
    checked = [
        ranks.select(
            F.lit(q).alias("summary"),
            *[F.col(f"`{q}_{c}`").cast("double").alias(c) if c in ORDER_NUMBERS else F.lit(None).cast("string").alias(c) for c in ORDER_COLUMNS],
        )
        for q in QUARTILES
    ]
    return union_all([whole.where(~F.col("summary").isin(*QUARTILES)), *checked])


def _profile_sql(column: str, kind: str) -> str:
    number, text = kind in ("bigint", "double"), kind in ("string", "timestamp_ntz")
    null = "CAST(NULL AS {})".format
    return f"""SELECT count(*) AS total_rows, '{column}' AS column, '{kind}' AS type,
      count(*) - count({column}) AS null_count, count(DISTINCT {column}) AS distinct_count,
      {f"CAST(min({column}) AS DOUBLE)" if number else null("DOUBLE")} AS min_num,
      {f"CAST(max({column}) AS DOUBLE)" if number else null("DOUBLE")} AS max_num,
      {f"round(avg({column}), 4)" if number else null("DOUBLE")} AS mean,
      {f"round(stddev_samp({column}), 4)" if number else null("DOUBLE")} AS stddev,
      {f"CAST(min({column}) AS VARCHAR)" if text else null("VARCHAR")} AS min_text,
      {f"CAST(max({column}) AS VARCHAR)" if text else null("VARCHAR")} AS max_text FROM orders"""


@query(
    " UNION ALL ".join(
        _profile_sql(c, t)
        for c, t in [
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
        ]
    )
)
def profile_orders(spark, sf):
    found = profile.profile(read_parquet(spark, sf, "orders"), exact=True)
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    " UNION ALL ".join(
        f"SELECT count(*) AS total_rows, '{c}' AS column, true AS distinct_fits, count(*) - count({c}) AS null_count FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )
)
def profile_orders_approx(spark, sf):
    """The sketched profile; of its distinct counts, whether they are within three deviations (5 % each)."""
    orders = read_parquet(spark, sf, "orders")
    exact = profile.profile(orders, exact=True).select("column", F.col("distinct_count").alias("exact"))
    off = F.abs(F.col("distinct_count") - F.col("exact")) / F.col("exact")
    return profile.profile(orders).join(exact, "column").select(
        "total_rows", "column", (off <= 0.15).alias("distinct_fits"), "null_count"
    )


@query(
    f"""{with_ctes("listings")} SELECT 'price' AS column, count(price) AS texts,
      count(CASE WHEN price IS NOT NULL AND {money("price")} IS NULL THEN 1 END) AS failed FROM listings
    UNION ALL SELECT 'bathrooms_text', count(bathrooms_text),
      count(CASE WHEN bathrooms_text IS NOT NULL
        AND try_cast(split_part(bathrooms_text, ' ', 1) AS DOUBLE) IS NULL THEN 1 END) FROM listings"""
)
def parse_failures(spark, sf):
    return profile.parse_failures(
        standins.listings(spark, sf),
        {"price": parse.parse_money("price"), "bathrooms_text": parse.leading_number("bathrooms_text")},
    )


@query(
    f"""{with_ctes("priced")} SELECT city, quantile_cont(price_num, 0.1) AS p10,
    quantile_cont(price_num, 0.5) AS p50, quantile_cont(price_num, 0.9) AS p90 FROM priced GROUP BY 1"""
)
def median_exact(spark, sf):
    return quantiles.quantiles(standins.priced(spark, sf), "price_num", [0.1, 0.5, 0.9], ["city"], exact=True)


@query(
    """SELECT round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
    round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
    round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem"""
)
def median_exact_lineitem(spark, sf):
    lines = read_parquet(spark, sf, "lineitem")
    found = quantiles.exact_quantiles(lines, "l_extendedprice", [0.1, 0.5, 0.9])
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query(
    f"""{with_ctes("priced")} SELECT city, count(price_num) AS prices, true AS p10, true AS p50, true AS p90
    FROM priced GROUP BY 1"""
)
def median_approx(spark, sf):
    """Whether the sketched quantiles have ranks within the sketch's error."""
    priced = standins.priced(spark, sf)
    found = quantiles.quantiles(priced, "price_num", [0.1, 0.5, 0.9], ["city"])
    return priced.join(found, "city").groupBy("city").agg(
        F.count("price_num").alias("prices"),
        *[rank_fits("price_num", q, p).alias(q) for q, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))],
    )
