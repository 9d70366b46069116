import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.functions import parse
from lakeops.functions.ids import key_hash, row_id
from lakeops.functions.measure import avg_2dp, duration_min, month_of, reasons, sum_2dp


def values(spark, texts, expr, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


PRICES = ["$1,200.00", "85", "85.00", "-$5.00", " ", "free", None, ""]


def test_price_parsers(spark):
    assert values(spark, PRICES, parse.price_to_double("x")) == [1200, 85, 85, -5, None, None, None, None]
    assert values(spark, PRICES, parse.parse_money("x")) == [1200, 85, 85, 5, None, None, None, None]
    assert values(spark, PRICES, parse.parse_money_signed("x")) == [1200, 85, 85, -5, None, None, None, None]


def test_bad_numbers_are_null_and_never_raise(spark):
    assert values(spark, ["1.2.3", "."], parse.parse_money("x")) == [None, None]


FLAGS = ["t", "T", "f", "F", "x", None]


def test_flags(spark):
    assert values(spark, FLAGS, parse.tf_equal("x")) == [True, False, False, False, False, None]
    assert values(spark, FLAGS, parse.tf_bool("x")) == [True, True, False, False, None, None]
    assert values(spark, FLAGS, parse.tf_int("x")) == [1, None, 0, None, None, None]


def test_bathrooms(spark):
    texts = ["1 bath", "1.5 shared baths", "Half-bath", "Shared half-bath", "none", None]
    assert values(spark, texts, parse.leading_number("x")) == [1, 1.5, None, None, None, None]
    assert values(spark, texts, parse.bathrooms("x")) == [1, 1.5, 0.5, 0.5, None, None]


def test_lists(spark):
    texts = ['["Wifi", "TV"]', "[]", None]
    assert values(spark, texts, parse.parse_list("x")) == [["Wifi", " TV"], [""], None]
    assert values(spark, texts, parse.parse_list("x", True, True)) == [["Wifi", "TV"], [], None]


def test_dates(spark):
    assert values(spark, ["2024-02-29", "not-a-date", "", None], parse.safe_date("x")) == [
        dt.date(2024, 2, 29), None, None, None,
    ]


def test_month_and_duration(spark):
    day = values(spark, ["2024-02-29"], month_of(F.col("x").cast("date")))
    assert day == [dt.date(2024, 2, 1)]
    for kind in ("timestamp", "timestamp_ntz"):
        end = F.lit("2024-01-01 01:30:00").cast(kind)
        assert values(spark, ["2024-01-01 00:00:00"], duration_min(F.col("x").cast(kind), end)) == [90.0]


def test_row_ids_skip_nulls_unless_told_otherwise(spark):
    df = spark.createDataFrame([(1, None, 7), (1, 7, None)], "a int, b int, c int")
    plain = {r[0] for r in df.select(row_id("a", "b", "c")).collect()}
    safe = {r[0] for r in df.select(row_id("a", "b", "c", null_safe=True)).collect()}
    assert len(plain) == 1 and len(safe) == 2


def test_key_hash_is_md5(spark):
    import hashlib

    expected = int(hashlib.md5(b"42").hexdigest()[:8], 16)
    assert values(spark, ["42"], key_hash("x")) == [expected]
    assert values(spark, ["42"], key_hash("x", seed=1)) != [expected]


def test_reasons_are_empty_for_good_rows(spark):
    rules = {"BLANK": F.trim("x") == "", "NULL": F.col("x").isNull()}
    assert values(spark, ["a", " ", None], reasons(rules)) == [[], ["BLANK"], ["NULL"]]


@pytest.mark.parametrize(
    "amounts, mean", [([65902.66, 65902.67], 65902.67), ([-0.01, -0.02], -0.02), ([1.0, None], 1.0), ([None], None)]
)
def test_rounded_means(spark, amounts, mean):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    row = df.agg(avg_2dp("x").alias("m"), sum_2dp("x").alias("s")).first()
    assert row.m == mean
    if mean is not None:
        assert row.s == pytest.approx(sum(a for a in amounts if a is not None))


def test_small_amounts_are_summed_before_they_are_rounded(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert df.agg(sum_2dp("x"), avg_2dp("x")).first()[:] == (4.0, 0.0)
    some = spark.createDataFrame([(x,) for x in (1.25, 1.255, 1.256, 0.006, 0.006, 0.006)], "x double")
    assert some.agg(sum_2dp("x")).first()[0] == 3.78
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,), (None,)], "x double")
    assert odd.agg(sum_2dp("x"), avg_2dp("x")).first()[:] == (1.5, 1.5)


def test_sums_do_not_depend_on_partitioning(spark):
    df = spark.range(100000).select((F.rand(7) * 1000).alias("x"))
    df = df.withColumn("x", F.round("x", 2))
    sums = {df.repartition(n).agg(sum_2dp("x")).first()[0] for n in (1, 3, 8)}
    assert len(sums) == 1
