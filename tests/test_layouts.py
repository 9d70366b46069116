"""Tables laid out for what is asked of them, profiles that merge, and values at the edges of their types."""

import datetime as dt
import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from lakeops.functions.measure import avg_2dp, left_out, sum_2dp
from lakeops.operators import aggregate, geo, quantiles, sample, sketches
from lakeops.plans import star, trips
from lakeops.sources import sinks, tables, versions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, schema):
    silver = f"{schema}_silver"
    try:
        orders = spark.range(500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("P").alias("o_orderstatus"))
        lines = spark.range(2000).select((F.col("id") % 600).alias("l_orderkey"), F.col("id").alias("l_quantity"))
        sinks.write_table(orders, f"{schema}.orders")
        sinks.write_table(lines, f"{schema}.lineitem")
        star.to_silver_bucketed(spark, schema, silver, 4)
        left, right = spark.table(f"{silver}.lineitem"), spark.table(f"{silver}.orders")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = left.join(right, F.col("l_orderkey") == F.col("order_id"))
        orphans = left.join(right, F.col("l_orderkey") == F.col("order_id"), "left_anti").groupBy("l_orderkey").count()
        for df in (joined, orphans):
            assert "SortMergeJoin" in plan(df) and "Exchange" not in plan(df)
        plain = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        assert rows(joined.select("l_orderkey", "l_quantity", "customer_id")) == rows(plain.select("l_orderkey", "l_quantity", "o_custkey"))
        assert orphans.count() == 100
        # replaced in the same buckets, by one change of the location, and still without a shuffle
        sinks.write_table(left.where("l_quantity < 100"), f"{silver}.lineitem", bucket_by=(4, ["l_orderkey"]))
        again = spark.table(f"{silver}.lineitem").join(right, F.col("l_orderkey") == F.col("order_id"))
        assert "Exchange" not in plan(again) and again.count() == 100
        assert versions.definition(spark, f"{silver}.lineitem").buckets == (4, ("l_orderkey",))
        assert not [t for t in tables.tables_like(spark, silver, "stage_")]
        with pytest.raises(ValueError):
            sinks.write_table(left, f"{silver}.x", mode="append", bucket_by=(4, ["l_orderkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
        spark.sql(f"DROP DATABASE IF EXISTS {silver} CASCADE")


def test_the_newest_window_reads_its_days_only(spark, schema):
    name, start = f"{schema}.days", dt.datetime(2025, 1, 1)
    stamped = [(start + dt.timedelta(hours=5 * k), float(k)) for k in range(100)] + [(None, 1.0)]
    df = spark.createDataFrame(stamped, f"{trips.PICKUP} timestamp, trip_distance double")
    trips.store_by_day(df, name)
    days = tables.partition_values(spark, name, trips.DAY)
    assert len(days) == 21 and days[-1] == "2025-01-21" and days == sorted(days)
    whole = trips.score_window(df, F.col("trip_distance") * 2, trips.PICKUP, ["trip_distance"], "1 days")
    got = trips.score_newest_days(spark, name, F.col("trip_distance") * 2, ["trip_distance"], 1)
    assert rows(got) == rows(whole) and got.count() == 4  # five hours apart, the newest left out
    # the other days are not opened: their files may as well be broken
    where = versions.definition(spark, name).location.removeprefix("file:")
    for file in glob.glob(f"{where}/*/*.parquet"):
        if not any(day in file for day in days[-2:]):
            open(file, "wb").write(b"no parquet")
    spark.catalog.refreshTable(name)
    assert rows(trips.score_newest_days(spark, name, F.col("trip_distance") * 2, ["trip_distance"], 1)) == rows(whole)
    trips.store_by_day(df.where("trip_distance < 0"), f"{schema}.none")
    assert tables.last_window_by_day(spark, f"{schema}.none", trips.PICKUP, trips.DAY).count() == 0


def test_sketches_merge_to_those_of_all_rows(spark):
    rng = random.Random(4)
    data = [(k % 13, rng.gauss(0, 1) * 10 ** (k % 3), f"s{rng.randrange(3000)}") for k in range(20_000)]
    df = spark.createDataFrame([*data, (1, None, None), (2, math.nan, "x")], "load int, v double, s string")
    kept = sketches.sketch(df, ["v"], ["s", "v"], by=["load"])
    assert kept.count() == 26
    merged, probs = sketches.merge(kept), [0.0, 0.01, 0.5, 0.99, 1.0]
    for sketched in (merged, sketches.sketch(df, ["v"], ["s", "v"])):
        errors = sketches.rank_errors(df, sketched, probs).collect()
        assert len(errors) == 5 and all(r.rank_error <= 2 * r.bound for r in errors)
        got = {r.column: r for r in sketches.read(sketched, probs).collect()}
        v = [x for _, x, _ in data]
        assert (got["v"].rows, got["v"].missing, got["v"].low, got["v"].high) == (20_002, 2, min(v), max(v))
        assert got["v"].mean == pytest.approx(sum(v) / len(v)) and got["v"].p0 == min(v) and got["v"].p100 == max(v)
        assert got["s"].distinct_values == pytest.approx(len({s for *_, s in data}) + 1, rel=0.1) and got["s"].p50 is None
    by_two = sketches.merge(kept.withColumn("half", F.col("load") % 2), by=["half"])
    assert rows(by_two.where("column = 'v'").select("half", "present")) == [(0, sum(k % 13 % 2 == 0 for k in range(20_000))), (1, sum(k % 13 % 2 for k in range(20_000)))]


def test_sketches_of_gaps_infinities_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, math.inf), (2, 1.0)], "g int, v double")
    got = {r.g: r for r in sketches.read(sketches.merge(sketches.sketch(df, ["v"], by=["g"]), by=["g"]), [0.5], by=["g"]).collect()}
    assert (got[1].missing, got[1].p50, got[1].mean) == (1, None, None)
    assert (got[2].high, got[2].mean) == (math.inf, None)  # no decimal holds the total
    none = sketches.merge(sketches.sketch(df.limit(0), ["v"], ["v"]))
    assert [(r.rows, r.p50) for r in sketches.read(none, [0.5]).collect()] in ([], [(0, None)])


def test_quantiles_of_values_that_lie_close_together(spark):
    micros = spark.range(200_000).select((F.lit(1_700_000_000_000_000) + F.col("id") * 2_000_003).cast("double").alias("v"))
    probs = [0.0, 0.1, 0.333, 0.5, 0.999, 1.0]
    got = quantiles.exact_quantiles(micros, "v", probs)
    assert got.first() == micros.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("p")).first()[0] or list(got.first()) == pytest.approx(
        micros.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0], rel=1e-15
    )
    # a range of a group is cut: no step holds more than a few of its values
    steps = micros.select(quantiles._step(F.col("v")).alias("s"))
    assert steps.groupBy(F.shiftright("s", quantiles.STEP_BITS)).count().agg(F.max("count")).first()[0] > 5_000
    assert steps.groupBy("s").count().agg(F.max("count")).first()[0] < 5


def test_quantiles_at_the_ends_of_doubles(spark):
    values = [-math.inf, -1.7976931348623157e308, -1.0, -5e-324, 0.0, -0.0, 5e-324, 2.0, 1.7976931348623157e308, math.inf]
    probs = [0.0, 0.1, 0.25, 0.5, 0.6, 0.9, 1.0]
    for some in (values, values[:3], [math.inf] * 3, [-math.inf, -math.inf, 3.0], [1.0, math.nan], [7.5]):
        df = spark.createDataFrame([(v,) for v in some], "v double")
        got = list(quantiles.exact_quantiles(df, "v", probs).first())
        want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
        same = lambda a, b: a == b or (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-12)
        assert all(same(a, b) for a, b in zip(got, want)), (some, got, want)


def test_a_sample_from_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    for k in (0, 1, 500, 15_000, 40_000):
        got = sample.sample_k(df, ["k"], k, seed=3)
        assert got.count() == min(k, 30_000) and got.columns == ["k", "v"] and got.distinct().count() == got.count()
    # the hot key comes whole, in part or not at all, and no key after one that is cut
    hashes = df.withColumn("h", sample.key_hash("k", seed=3)).groupBy("h", "k").count().orderBy("h", "k").collect()
    some = {r.k: r["count"] for r in sample.sample_k(df, ["k"], 12_000, seed=3).groupBy("k").count().collect()}
    left = 12_000
    for r in hashes:
        assert some.get(r.k, 0) == min(left, r["count"])
        left -= min(left, r["count"])


def test_nan_is_in_no_bin_and_no_cell(spark):
    df = spark.createDataFrame(
        [("a", math.nan, math.nan, 1.0, 5.0), ("a", 4.0, 1.2, math.nan, 5.0), ("a", 3.9, 1.2, 2.2, math.nan), ("a", None, 1.3, 2.3, 7.0), ("a", 0.0, math.inf, 1.0, 1.0)],
        "city string, review_scores_rating double, latitude double, longitude double, price_num double",
    )
    assert rows(aggregate.rating_histogram(df, width=1)) == [("a", 0, 1), ("a", 3, 1), ("a", 4, 1)]
    assert rows(geo.geo_grid(df, 1)) == [(1, 2, 2, pytest.approx(1.25), pytest.approx(2.25), 7.0)]
    assert rows(geo.geo_pyramid(df, 1)) == [(0, 1, 2, 2, pytest.approx(1.25), pytest.approx(2.25), 7.0)]


def test_every_zoom_level_is_a_direct_grouping(spark):
    rng = random.Random(8)
    data = [(rng.uniform(-80, 80), rng.uniform(-180, 180), rng.choice([None, 10.0, 20.0])) for _ in range(3000)]
    df = spark.createDataFrame(data, "latitude double, longitude double, price_num double")
    got = geo.geo_pyramid(df, 6, per_degree=1).cache()
    for level in range(6):
        direct = {(r.cell_lat, r.cell_lon): r for r in geo.geo_grid(df, 1 << level).collect()}
        mine = {(r.cell_lat, r.cell_lon): r for r in got.where(F.col("level") == level).collect()}
        assert {c: r.cnt for c, r in mine.items()} == {c: r.cnt for c, r in direct.items()}
        assert all(r.lat == pytest.approx(direct[c].lat) and r.avg_price == pytest.approx(direct[c].avg_price) for c, r in mine.items())


@pytest.mark.parametrize("values,total,mean", [
    ([1e29, 2.0], 1e29, 5e28), ([math.inf, 2.0], 2.0, 2.0), ([math.nan, 2.0, 3.005], 5.01, 2.5),
    ([None, None], None, None), ([math.nan], None, None), ([0.1] * 10, 1.0, 0.1), ([9e27] * 200, 1.8e30, 9e27), ([-math.inf, math.inf], None, None),
])
def test_no_amount_leaves_a_sum_in_silence(spark, values, total, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(sum_2dp("v").alias("s"), avg_2dp("v").alias("m"), left_out("v").alias("n")).first()
    assert got.n == sum(v is not None and not math.isfinite(v) for v in values)
    for a, b in ((got.s, total), (got.m, mean)):
        assert a == b or a == pytest.approx(b, rel=1e-12, nan_ok=True)
