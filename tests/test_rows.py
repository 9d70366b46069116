import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import aggregate, columns, rows
from lakeops.operators.combine import orphans, table_counts, top_by_count, union_all

AT = dt.datetime(2025, 1, 1)


def test_dedupe_ignores_load_stamps(spark):
    first = columns.add_load_timestamp(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "i int, s string"), AT)
    again = columns.add_load_timestamp(first.drop("load_timestamp"), AT + dt.timedelta(days=1))
    kept = rows.dedupe(first.unionByName(again))
    assert sorted(map(tuple, kept.collect())) == [(1, "a", AT), (1, "b", AT)]


def test_all_null_rows_are_dropped_in_spite_of_the_stamp(spark):
    df = columns.add_load_timestamp(spark.createDataFrame([(None, None), (None, 1)], "a int, b int"), AT)
    assert rows.drop_all_null(df).count() == 1
    assert rows.all_null_count(df).first()[0] == 1


@pytest.mark.parametrize(
    "table, cols, kept",
    [("berlin_listing", ("id", "listing_id"), 1), ("berlin_reviews", ("listing_id", "x"), 1),
     ("stock_review", ("listing_id", "x"), 1), ("berlin_reviews", ("id", "listing_id"), 1),
     ("berlin_calendar", ("id", "x"), 2), ("berlin_listing", ("x", "y"), 2)],
)
def test_null_keys(spark, table, cols, kept):
    df = spark.createDataFrame([(None, 1), (1, None)], f"{cols[0]} int, {cols[1]} int")
    assert rows.drop_null_key(df, table).count() == kept


def test_drop_null_takes_nan_for_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 1), (0.0, 1), (1.0, None)], "x double, y int")
    assert rows.drop_null(df, ["x"]).count() == 2


def test_outliers(spark):
    df = spark.createDataFrame([(1.0,), (10000.0,), (None,)], "p double")
    kept, extreme = rows.split_outliers(df, "p", 10000)
    assert (kept.count(), extreme.count()) == (1, 1)
    assert tuple(rows.outlier_counts(df, "p", 10000).first()) == (1, 1, 1)


def test_whole_prices(spark):
    df = spark.createDataFrame([("$85",), ("85.00",), ("$1,085",), ("5",), (" ",), (None,), ("1000",)], "price string")
    assert sorted(r.clean_price for r in rows.whole_prices(df).collect()) == [85, 1000]


def test_last_window_leaves_the_newest_row_out(spark):
    t = dt.datetime(2025, 1, 10, 12)
    times = [t, t - dt.timedelta(days=1), t - dt.timedelta(days=1, seconds=1), t - dt.timedelta(hours=1), None]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(x,) for x in times], f"ts {kind}")
        assert sorted(r.ts for r in rows.last_window(df, "ts").collect()) == [times[1], times[3]]
    empty = spark.createDataFrame([], "ts timestamp")
    assert rows.last_window(empty, "ts").count() == 0


def test_between_is_inclusive(spark):
    assert rows.between(spark.range(10), "id", 2, 4).count() == 3


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, union_all([a, b]).collect()), key=str) == [(1, 2), (3, None)]


def test_table_counts(spark):
    got = table_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(map(tuple, got.collect())) == [("a", 3), ("b", 0)]


def test_share_sums_to_one_and_takes_null_groups(spark):
    df = spark.createDataFrame([("B", "x"), ("B", "y"), ("B", "x"), (None, "x")], "city string, room string")
    got = {(r.city, r.room): (r.cnt, r.share) for r in aggregate.share(df, "room", ["city"]).collect()}
    assert got == {("B", "x"): (2, 2 / 3), ("B", "y"): (1, 1 / 3), (None, "x"): (1, 1.0)}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (199.9,), (200.0,), (900.0,), (None,), (float('nan'),)], "x double")
    got = {r.bin: r.cnt for r in aggregate.histogram(df, "x", 0, 200, 60).collect()}
    assert got == {0: 2, 59: 3}


def test_pivot_gaps(spark):
    df = spark.createDataFrame([(1, "B", 4), (2, "S", 5)], "b int, city string, cnt long")
    assert sorted(map(tuple, aggregate.pivot_counts(df, "b", "city", ["B", "S"]).collect())) == [(1, 4, 0), (2, 0, 5)]
    assert sorted(map(tuple, aggregate.pivot_counts(df, "b", "city", ["B", "S"], fill=None).collect())) == [
        (1, 4, None), (2, None, 5),
    ]


def test_empty_amenity_list_counts_as_an_item_unless_dropped(spark):
    from lakeops.plans.listings import amenity_items

    df = spark.createDataFrame([('["Wifi", "TV"]',), ("[]",)], "amenities string")
    plain = {r.item: r.cnt for r in aggregate.item_counts(df, amenity_items()).collect()}
    assert plain == {"wifi": 1, " tv": 1, "": 1}
    clean = {r.item: r.cnt for r in aggregate.item_counts(df, amenity_items(True, True)).collect()}
    assert clean == {"wifi": 1, "tv": 1}


def test_orphans_and_top_with_a_hot_key(spark):
    child = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("k"))
    parent = spark.range(40).select(F.col("id").alias("pk"))
    lost = {r.key: r.child_rows for r in orphans(child, "k", parent, "pk").collect()}
    brute = {}
    for (k,) in child.collect():
        if k >= 40:
            brute[k] = brute.get(k, 0) + 1
    assert lost == brute
    assert top_by_count(child, "k", parent, "pk").first().pk == 7


def test_rename_passes_over_missing_columns(spark):
    assert columns.rename(spark.createDataFrame([(1,)], "a int"), {"a": "b", "z": "y"}).columns == ["b"]


def test_with_price_and_occupancy_are_optional(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert columns.with_occupancy(columns.with_price(df)).columns == ["x"]
    full = spark.createDataFrame([("$10.00", 73)], "price string, availability_365 int")
    row = columns.with_occupancy(columns.with_price(full)).first()
    assert (row.price_num, row.occ_rate_365) == (10.0, pytest.approx(0.8))
