import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import keys, occupancy, profile, reconcile, rejects
from lakeops.operators.impute import impute
from lakeops.operators.recommend import recommend
from lakeops.plans import trips as trip_plan

AT = dt.datetime(2025, 1, 1)
NAN = float("nan")


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(
        [(1, None, NAN), (2, "x", None), (3, None, 0.0), (None, None, None)], "a int, b string, c double"
    )


def test_profile_equals_one_count_per_column(spark, dirty):
    got = {r.column: (r.total_rows, r.missing_count, r.missing_percent) for r in profile.missing_profile(dirty).collect()}
    filled = dirty.where("a is not null or b is not null or c is not null")
    n = filled.count()
    for c in dirty.columns:
        missing = filled.where(F.col(c).isNull()).count()
        assert got[c] == (n, missing, pytest.approx(missing / n * 100))


def test_nan_counts_as_missing_on_request(spark, dirty):
    def of_c(**kw):
        return next(r.missing_count for r in profile.missing_report(dirty, **kw).collect() if r.column == "c")

    assert (of_c(), of_c(nan_as_null=True)) == (2, 3)


def test_empty_frames(spark, dirty):
    empty = dirty.limit(0)
    assert profile.missing_report(empty).collect() == []
    assert {r.missing_percent for r in profile.missing_profile(empty).collect()} == {0.0}
    assert {r.missing_rate for r in profile.missing_rate(empty).collect()} == {None}
    assert tuple(profile.missing_rate(empty, wide=True).first()) == (None, None, None)


def test_rates_wide_and_long_agree(spark, dirty):
    wide = profile.missing_rate(dirty, wide=True).first().asDict()
    assert wide == {r["column"]: r.missing_rate for r in profile.missing_rate(dirty).collect()}


def test_profile_is_one_scan_whatever_the_width(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).select(*[F.col("id").alias(f"c{i}") for i in range(40)]).write.parquet(path)
    plan = profile.missing_profile(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_profile_types(spark):
    df = spark.createDataFrame([(1, "b", True, AT), (3, "a", None, AT)], "i int, s string, f boolean, t timestamp")
    got = {r.column: r for r in profile.profile(df, exact=True).collect()}
    assert (got["i"].min_num, got["i"].max_num, got["i"].mean) == (1, 3, 2)
    assert (got["s"].min_text, got["s"].distinct_count) == ("a", 2)
    assert (got["f"].null_count, got["f"].min_num, got["f"].min_text) == (1, None, None)
    assert got["t"].max_text.startswith("2025-01-01")


def test_reconcile_and_log(spark):
    upper, lower = {"a": spark.range(3), "b": spark.range(2)}, {"a": spark.range(3), "b": spark.range(1)}
    assert [tuple(r) for r in reconcile.reconcile(upper, lower).collect()] == [("b", 2, 1, 1)]
    log = {r.table_name: r.status for r in reconcile.quality_log(upper, lower, AT).collect()}
    assert log == {"a": "OK", "b": "MISMATCH"}


def test_a_table_that_one_layer_lacks_is_reported(spark):
    upper, lower = {"t1": spark.range(3), "t2": spark.range(2)}, {"t1": spark.range(3), "t3": spark.range(1)}
    found = sorted(tuple(r) for r in reconcile.reconcile(upper, lower).collect())
    assert found == [("t2", 2, None, None), ("t3", None, 1, None)]
    log = {r.table_name: r.status for r in reconcile.quality_log(upper, lower, AT).collect()}
    assert log == {"t1": "OK", "t2": "MISSING", "t3": "MISSING"}
    row = reconcile.filtered_counts(spark.range(9), all=F.lit(True), low=F.col("id") < 4).first()
    assert row.asDict() == {"all_cnt": 9, "low_cnt": 4}


def test_keys_of_absent_tables_are_rows_without_counts(spark):
    primary = keys.check_primary(lambda _: None, keys.STAR_PRIMARY)
    foreign = keys.check_foreign(lambda t: spark.range(2) if t == "region" else None, keys.STAR_FOREIGN)
    assert primary.count() == len(keys.STAR_PRIMARY) and foreign.count() == len(keys.STAR_FOREIGN)
    assert primary.where("null_rows is not null or excess_rows is not null").count() == 0
    for empty in (keys.check_primary(lambda _: None, []), keys.check_foreign(lambda _: None, [])):
        assert empty.count() == 0 and len(empty.columns) == 5


def trip(spark, pickup, dropoff, distance=1.0, total=5.0):
    return spark.createDataFrame(
        [(1, pickup, dropoff, 1, distance, 1, 2, 3, 1, 4.0, total, 1.0)],
        "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count int,"
        "trip_distance double, RatecodeID int, PULocationID int, DOLocationID int, payment_type int,"
        "fare_amount double, total_amount double, tip_amount double",
    )


LATER = AT + dt.timedelta(minutes=10)


@pytest.mark.parametrize(
    "args, plain, strict",
    [((AT, LATER), [], []),
     ((None, LATER), ["NULL_PICKUP_TS"], ["NULL_PICKUP_TS"]),
     ((AT, None), ["NULL_DROPOFF_TS"], ["NULL_DROPOFF_TS"]),
     ((LATER, AT), ["NEG_DURATION"], ["NEG_DURATION"]),
     ((AT, AT), [], ["ZERO_DURATION"]),
     ((AT, LATER, -1.0, -2.0), ["NEG_DISTANCE", "NEG_TOTAL"], ["NEG_DISTANCE", "NEG_TOTAL"]),
     ((AT, LATER, None, None), [], ["NULL_DISTANCE", "NULL_TOTAL"])],
)
def test_trip_reasons(spark, args, plain, strict):
    df = trip(spark, *args)
    assert trip_plan.dq_view(df).first().reject_reasons == plain
    assert trip_plan.dq_view(df, strict=True).first().reject_reasons == strict
    assert (trip_plan.silver(df).count() == 1) == (strict == [])


def test_strict_reasons_account_for_every_raw_trip(spark):
    from conftest import SF

    from lakeops.suite import standins

    raw = standins.trips(spark, SF)
    view = trip_plan.dq_view(raw, strict=True)
    silver, bad = trip_plan.silver(raw).count(), rejects.quarantine(view).count()
    assert silver + bad == raw.count() and rejects.accepted(view).count() == silver


def test_unknown_days_are_free_or_left_out(spark):
    df = spark.createDataFrame(
        [("B", "2025-01-01", "t"), ("B", "2025-01-02", "f"), ("B", "2025-01-03", None)],
        "city string, date string, available string",
    )
    by_month = occupancy.occupancy_by_month(occupancy.typed_calendar(df)).first()
    assert by_month.month == dt.date(2025, 1, 1) and by_month.occ_rate_month == pytest.approx(1 / 3)
    assert occupancy.occupancy_overall(df).first().avg_occupancy == 0.5


def test_keys_find_what_was_broken(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    assert tuple(keys.pk_violations(parent, "id").first()) == (1, 1, 1)
    assert keys.null_keys(parent, ["id"]).first().id == 1
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "pid long")
    assert tuple(keys.fk_orphans(child, "pid", parent, "id").first()) == (1, 2)
    clean = spark.createDataFrame([(1,)], "id long")
    assert tuple(keys.pk_violations(clean, "id").first()) == (0, 0, 0)
    assert tuple(keys.pk_violations(clean.limit(0), "id").first()) == (0, 0, 0)
    assert tuple(keys.fk_orphans(clean, "id", clean, "id").first()) == (0, 0)


@pytest.mark.parametrize("exact", [True, False])
def test_impute_flags_every_filled_value(spark, exact):
    df = spark.createDataFrame(
        [(1.0, 1.0, "a", None, 1), (None, None, None, "x", 1), (3.0, 9.0, "a", None, 1), (8.0, 2.0, "b", "y", None)],
        "mean double, median double, mode string, cat string, must int",
    )
    rules = {"mean": "mean", "median": "median", "mode": "mode", "cat": "category:none", "must": "drop"}
    got = impute(df, rules, exact).collect()
    assert len(got) == 3
    filled = next(r for r in got if r.mean_imputed)
    assert filled.mean == 2.0 and filled.mode == "a" and filled.mode_imputed and filled.median_imputed
    assert filled.median == (5.0 if exact else 1.0)
    assert sorted(r.cat for r in got) == ["none", "none", "x"]
    assert "must_imputed" not in got[0].asDict()


def test_nan_is_a_gap_to_impute(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (NAN, NAN, NAN), (None, None, None), (3.0, 3.0, 3.0)], "a double, b double, c double")
    for exact in (False, True):
        got = impute(df, {"a": "mean", "b": "median", "c": "zero"}, exact).collect()
        assert sorted(r.a for r in got) == [1.0, 2.0, 2.0, 3.0] and sorted(r.c for r in got) == [0.0, 0.0, 1.0, 3.0]
        assert [r.b for r in got].count(2.0 if exact else 1.0) >= 2 and sum(r.a_imputed for r in got) == 2


def test_means_and_medians_are_one_aggregate(spark):
    df = spark.createDataFrame([(float(k), float(-k), k) for k in range(9)], "a double, b double, c int")
    plan = impute(df, {"a": "mean", "b": "median", "c": "mean"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") >= 1 and plan.count("percentile_approx") <= plan.count("scalar-subquery")


def test_impute_zero_keeps_the_type_and_unknown_rules_raise(spark):
    df = spark.createDataFrame([(None,), (4,)], "n int")
    out = impute(df, {"n": "zero"})
    assert dict(out.dtypes)["n"] == "int" and sorted(r.n for r in out.collect()) == [0, 4]
    with pytest.raises(ValueError):
        impute(df, {"n": "guess"})


def test_recommendations(spark):
    hist = spark.createDataFrame([("B", 1.0, 1)], "city string, price_bucket double, cnt long")
    nb = spark.createDataFrame(
        [("B", "x", 1.0, None, 1.0, 1.0), ("B", "y", 1.0, 2.0, 1.0, 1.0)],
        "city string, neighbourhood string, lat double, lon double, avg_price double, avg_occ_365 double",
    )
    months = spark.createDataFrame([("B", dt.date(2025, 1, 1), 0.5)], "city string, month date, occ_rate_month double")
    got = [(r.city, r.dataset) for r in recommend(hist, nb, months, ["B", "S"]).collect()]
    assert sorted(got) == [
        ("B", "occ_by_month"), ("B", "price_hist"), ("S", "price_hist"), ("all", "neighbourhood_metrics"),
    ]
    empty = [(r.city, r.dataset) for r in recommend(hist, nb.limit(0), months.limit(0), ["B"]).collect()]
    assert sorted(empty) == [("B", "neighbourhood_metrics"), ("B", "occ_by_month"), ("B", "price_hist")]
