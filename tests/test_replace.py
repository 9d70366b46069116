"""Replacement that survives failure, loads that can be run again, counts by the write, quarantined CSV rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.reconcile import quality_log, quality_log_of
from lakeops.plans import layers, listings, star
from lakeops.sources import contracts, files, loads, sinks, versions

AT = dt.datetime(2025, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def failing(df):
    """The frame, with an error at its last row, after others are written."""
    return df.withColumn("id", F.when(F.col("id") == 99, F.raise_error("broken").cast("bigint")).otherwise(F.col("id")))


def folders(spark, name):
    path = versions.home(spark, name).removeprefix("file:")
    return sorted(os.listdir(path))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_failed_replacement_leaves_the_old_rows(spark, schema, fmt):
    name = f"{schema}.t"
    sinks.write_table(spark.range(5), name, fmt=fmt)
    kept = folders(spark, name)
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(failing(spark.range(0, 100, 1, 4)), name, fmt=fmt)
    assert rows(spark.table(name)) == [(k,) for k in range(5)] and folders(spark, name) == kept
    sinks.write_table(spark.range(7), name, fmt=fmt)
    assert spark.table(name).count() == 7


def test_a_table_replaces_itself(spark, schema):
    name = f"{schema}.t"
    sinks.write_table(spark.range(10), name)
    for n in (9, 8, 7):
        sinks.write_table(spark.table(name).where(F.col("id") < n), name)
        assert spark.table(name).count() == n
    assert len(folders(spark, name)) == 2  # the rows now and the ones before
    wider = spark.table(name).withColumn("twice", F.col("id") * 2)
    sinks.write_table(wider, name)
    assert rows(spark.table(name)) == [(k, 2 * k) for k in range(7)]
    sinks.append(spark.createDataFrame([(70, 7)], "twice long, id long"), name)
    assert spark.table(name).count() == 8
    sinks.drop_tables(spark, [name])
    assert not spark.catalog.tableExists(name) and not os.path.exists(versions.home(spark, name).removeprefix("file:"))


def test_readers_that_began_before_go_on(spark, schema):
    name = f"{schema}.t"
    sinks.write_table(spark.range(10), name)
    begun = spark.table(name).where("id >= 0")
    begun.queryExecution if hasattr(begun, "queryExecution") else begun._jdf.queryExecution().executedPlan()
    sinks.write_table(spark.range(3), name)
    assert begun.count() == 10 and spark.table(name).count() == 3


def test_partitions_and_their_types_stay(spark, schema):
    name = f"{schema}.p"
    df = spark.createDataFrame([("01", 1, dt.date(2025, 1, 1)), ("1", 2, dt.date(2025, 1, 2))], "k string, v int, d date")
    sinks.write_table(df, name, partition_by=["k", "d"])
    assert rows(spark.table(name)) == [(1, "01", dt.date(2025, 1, 1)), (2, "1", dt.date(2025, 1, 2))]
    sinks.write_table(spark.table(name).where("v = 2").select("k", "v", "d"), name, partition_by=["k", "d"])
    assert rows(spark.table(name)) == [(2, "1", dt.date(2025, 1, 2))]
    with pytest.raises(Exception):
        sinks.write_table(df.withColumn("v", F.raise_error("x").cast("int")), name, partition_by=["k", "d"])
    assert spark.table(name).count() == 1
    sinks.write_table(df, name)
    assert spark.table(name).columns == ["k", "v", "d"] and spark.table(name).count() == 2


def test_undo_and_tables_made_elsewhere(spark, schema, tmp_path):
    name = f"{schema}.u"
    sinks.ensure_table(spark, name, StructType.fromDDL("id bigint"))
    sinks.append(spark.range(2), name)
    sinks.write_table(spark.range(3), name)
    versions.undo_replace(spark, name)
    assert spark.table(name).count() == 2
    versions.undo_replace(spark, name)
    assert spark.table(name).count() == 3
    elsewhere = str(tmp_path / "mine")
    spark.range(4).write.parquet(elsewhere)
    spark.sql(f"CREATE TABLE {schema}.x (id bigint) USING parquet LOCATION '{elsewhere}'")
    for n in (5, 6, 7):
        sinks.write_table(spark.range(n), f"{schema}.x")
    assert spark.table(f"{schema}.x").count() == 7 and spark.read.parquet(elsewhere).count() == 4
    sinks.write_table(spark.range(1).withColumn("b", F.lit(1)), name)
    with pytest.raises(ValueError):
        versions.undo_replace(spark, name)


def test_a_definition_that_cannot_be_made_brings_the_old_one_back(spark, schema, monkeypatch):
    name = f"{schema}.t"
    sinks.write_table(spark.range(5), name)
    make, calls = versions._create, []

    def once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("catalog")
        make(*args)

    monkeypatch.setattr(versions, "_create", once)
    with pytest.raises(RuntimeError):
        sinks.write_table(spark.range(5).withColumn("b", F.lit(1)), name)
    assert rows(spark.table(name)) == [(k,) for k in range(5)]


def test_a_load_that_runs_twice_is_one_load(spark, schema):
    name = f"{schema}.l"
    assert loads.append_load(spark.range(3), name, "a'1") == 3
    assert loads.append_load(spark.range(30), name, "a'1") is None
    assert loads.append_load(spark.range(2).select(F.col("id").cast("int")), name, "b") == 2
    assert rows(spark.table(name)) == [(0, "a'1"), (0, "b"), (1, "a'1"), (1, "b"), (2, "a'1")]
    # a run that wrote its rows and ended before its record
    loads._write_partition(spark.range(50), name, "c")
    assert loads.append_load(spark.range(4), name, "c") == 4
    assert spark.table(name).where("load_id = 'c'").count() == 4
    with pytest.raises(Exception, match="broken"):
        loads.append_load(failing(spark.range(0, 100, 1, 4)), name, "d")
    assert spark.table(name).count() == 9 and spark.table(f"{name}_loads").count() == 3
    with pytest.raises(ValueError):
        loads.append_load(spark.range(1).withColumn("other", F.lit(1)), name, "e")
    sinks.write_table(spark.range(1), f"{schema}.plain")
    with pytest.raises(ValueError):
        loads.append_load(spark.range(1), f"{schema}.plain", "a")


def test_rows_that_earlier_loads_have_brought_stay_out(spark, schema):
    name, kind = f"{schema}.n", "k int, s string, f double, area string"
    feed = [(1, None, 1.0, "x"), (1, "", 1.0, "x"), (None, "a", float("nan"), "x"), (2, "b", 0.5, "x"), (2, "b", 0.5, "y")]
    df = spark.createDataFrame(feed, kind)
    assert loads.append_new(df, name, "one") == 4  # two rows differ in the load column only
    assert loads.append_new(df, name, "two") == 0 and loads.append_new(df, name, "one") is None
    more = spark.createDataFrame([(1, None, 1.0, "z"), (None, "1", 1.0, "z"), (3, "c", None, "z")], kind)
    assert loads.append_new(more, name, "three") == 2
    assert spark.table(name).count() == 6 and spark.table(f"{name}_ledger").count() == 6
    # a run that ended between the ledger and the rows brings them when it is run again
    late = spark.createDataFrame([(9, "late", 1.0, "z")], kind)
    loads._write_partition(late.select(loads.row_hash(late, ["area"]).alias("row_hash")), f"{name}_ledger", "four")
    assert loads.append_new(late, name, "four") == 1 and loads.append_new(late, name, "five") == 0


def test_counts_come_with_the_write(spark, schema):
    low = f"{schema}_low"
    try:
        sinks.write_table(spark.range(100), f"{schema}.orders")
        sinks.write_table(spark.range(10), f"{schema}.customer")
        sinks.write_table(spark.range(0), f"{schema}.part")

        def change(table, df):
            return df.where("id < 60") if table == "orders" else df.groupBy("id").count() if table == "customer" else df

        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("counted", "one scan a table")
        got = layers.copy_counted(spark, schema, low, ["orders", "part"], change)
        jobs = tracker.getJobIdsForGroup("counted")
        assert got == [("orders", 100, 60), ("part", 0, 0)] and len(jobs) == 2  # the writes and nothing else
        spark.sparkContext.setJobGroup("other", "")
        assert layers.copy_counted(spark, schema, low, ["customer"], change) == [("customer", 10, 10)]
        upper, lower = ({t: spark.table(f"{s}.{t}") for t in ("orders", "customer", "part")} for s in (schema, low))
        assert rows(quality_log_of(spark, [*got, ("customer", 10, 10)], AT)) == rows(quality_log(upper, lower, AT))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {low} CASCADE")


def test_the_log_of_a_load_has_one_row_a_table(spark, schema):
    names = [f"{schema}_{x}" for x in ("silver", "log")]
    try:
        for t, n in (("part", 5), ("region", 3)):
            sinks.write_table(spark.range(n), f"{schema}.{t}")
        sinks.ensure_schema(spark, names[0])
        sinks.write_table(spark.range(2), f"{names[0]}.nation")
        for _ in range(2):
            star.to_silver_logged(spark, schema, *names, "day 1", AT)
        log = spark.table(f"{names[1]}.data_quality_loads")
        assert rows(log.drop("run_timestamp", "load_id")) == [
            ("nation", None, 2, None, "MISSING"), ("part", 5, 5, 0, "OK"), ("region", 3, 3, 0, "OK"),
        ]
        star.to_silver_logged(spark, schema, *names, "day 2", AT)
        assert log.sparkSession.table(f"{names[1]}.data_quality_loads").count() == 6
    finally:
        for n in names:
            spark.sql(f"DROP DATABASE IF EXISTS {n} CASCADE")


BROKEN = [
    "id,name,size",
    '1,"one, ""first""",10',
    "2,two",  # short
    "3,three,30,more,still",  # long
    '4,"four,40',  # a quote that is not closed
    "5,,",  # empty fields are fields
    "",  # no row
    "6,six,many",  # not a number
    '7,"se""ven",70,',  # long by an empty field
]


@pytest.mark.parametrize("multi_line", [False, True, None])
def test_broken_rows_add_up_with_the_good_ones(spark, tmp_path, multi_line):
    lines = BROKEN if multi_line is False else [x for x in BROKEN if "four" not in x]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text('id,name,size\n8,"eight",80\n9\n')
    contract = StructType.fromDDL("size bigint, id bigint, note string")
    good, bad = files.read_csv_checked(spark, str(tmp_path), contract, multi_line)
    assert rows(good) == sorted([(10, 1, None), (None, 5, None), (None, 6, None), (80, 8, None)], key=str)
    found = {(r.file.rsplit("/", 1)[1], r.reason, r.record) for r in bad.collect()}
    want = {("a.csv", "too_few_fields", "2,two"), ("a.csv", "too_many_fields", "3,three,30,more,still"), ("a.csv", "too_many_fields", '7,"se""ven",70,'), ("b.csv", "too_few_fields", "9")}
    assert found == want | ({("a.csv", "unclosed_quote", '4,"four,40')} if multi_line is False else set())
    good, bad = files.read_csv_checked(spark, str(tmp_path), contract, multi_line, strict=True)
    assert {(r.reason, r.record) for r in bad.where("reason like 'bad%'").collect()} == {("bad_value:size", '{"id":"6","name":"six","size":"many"}')}
    assert good.count() == 3
    assert files.read_csv(spark, str(tmp_path), contract, multi_line).count() == len(lines) - 2 + 2


def test_line_breaks_in_quotes_are_seen(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n1,"x ""y"" z"\n2,w\n')
    assert not files.breaks_in_quotes(spark, str(tmp_path / "plain.csv"))
    (tmp_path / "broken.csv").write_text('a,b\n1,"x\ny"\n')
    assert files.breaks_in_quotes(spark, str(tmp_path / "broken.csv"))
    assert rows(files.read_csv(spark, str(tmp_path / "broken.csv"), StructType.fromDDL("a int, b string"))) == [(1, "x\ny")]
    big = tmp_path / "big.csv"
    big.write_text("a,b\n" + "".join(f"{k},text {k}\n" for k in range(300_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = files.read_csv(spark, str(big), StructType.fromDDL("a int, b string"))
        assert df.rdd.getNumPartitions() > 3 and df.count() == 300_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_feed_leaves_its_broken_rows_aside(spark, schema, tmp_path):
    path = tmp_path / "calendar.csv"
    path.write_text("date,available,price,adjusted_price,minimum_nights,maximum_nights\n2025-01-01,t,$5,$5,1,2\n2025-01-02,t\n")
    listings.load_feed(spark, str(path), contracts.CALENDAR, f"{schema}.calendar", "Athens", AT)
    assert spark.table(f"{schema}.calendar").count() == 1
    [bad] = spark.table(f"{schema}.calendar_quarantine").collect()
    assert (bad.reason, bad.record, bad.area) == ("too_few_fields", "2025-01-02,t", "Athens") and bad.file.endswith("calendar.csv")
