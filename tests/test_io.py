import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.operators.keys import STAR_FOREIGN
from lakeops.params import Params, city_prefix
from lakeops.plans import city, layers, listings, star, trips
from lakeops.session import scratch_path
from lakeops.sources import contracts, files, sinks, tables

AT = dt.datetime(2025, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_contracts_have_the_expected_width():
    assert [len(c) for c in (contracts.LISTING, contracts.CALENDAR, contracts.AGG_LISTING)] == [74, 6, 17]
    full = contracts.with_metadata_fields(contracts.CALENDAR)
    assert full.names[-2:] == ["processing_datetime", "area"] and len(contracts.CALENDAR) == 6


def test_contract_round_trip(spark, tmp_path):
    path = str(tmp_path / "contract")
    contracts.save_contract(spark, contracts.LISTING, path)
    assert contracts.load_contract(spark, path) == contracts.LISTING


def test_contract_diff(spark):
    want = StructType.fromDDL("a int, b string, c date")
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, x int")
    assert rows(contracts.contract_diff(df, want)) == [
        ("b", "mistyped", "string", "int"), ("c", "missing", "date", None), ("x", "extra", None, "int"),
    ]
    with pytest.raises(ValueError):
        contracts.conform(df, want)


FEED = 'id,price,minimum_nights,date,available,note\n1,"$1,200.00",2,2025-01-01,t,"two\nlines ""quoted"""\n2,$5.00,many,2025-01-02,f,x\n'


def test_csv_is_matched_by_name_and_bad_values_are_null(spark, tmp_path):
    path = tmp_path / "feed.csv.gz"
    path.write_bytes(gzip.compress(FEED.encode()))
    contract = StructType.fromDDL("note string, id bigint, minimum_nights bigint, adjusted_price string")
    assert rows(files.read_csv(spark, str(path), contract)) == [
        ('two\nlines "quoted"', 1, 2, None), ("x", 2, None, None),
    ]


def test_feed_is_appended_with_load_columns(spark, tmp_path, schema):
    path = tmp_path / "calendar.csv"
    path.write_text(FEED)
    for _ in range(2):
        listings.load_feed(spark, str(path), contracts.CALENDAR, f"{schema}.calendar", "Athens", AT)
    got = spark.table(f"{schema}.calendar")
    assert got.schema.names == contracts.with_metadata_fields(contracts.CALENDAR).names
    assert got.count() == 4 and {r.area for r in got.collect()} == {"Athens"}


def test_geojson(spark, tmp_path):
    feature = lambda n, x: {
        "type": "Feature", "properties": {"neighbourhood": n},
        "geometry": {"type": "Point", "coordinates": [x, 1.5]},
    }
    path = tmp_path / "g.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature("a", 1.0), feature("b", 2.0)]}, indent=1))
    got = files.read_geojson(spark, str(path))
    assert rows(got) == [("Point", "[1.0,1.5]", "a"), ("Point", "[2.0,1.5]", "b")]


def test_file_sizes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 3 * 1024 * 1024)
    (tmp_path / "b.bin").write_bytes(b"x" * 10)
    got = {r.name: (r.bytes, r.size_mb) for r in tables.file_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.bin": (3145728, 3), "b.bin": (10, 0), "Total size": (3145738, 3)}


def test_tables_like_and_read_first(spark, schema):
    for name in ("berlin_listing", "berlin_review", "stock_listing"):
        sinks.write_table(spark.range(1), f"{schema}.{name}")
    assert tables.tables_like(spark, schema, "berlin") == ["berlin_listing", "berlin_review"]
    found = tables.read_first(spark, [f"{schema}.berlin_reviews", f"{schema}.berlin_review"])
    assert found.count() == 1 and tables.read_first(spark, [f"{schema}.none"]) is None
    assert tables.read(spark, f"{schema}.stock_listing").count() == 1


def test_write_replaces_and_append_follows_names(spark, schema):
    name = f"{schema}.t"
    sinks.write_table(spark.createDataFrame([(1, "a")], "i int, s string"), name)
    sinks.write_table(spark.createDataFrame([(2, "b")], "i int, s string"), name)
    sinks.append(spark.createDataFrame([("c", 3)], "s string, i int"), name)
    assert rows(spark.table(name)) == [(2, "b"), (3, "c")]
    with pytest.raises(ValueError):
        sinks.append(spark.createDataFrame([("c",)], "s string"), name)


def test_append_evolving_adds_columns(spark, schema):
    name = f"{schema}.e"
    sinks.append_evolving(spark.createDataFrame([(1,)], "i int"), name)
    sinks.append_evolving(spark.createDataFrame([(2.5, 2)], "p double, i int"), name)
    sinks.append_evolving(spark.createDataFrame([(3,)], "i int"), name)
    assert rows(spark.table(name)) == [(1, None), (2, 2.5), (3, None)]


def test_ensure_is_idempotent(spark, schema):
    for _ in range(2):
        sinks.ensure_schema(spark, schema)
        sinks.ensure_table(spark, f"{schema}.n", StructType.fromDDL("a int"))
    assert spark.table(f"{schema}.n").columns == ["a"]


def test_source_tables_are_not_dropped(spark, schema):
    sinks.write_table(spark.range(1), f"{schema}.x")
    with pytest.raises(ValueError):
        sinks.drop_tables(spark, [f"{schema}.x", "raw.trips"])
    with pytest.raises(ValueError):
        sinks.drop_tables(spark, [f"{schema}.x", f"{schema}.trips_raw"])
    assert spark.catalog.tableExists(f"{schema}.x")
    sinks.drop_tables(spark, [f"{schema}.x", f"{schema}.never"])
    assert not spark.catalog.tableExists(f"{schema}.x")


def test_repeated_partition_writes_do_not_add_rows(spark, tmp_path):
    path = str(tmp_path / "scores")
    day = lambda d: spark.createDataFrame([(d, 1.0), (d, 2.0)], "window_end string, p double")
    for batch in (day("a"), day("b"), day("a"), day("c").limit(0)):
        sinks.replace_partitions(batch, path, ["window_end"])
    assert {r.window_end: r["count"] for r in spark.read.parquet(path).groupBy("window_end").count().collect()} == {
        "a": 2, "b": 2,
    }


def test_views(spark):
    sinks.as_view(spark.range(2), "two_rows")
    assert spark.table("two_rows").count() == 2
    spark.catalog.dropTempView("two_rows")


def test_params_and_prefixes():
    p = Params("main", "gold", " Stock, ,Berlin ")
    assert p.cities == ["Stock", "Berlin"] and p.city_table("Stock", "listing") == "main.gold.stock_listing"
    assert city_prefix("stockholm") == "stock" and city_prefix("Stock") == "stock"
    assert city_prefix(" Athens") == "athens" and Params().city_table("Athens", "calendar") == "gold.athens_calendar"
    with pytest.raises(ValueError):
        city_prefix("no such; table")


def test_scratch_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path.startswith((base or spark.conf.get("spark.checkpoint.dir")).rstrip("/"))
    assert path != scratch_path(spark, "x")


@pytest.fixture
def databases(spark, request):
    """Databases by layer, gone after the test."""
    tag = abs(hash(request.node.nodeid)) % 10**9
    names = {layer: f"{layer}_{tag}" for layer in ("src", "bronze", "silver", "gold", "monitoring")}
    spark.sql(f"CREATE DATABASE {names['src']}")
    yield names
    for name in names.values():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_star_layers(spark, databases):
    from conftest import SF

    db = databases
    for t in ("customer", "orders", "lineitem", "supplier", "part", "nation", "region"):
        sinks.write_table(tables.read_parquet(spark, SF, t), f"{db['src']}.{t}")
    assert len(star.to_bronze(spark, db["src"], db["bronze"])) == 7
    star.to_silver(spark, db["bronze"], db["silver"])
    assert spark.table(f"{db['silver']}.orders").columns[:2] == ["order_id", "customer_id"]
    for _ in range(2):
        star.log_counts(spark, db["bronze"], db["silver"], db["monitoring"], AT)
    log = spark.table(f"{db['monitoring']}.data_quality_log")
    assert log.count() == 14 and {r.status for r in log.collect()} == {"OK"}
    primary, foreign = star.check_keys(spark, db["silver"])
    assert primary.agg(F.sum(F.expr("null_rows + duplicate_keys"))).first()[0] == 0
    assert foreign.count() == len(STAR_FOREIGN)
    assert {(r.child, r.key_column) for r in foreign.where("orphan_rows is null").collect()} == {
        ("partsupp", "ps_partkey"), ("partsupp", "ps_suppkey")
    }
    assert foreign.agg(F.sum("orphan_rows")).first()[0] == 0
    spark.sql(f"DROP TABLE {db['silver']}.region")
    star.log_counts(spark, db["bronze"], db["silver"], db["monitoring"], AT)
    late = spark.table(f"{db['monitoring']}.data_quality_log").where("status <> 'OK'").collect()
    assert [(r.table_name, r.status, r.silver_count, r["diff"]) for r in late] == [("region", "MISSING", None, None)]


def test_city_layers_and_report(spark, databases):
    from conftest import SF

    from lakeops.suite import standins

    db = databases
    listing, calendar = standins.listings(spark, SF), standins.calendar(spark, SF)
    for name, prefix in (("Berlin", "berlin"), ("Stock", "stock")):
        mine = listing.where(F.col("city") == name).drop("city")
        sinks.write_table(mine.unionByName(mine.limit(5)), f"{db['src']}.{prefix}_listing")
        sinks.write_table(mine, f"{db['src']}.{prefix}_detailed_listing")
        sinks.write_table(calendar.where(F.col("city") == name).drop("city"), f"{db['src']}.{prefix}_calendar")
        review = "berlin_reviews" if prefix == "berlin" else "stock_review"
        sinks.write_table(spark.createDataFrame([(1,), (None,)], "listing_id long"), f"{db['src']}.{review}")
        for cityname in (name.lower(),):
            city.city_to_bronze(spark, db["src"], db["bronze"], cityname, AT)
            city.city_to_silver(spark, db["bronze"], db["silver"], cityname)
            city.city_to_gold(spark, db["silver"], db["gold"], cityname)
    params = Params(schema=db["gold"])
    assert city.reviews(spark, params).count() == 2
    assert spark.table(f"{db['gold']}.berlin_listing").count() == listing.where("city = 'Berlin'").count()
    report = city.city_report(spark, params)
    summary = {r.city: r.listing_count for r in report["clean_summary"].collect()}
    assert summary == {"Berlin": 7440, "Stock": 7560}
    assert report["datasets"].count() == 6 and report["room_share"].count() == 10
    shares = report["room_share"].groupBy("city").agg(F.sum("share").alias("s"))
    assert {r.city: r.s for r in shares.collect()} == pytest.approx({"Berlin": 1, "Stock": 1})
    stored = city.store_report(spark, params, db["monitoring"])
    assert len(stored) == len(report) == 10
    for name, df in report.items():
        assert spark.table(f"{db['monitoring']}.{name}").count() == df.count(), name
    assert report["recommendations"].count() == 0
    primary, foreign = city.check_keys(spark, [db["silver"], db["gold"]], ["berlin", "stock"])
    assert primary.where("null_rows is not null").count() == 8 and primary.agg(F.sum("duplicate_keys")).first()[0] == 0
    seen = foreign.where("orphan_rows is not null")
    assert {r.child for r in seen.collect()} == {"berlin_calendar", "stock_calendar", "berlin_reviews", "stock_review"}
    assert foreign.count() == 16 and foreign.where("child = 'stock_reviews' and orphan_rows is null").count() == 2
    none = city.check_keys(spark, [db["src"] + "_no"], ["berlin"])
    assert none[0].where("null_rows is null").count() == 3


def test_report_without_a_calendar(spark, schema):
    from conftest import SF

    from lakeops.suite import standins

    mine = standins.listings(spark, SF).where("city = 'Berlin'").drop("city")
    sinks.write_table(mine, f"{schema}.athens_listing")
    sinks.write_table(mine, f"{schema}.athens_detailed_listing")
    params = Params(schema=schema, cities_csv="Athens,Berlin")
    report = city.city_report(spark, params)
    assert set(report) == {"price_hist", "rating_hist", "city_metrics", "neighbourhood_metrics", "room_share", "datasets", "missing"}
    assert [r.city for r in report["city_metrics"].collect()] == ["Athens"]
    assert {r.dataset for r in report["datasets"].collect()} == {"listing", "detailed_listing"}
    assert city.city_report(spark, Params(schema=schema, cities_csv="Nowhere")) == {}


def test_append_goes_by_name_whatever_the_order(spark, schema):
    contract = StructType([StructField("city", StringType()), StructField("name", StringType())])
    name = f"{schema}.people"
    sinks.write_table(spark.createDataFrame([("n1", "c1")], "name string, city string"), name)
    row = spark.createDataFrame([("c2", "n2")], "city string, name string")
    sinks.append(row, name, contract)
    sinks.append(row, name)
    assert sorted((r.name, r.city) for r in spark.table(name).collect()) == [("n1", "c1"), ("n2", "c2"), ("n2", "c2")]
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (age int)")
    sinks.append(row, name, contract)
    assert spark.table(name).where("name = 'n2' and city = 'c2' and age is null").count() == 3
    parts = f"{schema}.parts"
    sinks.write_table(spark.createDataFrame([("x", "y")], "a string, b string"), parts, partition_by=["a"])
    sinks.append(spark.createDataFrame([("x2", "y2")], "a string, b string"), parts)
    assert sorted((r.a, r.b) for r in spark.table(parts).collect()) == [("x", "y"), ("x2", "y2")]
    with pytest.raises(ValueError):
        sinks.append(row.withColumn("zip", F.lit(1)), name, contract)
    with pytest.raises(ValueError):
        sinks.append(row.withColumn("zip", F.lit("1")), name, StructType([*contract.fields, StructField("zip", StringType())]))


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_files_with_other_headers_are_refused(spark, tmp_path, multi_line):
    contract = StructType([StructField("name", StringType()), StructField("city", StringType())])
    (tmp_path / "a.csv").write_text("name,city\nn1,c1\n")
    got = files.read_csv(spark, str(tmp_path), contract, multi_line).collect()
    assert [(r.name, r.city) for r in got] == [("n1", "c1")]
    (tmp_path / "b.csv").write_text("city,name\nc2,n2\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path), contract, multi_line).collect()


def test_trip_layers(spark, databases):
    from conftest import SF

    from lakeops.suite import standins

    db = databases["src"]
    trips.trips_pipeline(spark, standins.trips(spark, SF), db, AT)
    count = {t: spark.table(f"{db}.trips_{t}").count() for t in ("raw", "silver", "quarantine", "gold")}
    assert count["silver"] + count["quarantine"] == count["raw"] == 60000 and count["gold"] == 2328


def test_layers_never_read_the_table_they_replace(spark, schema):
    sinks.write_table(spark.range(1), f"{schema}.t")
    with pytest.raises(Exception):
        layers.copy_tables(spark, schema, schema, ["t"])
