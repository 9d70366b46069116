"""Report tables of the two cities."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import aggregate, occupancy, profile
from lakeops.operators.combine import union_all
from lakeops.operators.recommend import recommend
from lakeops.plans import city as plan
from lakeops.sources.tables import read_parquet
from lakeops.suite import standins
from lakeops.suite.registry import avg2, query
from lakeops.suite.standins import rank_fits, with_ctes

CITIES = ["Berlin", "Stock"]
PRICED = with_ctes("priced")
METRICS = """SELECT city, count(DISTINCT id) AS listing_count, count(DISTINCT host_id) AS host_count,
  median(price_num) AS median_price, round(avg(price_num), 6) AS avg_price,
  round(avg(occ_rate_365), 9) AS avg_occ_365, round(avg(review_scores_rating), 9) AS avg_review_score
  FROM priced GROUP BY 1"""
PRICE_HIST = """SELECT city, round(price_num) AS price_bucket, count(*) AS cnt FROM priced
  WHERE price_num BETWEEN 5 AND 2000 GROUP BY 1, 2"""
NEIGHBOURHOODS = """SELECT city, neighbourhood_cleansed AS neighbourhood, count(*) AS listing_cnt,
  avg(price_num) AS avg_price, avg(occ_rate_365) AS avg_occ_365, avg(latitude) AS lat,
  avg(longitude) AS lon FROM priced WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1, 2"""
ROUNDED = {"avg_price": 6, "avg_occ_365": 9, "avg_review_score": 9}


def _rounded(df, digits: dict[str, int]):
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _months(spark, sf):
    return occupancy.occupancy_by_month(occupancy.typed_calendar(standins.calendar(spark, sf)))


@query(f"{PRICED} {METRICS}")
def city_metrics(spark, sf):
    priced = standins.priced(spark, sf)
    return _rounded(plan.city_metrics(priced, priced, exact=True), ROUNDED)


@query(
    f"""{PRICED} SELECT city, count(DISTINCT id) AS listing_count, count(DISTINCT host_id) AS host_count,
  true AS median_fits, round(avg(price_num), 6) AS avg_price, round(avg(occ_rate_365), 9) AS avg_occ_365,
  round(avg(review_scores_rating), 9) AS avg_review_score FROM priced GROUP BY 1"""
)
def city_metrics_approx(spark, sf):
    """The metrics, and whether the sketched median has a rank within the sketch's error."""
    priced = standins.priced(spark, sf)
    found = plan.city_metrics(priced, priced)
    fits = priced.join(found.select("city", "median_price"), "city").groupBy("city").agg(
        rank_fits("price_num", "median_price", 0.5).alias("median_fits")
    )
    return _rounded(found.drop("median_price").join(fits, "city"), ROUNDED)


@query(f"{with_ctes('months')} SELECT city, month, round(occ_rate_month, 9) AS occ_rate_month FROM months")
def occupancy_by_month(spark, sf):
    return _rounded(_months(spark, sf), {"occ_rate_month": 9})


@query(
    f"""{with_ctes("calendar")} SELECT city, round(avg(1 - CASE available WHEN 't' THEN 1 WHEN 'f' THEN 0 END), 9)
    AS avg_occupancy FROM calendar GROUP BY 1"""
)
def occupancy_overall(spark, sf):
    return _rounded(occupancy.occupancy_overall(standins.calendar(spark, sf)), {"avg_occupancy": 9})


STATS = ("occ_month_avg", "occ_month_median", "occ_p10", "occ_p90")


@query(
    f"""{with_ctes("priced", "months")}, stats AS (SELECT city, round(avg(occ_rate_month), 9) AS occ_month_avg,
      round(median(occ_rate_month), 9) AS occ_month_median,
      round(quantile_cont(occ_rate_month, 0.1), 9) AS occ_p10,
      round(quantile_cont(occ_rate_month, 0.9), 9) AS occ_p90 FROM months GROUP BY 1)
    SELECT * FROM ({METRICS}) LEFT JOIN stats USING (city)"""
)
def city_clean_summary(spark, sf):
    priced = standins.priced(spark, sf)
    report = plan.build_report(priced, priced, standins.calendar(spark, sf), CITIES, exact=True)
    return _rounded(report["clean_summary"], ROUNDED | dict.fromkeys(STATS, 9))


@query(
    f"""{PRICED} SELECT city, neighbourhood, listing_cnt, round(avg_price, 6) AS avg_price,
    round(avg_occ_365, 9) AS avg_occ_365, round(lat, 9) AS lat, round(lon, 9) AS lon FROM ({NEIGHBOURHOODS})"""
)
def neighbourhood_metrics(spark, sf):
    found = plan.neighbourhood_metrics(standins.priced(spark, sf))
    return _rounded(found, {"avg_price": 6, "avg_occ_365": 9, "lat": 9, "lon": 9})


@query(f"{PRICED} {PRICE_HIST}")
def price_histogram(spark, sf):
    return aggregate.price_histogram(standins.priced(spark, sf))


@query(
    f"""{PRICED} SELECT price_bucket, CAST(coalesce(sum(CASE WHEN city = 'Berlin' THEN cnt END), 0) AS BIGINT)
      AS "Berlin", CAST(coalesce(sum(CASE WHEN city = 'Stock' THEN cnt END), 0) AS BIGINT) AS "Stock"
    FROM ({PRICE_HIST}) GROUP BY 1"""
)
def price_hist_pivot(spark, sf):
    hist = aggregate.price_histogram(standins.priced(spark, sf))
    return aggregate.pivot_counts(hist, "price_bucket", "city", CITIES)


@query(
    f"""{with_ctes("months")} SELECT month, round(max(CASE WHEN city = 'Berlin' THEN occ_rate_month END), 9)
      AS "Berlin", round(max(CASE WHEN city = 'Stock' THEN occ_rate_month END), 9) AS "Stock"
    FROM months GROUP BY 1"""
)
def occupancy_pivot(spark, sf):
    """Gaps stay null here: a month without rows has no occupancy, not an occupancy of zero."""
    wide = aggregate.pivot_counts(_months(spark, sf), "month", "city", CITIES, "occ_rate_month", fill=None)
    return _rounded(wide, dict.fromkeys(CITIES, 9))


@query(
    f"""{PRICED} SELECT city, CAST(floor(review_scores_rating / 5e0) AS BIGINT) * 5 AS rating_bin,
    count(*) AS cnt FROM priced WHERE review_scores_rating IS NOT NULL GROUP BY 1, 2"""
)
def rating_histogram(spark, sf):
    return aggregate.rating_histogram(standins.priced(spark, sf))


@query(
    f"""{PRICED}, shares AS (SELECT city, room_type, cnt / sum(cnt) OVER (PARTITION BY city) AS share
      FROM (SELECT city, room_type, count(*) AS cnt FROM priced GROUP BY 1, 2))
    SELECT room_type, round(coalesce(sum(CASE WHEN city = 'Berlin' THEN share END), 0e0), 9) AS "Berlin",
      round(coalesce(sum(CASE WHEN city = 'Stock' THEN share END), 0e0), 9) AS "Stock" FROM shares GROUP BY 1"""
)
def room_share_pivot(spark, sf):
    return _rounded(plan.room_share_pivot(standins.priced(spark, sf), CITIES), dict.fromkeys(CITIES, 9))


@query(
    f"""{PRICED} SELECT CAST(floor(review_scores_rating / 5e0) AS BIGINT) * 5 AS rating_bin,
      count(CASE WHEN city = 'Berlin' THEN 1 END) AS "Berlin", count(CASE WHEN city = 'Stock' THEN 1 END) AS "Stock"
    FROM priced WHERE review_scores_rating IS NOT NULL GROUP BY 1"""
)
def rating_pivot(spark, sf):
    return plan.rating_pivot(standins.priced(spark, sf), CITIES)


@query(
    f"""{PRICED} SELECT city, room_type, cnt, cnt / sum(cnt) OVER (PARTITION BY city) AS share
    FROM (SELECT city, room_type, count(*) AS cnt FROM priced GROUP BY 1, 2)"""
)
def room_type_share(spark, sf):
    return plan.room_type_share(standins.priced(spark, sf))


def _cross(berlin: str) -> str:
    return f"FROM priced WHERE is_berlin = {berlin}"


@query(
    f"""{PRICED} SELECT (SELECT {avg2("price_num")} {_cross("true")}) AS berlin_avg_price,
    (SELECT {avg2("price_num")} {_cross("false")}) AS stockholm_avg_price,
    (SELECT {avg2("number_of_reviews")} {_cross("true")}) AS berlin_avg_reviews,
    (SELECT {avg2("number_of_reviews")} {_cross("false")}) AS stockholm_avg_reviews,
    (SELECT count(DISTINCT id) {_cross("true")}) AS berlin_listings,
    (SELECT count(DISTINCT id) {_cross("false")}) AS stockholm_listings"""
)
def cross_city_comparison(spark, sf):
    return plan.cross_city(standins.priced(spark, sf))


@query(
    f"""{PRICED} SELECT city, count(*) AS total_listings, {avg2("price_num")} AS avg_price,
    round(avg(occ_rate_365), 9) AS occupancy_rate FROM priced GROUP BY 1"""
)
def city_summary(spark, sf):
    return _rounded(plan.city_summary(standins.priced(spark, sf)), {"occupancy_rate": 9})


@query(
    f"""{with_ctes("priced", "days")}
    SELECT city, 'listing' AS dataset, count(*) AS rows, CAST(NULL AS DATE) AS min_date,
      CAST(NULL AS DATE) AS max_date FROM priced GROUP BY 1
    UNION ALL SELECT city, 'detailed_listing', count(*), min(try_cast(last_scraped AS DATE)),
      max(try_cast(last_scraped AS DATE)) FROM priced GROUP BY 1
    UNION ALL SELECT city, 'calendar', count(*), min(date), max(date) FROM days GROUP BY 1"""
)
def dataset_coverage(spark, sf):
    priced, days = standins.priced(spark, sf), occupancy.typed_calendar(standins.calendar(spark, sf))
    return union_all(
        [
            profile.coverage("listing", priced),
            profile.coverage("detailed_listing", plan.prepare_detailed(priced), "last_scraped"),
            profile.coverage("calendar", days, "date"),
        ]
    )


def _missing(name: str, columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS column, count(*) AS total_rows,
        count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) * 100 / count(*), 2) AS missing_percent FROM ({table})"""
        for c in columns
    )


NB_COLUMNS = ["city", "neighbourhood", "listing_cnt", "avg_price", "avg_occ_365", "lat", "lon"]


@query(
    with_ctes("priced", "months")
    + " UNION ALL ".join(
        [
            _missing("neighbourhood_metrics", NB_COLUMNS, NEIGHBOURHOODS),
            _missing("price_hist", ["city", "price_bucket", "cnt"], PRICE_HIST),
            _missing("occ_by_month", ["city", "month", "occ_rate_month"], "SELECT * FROM months"),
        ]
    )
)
def missing_reports(spark, sf):
    priced = standins.priced(spark, sf)
    return plan.build_report(priced, priced, standins.calendar(spark, sf), CITIES)["missing"]


EACH_CITY = " UNION ALL ".join(f"SELECT '{c}' AS city" for c in CITIES)


def _for_each(dataset: str, text: str) -> str:
    return f"SELECT city, '{dataset}' AS dataset, '{text}' AS recommendation FROM ({EACH_CITY})"


@query(
    f"""{PRICED}, patchy AS (SELECT CASE WHEN listing_cnt % 2 = 0 THEN avg_price END AS avg_price FROM ({NEIGHBOURHOODS}))
    {_for_each("price_hist", "few or no price bins: check the price texts and the price range")}
    UNION ALL {_for_each("neighbourhood_metrics", "no neighbourhoods: check the neighbourhood and location columns")}
    UNION ALL {_for_each("occ_by_month", "no monthly occupancy: check the calendar dates and t/f flags")}
    UNION ALL SELECT 'all', 'neighbourhood_metrics', concat('avg_price: ',
      CAST(round((count(*) - count(avg_price)) * 100 / count(*), 1) AS VARCHAR), '% null, filter or impute before mapping')
    FROM patchy HAVING (count(*) - count(avg_price)) * 100 / count(*) > 20
    UNION ALL SELECT event_type, 'occ_by_month', concat('short history (',
      CAST(count(DISTINCT date_trunc('month', ts)) AS VARCHAR),
      ' months): seasonality is weak, add data or group by quarter')
    FROM events GROUP BY 1 HAVING count(DISTINCT date_trunc('month', ts)) < 6"""
)
def recommendations(spark, sf):
    """All five rules: three on a report without listings or days, and two on one with gaps in a metric
    and the months of the events, a group per event type with a short history."""
    priced = standins.priced(spark, sf)
    bins, areas = aggregate.price_histogram(priced), plan.neighbourhood_metrics(priced)
    days = read_parquet(spark, sf, "events").select(
        F.col("event_type").alias("city"), F.to_date("ts").alias("date"), F.lit(True).alias("available")
    )
    months = occupancy.occupancy_by_month(days)
    patchy = areas.withColumn("avg_price", F.when(F.col("listing_cnt") % 2 == 0, F.col("avg_price")))
    few = bins.where("price_bucket < 0")
    return recommend(few, areas.where("listing_cnt < 0"), months.where("city is null"), CITIES).union(
        recommend(bins, patchy, months, CITIES)
    )
