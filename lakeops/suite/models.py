"""Linear models over silver trips."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from lakeops.operators import regression as reg
from lakeops.operators.sample import with_split
from lakeops.plans.trips import FEATURES, LABEL, PICKUP
from lakeops.suite import standins
from lakeops.suite.registry import bucket, query
from lakeops.suite.standins import with_ctes

KEY = ["VendorID", PICKUP, "PULocationID", "DOLocationID"]
SILVER = with_ctes("silver")
# made-up coefficients, one per feature, to compare scoring by value
COEFS, INTERCEPT = (12.5, -3.25, 1500.75, 8.5, -0.125, 0.375, 0.001), 250.5
KEY_TEXT = "concat_ws('||', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '∅')" for k in KEY) + ")"
SPLIT = f"""{SILVER}, parts AS (SELECT *, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END
  AS split FROM (SELECT *, {bucket(KEY_TEXT)} % 100 AS b FROM silver))"""
PREDICTION = " + ".join([f"{INTERCEPT}e0", *[f"CAST({c} AS DOUBLE) * {w}e0" for w, c in zip(COEFS, FEATURES)]])


def _tagged(spark, sf):
    """Silver trips ready for training, each row in one part of the split."""
    tagged = with_split(standins.silver_trips(spark, sf), KEY)
    return reg.training_rows(tagged.select(*FEATURES, LABEL, "split"), FEATURES, LABEL)


@query(
    f"""{SILVER} SELECT round(regr_slope(fare_amount, trip_distance), 6) AS slope,
    round(regr_intercept(fare_amount, trip_distance), 4) AS intercept FROM silver"""
)
def linear_fit_1d(spark, sf):
    fit = reg.simple_fit(standins.silver_trips(spark, sf), "trip_distance", LABEL)
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    f"""{SPLIT}, fit AS (SELECT regr_slope(fare_amount, trip_distance) AS a,
      regr_intercept(fare_amount, trip_distance) AS b FROM parts WHERE split = 'train'),
    errors AS (SELECT a * trip_distance + fit.b - fare_amount AS e FROM parts, fit WHERE split = 'test')
    SELECT count(*) AS rows, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae FROM errors"""
)
def linear_metrics_1d(spark, sf):
    tagged = with_split(standins.silver_trips(spark, sf), KEY)
    train, test = (tagged.where(F.col("split") == s) for s in ("train", "test"))
    fit = reg.simple_fit(train, "trip_distance", LABEL)
    slope, intercept = (fit.select(c).scalar() for c in ("slope", "intercept"))
    scored = test.select(LABEL, (slope * F.col("trip_distance") + intercept).alias("prediction"))
    return reg.evaluate(scored, LABEL).select(
        "rows", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae")
    )


def _least_squares_sql() -> str:
    """The error of a fit on all features, one feature at a time: what a feature explains in the later
    ones and in the label (slopes on the fitted rows) is taken out, until only the label's error is left."""
    names = [*[f"x{i}" for i in range(len(FEATURES))], "y"]
    columns = [f"CAST({c} AS DOUBLE) AS {n}" for n, c in zip(names, (*FEATURES, LABEL))]
    steps = [f"r0 AS (SELECT split, {', '.join(columns)} FROM parts WHERE {' AND '.join(f'{c} IS NOT NULL' for c in (*FEATURES, LABEL))})"]
    for i, x in enumerate(names[:-1]):
        rest = names[i + 1 :]
        fitted = ", ".join(f"regr_slope({n}, {x}) AS s_{n}, avg({n}) AS m_{n}" for n in rest)
        steps.append(f"f{i} AS (SELECT avg({x}) AS m, {fitted} FROM r{i} WHERE split <> 'test')")
        left = ", ".join(f"{n} - m_{n} - coalesce(s_{n}, 0e0) * ({x} - m) AS {n}" for n in rest)
        steps.append(f"r{i + 1} AS (SELECT split, {left} FROM r{i}, f{i})")
    return f"""{SPLIT}, {", ".join(steps)}
    SELECT count(*) AS rows, round(sqrt(avg(y * y)), 6) AS rmse, round(avg(abs(y)), 6) AS mae
    FROM r{len(FEATURES)} WHERE split = 'test'"""


@query(_least_squares_sql())
def fare_model(spark, sf):
    """Fit on train and validation rows, error on the test rows."""
    tagged = _tagged(spark, sf)
    model = reg.fit_linear(tagged.where("split <> 'test'"), FEATURES, LABEL)
    test = tagged.where("split = 'test'")
    found = reg.evaluate(test.withColumn("prediction", reg.model_expr(model, FEATURES)), LABEL)
    return found.select("rows", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query()
def param_search(spark, sf):
    return reg.search(_tagged(spark, sf), FEATURES, LABEL)


@query(f"{SILVER} SELECT {', '.join(KEY)}, round({PREDICTION}, 6) AS prediction FROM silver")
def score_linear(spark, sf):
    prediction = F.round(reg.score_expr(COEFS, INTERCEPT, FEATURES), 6)
    return standins.silver_trips(spark, sf).select(*KEY, prediction.alias("prediction"))


@query(f"{SILVER} SELECT {', '.join(FEATURES)}, round({PREDICTION}, 6) AS prediction FROM silver")
def score_opaque(spark, sf):
    """The same model as in ``score_linear``, known to Spark as a Python function only."""

    def predict(batch):
        return batch.astype(float).to_numpy() @ np.array(COEFS) + INTERCEPT

    scored = reg.score_opaque(standins.silver_trips(spark, sf).select(*FEATURES), predict, FEATURES)
    return scored.withColumn("prediction", F.round("prediction", 6))


@query(
    f"""{SILVER} SELECT {", ".join(FEATURES)}, {PICKUP}, round({PREDICTION}, 6) AS prediction,
      CAST((SELECT max({PICKUP}) FROM silver) AS VARCHAR) AS window_end FROM silver
    WHERE {PICKUP} >= (SELECT max({PICKUP}) FROM silver) - INTERVAL 30 DAY
      AND {PICKUP} < (SELECT max({PICKUP}) FROM silver)"""
)
def score_last_day(spark, sf):
    prediction = F.round(reg.score_expr(COEFS, INTERCEPT, FEATURES), 6)
    return reg.score_window(standins.silver_trips(spark, sf), prediction, PICKUP, FEATURES, "30 days")


@query(
    f"""{SILVER}, binned AS (SELECT least(CAST(floor((least(greatest({PREDICTION} - fare_amount, -50000e0), 50000e0)
      - -50000e0) / 1250e0) AS BIGINT), 79) AS bin FROM silver)
    SELECT bin, count(*) AS cnt, -50000e0 + bin * 1250e0 AS bin_start FROM binned GROUP BY bin"""
)
def residual_histogram(spark, sf):
    """Wider than the default range, as the stand-in fares run to tens of thousands."""
    prediction = reg.score_expr(COEFS, INTERCEPT, FEATURES)
    scored = standins.silver_trips(spark, sf).withColumn("prediction", prediction)
    return reg.residual_histogram(reg.residuals(scored, LABEL), limit=50000)
