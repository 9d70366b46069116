import datetime as dt

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from lakeops.operators import regression as reg
from lakeops.operators.geo import geo_grid, geo_points
from lakeops.operators.quantiles import approx_quantiles, exact_quantiles
from lakeops.operators.sample import latest, sample_k, split, with_split
from lakeops.plans.trips import FEATURES, LABEL, PICKUP
from lakeops.sources.sinks import replace_partitions
from lakeops.suite import models


@pytest.fixture(scope="module")
def tagged(spark):
    return models._tagged(spark, SF).persist()


def arrays(df):
    data = df.select(*FEATURES, LABEL).toPandas().to_numpy()
    return data[:, :-1], data[:, -1]


def test_fit_equals_least_squares(spark, tagged):
    x, y = arrays(tagged)
    solved = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)[0]
    stage = reg.linear_stage(reg.fit_linear(tagged, FEATURES, LABEL))
    assert np.allclose(stage.coefficients.toArray(), solved[1:], rtol=1e-6)
    assert stage.intercept == pytest.approx(solved[0], rel=1e-6)


def test_fit_equals_mllib_on_the_rows(tagged):
    for params in ({}, {"regParam": 5.0}, {"regParam": 900.0, "elasticNetParam": 1.0}):
        ours, full = reg.linear_stage(reg.fit_linear(tagged, FEATURES, LABEL, **params)), mllib_fit(tagged, **params)
        assert np.allclose(full.coefficients.toArray(), ours.coefficients.toArray(), rtol=1e-6, atol=1e-6)
        assert full.intercept == pytest.approx(ours.intercept, rel=1e-6)


def test_moments_equal_numpy(tagged):
    m = reg.moments(tagged, [*FEATURES, LABEL], "split", ("val",))["val"]
    x, y = arrays(tagged.where("split = 'val'"))
    data = np.c_[x, y]
    assert m.rows == len(data)
    assert np.allclose(m.mean, data.mean(axis=0)) and np.allclose(m.cov, np.cov(data.T, bias=True))


def mllib_fit(df, **params):
    """MLlib on the rows themselves."""
    from pyspark.ml.regression import LinearRegression

    lr = LinearRegression(featuresCol="features", labelCol=LABEL, **params)
    return lr.fit(reg.assemble(df, FEATURES))


def test_moments_keep_their_digits_far_from_zero(spark):
    far = spark.range(20000).select((F.lit(1e9) + F.rand(1)).alias("a"), (F.lit(-1e8) + F.randn(2)).alias("b")).persist()
    data = far.toPandas().to_numpy()
    m = reg.moments(far, ["a", "b"])[None]
    centred = data - data.mean(axis=0)
    assert np.allclose(m.cov, centred.T @ centred / len(data), rtol=1e-6, atol=1e-6)


def test_condensed_rows_give_the_same_fit(spark, tagged):
    train = tagged.where("split = 'train'")
    m = reg.moments(tagged, [*FEATURES, LABEL], "split", ("train", "val"))["train"]
    for trial in reg.fit_trials(spark, m, FEATURES, LABEL, n=3, seed=5):
        full = mllib_fit(train, regParam=trial.regParam, elasticNetParam=trial.elasticNetParam)
        assert np.allclose(full.coefficients.toArray(), trial.coefficients.toArray(), rtol=1e-6, atol=1e-6)
        assert full.intercept == pytest.approx(trial.intercept, rel=1e-6)


def test_rows_with_a_gap_are_skipped(spark):
    rows = [(float(a), float(b), 3.0 * a + 5.0 * b - 3.0 + (a * b) % 3) for a in range(8) for b in range(6)]
    gaps = [(None if b > 3 else a, b, y) for a, b, y in rows] + [(float("nan"), 1.0, 2.0), (1.0, 2.0, None), (1.0, 1.0, float("nan"))]
    df = spark.createDataFrame(gaps, "a double, b double, y double")
    clean = df.na.drop()
    from pyspark.ml.regression import LinearRegression

    for params in ({}, {"regParam": 0.5, "elasticNetParam": 0.3}):
        want = LinearRegression(labelCol="y", **params).fit(reg.assemble(clean, ["a", "b"]))
        got = reg.linear_stage(reg.fit_linear(df, ["a", "b"], "y", **params))
        assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), atol=1e-6)
        assert got.intercept == pytest.approx(want.intercept, abs=1e-6)
    tagged = df.withColumn("split", F.when(F.col("b") % 2 == 0, "train").otherwise("val"))
    same = [reg.search(t, ["a", "b"], "y", n=3).collect() for t in (tagged, tagged.na.drop())]
    assert same[0] == same[1]
    with pytest.raises(TypeError):
        reg.fit_linear(df, ["a", "b"], "y", solver="l-bfgs")


def test_tune_then_fit_then_score_and_store(spark, tagged, tmp_path):
    from lakeops.plans import trips as plan
    from lakeops.suite import standins

    model = reg.tune_and_fit(tagged, FEATURES, LABEL, n=3, seed=3)
    best = reg.best_params(reg.search(tagged, FEATURES, LABEL, n=3, seed=3))
    want = reg.linear_stage(reg.fit_linear(tagged.where("split <> 'test'"), FEATURES, LABEL, **best))
    assert np.allclose(reg.linear_stage(model).coefficients.toArray(), want.coefficients.toArray())
    path, target = str(tmp_path / "model"), str(tmp_path / "scores")
    reg.save_model(model, path)
    silver = standins.silver_trips(spark, SF)
    for _ in range(2):
        plan.score_and_store(spark, silver, path, target, length="30 days")
    stored = spark.read.parquet(target)
    assert stored.count() == reg.score_window(silver, F.lit(0.0), PICKUP, FEATURES, "30 days").count() > 1
    assert stored.select("window_end").distinct().count() == 1


def test_search_ranks_by_the_real_error(spark, tagged):
    ranked = reg.search(tagged, FEATURES, LABEL, n=4, seed=3).collect()
    assert [r.val_rmse for r in ranked] == sorted(r.val_rmse for r in ranked)
    best = reg.best_params(spark.createDataFrame(ranked))
    model = reg.fit_linear(tagged.where("split = 'train'"), FEATURES, LABEL, **best)
    val = model.transform(tagged.where("split = 'val'"))
    assert reg.evaluate(val, LABEL).first().rmse == pytest.approx(ranked[0].val_rmse, rel=1e-9)
    again = reg.search(tagged, FEATURES, LABEL, n=4, seed=3).collect()
    assert [r.reg_param for r in ranked] == [r.reg_param for r in again]
    with pytest.raises(ValueError):
        reg.search(tagged.where("split = 'val'"), FEATURES, LABEL, n=1)


def test_saved_model_scores_alike_as_expression(spark, tagged, tmp_path):
    model = reg.fit_linear(tagged, FEATURES, LABEL)
    reg.save_model(model, str(tmp_path / "m"))
    loaded = reg.load_model(str(tmp_path / "m"))
    both = loaded.transform(tagged).withColumn("expr", reg.model_expr(loaded, FEATURES))
    assert both.agg(F.max(F.abs(F.col("expr") - F.col("prediction")))).first()[0] < 1e-6
    coefs = [r.coef for r in reg.coef_table(model, FEATURES).collect()]
    assert coefs == sorted(coefs) and len(coefs) == 7


def test_evaluate_equals_the_evaluator(tagged):
    from pyspark.ml.evaluation import RegressionEvaluator

    pred = reg.fit_linear(tagged, FEATURES, LABEL).transform(tagged)
    got = reg.evaluate(pred, LABEL).first()
    for name in ("rmse", "mae"):
        assert got[name] == pytest.approx(RegressionEvaluator(labelCol=LABEL, metricName=name).evaluate(pred))


def test_assemble_skips_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    assert reg.assemble(df, ["a", "b"]).count() == 1


def test_scoring_twice_writes_once(spark, tmp_path):
    t = dt.datetime(2025, 1, 10)
    df = spark.createDataFrame([(1.0, t), (2.0, t - dt.timedelta(hours=2)), (3.0, t - dt.timedelta(days=3))], f"x double, {PICKUP} timestamp")
    path = str(tmp_path / "p")
    for _ in range(2):
        scored = reg.score_window(df, reg.score_expr([2.0], 1.0, ["x"]), PICKUP, ["x"])
        replace_partitions(scored, path, ["window_end"])
    got = spark.read.parquet(path).collect()
    assert [r.prediction for r in got] == [5.0]
    assert reg.score_window(df.limit(0), F.lit(1.0), PICKUP, ["x"]).count() == 0


def test_residual_histogram_counts_every_row(tagged):
    scored = reg.residuals(tagged.withColumn("prediction", F.lit(0.0)), LABEL)
    assert reg.residual_histogram(scored).agg(F.sum("cnt")).first()[0] == tagged.count()


# Samples and splits: the same rows whatever the partitioning, and whatever the skew.


def skewed(spark, n=30000):
    """A third of the rows hold one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("row")
    )


def test_split_is_disjoint_whole_and_repeatable(spark):
    df = spark.range(20000)
    parts = split(df, ["id"])
    ids = [set(r.id for r in p.collect()) for p in parts]
    assert sum(map(len, ids)) == 20000 == len(set.union(*ids))
    again = [set(r.id for r in p.collect()) for p in split(df.repartition(3), ["id"])]
    assert ids == again
    assert [round(len(i) / 200) for i in ids] == pytest.approx([70, 15, 15], abs=2)
    with pytest.raises(ValueError):
        with_split(df, ["id"], (50, 40), ("a", "b"))


@pytest.mark.parametrize("k", [10, 1500, 12000, 50000])
@pytest.mark.parametrize("parts", [1, 7])
def test_sample_equals_a_full_sort(spark, k, parts):
    from lakeops.functions.ids import key_hash

    df = skewed(spark).repartition(parts)
    got = sorted(r.k for r in sample_k(df, ["k"], k).collect())
    brute = df.withColumn("h", key_hash("k")).orderBy("h", "k").limit(k)
    assert got == sorted(r.k for r in brute.collect()) and len(got) == min(k, 30000)


def test_sample_of_an_empty_table(spark):
    assert sample_k(spark.range(0), ["id"], 5).count() == 0


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4)], "id int, ts int")
    assert [r.id for r in latest(df, "ts", 2, ["id"]).collect()] == [1, 2]


@pytest.mark.parametrize("parts", [1, 6])
def test_exact_quantiles_equal_percentile(spark, parts):
    df = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 4).cast("int").alias("g"),
        F.when(F.col("id") % 5 < 2, 7.5).when(F.col("id") % 11 == 0, None)
        .otherwise(F.pow(F.rand(3), 4) * 1e6).alias("v"),
    ).persist().repartition(parts)
    probs = [0.0, 0.1, 0.35, 0.5, 0.9, 0.999, 1.0]
    exact = F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")
    got = {r[0]: list(r)[1:] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(exact).collect()}
    assert got.keys() == want.keys() and None in got
    for g in want:
        assert got[g] == pytest.approx(want[g])
    assert list(exact_quantiles(df, "v", probs).first()) == pytest.approx(df.agg(exact).first().q)


def test_quantiles_of_little_data(spark):
    one = spark.createDataFrame([("a", 3.0), ("a", None), ("b", None)], "g string, v double")
    assert [tuple(r) for r in exact_quantiles(one, "v", [0.5], ["g"]).collect()] == [("a", 3.0)]
    assert [tuple(r) for r in exact_quantiles(one.limit(0), "v", [0.5]).collect()] == [(None,)]
    assert approx_quantiles(one, "v", [0.5], ["g"]).columns == ["g", "p50"]


def test_grid_counts_every_place_once(spark):
    df = spark.createDataFrame(
        [(1, "$5", 5.0, 37.901, 23.7), (2, "$7", 7.0, 37.909, 23.7), (3, None, None, 37.95, -0.001), (4, "x", 1.0, None, 1.0)],
        "id int, price string, price_num double, latitude double, longitude double",
    )
    got = {(r.cell_lat, r.cell_lon): (r.cnt, r.avg_price) for r in geo_grid(df, 100).collect()}
    assert got == {(3790, 2370): (2, 6.0), (3795, -1): (1, None)}
    assert [r.price for r in geo_points(df, 2).collect()] == ["$5", "$7"]


def test_fit_needs_rows(spark):
    with pytest.raises(ValueError):
        reg.fit_linear(spark.createDataFrame([], "a double, y double"), ["a"], "y")
