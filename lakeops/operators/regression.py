"""Linear models on tables: fitting, search, scoring and evaluation."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lakeops.operators.aggregate import histogram
from lakeops.operators.columns import cast_all
from lakeops.operators.rows import drop_null, last_window

# fixed values: search space and number of trials
REG_PARAM = (0.0, 0.2)
ELASTIC_NET_PARAM = (0.0, 1.0)
TRIALS = 30
PARALLEL_FITS = 8


def training_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Features and label as doubles, rows with a gap left out."""
    cols = [*features, label]
    return drop_null(cast_all(df, cols), cols)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _assembler(features).transform(df)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def linear_stage(model: PipelineModel) -> LinearRegressionModel:
    return model.stages[-1]


def coef_table(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Feature and coefficient, lowest first; as many rows as the model has features."""
    stage = linear_stage(model)
    rows = sorted(zip(features, map(float, stage.coefficients)), key=lambda r: (r[1], r[0]))
    return SparkSession.active().createDataFrame(rows, "feature string, coef double")


def score_expr(coefs: Iterable[float], intercept: float, cols: Sequence[str]) -> Column:
    """The prediction as a column expression: no UDF, no vector column."""
    total = F.lit(float(intercept))
    for value, name in zip(coefs, cols, strict=True):
        total = total + F.col(name).cast("double") * F.lit(float(value))
    return total


def model_expr(model: PipelineModel, features: Sequence[str]) -> Column:
    stage = linear_stage(model)
    return score_expr(stage.coefficients, stage.intercept, features)


def score_opaque(
    df: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], features: Sequence[str]
) -> DataFrame:
    """Predictions of a model known only by its ``predict`` on pandas frames, batch by batch in
    the tasks, which get the features alone. For a linear model ``score_expr`` stays in the JVM."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(predict(batch), dtype="float64")

    return df.withColumn("prediction", score(F.struct(*[F.col(c) for c in features])))


def rmse(prediction: str | Column, label: str) -> Column:
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    error = p - F.col(label)
    return F.sqrt(F.avg(error * error))


def mae(prediction: str | Column, label: str) -> Column:
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.avg(F.abs(p - F.col(label)))


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``rows, rmse, mae`` from one pass."""
    return pred.agg(
        F.count(F.lit(1)).alias("rows"),
        rmse(prediction, label).alias("rmse"),
        mae(prediction, label).alias("mae"),
    )


def residuals(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return pred.withColumn("residual", F.col(prediction) - F.col(label))


def residual_histogram(pred: DataFrame, limit: float = 100, bins: int = 80) -> DataFrame:
    return histogram(pred, "residual", -limit, limit, bins)


def simple_fit(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Slope and intercept of a one-feature least-squares fit."""
    return df.agg(
        F.regr_slope(label, feature).alias("slope"),
        F.regr_intercept(label, feature).alias("intercept"),
    )


@dataclass(frozen=True)
class Moments:
    """Row count, means and covariances of a few columns."""

    rows: int
    mean: np.ndarray
    cov: np.ndarray


def moments(
    df: DataFrame, cols: Sequence[str], by: str | None = None, parts: Sequence[str] = ()
) -> dict[str | None, Moments]:
    """Moments of the named parts of column ``by`` (such as those of a split), or of the whole table
    under None. One pass over the table, summed on the executors into one row per part. Rows
    with a gap are the caller's to leave out: averages and covariances would skip them differently."""
    if by:
        df = df.where(F.col(by).isin(*parts))
    size = len(cols)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = df.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)),
        *[F.avg(c) for c in cols],
        *[F.covar_pop(cols[i], cols[j]) for i, j in pairs],
    )
    groups = {}
    for row in found.collect():
        name, (n, *values) = (row[0], row[1:]) if by else (None, row)
        if not n:
            continue
        cov = np.zeros((size, size))
        for (i, j), value in zip(pairs, values[size:]):
            cov[i, j] = cov[j, i] = value
        groups[name] = Moments(n, np.array(values[:size]), cov)
    return groups


def condense(spark: SparkSession, m: Moments, cols: Sequence[str]) -> DataFrame:
    """A few weighted rows with the given count, means and covariances.

    Least squares, ridge and elastic net see the data through these moments only, so a fit on
    the condensed rows equals a fit on the table. A search over any number of parameters then
    reads the table once and fits ``2 * columns`` rows.
    """
    size = len(cols)
    scale = np.sqrt(np.diag(m.cov))
    scale[scale == 0] = 1.0
    roots, axes = np.linalg.eigh(m.cov / np.outer(scale, scale))
    steps = (axes * np.sqrt(np.clip(roots, 0, None) * size)).T * scale
    weight = m.rows / (2.0 * size)
    rows = [(*map(float, m.mean + sign * step), weight) for step in steps for sign in (1, -1)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in [*cols, "row_weight"]))


def fit_moments(
    spark: SparkSession, m: Moments, features: Sequence[str], label: str, **params: float
) -> PipelineModel:
    """Assembler and linear regression, fitted to the condensed rows."""
    stage = LinearRegression(featuresCol="features", labelCol=label, weightCol="row_weight", **params)
    points = condense(spark, m, [*features, label]).coalesce(1)
    return Pipeline(stages=[_assembler(features), stage]).fit(points)


def fit_linear(
    df: DataFrame, features: Sequence[str], label: str, regParam: float = 0.0, elasticNetParam: float = 0.0
) -> PipelineModel:
    """Least squares (or ridge, lasso and elastic net) over the whole table, which is read once.
    Rows with a gap in a feature or the label are left out. Fitting the table itself would read it
    a second time for a training summary."""
    params = {"regParam": regParam, "elasticNetParam": elasticNetParam}
    found = moments(training_rows(df, features, label), [*features, label])
    if not found:
        raise ValueError("no rows to fit")
    return fit_moments(df.sparkSession, found[None], features, label, **params)


@dataclass(frozen=True)
class Trial:
    regParam: float
    elasticNetParam: float
    coefficients: DenseVector
    intercept: float


def fit_trials(
    spark: SparkSession, train: Moments, features: Sequence[str], label: str, n: int = TRIALS, seed: int = 42
) -> list[Trial]:
    """Fit seeded random parameters to the moments of the training rows."""
    points = condense(spark, train, [*features, label])
    small = assemble(points, features).select("features", label, "row_weight").coalesce(1).persist()
    pick = random.Random(seed)
    lr = LinearRegression(featuresCol="features", labelCol=label, weightCol="row_weight")
    grid = [
        {lr.regParam: pick.uniform(*REG_PARAM), lr.elasticNetParam: pick.uniform(*ELASTIC_NET_PARAM)}
        for _ in range(n)
    ]
    fits = lr.fitMultiple(small, grid)
    with ThreadPool(min(n, PARALLEL_FITS)) as pool:
        step = inheritable_thread_target(spark)(lambda _: next(fits))
        models = dict(pool.imap_unordered(step, range(n)))
    small.unpersist()
    return [
        Trial(params[lr.regParam], params[lr.elasticNetParam], model.coefficients, model.intercept)
        for params, model in zip(grid, (models[i] for i in range(n)))
    ]


def rank_trials(spark: SparkSession, trials: Sequence[Trial], val: Moments) -> DataFrame:
    """Trials with their error on the validation rows, best first. The mean squared error of a
    linear model is a function of the moments too."""
    rows = []
    for i, t in enumerate(trials):
        weights = np.append(t.coefficients.toArray(), -1.0)
        bias = weights @ val.mean + t.intercept
        error = math.sqrt(max(weights @ val.cov @ weights, 0.0) + bias**2)
        rows.append((i, t.regParam, t.elasticNetParam, error))
    rows.sort(key=lambda r: (r[3], r[0]))
    return spark.createDataFrame(rows, "trial int, reg_param double, elastic_net_param double, val_rmse double")


def search(
    tagged: DataFrame, features: Sequence[str], label: str, n: int = TRIALS, seed: int = 42, by: str = "split"
) -> DataFrame:
    """Ranked trials of a random parameter search over rows tagged ``train`` and ``val``; rows with
    a gap are left out. The table is read once, whatever n is."""
    rows = training_rows(tagged, features, label)
    parts = moments(rows, [*features, label], by, ("train", "val"))
    if "train" not in parts or "val" not in parts:
        raise ValueError("no training or no validation rows")
    trials = fit_trials(tagged.sparkSession, parts["train"], features, label, n, seed)
    return rank_trials(tagged.sparkSession, trials, parts["val"])


def best_params(ranked: DataFrame) -> dict[str, float]:
    """Parameters of the first trial, to be passed to ``fit_linear``."""
    top = ranked.orderBy("val_rmse", "trial").first()
    if top is None:
        raise ValueError("no trials")
    return {"regParam": top.reg_param, "elasticNetParam": top.elastic_net_param}


def tune_and_fit(
    tagged: DataFrame, features: Sequence[str], label: str, n: int = TRIALS, seed: int = 42, by: str = "split"
) -> PipelineModel:
    """Search on ``train`` and ``val``, then fit both together with the best parameters."""
    best = best_params(search(tagged, features, label, n, seed, by))
    return fit_linear(tagged.where(F.col(by).isin("train", "val")), features, label, **best)


def score_window(
    df: DataFrame, prediction: Column, ts: str, features: Sequence[str], length: str = "1 day"
) -> DataFrame:
    """Predictions for the newest slice of the table (see ``last_window``), tagged with the end
    of the slice so that a repeated run can replace its own rows."""
    end = df.agg(F.max(ts)).scalar()
    return last_window(df, ts, length).select(
        *features, ts, prediction.alias("prediction"), end.cast("string").alias("window_end")
    )
