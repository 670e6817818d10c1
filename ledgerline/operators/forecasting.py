"""Weekly sales forecasts: regression, forest and harmonic models, their errors and the winner."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.operators.features import LEAKY_COLUMNS

logger = logging.getLogger(__name__)

# Predictors, forest size, yearly harmonics.
WEEK_FEATURES = ("time_index", "month", "quarter", "week_of_year", "is_festive_season")
FOREST = {"numTrees": 200, "maxDepth": 6, "seed": 42, "featureSubsetStrategy": "all", "maxBins": 512}
HARMONICS = 10

TARGET = "total_sales"


def reject_leaky(columns: Sequence[str]) -> None:
    leaky = sorted(set(columns) & set(LEAKY_COLUMNS))
    if leaky:
        raise ValueError(f"these columns know the future and cannot predict it: {', '.join(leaky)}")


def _week_vector(features: Sequence[str]) -> VectorAssembler:
    reject_leaky(features)
    return VectorAssembler(inputCols=list(features), outputCol="features")


def fit_linear(train: DataFrame, features: Sequence[str] = WEEK_FEATURES) -> PipelineModel:
    regression = LinearRegression(labelCol=TARGET, predictionCol="predicted", regParam=0.0, solver="normal")
    return Pipeline(stages=[_week_vector(features), regression]).fit(train)


def fit_forest(train: DataFrame, features: Sequence[str] = WEEK_FEATURES) -> PipelineModel:
    forest = RandomForestRegressor(labelCol=TARGET, predictionCol="predicted", **FOREST)
    return Pipeline(stages=[_week_vector(features), forest]).fit(train)


def fit_harmonic(train: DataFrame, harmonics: int = HARMONICS) -> PipelineModel:
    """Linear trend plus a yearly Fourier series of the week-end date, lightly regularized."""
    years = "(unix_date(week_end) / 365.25D)"
    waves = [
        f"{fn}({2.0 * np.pi * k!r}D * {years}) AS {fn}_{k}" for k in range(1, harmonics + 1) for fn in ("sin", "cos")
    ]
    names = [w.rsplit(" ", 1)[1] for w in waves]
    expand = SQLTransformer(statement=f"SELECT *, {years} AS years, {', '.join(waves)} FROM __THIS__")
    regression = LinearRegression(
        labelCol=TARGET, predictionCol="predicted", regParam=0.01, elasticNetParam=0.0, solver="normal"
    )
    return Pipeline(stages=[expand, _week_vector(["years", *names]), regression]).fit(train)


#: Model name to fitting function. The last one is optional in the sense that all are: one that fails is left out.
MODELS: dict[str, Callable[[DataFrame], PipelineModel]] = {
    "Linear Regression": fit_linear,
    "Random Forest": fit_forest,
    "Harmonic Regression": fit_harmonic,
}


def fit_models(
    split: DataFrame, models: dict[str, Callable[[DataFrame], PipelineModel]] = MODELS
) -> dict[str, PipelineModel]:
    """Fit every model on the training weeks; a failure is logged and the others go on.

    One row per calendar week: the training frame is small whatever the order volume.
    """
    train = split.where("is_train").persist()
    fitted = {}
    try:
        for name, fit in models.items():
            try:
                fitted[name] = fit(train)
            except ValueError:  # a wrong predictor is a mistake of the caller
                raise
            except Exception as error:  # a missing optional model must not stop the comparison
                logger.warning("%s could not be fitted and is skipped: %s", name, error)
    finally:
        train.unpersist()
    return fitted


def predict(split: DataFrame, fitted: dict[str, PipelineModel]) -> DataFrame:
    """(model, week_end, total_sales, predicted) over the held-out weeks; no rows if no model was fitted."""
    test = split.where("NOT is_train")
    frames = [
        model.transform(test).select(F.lit(name).alias("model"), "week_end", TARGET, "predicted")
        for name, model in fitted.items()
    ]
    none = test.select(F.lit("").alias("model"), "week_end", TARGET, F.lit(0.0).alias("predicted")).where(F.lit(False))
    return reduce(DataFrame.unionByName, frames, none)


def error_metrics(predictions: DataFrame, keys: Sequence[str] = ("model",), digits: tuple[int, int] = (2, 4)) -> DataFrame:
    """Mean absolute error, root mean squared error and R squared per key."""
    error = F.col(TARGET) - F.col("predicted")
    spread = F.var_pop(TARGET) * F.count("*")
    return predictions.groupBy(*keys).agg(
        F.round(F.avg(F.abs(error)), digits[0]).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), digits[0]).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide(F.sum(error * error), spread), digits[1]).alias("r2"),
    )


def compare_models(metrics: DataFrame) -> DataFrame:
    """The metrics with the winner, the model of the lowest RMSE, marked."""
    winner = metrics.agg(F.min_by("model", F.struct("rmse", "model")))
    return metrics.withColumn("is_best", F.col("model") == winner.scalar())


def model_checks(split: DataFrame, fitted: dict[str, PipelineModel], tolerance: float = 1e-6) -> DataFrame:
    """(model, held_out_weeks, holds): every held-out week is predicted, and what must be so of each kind of model is so.

    The residuals of the linear regression on its training weeks are orthogonal to its predictors, forest predictions stay
    inside the range of the training values, and the harmonic predictions are finite.
    """
    train, test = split.where("is_train"), split.where("NOT is_train")
    low, high = (train.agg(f(TARGET)).scalar() for f in (F.min, F.max))
    frames = []
    for name, model in fitted.items():
        predicted = model.transform(test)
        inside = F.count_if(F.col("predicted").between(low, high)) == F.count("*")
        finite = F.count_if(F.abs("predicted") < float("inf")) == F.count("*")
        holds = inside if name == "Random Forest" else finite
        if name == "Linear Regression":
            residual = F.col(TARGET) - F.col("predicted")
            sums = [F.abs(F.sum(residual * F.col(f))) <= tolerance * F.sum(F.abs(F.col(TARGET) * F.col(f))) for f in WEEK_FEATURES]
            holds = holds & model.transform(train).agg(reduce(Column.__and__, sums)).scalar()
        frames.append(predicted.agg(F.lit(name).alias("model"), F.count("predicted").alias("held_out_weeks"), holds.alias("holds")))
    return reduce(DataFrame.unionByName, frames)


def actual_vs_predicted(predictions: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per held-out week with the actual value and one column per model."""
    return predictions.groupBy("week_end", TARGET).agg(
        *[F.max(F.when(F.col("model") == n, F.col("predicted"))).alias(n.lower().replace(" ", "_")) for n in names]
    )


def trend_lines(split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Straight-line trend of every series, fitted on its training weeks in one aggregation."""
    x, y = F.col("time_index").cast("double"), F.col(TARGET)
    return split.where("is_train").groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count("*").alias("train_weeks")
    )


def trend_predictions(split: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trend forecast of the held-out weeks of every series, or of the one series without keys."""
    lines = trend_lines(split, keys)
    test = split.where("NOT is_train")
    if keys:
        test, slope, intercept = test.join(lines, list(keys)), F.col("slope"), F.col("intercept")
    else:
        line = lines.select(F.struct("slope", "intercept")).scalar()
        slope, intercept = line["slope"], line["intercept"]
    return test.withColumn("predicted", intercept + slope * F.col("time_index"))


def series_forecasts(split: DataFrame, keys: Sequence[str], features: Sequence[str] = WEEK_FEATURES) -> DataFrame:
    """Least squares on the calendar features for every series at once.

    One aggregation sums the products of the features over each series' training weeks; the normal equations, a row per
    series, are solved where that row lies; the held-out weeks are predicted in the join back.
    """
    reject_leaky(features)
    keys, features = list(keys), list(features)
    terms = ["_one", *features]
    named = split.withColumn("_one", F.lit(1.0))
    products = {f"_p{i}_{j}": F.sum(F.col(a).cast("double") * F.col(b)) for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j}
    targets = {f"_t{i}": F.sum(F.col(a) * F.col(TARGET)) for i, a in enumerate(terms)}
    sums = named.where("is_train").groupBy(*keys).agg(*[v.alias(k) for k, v in {**products, **targets}.items()])

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            weights = []
            for row in frame.to_dict("records"):
                normal = [[row[f"_p{min(i, j)}_{max(i, j)}"] for j in range(len(terms))] for i in range(len(terms))]
                size = np.sqrt(np.diag(normal))
                size[size == 0] = 1.0
                scaled = np.array(normal) / np.outer(size, size)
                weights.append(np.linalg.lstsq(scaled, np.array([row[f"_t{i}"] for i in range(len(terms))]) / size, rcond=1e-12)[0] / size)
            yield frame[keys].assign(_weights=weights)

    schema = T.StructType([*[split.schema[k] for k in keys], T.StructField("_weights", T.ArrayType(T.DoubleType()))])
    solved = sums.mapInPandas(solve, schema)
    predicted = reduce(Column.__add__, [F.col("_weights")[i] * F.col(c) for i, c in enumerate(terms)])
    return named.where("NOT is_train").join(solved, keys, "left").select(*keys, "week_end", TARGET, predicted.alias("predicted"))
