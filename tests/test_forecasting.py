from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from ledgerline.operators import forecasting, timebins


@pytest.fixture(scope="module")
def split(spark):
    first = dt.date(2022, 1, 2)
    days = [first + dt.timedelta(7 * i) for i in range(160)]
    data = [(d, 1000.0 + 3 * i + 200 * (d.month in (10, 11)) + 40 * np.sin(i)) for i, d in enumerate(days)]
    weekly = spark.createDataFrame([(d, float(v)) for d, v in data], "week_end date, total_sales double")
    return timebins.chronological_split(timebins.add_week_features(weekly)).persist()


def test_linear_model_equals_least_squares(split):
    pdf = split.toPandas()
    design = np.column_stack([np.ones(len(pdf)), pdf[list(forecasting.WEEK_FEATURES)].to_numpy(float)])
    train = pdf["is_train"].to_numpy(bool)
    weights = np.linalg.lstsq(design[train], pdf["total_sales"].to_numpy()[train], rcond=None)[0]
    model = forecasting.fit_linear(split.where("is_train"))
    got = model.transform(split.where("NOT is_train")).orderBy("week_end").toPandas()["predicted"]
    assert np.allclose(got, (design @ weights)[~train], rtol=1e-6)


def test_series_forecast_equals_least_squares_per_series(split, spark):
    both = split.selectExpr("'a' AS s", "*").unionByName(split.selectExpr("'b' AS s", "*"))
    got = forecasting.series_forecasts(both, ["s"]).orderBy("s", "week_end").toPandas()
    model = forecasting.fit_linear(split.where("is_train"))
    one = model.transform(split.where("NOT is_train")).orderBy("week_end").toPandas()["predicted"]
    assert np.allclose(got["predicted"], np.concatenate([one, one]), rtol=1e-6)


def test_a_failing_model_is_left_out(split):
    def broken(train):
        raise ImportError("no such library")

    fitted = forecasting.fit_models(split, {"Linear Regression": forecasting.fit_linear, "Broken": broken})
    assert list(fitted) == ["Linear Regression"]


def test_comparison_marks_the_lowest_rmse_and_the_model_reloads(split, tmp_path):
    models = {"Linear Regression": forecasting.fit_linear, "Harmonic Regression": forecasting.fit_harmonic}
    fitted = forecasting.fit_models(split, models)
    predictions = forecasting.predict(split, fitted)
    compared = forecasting.compare_models(forecasting.error_metrics(predictions)).collect()
    best = min(compared, key=lambda r: r["rmse"])
    assert [r["model"] for r in compared if r["is_best"]] == [best["model"]]
    wide = forecasting.actual_vs_predicted(predictions, list(fitted))
    assert wide.columns == ["week_end", "total_sales", "linear_regression", "harmonic_regression"] and wide.count() == 24
    fitted["Harmonic Regression"].write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    test = split.where("NOT is_train")
    one, two = (m.transform(test).orderBy("week_end").toPandas()["predicted"] for m in (fitted["Harmonic Regression"], again))
    assert np.allclose(one, two)


def test_metrics(spark):
    df = spark.createDataFrame([("m", 1.0, 2.0), ("m", 3.0, 3.0), ("m", 5.0, 3.0)], "model string, total_sales double, predicted double")
    got = forecasting.error_metrics(df).first()
    assert (got["mae"], got["rmse"], got["r2"]) == (1.0, 1.29, 0.375)


def test_forest_fits(split):
    model = forecasting.fit_forest(split.where("is_train"))
    assert model.stages[-1].getNumTrees == 200
