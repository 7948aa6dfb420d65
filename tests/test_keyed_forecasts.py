"""Keyed forecasts against the 12 candidates fitted and scored one by one on the same split."""

from __future__ import annotations

import os

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from cartwise.operators import finances as fi
from cartwise.operators import stock as st
from cartwise.sources.tables import load_tables
from store_fixtures import AS_OF

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="no test data")


@pytest.fixture(scope="module")
def tables(spark):
    return load_tables(spark, SF)


def fitted_one_by_one(series, key):
    """The best candidate's line over (month, year, key), by the evaluator's RMSE; the first one wins a tie."""
    months = sorted({(r.year, r.month) for r in series.select("year", "month").distinct().collect()})
    held = [y * 100 + m for i, (y, m) in enumerate(months) if i % 4 == 3]
    data = VectorAssembler(inputCols=["month", "year", key], outputCol="features").transform(series).cache()
    is_held = (F.col("year") * 100 + F.col("month")).isin(held)
    rmse = RegressionEvaluator(metricName="rmse")

    def fit(rows, reg, intercept, net):
        return LinearRegression(regParam=reg, fitIntercept=intercept, elasticNetParam=net).fit(rows)

    grid = [(reg, intercept, net) for reg in (0.1, 0.01) for intercept in (True, False) for net in (0.0, 0.5, 1.0)]
    scores = [rmse.evaluate(fit(data.filter(~is_held), *c).transform(data.filter(is_held))) for c in grid]
    return fit(data, *grid[min(range(12), key=lambda i: (round(scores[i], 9), i))])


def line(model, r, key):
    return float(model.intercept) + sum(float(w) * x for w, x in zip(model.coefficients, (r.month, r.year, r[key]), strict=True))


def test_units_by_state(tables):
    series = st.unit_series_by_state(tables, AS_OF)
    model = fitted_one_by_one(series, "state_idx")
    index = {r.state: r.state_idx for r in series.select("state", "state_idx").distinct().collect()}
    got = st.sales_predictions_by_state(tables, AS_OF).withColumn("state_idx", F.lit(0)).collect()
    assert len(got) == 12 * len(index)
    for r in got:
        want = line(model, type(r)(**{**r.asDict(), "state_idx": index[r.state]}), "state_idx")
        assert abs(r.sales - want) <= 0.5 + 1e-6 * abs(want)


def test_value_by_state(tables):
    series = fi.value_series_by_state(tables, AS_OF)
    model = fitted_one_by_one(series, "state_idx")
    index = {r.state: r.state_idx for r in series.select("state", "state_idx").distinct().collect()}
    got = fi.sales_value_predictions_by_state(tables, AS_OF).withColumn("state_idx", F.lit(0)).collect()
    assert len(got) == 12 * len(index)
    for r in got:
        want = line(model, type(r)(**{**r.asDict(), "state_idx": index[r.state]}), "state_idx")
        assert abs(r.sales - want) <= 0.0051 + 1e-6 * abs(want)


def test_units_by_item(tables):
    series = st.unit_series_by_item(tables, AS_OF)
    model = fitted_one_by_one(series, "item_idx")
    index = {r.item_id: r.item_idx for r in series.select("item_id", "item_idx").distinct().collect()}
    got = st.sales_predictions_by_item(tables, AS_OF).withColumn("item_idx", F.lit(0)).collect()
    assert len(got) == 12 * len(index)
    for r in got:
        want = line(model, type(r)(**{**r.asDict(), "item_idx": index[r.itemId]}), "item_idx")
        assert abs(r.sales - want) <= 0.5 + 1e-6 * abs(want)
