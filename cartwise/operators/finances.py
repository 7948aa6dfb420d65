"""Finance jobs: monthly revenue overview and revenue forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.calendar import since_months
from cartwise.functions.holding import hold
from cartwise.functions.indexing import rank_on
from cartwise.functions.people import known_states, state_code
from cartwise.operators import forecast as fc
from cartwise.operators.documents import nest_by_month, one_row_document, sorted_list
from cartwise.sources.tables import StoreTables

OVERVIEW_MONTHS = 24
VALUE_HISTORY = 24
KEYED_HISTORY = 48


def orders_with_state(t: StoreTables, as_of: dt.date | str, months: int) -> DataFrame:
    """Orders newer than as_of - months (open above), with the buyer's known state."""
    recent = t.order.filter(since_months(F.col("date"), as_of, months))
    cust = t.customer.select(F.col("id").alias("_cid"), "state")
    joined = recent.join(cust, F.col("customer_id") == F.col("_cid"))
    return known_states(joined, "state", t.state_map)


def revenue_by_month_state(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS) -> DataFrame:
    """(year, month, state, abbreviation, revenue): exact decimal sums of the
    2-decimal prices, so coarser totals roll up from them without rounding."""
    o = orders_with_state(t, as_of, months)
    return (o.groupBy(F.year("date").cast("int").alias("year"), F.month("date").cast("int").alias("month"),
                      "state", "abbreviation")
            .agg(F.sum(F.col("totalPrice").cast("decimal(18,2)")).alias("revenue")))


def finances_monthly(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS,
                     revenue: DataFrame | None = None) -> DataFrame:
    """(month, year, value): revenue per calendar month of known-state buyers."""
    r = revenue if revenue is not None else revenue_by_month_state(t, as_of, months)
    return (r.groupBy("year", "month").agg(F.sum("revenue").cast("double").alias("value"))
            .select("month", "year", "value"))


def finances_monthly_by_state(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS,
                              revenue: DataFrame | None = None) -> DataFrame:
    """(month, year, state, sales, abbreviation) per calendar month and state."""
    r = revenue if revenue is not None else revenue_by_month_state(t, as_of, months)
    return r.select("month", "year", "state", F.col("revenue").cast("double").alias("sales"),
                    state_code(F.col("abbreviation")).alias("abbreviation"))


def finances_overview(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS) -> DataFrame:
    """The one-row document: monthly_sales and monthly_sales_by_state arrays.

    Both arrays are bounded by the calendar window (and the state dimension), not
    by the number of orders. The orders are scanned and aggregated once; the
    monthly totals roll up from the persisted per-state sums.
    """
    revenue = hold(revenue_by_month_state(t, as_of, months))
    monthly = sorted_list(finances_monthly(t, as_of, months, revenue), ["year", "month"],
                          ["month", "year", "value"], "monthly_sales")
    by_state = sorted_list(
        nest_by_month(finances_monthly_by_state(t, as_of, months, revenue),
                      ["state", "sales", "abbreviation"], "statesSales"),
        ["year", "month"], ["month", "year", "statesSales"], "monthly_sales_by_state")
    return one_row_document(monthly, by_state)


# ---------------------------------------------------------------------------
# forecasts
# ---------------------------------------------------------------------------

def value_series(t: StoreTables, as_of, history: int = VALUE_HISTORY) -> DataFrame:
    """(year, month, t, label): revenue per whole month before as_of's month."""
    s = fc.monthly_series(t.order, "date", F.col("totalPrice"), as_of, history,
                          value_type="decimal")
    return fc.number_months(s).select("year", "month", "t", F.col("label").cast("double").alias("label"))


def sales_value_predictions(t: StoreTables, as_of, history: int = VALUE_HISTORY,
                            horizon: int = fc.HORIZON) -> DataFrame:
    """(month, year, salesValue): trend forecast, 2 decimals, floored at 0."""
    model = fc.fit_trend(value_series(t, as_of, history))
    pred = fc.trend_forecast(model, as_of, horizon)
    v = fc.cents(F.col("prediction"))
    return pred.select("month", "year", F.when(v >= 0, v).otherwise(F.lit(0.0)).alias("salesValue"))


def value_series_by_state(t: StoreTables, as_of, history: int = KEYED_HISTORY) -> DataFrame:
    """(year, month, state, state_idx, label) over all states (no state filter)."""
    cust = t.customer.select(F.col("id").alias("_cid"), "state")
    o = t.order.join(cust, F.col("customer_id") == F.col("_cid"))
    s = fc.monthly_series(o, "date", F.col("totalPrice"), as_of, history, keys=["state"],
                          value_type="decimal")
    # months x states rows: the index is a window on them
    return (rank_on(s, ["state"], "state_idx")
            .select("year", "month", "state", "state_idx", F.col("label").cast("double").alias("label")))


def forecast_horizon_by_state(t: StoreTables, as_of, history: int = KEYED_HISTORY,
                              horizon: int = fc.HORIZON, series: DataFrame | None = None) -> DataFrame:
    """(month, year, state, state_idx, abbreviation): the rows a state model scores."""
    series = series if series is not None else value_series_by_state(t, as_of, history)
    states = series.select("state", "state_idx").distinct()
    sm = t.state_map.select(F.col("name").alias("state"), "abbreviation")
    keyed = states.join(sm, "state", "left")
    return fc.keyed_horizon(keyed, as_of, horizon).select(
        "month", "year", "state", "state_idx", state_code(F.col("abbreviation")).alias("abbreviation"))


def sales_value_predictions_by_state(t: StoreTables, as_of, history: int = KEYED_HISTORY,
                                     horizon: int = fc.HORIZON) -> DataFrame:
    """Flat (month, year, state, sales, abbreviation); one model for all states.

    Features are (month, year, state index) as in the reference; 2 decimals, no floor.
    """
    series = hold(value_series_by_state(t, as_of, history))
    model = fc.fit_keyed(series, ["month", "year", "state_idx"])
    hz = forecast_horizon_by_state(t, as_of, history, horizon, series)
    scored = model.transform(hz)
    return scored.select("month", "year", "state", fc.cents(F.col("prediction")).alias("sales"),
                         "abbreviation")


def sales_value_predictions_by_state_document(t: StoreTables, as_of, **kw) -> DataFrame:
    """(month, year, statesSales: array<struct(state, sales, abbreviation)>) per month."""
    return nest_by_month(sales_value_predictions_by_state(t, as_of, **kw),
                         ["state", "sales", "abbreviation"], "statesSales")
