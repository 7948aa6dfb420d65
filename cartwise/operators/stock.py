"""Stock jobs: units sold overview and unit forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.calendar import add_months, first_of_month, month_prefilter, since_months, whole_months_before
from cartwise.functions.holding import hold
from cartwise.functions.indexing import dense_index, rank_on
from cartwise.functions.people import known_states, state_code
from cartwise.functions.pruning import lines_in_key_range
from cartwise.operators import forecast as fc
from cartwise.operators.documents import nest_by_month, one_row_document, sorted_list
from cartwise.sources.tables import StoreTables

OVERVIEW_MONTHS = 24
UNIT_HISTORY = 24
KEYED_HISTORY = 48
TOP_PRODUCTS = 20
TOP_PROFILES = 20


def _known_lines(t: StoreTables, as_of, months: int) -> DataFrame:
    """(year, month, state, abbreviation, item_id, quantity): order lines of
    known-state customers in orders newer than as_of - months.

    Plan: the date filter reaches the orders scan, the range of the surviving ids
    the line scan, and orders are joined to
    their known-state buyers before they meet the line table, so only the
    surviving orders reach the large join on the order id. With the co-located
    layout (``sources/layout.py``) that join needs no exchange, so lines meet
    orders first and buyers afterwards.
    """
    cust = known_states(t.customer.select(F.col("id").alias("_cid"), "state"), "state", t.state_map)
    recent = t.order.filter(since_months(F.col("date"), as_of, months))
    if t.colocated:
        # bucketed alike: lines meet their orders bucket by bucket, no exchange;
        # the buyers join the already matched rows; old months are pruned at the scan
        d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
        lines = (month_prefilter(t.ordereditem, add_months(d, -months), None)
                 .join(recent, F.col("order_id") == F.col("id"))
                 .join(cust, F.col("customer_id") == F.col("_cid")))
    else:
        orders = (recent.join(cust, F.col("customer_id") == F.col("_cid"))
                  .select(F.col("id").alias("_oid"), "date", "state", "abbreviation"))
        lines = lines_in_key_range(t.ordereditem, recent).join(orders, F.col("order_id") == F.col("_oid"))
    return lines.select(*_ym(), "state", "abbreviation", "item_id", F.col("quantity").cast("bigint").alias("quantity"))


def units_in_sets(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS) -> DataFrame:
    """(year, month, state, abbreviation, item_id, quantity, of_item): the units
    of catalog items, once per (month, state) and once per item, ``of_item``
    telling the two apart; what the three parts of the overview need.

    One pass with grouping sets: a task combines its lines into at most months x
    states rows and one row per item it holds, and only those are shuffled. Sums
    per (month, state, item) would be nearly as many rows as lines.
    """
    lines = _known_items(t, _known_lines(t, as_of, months))
    return (lines.groupingSets([["year", "month", "state", "abbreviation"], ["item_id"]],
                               "year", "month", "state", "abbreviation", "item_id")
            .agg(F.sum("quantity").alias("quantity"), (F.grouping("item_id") == 0).alias("of_item")))


def _ym(date: str = "date"):
    return [F.year(date).cast("int").alias("year"), F.month(date).cast("int").alias("month")]


def _of_states(t: StoreTables, as_of, months: int, units: DataFrame | None) -> DataFrame:
    """Quantities by month and state: the rows of ``units`` for them, or else the lines themselves."""
    if units is not None:
        return units.filter("NOT of_item")
    return _known_items(t, _known_lines(t, as_of, months))


def stock_monthly(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS,
                  units: DataFrame | None = None) -> DataFrame:
    """(month, year, numProducts): units sold per calendar month."""
    u = _of_states(t, as_of, months, units)
    return (u.groupBy("year", "month").agg(F.sum("quantity").alias("numProducts"))
            .select("month", "year", "numProducts"))


def stock_monthly_by_state(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS,
                           units: DataFrame | None = None) -> DataFrame:
    """(month, year, state, sales, abbreviation): units per month and known state."""
    u = _of_states(t, as_of, months, units)
    return (u.groupBy("year", "month", "state", "abbreviation")
            .agg(F.sum("quantity").alias("sales"))
            .select("month", "year", "state", "sales",
                    state_code(F.col("abbreviation")).alias("abbreviation")))


def stock_top_products(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS,
                       n: int = TOP_PRODUCTS, units: DataFrame | None = None) -> DataFrame:
    """(id, title, quantity): the n items with most units; ties by item id.

    Sums per item, checks the catalog on the sums, takes the top n with
    TakeOrderedAndProject, and only then joins the n titles.
    """
    if units is not None:
        sums = units.filter("of_item").select("item_id", "quantity")
    else:
        sums = _known_items(t, _known_lines(t, as_of, months).groupBy("item_id").agg(F.sum("quantity").alias("quantity")))
    top = (sums.withColumnRenamed("item_id", "id")
           .orderBy(F.col("quantity").desc(), F.col("id").asc()).limit(n))
    titles = t.item.select("id", "title")
    return top.join(titles, "id").select("id", "title", "quantity")


def stock_overview(t: StoreTables, as_of, months: int = OVERVIEW_MONTHS,
                   n: int = TOP_PRODUCTS) -> DataFrame:
    """The one-row document: monthly_sales, monthly_sales_by_state, top_products.

    The sums of all three are computed in one pass and persisted.
    """
    units = hold(units_in_sets(t, as_of, months))
    monthly = sorted_list(stock_monthly(t, as_of, months, units), ["year", "month"],
                          ["month", "year", "numProducts"], "monthly_sales")
    by_state = sorted_list(
        nest_by_month(stock_monthly_by_state(t, as_of, months, units), ["state", "sales", "abbreviation"],
                      "statesSales"),
        ["year", "month"], ["month", "year", "statesSales"], "monthly_sales_by_state")
    top = stock_top_products(t, as_of, months, n, units).select(
        (-F.col("quantity")).alias("_neg"), "id", "title", "quantity")
    top_list = sorted_list(top, ["_neg", "id"], ["id", "title", "quantity"], "top_products")
    return one_row_document(monthly, by_state, top_list)


# ---------------------------------------------------------------------------
# forecasts
# ---------------------------------------------------------------------------

def _lines_in_history(t: StoreTables, as_of, history: int) -> DataFrame:
    """Order lines of the history's whole months with their order's date and buyer.

    The line scan reads only what the months can hold: on the co-located layout
    their partitions, else the row groups with their orders' ids.
    """
    first = first_of_month(as_of)
    orders = t.order.filter(whole_months_before(F.col("date"), as_of, history))
    if t.colocated:
        lines = month_prefilter(t.ordereditem, add_months(first, -history), add_months(first, -1))
    else:
        lines = lines_in_key_range(t.ordereditem, orders)
    return lines.join(orders.select(F.col("id").alias("_oid"), "customer_id", "date"), F.col("order_id") == F.col("_oid"))


def _units_per_item_month(t: StoreTables, as_of, history: int) -> DataFrame:
    """(year, month, item_id, label): units per whole month and catalog item."""
    lines = _lines_in_history(t, as_of, history)
    return _known_items(t, fc.monthly_series(lines, "date", F.col("quantity"), as_of, history, keys=["item_id"]))


def _known_items(t: StoreTables, df: DataFrame) -> DataFrame:
    """Rows whose item is in the catalog; where items are summed, applied to the sums rather than to lines."""
    return df.join(t.item.select(F.col("id").alias("item_id")), "item_id", "left_semi")


def unit_series(t: StoreTables, as_of, history: int = UNIT_HISTORY) -> DataFrame:
    """(year, month, t, label): units per whole month before as_of's month."""
    s = fc.monthly_series(_lines_in_history(t, as_of, history), "date", F.col("quantity"), as_of, history)
    return fc.number_months(s).select("year", "month", "t", F.col("label").cast("double").alias("label"))


def sales_predictions(t: StoreTables, as_of, history: int = UNIT_HISTORY,
                      horizon: int = fc.HORIZON) -> DataFrame:
    """(month, year, sales): trend forecast, nearest integer, floored at 0."""
    model = fc.fit_trend(unit_series(t, as_of, history))
    pred = fc.trend_forecast(model, as_of, horizon)
    v = fc.nearest_int(F.col("prediction"))
    return pred.select("month", "year", F.greatest(v, F.lit(0)).alias("sales"))


def _item_series(t: StoreTables, as_of, history: int) -> tuple[DataFrame, DataFrame]:
    """(series with item_idx, the item index itself)."""
    # persisted: the index (a checkpointed job) and the join both read the sums
    s = hold(_units_per_item_month(t, as_of, history))
    items = dense_index(s.select("item_id").distinct(), ["item_id"], "item_idx")
    series = (s.join(items, "item_id")
              .select("year", "month", "item_id", "item_idx", F.col("label").cast("double").alias("label")))
    return series, items


def unit_series_by_item(t: StoreTables, as_of, history: int = KEYED_HISTORY) -> DataFrame:
    """(year, month, item_id, item_idx, label): units per whole month and item.

    The item index is a dense rank of the item id computed without a
    single-partition window (see ``dense_index``).
    """
    return _item_series(t, as_of, history)[0]


def _item_horizon(t: StoreTables, items: DataFrame, as_of, horizon: int) -> DataFrame:
    keys = items.join(t.item.select(F.col("id").alias("item_id"), "title"), "item_id", "left")
    return fc.keyed_horizon(keys, as_of, horizon)


def horizon_by_item(t: StoreTables, as_of, history: int = KEYED_HISTORY, horizon: int = fc.HORIZON) -> DataFrame:
    """(month, year, item_id, item_idx, title): the rows the item model scores."""
    return _item_horizon(t, _item_series(t, as_of, history)[1], as_of, horizon).select(
        "month", "year", "item_id", "item_idx", "title")


def horizon_by_profile(profile_map: DataFrame, as_of, horizon: int = fc.HORIZON) -> DataFrame:
    """(month, year, profile_id, categories): the rows the profile model scores;
    every profile of the map, also one without sales in the window."""
    cats = profile_map.groupBy("profile_id").agg(F.first("categories").alias("categories"))
    return fc.keyed_horizon(cats, as_of, horizon).select("month", "year", "profile_id", "categories")


def sales_predictions_by_item(t: StoreTables, as_of, history: int = KEYED_HISTORY,
                              horizon: int = fc.HORIZON) -> DataFrame:
    """(month, year, itemId, itemName, sales): one model over (month, year, item index).

    The horizon's keys come from the item index (one row per item), not from
    a distinct over the months x items series.
    """
    series, items = _item_series(t, as_of, history)
    model = fc.fit_keyed(hold(series), ["month", "year", "item_idx"])
    scored = model.transform(_item_horizon(t, items, as_of, horizon))
    return scored.select("month", "year", F.col("item_id").alias("itemId"),
                         F.col("title").alias("itemName"),
                         fc.nearest_int(F.col("prediction")).alias("sales"))


def unit_series_by_state(t: StoreTables, as_of, history: int = KEYED_HISTORY) -> DataFrame:
    """(year, month, state, state_idx, label) over all states (no state filter)."""
    cust = t.customer.select(F.col("id").alias("_cid"), "state")
    li = _lines_in_history(t, as_of, history).join(cust, F.col("customer_id") == F.col("_cid"))
    s = fc.monthly_series(li, "date", F.col("quantity"), as_of, history, keys=["state"])
    # months x states rows: the index is a window on them
    return (rank_on(s, ["state"], "state_idx")
            .select("year", "month", "state", "state_idx", F.col("label").cast("double").alias("label")))


def sales_predictions_by_state(t: StoreTables, as_of, history: int = KEYED_HISTORY,
                               horizon: int = fc.HORIZON) -> DataFrame:
    """Flat (month, year, state, sales, abbreviation); one model for all states."""
    series = hold(unit_series_by_state(t, as_of, history))
    model = fc.fit_keyed(series, ["month", "year", "state_idx"])
    sm = t.state_map.select(F.col("name").alias("state"), "abbreviation")
    keys = series.select("state", "state_idx").distinct().join(sm, "state", "left")
    scored = model.transform(fc.keyed_horizon(keys, as_of, horizon))
    return scored.select("month", "year", "state", fc.nearest_int(F.col("prediction")).alias("sales"),
                         state_code(F.col("abbreviation")).alias("abbreviation"))


def sales_predictions_by_state_document(t: StoreTables, as_of, **kw) -> DataFrame:
    """(month, year, statesSales array) -- the reference's nested form."""
    return nest_by_month(sales_predictions_by_state(t, as_of, **kw),
                         ["state", "sales", "abbreviation"], "statesSales")


def unit_series_by_profile(t: StoreTables, profile_map: DataFrame, as_of,
                           history: int = KEYED_HISTORY) -> DataFrame:
    """(year, month, profile_id, label): units per whole month and item profile."""
    pm = profile_map.select("item_id", "profile_id")
    per_item = _units_per_item_month(t, as_of, history)
    return (per_item.join(pm, "item_id").groupBy("year", "month", "profile_id")
            .agg(F.sum("label").cast("double").alias("label")))


def sales_predictions_by_item_profile(t: StoreTables, profile_map: DataFrame, as_of,
                                      history: int = KEYED_HISTORY, horizon: int = fc.HORIZON,
                                      n: int = TOP_PROFILES) -> DataFrame:
    """Flat (month, year, itemProfileId, sales, categories): per month the n
    profiles with the largest forecast (ties by profile id).

    The ranking window is partitioned by (year, month): 12 partitions of at
    most #profiles rows each, bounded by the profile count k.
    """
    series = hold(unit_series_by_profile(t, profile_map, as_of, history))
    model = fc.fit_keyed(series, ["month", "year", "profile_id"])
    scored = model.transform(horizon_by_profile(profile_map, as_of, horizon)) \
        .withColumn("sales", fc.nearest_int(F.col("prediction")))
    w = Window.partitionBy("year", "month").orderBy(F.col("sales").desc(), F.col("profile_id").asc())
    return (scored.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
            .select("month", "year", F.col("profile_id").alias("itemProfileId"), "sales", "categories"))


def sales_predictions_by_item_profile_document(t: StoreTables, profile_map: DataFrame, as_of,
                                               **kw) -> DataFrame:
    """(month, year, item_profile_sales: array<struct(itemProfileId, sales, categories)>),
    the list ordered by forecast descending (ties by profile id); at most n per month."""
    flat = sales_predictions_by_item_profile(t, profile_map, as_of, **kw)
    packed = (flat.groupBy("month", "year")
              .agg(F.sort_array(F.collect_list(F.struct(
                  (-F.col("sales")).alias("_neg"), "itemProfileId", "sales", "categories"))).alias("_l")))
    return packed.select("month", "year", F.transform("_l", lambda r: F.struct(
        r["itemProfileId"].alias("itemProfileId"), r["sales"].alias("sales"),
        r["categories"].alias("categories"))).alias("item_profile_sales"))
