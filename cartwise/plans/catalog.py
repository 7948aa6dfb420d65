"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the whole parquet tables of ``sf_dir`` through
``load_tables`` and runs at the fixed as-of date. Queries whose result is a
flat relation have a DuckDB twin in ``cartwise.plans.oracle``; the model-based
ones (KMeans, ALS, multi-feature regression) and the nested documents are
checked by row counts and invariants instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.calendar import DEFAULT_AS_OF
from cartwise.functions.holding import hold
from cartwise.operators import clusters as cl
from cartwise.operators import customers as cu
from cartwise.operators import finances as fi
from cartwise.operators import items as it
from cartwise.operators import recommend as rc
from cartwise.operators import stock as st
from cartwise.operators.documents import unnested
from cartwise.sources.tables import StoreTables, load_tables

AS_OF = DEFAULT_AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(fn: Callable[[StoreTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_tables(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


# ---- rows read back out of the documents themselves


def _overview_rows(document: DataFrame, *lists: str) -> DataFrame:
    return unnested(document.select(lists[0]), *lists)


def _customers_overview_means(t: StoreTables) -> DataFrame:
    return cu.customers_overview(t, AS_OF).select("average_age", "average_age_male", "average_age_female")


# ---- what SQL can tell of a model's own output


def _item_profile_map_items(t: StoreTables) -> DataFrame:
    """The clustered items with their attributes; which profile they got is the model's."""
    return it.item_profiles(t)[1].select("item_id", "item_brand", "item_description", "item_imUrl", "item_title", "item_price")


def _item_profiles_total(t: StoreTables) -> DataFrame:
    """Items over all profiles, and that every profile has some."""
    return it.item_profiles(t)[0].agg(F.sum("number_items").alias("number_items"), (F.min("number_items") > 0).alias("none_empty"))


def _segment_total(segments: DataFrame) -> DataFrame:
    """Customers over all segments, and that there are no more than k."""
    return segments.agg(F.sum("number_customers").alias("number_customers"), (F.count("*") <= cu.BRAND_K).alias("at_most_k"))


# ---- the models' reports on clusters that SQL can form too


def _coordinates(feats: DataFrame, prediction: Column) -> DataFrame:
    """(prediction, pos, value): every coordinate of every vector."""
    return feats.select(prediction.alias("prediction"), F.posexplode(vector_to_array("features")).alias("pos", "value"))


def _customer_clusters(feats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Customers by id modulo k; a centroid has the largest value of each coordinate (exact in any order of summing)."""
    which = F.pmod("customer_id", F.lit(cu.BRAND_K)).cast("int")
    cent = _coordinates(feats, which).groupBy("prediction", "pos").agg(F.max("value").alias("weight"))
    return feats.select("customer_id", which.alias("prediction")), cent


def _brand_vectors(t: StoreTables) -> tuple[DataFrame, DataFrame, int]:
    shares = hold(cu.customer_brand_shares(t, AS_OF))
    vocab = cl.vocabulary(shares, "brand")
    n = cl.vocab_size(vocab)
    return cl.share_vectors(shares, vocab, "brand", "customer_id", n), vocab, n


def _brand_vector_slots(t: StoreTables) -> DataFrame:
    """The coordinates of the brand segmentation's vectors that are not 0."""
    return _coordinates(_brand_vectors(t)[0].withColumnRenamed("customer_id", "_id"), F.col("_id")).filter(
        "value <> 0").withColumnRenamed("prediction", "customer_id")


def _segments_age_brand_fixed(t: StoreTables) -> DataFrame:
    feats, vocab, n = _brand_vectors(t)
    report = cu.brand_report(*_customer_clusters(feats), vocab, n)
    return report.withColumn("brands", F.array_join("brands", "|"))


def _segments_age_profile_fixed(t: StoreTables) -> DataFrame:
    profile_map = it.fixed_profile_map(t)
    shares = hold(cu.customer_profile_shares(t, profile_map, AS_OF))
    vocab = cl.vocabulary(shares, "profile_id")
    n = cl.vocab_size(vocab)
    feats = cl.share_vectors(shares, vocab, "profile_id", "customer_id", n)
    report = cu.profile_report(*_customer_clusters(feats), vocab, profile_map, n)
    return report.withColumn("categories", F.array_join("categories", "|"))


def _item_reports_fixed(t: StoreTables) -> tuple[DataFrame, DataFrame]:
    """Items by their first category; a centroid is the mean vector (sums of ones, exact in any order)."""
    feats, vocab = it.item_vectors(t)
    which = F.array_position(vector_to_array("features"), 1.0).cast("int") - 1
    cent = _coordinates(feats, which).groupBy("prediction", "pos").agg((F.sum("value") / F.count("*")).alias("weight"))
    return it.profile_reports(t, feats.select("item_id", which.alias("prediction")), cent, vocab)


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("categories", F.array_join("categories", "|"))


def _asked_users(t: StoreTables) -> DataFrame:
    """The registered request: every hundredth customer."""
    return t.customer.filter(F.col("id") % 100 == 0).select(F.col("id").alias("customer_id"))


def _recommend_products_fixed(t: StoreTables) -> DataFrame:
    """Recommendations from factors that follow from the ids, in halves and quarters: sums are exact."""
    c, i = F.col("id"), F.col("id")
    exact = lambda *x: F.array(*[v.cast("double") for v in x])
    user = t.customer.select(c.cast("int").alias("id"), exact(c % 3, c % 2, F.lit(1)).alias("features"))
    item = t.item.select(i.cast("int").alias("id"), exact((i % 4) * 0.5, i % 3, (i % 5) * 0.25).alias("features"))
    return rc.recommend_from_factors(
        user, item, t.customer.select(c.alias("customer_id"), c.cast("int").alias("user_idx")),
        t.item.select(i.alias("item_id"), i.cast("int").alias("item_idx")), t, _asked_users(t))


def _recommended(t: StoreTables) -> DataFrame:
    return rc.recommend_products_flat(rc.train_collaborative_filtering(t), t, _asked_users(t))


def _recommendations(t: StoreTables) -> DataFrame:
    return rc.recommend_products(rc.train_collaborative_filtering(t), t, _asked_users(t))


def _profile_recommender_fixed(t: StoreTables) -> DataFrame:
    r = rc.item_profile_recommender(it.fixed_profile_map(t))
    return r.select("item_id", F.array_join("categories", "|").alias("categories"), "profile_id", "n_items")


def _item_profiles(t: StoreTables) -> DataFrame:
    return it.item_profiles(t)[0]


def _item_profile_map(t: StoreTables) -> DataFrame:
    return it.item_profiles(t)[1]


def _segments_age_profile(t: StoreTables) -> DataFrame:
    pm = hold(it.item_profiles(t)[1])
    return cu.segments_age_profile(t, pm, AS_OF)


def _sales_predictions_by_item_profile(t: StoreTables) -> DataFrame:
    pm = hold(it.item_profiles(t)[1])
    return st.sales_predictions_by_item_profile(t, pm, AS_OF)


def queries() -> dict[str, Query]:
    a = AS_OF
    exact: dict[str, Callable[[StoreTables], DataFrame]] = {
        "finances_monthly": lambda t: fi.finances_monthly(t, a),
        "finances_monthly_by_state": lambda t: fi.finances_monthly_by_state(t, a),
        "stock_monthly": lambda t: st.stock_monthly(t, a),
        "stock_monthly_by_state": lambda t: st.stock_monthly_by_state(t, a),
        "stock_top_products": lambda t: st.stock_top_products(t, a),
        "best_reviewers": lambda t: cu.best_reviewers(t),
        "customers_mean_age": lambda t: cu.customers_mean_age(t, a),
        "customers_age_by_state": lambda t: cu.customers_age_by_state(t, a),
        "customers_by_state": lambda t: cu.customers_by_state(t, a),
        "customer_brand_shares": lambda t: cu.customer_brand_shares(t, a),
        "customer_profile_shares_fixed": lambda t: cu.customer_profile_shares(t, it.fixed_profile_map(t), a),
        "item_category_features": lambda t: it.item_category_features(t),
        "also_bought_pairs": lambda t: rc.also_bought_pairs(t),
        "most_sold_6m": lambda t: rc.most_sold(t, a),
        "best_reviewed_6m": lambda t: rc.best_reviewed(t, a),
        "profile_recommender_fixed": _profile_recommender_fixed,
        "value_series": lambda t: fi.value_series(t, a),
        "unit_series": lambda t: st.unit_series(t, a),
        "value_series_by_state": lambda t: fi.value_series_by_state(t, a),
        "unit_series_by_state": lambda t: st.unit_series_by_state(t, a),
        "unit_series_by_item": lambda t: st.unit_series_by_item(t, a),
        "unit_series_by_profile_fixed": lambda t: st.unit_series_by_profile(t, it.fixed_profile_map(t), a),
        "forecast_horizon_by_state": lambda t: fi.forecast_horizon_by_state(t, a),
        "sales_value_predictions": lambda t: fi.sales_value_predictions(t, a),
        "sales_predictions": lambda t: st.sales_predictions(t, a),
        # the documents of the overviews and of also-bought, unnested
        "customers_overview_means": _customers_overview_means,
        "customers_overview_ages": lambda t: _overview_rows(cu.customers_overview(t, a), "average_age_by_state"),
        "customers_overview_totals": lambda t: _overview_rows(cu.customers_overview(t, a), "customers_by_state"),
        "finances_overview_monthly": lambda t: _overview_rows(fi.finances_overview(t, a), "monthly_sales"),
        "finances_overview_by_state": lambda t: _overview_rows(
            fi.finances_overview(t, a), "monthly_sales_by_state", "statesSales"),
        "stock_overview_monthly": lambda t: _overview_rows(st.stock_overview(t, a), "monthly_sales"),
        "stock_overview_by_state": lambda t: _overview_rows(st.stock_overview(t, a), "monthly_sales_by_state", "statesSales"),
        "stock_overview_top_products": lambda t: _overview_rows(st.stock_overview(t, a), "top_products"),
        "also_bought_rows": lambda t: rc.also_bought_rows(rc.also_bought(t)),
        # around the models
        "profile_members_fixed": lambda t: rc.profile_members(it.fixed_profile_map(t)),
        "item_profile_map_items": _item_profile_map_items,
        "item_profiles_total": _item_profiles_total,
        "segments_age_brand_total": lambda t: _segment_total(cu.segments_age_brand(t, a)),
        "segments_age_profile_total": lambda t: _segment_total(_segments_age_profile(t)),
        "brand_vector_slots": _brand_vector_slots,
        "segments_age_brand_fixed": _segments_age_brand_fixed,
        "segments_age_profile_fixed": _segments_age_profile_fixed,
        "item_profiles_fixed": lambda t: _joined(_item_reports_fixed(t)[0]),
        "item_profile_map_fixed": lambda t: _joined(_item_reports_fixed(t)[1]),
        "recommend_products_fixed": _recommend_products_fixed,
        "horizon_by_item": lambda t: st.horizon_by_item(t, a),
        "horizon_by_profile_fixed": lambda t: st.horizon_by_profile(it.fixed_profile_map(t), a).withColumn(
            "categories", F.array_join("categories", "|")),
        "als_ratings": lambda t: rc.ratings(t).withColumn("overall", F.col("overall").cast("double")),
        "sales_value_predictions_by_state_keys": lambda t: fi.sales_value_predictions_by_state(t, a).select(
            "month", "year", "state", "abbreviation"),
        "sales_predictions_by_state_keys": lambda t: st.sales_predictions_by_state(t, a).select(
            "month", "year", "state", "abbreviation"),
        "sales_predictions_by_item_keys": lambda t: st.sales_predictions_by_item(t, a).select(
            "month", "year", "itemId", "itemName"),
    }
    rows_only: dict[str, Callable[[StoreTables], DataFrame]] = {
        "customers_overview": lambda t: cu.customers_overview(t, a),
        "finances_overview": lambda t: fi.finances_overview(t, a),
        "stock_overview": lambda t: st.stock_overview(t, a),
        "also_bought": lambda t: rc.also_bought(t),
        "item_profiles": _item_profiles,
        "item_profile_map": _item_profile_map,
        "segments_age_brand": lambda t: cu.segments_age_brand(t, a),
        "segments_age_profile": _segments_age_profile,
        "sales_value_predictions_by_state": lambda t: fi.sales_value_predictions_by_state(t, a),
        "sales_predictions_by_state": lambda t: st.sales_predictions_by_state(t, a),
        "sales_predictions_by_item": lambda t: st.sales_predictions_by_item(t, a),
        "sales_predictions_by_item_profile": _sales_predictions_by_item_profile,
        "recommend_products": _recommended,
        "recommend_products_responses": _recommendations,
    }
    return {name: _on_tables(fn) for name, fn in {**exact, **rows_only}.items()}


def oracle_sql() -> dict[str, str]:
    from cartwise.plans.oracle import oracle_sql as _sql
    return _sql()
