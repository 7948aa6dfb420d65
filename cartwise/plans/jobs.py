"""Run the store's jobs end to end: each job replaces its output collection.

The reference runs one job per request and each job replaces one document
collection (two for the item profiles); three jobs read the item-profile map
written by another, and the recommender reads the saved ALS model. This module
keeps that data flow with Spark writers and readers under one output folder,
where every collection is a folder of snapshots (``sources/snapshots.py``):

    python -m cartwise.plans.jobs --tables /data/store --out /data/collections \
        --as-of 2001-07-15 [job ...]

Jobs run in dependency order; a reader job finds its input in ``--out``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwise.functions import holding
from cartwise.operators import customers as cu
from cartwise.operators import finances as fi
from cartwise.operators import items as it
from cartwise.operators import recommend as rc
from cartwise.operators import stock as st
from cartwise.session import get_session, size_for_input
from cartwise.sources import layout as colocated_layout
from cartwise.sources import sinks
from cartwise.sources.tables import STORE_TABLES, StoreTables, load_store_jdbc, load_store_parquet, load_tables

PROFILE_MAP = "item_profile_item_id_map"
ALS_MODEL = "collaborative_filtering_model"
RECOMMENDATIONS = "collaborative_filtering_recommendations"
RESPONSES = "collaborative_filtering_responses"


class JobContext:
    def __init__(self, spark: SparkSession, tables: StoreTables, out_dir: str, as_of: dt.date,
                 users: DataFrame | None = None):
        self.spark, self.t, self.out, self.as_of, self.users = spark, tables, out_dir.rstrip("/"), as_of, users

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def read(self, name: str) -> DataFrame:
        return sinks.read_collection(self.spark, self.path(name))

    def replace(self, name: str, df: DataFrame) -> None:
        sinks.replace_collection(df, self.path(name))


def _item_profiles(c: JobContext) -> None:
    profiles, profile_map = it.item_profiles(c.t)
    # both tables come from one fitted model; readers of the map run later
    c.replace(PROFILE_MAP, profile_map)
    c.replace("item_profiles", profiles)


def _collaborative_filtering(c: JobContext) -> None:
    rc.train_collaborative_filtering(c.t, path=c.path(ALS_MODEL), recommendations_path=c.path(RECOMMENDATIONS))


def _recommend(c: JobContext) -> None:
    if c.users is None:
        raise ValueError("recommend_products needs a request: the customers to recommend for (--user or --users)")
    recommender = rc.Recommender.load(c.spark, c.path(ALS_MODEL))
    rc.recommend_products(recommender, c.t, c.users, path=c.path(RECOMMENDATIONS),
                          json_path=c.path(RESPONSES))


# job name -> job; the order is the dependency order
JOBS: dict[str, Callable[[JobContext], None]] = {
    "best_reviewers": lambda c: c.replace("best_reviewers", cu.best_reviewers(c.t)),
    "customers_overview": lambda c: c.replace("customer_overview", cu.customers_overview(c.t, c.as_of)),
    "item_profiles": _item_profiles,
    "customer_segmentation_age_and_brand": lambda c: c.replace(
        "customer_segmentation_age_and_brand", cu.segments_age_brand(c.t, c.as_of)),
    "customer_segmentation_age_and_item_profile": lambda c: c.replace(
        "customer_segmentation_age_and_item_profile", cu.segments_age_profile(c.t, c.read(PROFILE_MAP), c.as_of)),
    "also_bought": lambda c: rc.write_also_bought(c.t, c.path("also_bought_recommender")),
    "best_reviewed": lambda c: c.replace("best_reviewed_during_last_six_months", rc.best_reviewed(c.t, c.as_of)),
    "most_sold": lambda c: c.replace("most_sold_during_last_six_months", rc.most_sold(c.t, c.as_of)),
    "item_profile_recommender": lambda c: (
        c.replace("item_profile_recommender", rc.item_profile_recommender(c.read(PROFILE_MAP))),
        c.replace("item_profile_members", rc.profile_members(c.read(PROFILE_MAP)))),
    "collaborative_filtering": _collaborative_filtering,
    "recommend_products": _recommend,
    "finances_overview": lambda c: c.replace("finances_overview", fi.finances_overview(c.t, c.as_of)),
    "sales_value_predictions": lambda c: c.replace(
        "sales_value_predictions", fi.sales_value_predictions(c.t, c.as_of)),
    "sales_value_predictions_by_state": lambda c: c.replace(
        "sales_value_predictions_by_state", fi.sales_value_predictions_by_state_document(c.t, c.as_of)),
    "stock_overview": lambda c: c.replace("stock_overview", st.stock_overview(c.t, c.as_of)),
    "sales_predictions": lambda c: c.replace("sales_predictions", st.sales_predictions(c.t, c.as_of)),
    "sales_predictions_by_item": lambda c: c.replace(
        "sales_predictions_by_item", st.sales_predictions_by_item(c.t, c.as_of)),
    "sales_predictions_by_state": lambda c: c.replace(
        "sales_predictions_by_state", st.sales_predictions_by_state_document(c.t, c.as_of)),
    "sales_predictions_by_item_profile": lambda c: c.replace(
        "sales_predictions_by_item_profiles",
        st.sales_predictions_by_item_profile_document(c.t, c.read(PROFILE_MAP), c.as_of)),
}


def run(spark: SparkSession, tables_dir: str, out_dir: str, as_of: dt.date,
        names: list[str] | None = None, users: DataFrame | None = None,
        layout: str = "testdata", colocate: tuple[str, int] | None = None,
        jdbc: dict[str, str] | None = None, size: bool = False, source_version: str | None = None) -> list[str]:
    """Run the named jobs (all by default) in dependency order; return their names.

    ``users`` is the request that ``recommend_products`` answers; without one
    that job is left out, unless it is named.

    ``layout`` "store" reads the store's own tables from ``tables_dir``;
    "testdata" adapts the benchmark's star schema. ``colocate`` = (folder,
    buckets) reads orders and order lines from a bucketed copy in ``folder``,
    writing it first unless one of this very source is there and complete (see
    ``sources/layout.py``); ``source_version`` names the state of a source that has no
    files to tell it from, a database. ``jdbc`` (url and connection properties) reads the
    store's tables from its database instead. ``size`` sets shuffle partitions
    and scan splits by the size of this run's input.
    """
    unknown = set(names or []) - set(JOBS)
    if unknown:
        raise ValueError(f"unknown jobs: {sorted(unknown)}")
    sources: list[str] = []
    if jdbc:
        if colocate and not source_version:
            raise ValueError("a co-located copy of a database needs a source_version")
        properties = dict(jdbc)
        tables = load_store_jdbc(spark, properties.pop("url"), properties)
    else:
        sources = [f"{tables_dir.rstrip('/')}/{n}" for n in (
            ("order_", "ordereditem") if layout == "store" else ("orders.parquet", "lineitem.parquet"))]
        tables = load_store_parquet(spark, tables_dir) if layout == "store" else load_tables(spark, tables_dir)
        if size:
            size_for_input(spark, [f"{tables_dir.rstrip('/')}/{n}" for n in (
                STORE_TABLES if layout == "store" else [f"{x}.parquet" for x in ("lineitem", "orders", "part", "customer")])])
    if colocate:
        folder, buckets = colocate
        version = source_version or colocated_layout.source_version(spark, sources)
        if not colocated_layout.is_complete(spark, folder, buckets, version):
            colocated_layout.write_colocated(tables, folder, buckets, version, None if source_version else sources)
        tables = colocated_layout.load_colocated(spark, tables, folder, buckets, version)
    ctx = JobContext(spark, tables, out_dir, as_of, users)
    chosen = [n for n in JOBS if (n in names if names else n != "recommend_products" or users is not None)]
    for name in chosen:
        with holding.scope():    # what the job's operators hold goes, also after an error; other frames stay
            JOBS[name](ctx)
    return chosen


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--tables", help="folder of the input parquet tables")
    ap.add_argument("--jdbc", metavar="URL", help="read the store's tables from this database (its driver on the classpath)")
    ap.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE",
                    help="connection property, such as user=..., repeatable")
    ap.add_argument("--users", help="parquet folder with the customer_id of the customers to recommend for")
    ap.add_argument("--out", required=True, help="folder of the output collections")
    ap.add_argument("--as-of", default=dt.date.today().isoformat(), help="the job's 'today' (YYYY-MM-DD)")
    ap.add_argument("--layout", choices=["store", "testdata"], default="store",
                    help="store: the store's own tables; testdata: the benchmark star schema")
    ap.add_argument("--user", type=int, action="append", help="recommend for these customers only")
    ap.add_argument("--colocate-into", help="folder for orders and lines bucketed by order id")
    ap.add_argument("--source-version", help="state of the source that a co-located copy is made of; needed with --jdbc")
    ap.add_argument("--buckets", type=int, default=1024, help="bucket count of the co-located copy")
    ap.add_argument("jobs", nargs="*", help=f"jobs to run (default all): {', '.join(JOBS)}")
    a = ap.parse_args(argv)
    if not a.tables and not a.jdbc:
        ap.error("either --tables or --jdbc is needed")
    spark = get_session(os.environ.get("CARTWISE_MASTER"))
    users = None
    if a.users:
        users = spark.read.parquet(a.users)
    if a.user:
        users = spark.createDataFrame([(u,) for u in a.user], "customer_id bigint")
    colocate = (a.colocate_into, a.buckets) if a.colocate_into else None
    jdbc = {"url": a.jdbc, **dict(p.split("=", 1) for p in a.jdbc_property)} if a.jdbc else None
    done = run(spark, a.tables, a.out, dt.date.fromisoformat(a.as_of), a.jobs or None, users, a.layout,
               colocate, jdbc, size=True, source_version=a.source_version)
    print(" ".join(done))


if __name__ == "__main__":
    main()
