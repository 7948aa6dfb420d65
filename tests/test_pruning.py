"""Date windows reach the line scan as a range of order ids."""

from __future__ import annotations

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from cartwise.operators import recommend as rc
from cartwise.operators import stock as st
from store_fixtures import AS_OF, D, item_row, make_tables

N = 40_000


def scans(plan) -> list:
    """The scan nodes of an executed plan."""
    name = plan.nodeName()
    if "AdaptiveSparkPlan" in name:
        return scans(plan.executedPlan())
    if "QueryStage" in name:
        return scans(plan.plan())
    found = [plan] if name.startswith("Scan parquet") else []
    children = plan.children().iterator()
    while children.hasNext():
        found += scans(children.next())
    return found


def line_scans(df) -> list:
    df.collect()
    return [s for s in scans(df._jdf.queryExecution().executedPlan()) if "order_id" in s.simpleString(10_000)]


@pytest.fixture(scope="module", params=["ascending", "random"])
def store(spark, tmp_path_factory, request):
    """Four years of orders, one to three lines each; ids follow time, or don't. Lines lie in many row groups by id."""
    folder = str(tmp_path_factory.mktemp("store"))
    ids = list(range(N))
    if request.param == "random":
        random.Random(1).shuffle(ids)
    orders = [(ids[i], i % 7, D("1997-07-15"), float(i % 5)) for i in range(N)]
    t = make_tables(spark, customers=[(c, "n", None, "F", "Ohio") for c in range(7)], items=[item_row(i) for i in range(9)])
    dated = spark.createDataFrame([(o[0], o[1], i, o[3]) for i, o in enumerate(orders)], "id bigint, customer_id bigint, i int, totalPrice double")
    order = dated.select("id", "customer_id", F.date_add(F.lit(D("1997-07-15")), F.floor(F.col("i") * 1500 / N).cast("int")).alias("date"), "totalPrice")
    order.write.parquet(f"{folder}/order")
    lines = (spark.range(N).select(F.col("id").alias("order_id"), F.explode(F.sequence(F.lit(0), F.col("id") % 3)).alias("k"))
             .select("order_id", F.pmod(F.xxhash64("order_id", "k"), F.lit(9)).alias("item_id"), (F.col("k") + 1).cast("int").alias("quantity")))
    lines.coalesce(1).sortWithinPartitions("order_id").write.option("parquet.block.size", str(64 << 10)).parquet(f"{folder}/lines")
    plain = dataclasses.replace(t, order=spark.read.parquet(f"{folder}/order"), ordereditem=spark.read.parquet(f"{folder}/lines"))
    return request.param, plain


JOBS = {"most_sold": rc.most_sold, "unit_series": st.unit_series, "unit_series_by_state": st.unit_series_by_state,
        "stock_monthly": st.stock_monthly, "stock_top_products": st.stock_top_products}


@pytest.mark.parametrize("job", JOBS)
def test_range_reaches_the_line_scan(store, job):
    kind, t = store
    df = JOBS[job](t, AS_OF)
    found = line_scans(df)
    assert found
    total = t.ordereditem.count()
    for scan in found:
        text = scan.simpleString(10_000)
        assert "GreaterThanOrEqual(order_id" in text and "LessThanOrEqual(order_id" in text
        read = scan.metrics().apply("numOutputRows").value()
        if kind == "ascending" and job == "most_sold":
            assert 0 < read < total / 4              # six months of four years
        elif kind == "ascending" and job != "unit_series_by_state":
            assert read < total * 0.75               # two years, and what came after them
        elif kind == "random":
            assert read > total * 0.9


@pytest.mark.parametrize("job", JOBS)
def test_same_result_without_the_range(store, job, monkeypatch):
    _, t = store
    got = sorted(map(tuple, JOBS[job](t, AS_OF).collect()))
    for module in (rc, st):
        monkeypatch.setattr(module, "lines_in_key_range", lambda lines, orders: lines)
    assert got and got == sorted(map(tuple, JOBS[job](t, AS_OF).collect()))


def test_window_without_orders(spark, store):
    _, t = store
    assert rc.most_sold(t, D("1990-01-01")).count() == 0
    assert st.unit_series(t, D("1990-01-01")).count() == 0
