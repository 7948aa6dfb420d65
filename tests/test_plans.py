"""Plans and results on what the test tables lack: null states, very large orders, several inputs."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cartwise.operators import finances as fi
from cartwise.operators import recommend as rc
from cartwise.operators import stock as st
from cartwise.session import size_for_input
from cartwise.sources.tables import load_tables
from store_fixtures import AS_OF, D, item_row, make_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="no test data")


@pytest.mark.parametrize("series, lines, orders", [
    (st.unit_series, 1, 1), (fi.value_series, 0, 1), (st.unit_series_by_state, 1, 1), (fi.value_series_by_state, 0, 1),
    (fi.forecast_horizon_by_state, 0, 1), (st.sales_predictions, 1, 1), (fi.sales_value_predictions, 0, 1)])
def test_monthly_series_read_their_tables_once(spark, series, lines, orders):
    frame = series(load_tables(spark, SF), AS_OF)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan[^\n]*lineitem\.parquet", final)) == lines
    assert len(re.findall(r"FileScan[^\n]*/orders\.parquet", final)) == orders


def test_null_states_keep_their_rows(spark):
    t = make_tables(spark, customers=[(1, "a", None, "M", None), (2, "b", None, "F", "Ohio"), (3, "c", None, "F", "Utah")],
                    orders=[(i, i, D("2001-03-05"), 10.0 * i) for i in (1, 2, 3)],
                    lines=[(i, 1, i) for i in (1, 2, 3)], items=[item_row(1)])
    values = [(r.state, r.state_idx, r.label) for r in fi.value_series_by_state(t, AS_OF).collect()]
    con = duckdb.connect()
    con.sql("CREATE TABLE s AS SELECT * FROM (VALUES (NULL, 10.0), ('Ohio', 20.0), ('Utah', 30.0)) v(state, label)")
    want = con.sql("SELECT state, DENSE_RANK() OVER (ORDER BY state NULLS FIRST) - 1, label::DOUBLE FROM s").fetchall()
    assert sorted(values, key=str) == sorted(want, key=str)
    units = {(r.state, r.state_idx, r.label) for r in st.unit_series_by_state(t, AS_OF).collect()}
    assert units == {(None, 0, 1.0), ("Ohio", 1, 2.0), ("Utah", 2, 3.0)}
    horizon = fi.forecast_horizon_by_state(t, AS_OF).collect()
    assert len(horizon) == 36 and {r.abbreviation for r in horizon if r.state is None} == {"US-DESC"}
    assert fi.sales_value_predictions_by_state(t, AS_OF).count() == 36


def test_both_sides_of_a_very_large_order_are_divided(spark):
    n, block = 400, 50
    t = make_tables(spark, lines=[(1, i, 1) for i in range(n)] + [(2, 1, 1), (2, 2, 1)], items=[item_row(i) for i in range(n)])
    pairs = rc.also_bought_pairs(t, block=block)
    assert pairs.count() == n * (n - 1)
    assert pairs.filter("quantity = 2").count() == 2
    # the join's inputs: a cell holds about a block of the order on either side
    per = t.ordereditem.groupBy("order_id", "item_id").count()
    r = n // block
    cells = (per.filter("order_id = 1").withColumn("b", F.pmod(F.xxhash64("item_id"), F.lit(r)))
             .groupBy("b").count().agg(F.max("count")).first()[0])
    assert cells < 2 * block < n


def test_sizing_follows_each_input(spark, monkeypatch):
    import cartwise.session as session

    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    old = {k: spark.conf.get(k) for k in keys}
    launched = spark.sparkContext.getConf()
    if launched.contains(keys[0]):
        monkeypatch.setattr(session, "_default", lambda s, k: old[k])
        monkeypatch.setattr(type(launched), "contains", lambda self, k: False)
    try:
        monkeypatch.setattr(session, "input_bytes", lambda s, p: 1 << 30)
        size_for_input(spark, ["small"])
        assert spark.conf.get(keys[0]) == "200"
        monkeypatch.setattr(session, "input_bytes", lambda s, p: 100 << 40)
        size_for_input(spark, ["large"])
        assert spark.conf.get(keys[0]) == "50000" and int(spark.conf.get(keys[1])) > 128 << 20
        spark.conf.set(keys[0], "77")       # the application's own choice stays
        size_for_input(spark, ["small"])
        assert spark.conf.get(keys[0]) == "77"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
            spark.conf.unset(f"cartwise.sized.{k}")
