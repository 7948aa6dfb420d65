"""The bucketed layout removes the exchanges of the line-order join."""

from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from cartwise.operators import recommend as rc
from cartwise.operators import stock as st
from cartwise.sources import layout
from cartwise.sources.tables import load_tables
from store_fixtures import AS_OF, D, item_row, make_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="no test data")


def forget(spark, folder, buckets, version="1"):
    for name in layout._names(layout.copy_folder(str(folder), buckets, version)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_colocated_join_has_no_exchange_and_same_result(spark, tmp_path):
    t = load_tables(spark, SF)
    layout.write_colocated(t, str(tmp_path / "b"), buckets=4, version="1")
    forget(spark, tmp_path / "b", 4)          # as a new application would see it
    b = layout.load_colocated(spark, t, str(tmp_path / "b"), buckets=4, version="1")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the sort-merge join
    try:
        joined = b.ordereditem.join(b.order, F.col("order_id") == F.col("id"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        for fn in (st.unit_series, st.unit_series_by_item, st.stock_monthly_by_state, st.stock_top_products,
                   rc.most_sold):
            got = sorted(map(tuple, fn(b, AS_OF).collect()))
            want = sorted(map(tuple, fn(t, AS_OF).collect()))
            assert got == want, fn.__name__
        pairs = lambda tt: sorted(map(tuple, rc.also_bought_pairs(tt).collect()))
        assert pairs(b) == pairs(t)        # lines without a window are all kept
        # the six-month window prunes line partitions at the scan
        scan = [line for line in rc.most_sold(b, AS_OF)._jdf.queryExecution().executedPlan().toString()
                .split("\n") if "FileScan" in line and "order_month" in line]
        assert scan and "PartitionFilters: [isnotnull(order_month" in scan[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        forget(spark, tmp_path / "b", 4)


def test_copies_side_by_side(spark, tmp_path):
    for name, quantity in (("a", 3), ("b", 4)):
        t = make_tables(spark, orders=[(1, 1, D("2001-01-10"), 1.0)], lines=[(1, 1, quantity)], items=[item_row(1)])
        layout.write_colocated(t, str(tmp_path / name), buckets=2, version="1")
    for name, quantity in (("a", 3), ("b", 4), ("a", 3)):
        got = layout.load_colocated(spark, t, str(tmp_path / name), buckets=2, version="1")
        assert [r.quantity for r in got.ordereditem.collect()] == [quantity]
    for name in "ab":
        forget(spark, tmp_path / name, 2)


def test_half_written_copy_is_not_ready(spark, tmp_path):
    t = load_tables(spark, SF)
    folder = str(tmp_path / "b")
    layout.write_colocated(t, folder, buckets=2, version="1")
    assert layout.is_complete(spark, folder, 2, "1") and not layout.is_complete(spark, folder, 4, "1")
    assert not layout.is_complete(spark, folder, 2, version="2")
    os.rename(os.path.join(layout.copy_folder(folder, 2, "1"), "complete"), str(tmp_path / "elsewhere"))
    with pytest.raises(FileNotFoundError):
        layout.load_colocated(spark, t, folder, buckets=2, version="1")
    layout.write_colocated(t, folder, buckets=2, version="1")        # written again over the rest
    got = layout.load_colocated(spark, t, folder, buckets=2, version="1")
    assert got.ordereditem.count() == t.ordereditem.count()
    forget(spark, folder, 2)


def test_files_of_a_copy_are_bounded(spark, tmp_path):
    t = load_tables(spark, SF)
    t = dataclasses.replace(t, order=t.order.repartition(9), ordereditem=t.ordereditem.repartition(9))
    layout.write_colocated(t, str(tmp_path / "b"), buckets=3, version="1")
    place = layout.copy_folder(str(tmp_path / "b"), 3, "1")
    files = lambda d: [f for f in os.listdir(d) if f.endswith(".parquet")]
    assert len(files(f"{place}/order")) <= 3
    months = [d for d in os.listdir(f"{place}/ordereditem") if d.startswith("order_month")]
    assert months and all(len(files(f"{place}/ordereditem/{m}")) <= 3 for m in months)
    forget(spark, tmp_path / "b", 3)


def test_lines_without_an_order_stay_in_the_copy(spark, tmp_path):
    # order 9 does not exist: its lines get a null month but still pair up
    t = make_tables(spark, orders=[(1, 1, D("2001-01-10"), 1.0)],
                    lines=[(1, 1, 2), (1, 2, 3), (9, 1, 4), (9, 3, 5)],
                    items=[item_row(i) for i in (1, 2, 3)])
    try:
        layout.write_colocated(t, str(tmp_path / "b"), buckets=2, version="1")
        b = layout.load_colocated(spark, t, str(tmp_path / "b"), buckets=2, version="1")
        assert b.ordereditem.count() == 4
        got = sorted((r.item_id, r.r_item_id, r.quantity) for r in rc.also_bought_pairs(b).collect())
        assert got == [(1, 2, 3), (1, 3, 5), (2, 1, 2), (3, 1, 4)]
    finally:
        forget(spark, tmp_path / "b", 2)


def test_version_follows_the_source_files(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.range(5).write.parquet(path)
    first = layout.source_version(spark, [path])
    assert first == layout.source_version(spark, [path + "/"])
    spark.range(5).write.mode("append").parquet(path)           # a file more
    second = layout.source_version(spark, [path])
    spark.range(6, 16).write.mode("overwrite").parquet(path)    # other files
    third = layout.source_version(spark, [path])
    part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    os.utime(f"{path}/{part}", (1, 1))                          # the same file, written at another time
    assert len({first, second, third, layout.source_version(spark, [path])}) == 4
    spark.range(5).write.parquet(str(tmp_path / "lines"))
    assert layout.source_version(spark, [path, str(tmp_path / "lines")]) != layout.source_version(spark, [path])


def test_copy_of_a_source_that_changed_meanwhile_is_not_complete(spark, tmp_path):
    t = make_tables(spark, orders=[(1, 1, D("2001-01-10"), 1.0)], lines=[(1, 1, 1)], items=[item_row(1)])
    path, folder = str(tmp_path / "source"), str(tmp_path / "b")
    spark.range(3).write.parquet(path)
    with pytest.raises(RuntimeError, match="changed"):
        layout.write_colocated(t, folder, 2, "of-before", [path])
    assert not layout.is_complete(spark, folder, 2, "of-before")
    now = layout.source_version(spark, [path])
    layout.write_colocated(t, folder, 2, now, [path])
    assert layout.is_complete(spark, folder, 2, now)
    for version in ("of-before", now):
        forget(spark, folder, 2, version)
