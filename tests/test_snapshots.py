"""Collections and models are replaced as a whole or not at all."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from cartwise.operators import recommend as rc
from cartwise.sources import sinks
from cartwise.sources.snapshots import KEPT, Snapshots
from store_fixtures import D, item_row, make_tables


def values(spark, path: str) -> list:
    return sorted(tuple(r) for r in sinks.read_collection(spark, path).collect())


def test_failed_replacement_leaves_the_old_collection(spark, tmp_path):
    path = str(tmp_path / "c")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.replace_collection(good, path)
    bad = spark.range(100).repartition(4).select(F.col("id").cast("int").alias("id"), F.expr(
        "if(id = 77, raise_error('stop'), 'x')").alias("v"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_collection(bad, path)
    assert values(spark, path) == [(1, "a"), (2, "b")]
    sinks.replace_collection(good.limit(1), path)
    assert values(spark, path) == [(1, "a")]


def test_a_reader_of_the_old_collection_finishes(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.replace_collection(spark.range(10), path)
    opened = sinks.read_collection(spark, path)
    sinks.replace_collection(spark.range(3), path)
    assert opened.count() == 10 and sinks.read_collection(spark, path).count() == 3
    # a collection may be derived from itself
    sinks.replace_collection(sinks.read_collection(spark, path).selectExpr("id + 100 AS id"), path)
    assert values(spark, path) == [(100,), (101,), (102,)]


def test_old_snapshots_go_and_unfinished_newer_ones_stay(spark, tmp_path):
    path = str(tmp_path / "c")
    versions = Snapshots(spark, path)
    stale = versions.begin()
    spark.range(1).write.parquet(f"{stale}/data")            # begun and never finished
    for n in range(1, 5):
        sinks.replace_collection(spark.range(n), path)
    assert len(versions.names()) == KEPT and not os.path.exists(stale)
    unfinished = versions.begin()
    spark.range(50).write.parquet(f"{unfinished}/data")
    assert sinks.read_collection(spark, path).count() == 4
    versions.finish(unfinished)
    assert sinks.read_collection(spark, path).count() == 50


def test_two_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "c")
    versions = Snapshots(spark, path)
    a, b = versions.begin(), versions.begin()
    for place, n in ((a, 3), (b, 4)):
        spark.range(n).write.parquet(f"{place}/data")
    versions.finish(b)
    versions.finish(a)
    assert versions.current() == max(a, b) and sinks.read_collection(spark, path).count() in (3, 4)


def test_append_by_request(spark, tmp_path):
    path = str(tmp_path / "c")
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    sinks.append_collection(frame(1, 2), path, request="r1")     # makes the collection
    sinks.append_collection(frame(3), path, request="r2")
    sinks.append_collection(frame(1, 2), path, request="r1")
    assert values(spark, path) == [(1,), (2,), (3,)]
    sinks.append_collection(frame(9), path)
    sinks.append_collection(frame(9), path)                      # requests of their own
    assert values(spark, path) == [(1,), (2,), (3,), (9,), (9,)]
    with pytest.raises(Exception, match="stop"):
        sinks.append_collection(spark.range(3).selectExpr("CAST(if(id = 2, raise_error('stop'), id) AS int) AS id"), path, request="r1")
    assert values(spark, path) == [(1,), (2,), (3,), (9,), (9,)]
    sinks.clear_collection(spark, frame(1).schema, path)
    assert values(spark, path) == []


def test_request_id(spark):
    users = lambda *ids: spark.createDataFrame([(i,) for i in ids], "customer_id bigint")
    assert sinks.request_id(users(1, 2, 3)) == sinks.request_id(users(3, 3, 1, 2).repartition(3))
    assert len({sinks.request_id(u) for u in (users(), users(1), users(2), users(1, 2), users(3))}) == 5


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sinks.read_collection(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        rc.Recommender.load(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("stop_after", ["nothing", "model", "users", "items"])
def test_stop_between_the_parts_of_a_model(spark, tmp_path, monkeypatch, stop_after):
    """Whatever part a save stops at, the old model is loaded, with its own customers and items."""
    def trained(customers):
        reviews = [(c, i, 5.0 - (c + i) % 3, 0, 0, D("2001-01-01")) for c in customers for i in (1, 2, 3)]
        return rc.train_collaborative_filtering(make_tables(spark, reviews=reviews, items=[item_row(i) for i in (1, 2, 3)]),
                                                rank=2, max_iter=2)
    path = str(tmp_path / "als")
    old = trained([10, 11])
    old.save(path)
    new = trained([20, 21, 22])
    place = {}
    monkeypatch.setattr(Snapshots, "finish", lambda self, p: place.setdefault("stopped", p))
    if stop_after == "items":
        new.save(path)                     # everything but the marker
    else:
        parts = ["nothing", "model", "users"]
        begun = Snapshots(spark, path).begin()
        if parts.index(stop_after) >= 1:
            new.model.write().save(f"{begun}/model")
        if parts.index(stop_after) >= 2:
            new.users.write.parquet(f"{begun}/users")
    monkeypatch.undo()
    loaded = rc.Recommender.load(spark, path)
    assert {r.customer_id for r in loaded.users.collect()} == {10, 11}
    assert loaded.model.userFactors.count() == 2
    new.save(path)
    assert {r.customer_id for r in rc.Recommender.load(spark, path).users.collect()} == {20, 21, 22}


def buckets_read(spark, df) -> str:
    """The buckets that a filter leaves to read: skipped in any scan, but shown for those kept apart by bucket only."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    return re.search(r"SelectedBucketsCount: (\d+ out of \d+)", plan).group(1)


def forget(spark, path: str) -> None:
    """As a new application would find the collection."""
    versions = Snapshots(spark, path)
    for name in versions.names():
        spark.sql(f"DROP TABLE IF EXISTS {sinks._table(f'{versions.path}/{name}')}")


def test_lists_as_rows_of_one_bucket(spark, tmp_path):
    lines = [(o, i, 1 + (o + i) % 3) for o in range(40) for i in range(o % 7)] + [(100, i, 2) for i in range(60)]
    t = make_tables(spark, orders=[(o, 1, D("2001-01-10"), 1.0) for o in [*range(40), 100]], lines=lines,
                    items=[item_row(i) for i in range(60)])
    path = str(tmp_path / "pairs")
    rc.write_also_bought(t, path, buckets=8)
    want = sorted(map(tuple, rc.also_bought_pairs(t).collect()))
    assert sorted(map(tuple, sinks.read_collection(spark, path).collect())) == want
    assert "collect_list" not in rc.also_bought_pairs(t)._jdf.queryExecution().optimizedPlan().toString()
    forget(spark, path)
    got = rc.also_bought_of(spark, path, [3])
    rows = [tuple(r) for r in got.collect()]
    assert rows == [r for r in want if r[0] == 3] and len(rows) == 59         # in order of the partner as stored
    assert buckets_read(spark, got) == "1 out of 8"
    assert len([f for f in os.listdir(f"{Snapshots(spark, path).current()}/data") if f.endswith(".parquet")]) <= 8
    # replaced: the next snapshot has another number of buckets, and the old one is still whole
    rc.write_also_bought(t, path, buckets=3)
    assert buckets_read(spark, rc.also_bought_of(spark, path, [2])) == "1 out of 3"
    assert got.count() == 59
    assert rc.also_bought_of(spark, path, [999]).count() == 0
    forget(spark, path)
    with pytest.raises(FileNotFoundError):
        rc.also_bought_of(spark, str(tmp_path / "none"), [1])
