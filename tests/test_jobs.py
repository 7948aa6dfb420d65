"""The job runner writes every collection and feeds readers from written outputs."""

from __future__ import annotations

import os

import pytest

from cartwise.functions import holding
from cartwise.plans import jobs
from cartwise.sources import layout, sinks
from cartwise.sources.tables import load_tables
from store_fixtures import AS_OF

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="no test data")


def test_all_jobs_write_their_collections(spark, tmp_path):
    out = str(tmp_path / "collections")
    users = spark.createDataFrame([(1,), (2,), (3,)], "customer_id bigint")
    done = jobs.run(spark, SF, out, AS_OF, users=users)
    assert done == list(jobs.JOBS)
    written = set(os.listdir(out))
    for name in ["best_reviewers", "customer_overview", "item_profiles", jobs.PROFILE_MAP,
                 "customer_segmentation_age_and_brand", "customer_segmentation_age_and_item_profile",
                 "also_bought_recommender", "best_reviewed_during_last_six_months",
                 "most_sold_during_last_six_months", "item_profile_recommender", "item_profile_members",
                 jobs.ALS_MODEL, jobs.RECOMMENDATIONS, jobs.RESPONSES, "finances_overview", "sales_value_predictions",
                 "sales_value_predictions_by_state", "stock_overview", "sales_predictions",
                 "sales_predictions_by_item", "sales_predictions_by_state",
                 "sales_predictions_by_item_profiles"]:
        assert name in written, name
    read = lambda n: sinks.read_collection(spark, f"{out}/{n}")
    assert read("customer_overview").count() == 1 and read("stock_overview").count() == 1
    assert read("best_reviewers").count() == 20
    assert read("sales_predictions").count() == 12
    # readers used the written map: every recommender row points at a written profile
    profiles = {r.profile_id for r in read(jobs.PROFILE_MAP).select("profile_id").distinct().collect()}
    assert {r.profile_id for r in read("item_profile_recommender").collect()} <= profiles
    recs = read(jobs.RECOMMENDATIONS)
    assert {r.customer_id for r in recs.collect()} <= {1, 2, 3}


def test_unknown_job_is_rejected(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.run(spark, SF, str(tmp_path), AS_OF, ["no_such_job"])


def test_store_layout_reads_the_reference_schema(spark, tmp_path):
    # the store's own tables, as parquet folders, run through the same jobs
    from store_fixtures import D
    from cartwise.sources.tables import STORE_TABLES
    folder = tmp_path / "store"
    rows = {
        "customer": ([(1, "ann", D("1970-01-01"), "F", "Ohio"), (2, "bob", None, "M", "Utah")],
                     "id int, name string, birthdate date, sex string, state string"),
        "order_": ([(10, 1, D("2001-03-01"), 20.5), (11, 2, D("2001-04-02"), 3.25)],
                   "id int, customer_id int, date date, totalPrice double"),
        "ordereditem": ([(10, 100, 2), (10, 101, 1), (11, 100, 4)], "order_id int, item_id int, quantity int"),
        "item": ([(100, "t100", "B1", "d", "u", 1.0), (101, "t101", "B2", "d", "u", 2.0)],
                 "id int, title string, brand string, description string, imUrl string, price double"),
        "category": ([(1, "rock"), (2, "jazz")], "id int, name string"),
        "item_category": ([(100, 1), (101, 1), (101, 2)], "items_id int, categories_id int"),
        "review": ([(1, 100, 5.0, 3, 1, D("2001-05-01")), (2, 101, 2.0, 0, 2, D("2001-05-02"))],
                   "customer_id int, item_id int, overall double, helpful int, unhelpful int, date date"),
        "map_state_name_abbreviation": ([("Ohio", "OH"), ("Utah", "UT")], "name string, abbreviation string"),
    }
    assert set(rows) == set(STORE_TABLES)
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(str(folder / name))
    out = str(tmp_path / "out")
    jobs.run(spark, str(folder), out, AS_OF, ["best_reviewers", "stock_overview", "also_bought",
                                               "most_sold", "finances_overview"], layout="store")
    br = {r.customerId: r.usefullness for r in sinks.read_collection(spark, f"{out}/best_reviewers").collect()}
    assert br == {1: 2, 2: -2}
    doc = sinks.read_collection(spark, f"{out}/stock_overview").first()
    assert sum(m.numProducts for m in doc.monthly_sales) == 7
    ms = {r.item_id: r.quantity for r in sinks.read_collection(spark, f"{out}/most_sold_during_last_six_months").collect()}
    assert ms == {100: 6, 101: 1}


def predicted(spark, out: str) -> int:
    return sum(r.sales for r in sinks.read_collection(spark, f"{out}/sales_predictions").collect())


def test_jobs_on_the_colocated_layout(spark, tmp_path):
    """Two sources and one folder: each run reads the copy of its own source, made once."""
    copies = str(tmp_path / "b")
    plain, got = {}, {}
    for sf in ("sf0.001", "sf0.01", "sf0.001"):
        source = f"/root/testdata/{sf}"
        jobs.run(spark, source, str(tmp_path / "plain"), AS_OF, ["sales_predictions"])
        plain[sf] = predicted(spark, str(tmp_path / "plain"))
        jobs.run(spark, source, str(tmp_path / "out"), AS_OF, ["stock_overview", "sales_predictions"], colocate=(copies, 4))
        assert sinks.read_collection(spark, f"{tmp_path}/out/stock_overview").count() == 1
        got[sf] = predicted(spark, str(tmp_path / "out"))
        assert got == plain
    assert len(set(got.values())) == 2 and len(os.listdir(copies)) == 2
    forget_all(spark, copies)


def forget_all(spark, copies: str) -> None:
    for name in os.listdir(copies):
        for table in layout._names(f"{copies}/{name}"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_changed_source_gets_a_new_copy(spark, tmp_path):
    from store_fixtures import D, item_row
    folder, copies, out = str(tmp_path / "store"), str(tmp_path / "b"), str(tmp_path / "out")

    def store(quantity: int) -> None:
        rows = {"customer": ([(1, "ann", None, "F", "Ohio")], "id int, name string, birthdate date, sex string, state string"),
                "order_": ([(10, 1, D("2001-03-01"), 20.5)], "id int, customer_id int, date date, totalPrice double"),
                "ordereditem": ([(10, 100, quantity)], "order_id int, item_id int, quantity int"),
                "item": ([item_row(100)], "id int, title string, brand string, description string, imUrl string, price double"),
                "category": ([(1, "rock")], "id int, name string"),
                "item_category": ([(100, 1)], "items_id int, categories_id int"),
                "review": ([(1, 100, 5.0, 3, 1, D("2001-05-01"))],
                           "customer_id int, item_id int, overall double, helpful int, unhelpful int, date date"),
                "map_state_name_abbreviation": ([("Ohio", "OH")], "name string, abbreviation string")}
        for name, (data, schema) in rows.items():
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{folder}/{name}")

    for quantity in (3, 4):
        store(quantity)
        jobs.run(spark, folder, out, AS_OF, ["most_sold"], layout="store", colocate=(copies, 2))
        got = sinks.read_collection(spark, f"{out}/most_sold_during_last_six_months").collect()
        assert [r.quantity for r in got] == [quantity]
    forget_all(spark, copies)


def test_copy_of_a_database_needs_a_version(spark, tmp_path):
    with pytest.raises(ValueError, match="source_version"):
        jobs.run(spark, None, str(tmp_path), AS_OF, ["most_sold"], jdbc={"url": "jdbc:x://db/s"}, colocate=(str(tmp_path), 2))


def test_jobs_release_what_they_hold_and_nothing_else(spark, tmp_path):
    holding.release()           # what tests before this one hold
    mine = spark.range(5).cache()
    mine.count()
    other = holding.hold(spark.range(6))
    jobs.run(spark, SF, str(tmp_path), AS_OF, ["finances_overview"])
    assert mine.is_cached and other.is_cached and holding._HELD == [other]
    assert holding.release() == 1 and not other.is_cached
    mine.unpersist()


def test_failing_job_releases_and_leaves_the_old_collection(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    jobs.run(spark, SF, out, AS_OF, ["finances_overview"])
    before = sinks.read_collection(spark, f"{out}/finances_overview").collect()
    held = []

    def failing(c):
        held.append(holding.hold(spark.range(3)))
        c.replace("finances_overview", spark.range(3).selectExpr("raise_error('no luck') AS x"))

    monkeypatch.setitem(jobs.JOBS, "finances_overview", failing)
    with pytest.raises(Exception, match="no luck"):
        jobs.run(spark, SF, out, AS_OF, ["finances_overview"])
    assert not held[0].is_cached
    assert sinks.read_collection(spark, f"{out}/finances_overview").collect() == before


def test_repeated_request_leaves_one_copy(spark, tmp_path):
    out = str(tmp_path)
    jobs.run(spark, SF, out, AS_OF, ["collaborative_filtering"])
    rows = lambda: sinks.read_collection(spark, f"{out}/{jobs.RECOMMENDATIONS}")
    assert rows().count() == 0
    for ids in ([1, 2, 3], [3, 1, 2, 2], [4, 5]):
        users = spark.createDataFrame([(i,) for i in ids], "customer_id bigint")
        jobs.run(spark, SF, out, AS_OF, ["recommend_products"], users=users)
    got = [r.customer_id for r in rows().collect()]
    assert len(got) == len(set(got)) and set(got) <= {1, 2, 3, 4, 5} and rows().columns == ["customer_id", "items"]
    jobs.run(spark, SF, out, AS_OF, ["collaborative_filtering"])        # a new model clears them
    assert rows().count() == 0


def test_recommending_needs_a_request(spark, tmp_path):
    with pytest.raises(ValueError, match="request"):
        jobs.run(spark, SF, str(tmp_path), AS_OF, ["recommend_products"])


def test_jdbc_option_reaches_the_loader(spark, tmp_path, monkeypatch):
    seen = {}

    def load(session, url, properties):
        seen.update(properties, url=url)
        return load_tables(session, SF)

    monkeypatch.setattr(jobs, "load_store_jdbc", load)
    jobs.run(spark, None, str(tmp_path), AS_OF, ["best_reviewers"], jdbc={"url": "jdbc:x://db/store", "user": "u"})
    assert seen == {"url": "jdbc:x://db/store", "user": "u"}
    assert sinks.read_collection(spark, f"{tmp_path}/best_reviewers").count() == 20


def test_jdbc_loader_passes_partitioned_reads(spark, monkeypatch):
    # no database here: the JDBC reader is replaced by local frames, and the
    # test checks which tables are read and with which partitioning
    from pyspark.sql.readwriter import DataFrameReader

    from cartwise.sources.tables import STORE_TABLES, load_store_jdbc
    frames = {
        "customer": ([(1, "ann", None, "F", "Ohio")], "id int, name string, birthdate date, sex string, state string"),
        "order_": ([(10, 1, None, 2.0)], "id int, customer_id int, date date, totalPrice double"),
        "ordereditem": ([(10, 100, 2)], "order_id int, item_id int, quantity int"),
        "item": ([(100, "t", "b", "d", "u", 1.0)],
                 "id int, title string, brand string, description string, imUrl string, price double"),
        "category": ([(1, "rock")], "id int, name string"),
        "item_category": ([(100, 1)], "items_id int, categories_id int"),
        "review": ([(1, 100, 5.0, 1, 0, None)],
                   "customer_id int, item_id int, overall double, helpful int, unhelpful int, date date"),
        "map_state_name_abbreviation": ([("Ohio", "OH")], "name string, abbreviation string"),
    }
    calls = {}

    def fake_jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
                  predicates=None, properties=None):
        calls[table] = (url, column, lowerBound, upperBound, numPartitions, dict(properties or {}))
        data, schema = frames[table]
        return spark.createDataFrame(data, schema)

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    t = load_store_jdbc(spark, "jdbc:mysql://db/store", {"user": "u"},
                        partitioning={"ordereditem": ("order_id", 0, 1_000_000, 64)})
    assert set(calls) == set(STORE_TABLES)
    assert calls["ordereditem"][1:5] == ("order_id", 0, 1_000_000, 64)
    assert calls["customer"][1] is None and calls["customer"][5] == {"user": "u"}
    assert t.item_tag.collect()[0].tag == "rock"
    assert t.ordereditem.schema["order_id"].dataType.simpleString() == "bigint"
