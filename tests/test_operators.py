"""Hand-made fixtures, one test per semantics decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise.functions.indexing import dense_index
from cartwise.operators import customers as cu
from cartwise.operators import finances as fi
from cartwise.operators import forecast as fc
from cartwise.operators import recommend as rc
from cartwise.operators import stock as st
from store_fixtures import AS_OF, D, item_row, make_tables


def test_best_reviewers_ties_by_id(spark):
    # Equal usefulness -> lower customer id first; n cuts the list
    t = make_tables(spark,
                    customers=[(1, "a", None, "M", "Ohio"), (2, "b", None, "F", "Ohio"),
                               (3, "c", None, "F", "Ohio")],
                    reviews=[(3, 10, 5.0, 5, 1, D("2001-01-01")), (2, 10, 4.0, 4, 0, D("2001-01-01")),
                             (1, 10, 4.0, 6, 2, D("2001-01-01")), (1, 11, 4.0, 1, 1, D("2001-01-01"))])
    rows = cu.best_reviewers(t, n=2).collect()
    assert [(r.customerId, r.usefullness, r.numberOfReviews) for r in rows] == [(1, 4, 2), (2, 4, 1)]


def test_customers_overview_filters_unknown_state_and_null_birthdate(spark):
    t = make_tables(spark, customers=[
        (1, "a", D("1971-07-15"), "M", "Ohio"), (2, "b", D("1981-07-15"), "F", "Ohio"),
        (3, "c", None, "F", "Ohio"), (4, "d", D("1961-07-15"), "M", "Mars")])
    by = {r.name: r for r in cu.customers_by_state(t, AS_OF).collect()}
    assert list(by) == ["Ohio"] and by["Ohio"].totalCustomers == 2
    assert by["Ohio"].abbreviation == "US-OH"
    m = cu.customers_mean_age(t, AS_OF).first()
    # 365-day years: 30 calendar years hold 8 leap days, 20 hold 5
    assert abs(m.average_age_male - 30.021918) < 1e-6 and abs(m.average_age_female - 20.013699) < 1e-6
    doc = cu.customers_overview(t, AS_OF).first()
    assert doc.customers_by_state[0].totalCustomers == 2


def test_overview_window_is_open_above(spark):
    # Orders after as_of still count in the overview
    t = make_tables(spark, customers=[(1, "a", None, "M", "Ohio")],
                    orders=[(1, 1, D("2001-08-01"), 10.0), (2, 1, D("1999-07-15"), 5.0),
                            (3, 1, D("1999-07-16"), 2.5)])
    rows = sorted((r.year, r.month, r.value) for r in fi.finances_monthly(t, AS_OF).collect())
    assert rows == [(1999, 7, 2.5), (2001, 8, 10.0)]


def test_stock_sums_are_bigint_and_top_products_ties(spark):
    # Units sum as 64-bit; ties in the top list by item id
    big = 2_000_000_000
    t = make_tables(spark, customers=[(1, "a", None, "M", "Ohio")],
                    orders=[(1, 1, D("2001-01-10"), 1.0)],
                    lines=[(1, 5, big), (1, 5, big), (1, 6, 7), (1, 7, 7)],
                    items=[item_row(5), item_row(6), item_row(7)])
    m = st.stock_monthly(t, AS_OF).first()
    assert m.numProducts == 2 * big + 14
    top = st.stock_top_products(t, AS_OF, n=2).collect()
    assert sorted([(r.quantity, r.id) for r in top], reverse=True) == [(2 * big, 5), (7, 6)]


def test_number_months_closes_gaps(spark):
    # Months without sales get no number
    s = spark.createDataFrame([(2000, 1, 1), (2000, 3, 2), (2000, 4, 3)], "year int, month int, label bigint")
    got = sorted((r.year, r.month, r.t) for r in fc.number_months(s).collect())
    assert got == [(2000, 1, 0), (2000, 3, 1), (2000, 4, 2)]


def test_nearest_int_rounds_half_up(spark):
    df = spark.createDataFrame([(-0.5,), (2.5,), (-1.5,), (0.49,)], "x double")
    assert [r[0] for r in df.select(fc.nearest_int(F.col("x"))).collect()] == [0, 3, -1, 0]


def test_totals_forecast_floored_at_zero(spark):
    # A steeply falling series forecasts negative values -> floored at 0 for totals
    orders = [(i, 1, D(f"{1999 + (6 + i) // 12}-{(6 + i) % 12 + 1:02d}-10"), float(24 - i) * 100.0)
              for i in range(24)]
    lines = [(i, 1, 48 - 2 * i) for i in range(24)]
    t = make_tables(spark, customers=[(1, "a", None, "M", "Ohio")], orders=orders, lines=lines,
                    items=[item_row(1)])
    sv = fi.sales_value_predictions(t, AS_OF).collect()
    sp = st.sales_predictions(t, AS_OF).collect()
    assert len(sv) == 12 and len(sp) == 12
    assert min(r.salesValue for r in sv) >= 0.0 and min(r.sales for r in sp) >= 0
    assert [(r.month, r.year) for r in sp][:2] == [(7, 2001), (8, 2001)]  # D4: starts this month


def test_closed_form_matches_spark_linear_regression(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    ys = [50.0, 48.5, 51.2, 47.0, 46.3, 49.9, 44.1, 45.0, 43.3, 47.7, 42.2, 41.0]
    s = spark.createDataFrame([(i, y) for i, y in enumerate(ys)], "t int, label double")
    stats = s.agg(*fc._stats(F.col("t"), F.col("label"), F.lit(True), "al"))
    data = VectorAssembler(inputCols=["t"], outputCol="features").transform(s)
    for reg, fit_i, enet in fc.grid():
        slope, icpt = fc._solve("al", F.lit(reg), F.lit(enet), F.lit(fit_i))
        mine = stats.select(slope.alias("s"), icpt.alias("i")).first()
        m = LinearRegression(regParam=reg, elasticNetParam=enet, fitIntercept=fit_i,
                             standardization=True).fit(data)
        assert abs(mine.s - m.coefficients[0]) < 1e-6, (reg, fit_i, enet)
        assert abs(mine.i - m.intercept) < 1e-5, (reg, fit_i, enet)


def test_state_forecast_keeps_unknown_states(spark):
    # No state filter in the keyed forecasts; missing abbreviation -> US-DESC
    t = make_tables(spark, customers=[(1, "a", None, "M", "Ohio"), (2, "b", None, "F", "Mars")],
                    orders=[(1, 1, D("2001-01-10"), 5.0), (2, 2, D("2001-02-10"), 6.0)])
    hz = fi.forecast_horizon_by_state(t, AS_OF).collect()
    assert len(hz) == 24
    assert {(r.state, r.abbreviation) for r in hz} == {("Ohio", "US-OH"), ("Mars", "US-DESC")}


def test_dense_index_matches_dense_rank(spark):
    keys = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = dense_index(keys, ["k"], "i", num_partitions=7).collect()
    assert sorted((r.k, r.i) for r in got) == [(k, k) for k in range(1000)]


def _naive_also_bought(t):
    a = t.ordereditem.alias("a")
    b = t.ordereditem.alias("b")
    return (a.join(b, (F.col("a.order_id") == F.col("b.order_id")) & (F.col("a.item_id") != F.col("b.item_id")))
            .groupBy(F.col("a.item_id").alias("item_id"), F.col("b.item_id").alias("r_item_id"))
            .agg(F.sum("b.quantity").alias("quantity")))


def test_also_bought_preaggregation_and_grid_match_naive(spark):
    # Duplicate lines of an item in one order; order 1 has a grid of cells when block=1
    lines = [(1, 1, 2), (1, 1, 3), (1, 2, 5), (1, 3, 1), (2, 1, 1), (2, 2, 4), (3, 4, 9)]
    t = make_tables(spark, lines=lines, items=[item_row(i) for i in range(1, 5)])
    want = sorted(tuple(r) for r in _naive_also_bought(t).collect())
    plain = sorted((r.item_id, r.r_item_id, r.quantity) for r in rc.also_bought_pairs(t).collect())
    salted = sorted((r.item_id, r.r_item_id, r.quantity)
                    for r in rc.also_bought_pairs(t, block=1).collect())
    assert plain == want and salted == want
    # (1, 2): order 1 pairs two lines of item 1 with 5 units, order 2 adds 4
    assert (1, 2, 14) in plain and (2, 1, 6) in plain
    doc = {r.item_id: r.alsoBought for r in rc.also_bought(t, buckets=1).collect()}
    assert [x.item_id for x in doc[1]] == [2, 3] and 4 not in doc
    # in buckets every partner still appears exactly once
    parts = rc.also_bought(t).collect()
    assert all(len(r.alsoBought) >= 1 for r in parts)
    assert sorted((r.item_id, x.item_id) for r in parts for x in r.alsoBought) == \
        sorted((r.item_id, r.r_item_id) for r in rc.also_bought_pairs(t).collect())


def test_rankings_use_half_open_six_month_window(spark):
    t = make_tables(spark, customers=[(1, "a", None, "M", "Ohio")],
                    orders=[(1, 1, D("2001-01-15"), 1.0), (2, 1, D("2001-07-15"), 1.0),
                            (3, 1, D("2001-01-14"), 1.0)],
                    lines=[(1, 1, 3), (2, 2, 100), (3, 3, 100)],
                    items=[item_row(1), item_row(2), item_row(3)],
                    reviews=[(1, 1, 5.0, 0, 0, D("2001-03-01")), (1, 2, 1.0, 0, 0, D("2001-03-01")),
                             (1, 2, 3.0, 0, 0, D("2001-03-01")), (1, 3, 5.0, 0, 0, D("2001-07-15"))])
    ms = rc.most_sold(t, AS_OF).collect()
    assert [(r.item_id, r.quantity) for r in ms] == [(1, 3)]
    br = {r.item_id: r.averageOverall for r in rc.best_reviewed(t, AS_OF).collect()}
    c = (5.0 + 1.0 + 3.0) / 3
    assert abs(br[1] - (5.0 + c) / 2) < 1e-12 and abs(br[2] - (4.0 + c) / 3) < 1e-12 and 3 not in br


def test_profile_recommender_includes_item_itself(spark):
    # The item is in its own profile's list
    pm = spark.createDataFrame(
        [(0, 1, ["x"], "b", "d", "u", "t1", 1.0), (0, 2, ["x"], "b", "d", "u", "t2", 2.0),
         (1, 3, ["y"], "b", "d", "u", "t3", 3.0)],
        "profile_id int, item_id bigint, categories array<string>, item_brand string, "
        "item_description string, item_imUrl string, item_title string, item_price double")
    r = {x.item_id: x for x in rc.item_profile_recommender(pm).collect()}
    assert r[1].n_items == 2 and r[3].n_items == 1 and r[1].categories == ["x"]
    members = {(m.profile_id, m.id) for m in rc.profile_members(pm).collect()}
    assert (0, 1) in members and (0, 2) in members


def test_brand_shares_one_row_per_customer_and_brand(spark):
    # Null and blank brands dropped; null birthdate dropped
    t = make_tables(spark,
                    customers=[(1, "a", D("1981-07-21"), "M", "Ohio"), (2, "b", None, "F", "Ohio")],
                    orders=[(1, 1, D("2001-01-10"), 1.0), (2, 2, D("2001-01-10"), 1.0)],
                    lines=[(1, 1, 3), (1, 2, 1), (1, 3, 5), (1, 4, 2), (2, 1, 1)],
                    items=[item_row(1, "A"), item_row(2, "B"), item_row(3, None), item_row(4, "")])
    rows = sorted((r.customer_id, r.brand, r.quantity, r.share, r.age_code)
                  for r in cu.customer_brand_shares(t, AS_OF).collect())
    # 7,299 days = 19 years of 365 days (one day short of 20) -> bucket 0
    assert rows == [(1, "A", 3, 0.75, 0), (1, "B", 1, 0.25, 0)]


def test_top_slots_ties_go_to_higher_index_and_keep_zero_weights(spark):
    # Stable sort then reverse -> among equal weights the higher slot wins; zeros can fill
    from cartwise.operators import clusters as cl
    dims = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5), (0, 2, 0.0), (0, 3, 0.0), (0, 4, 0.2)],
                                 "prediction int, pos int, weight double")
    got = [(r.pos, r.rank) for r in cl.top_slots(dims, 4).orderBy("rank").collect()]
    assert got == [(1, 1), (0, 2), (4, 3), (3, 4)]


def test_cluster_report_truncates_centroid_age(spark):
    # Centroid age code 1.9 -> code 1; 50.0 (mixed with "Other") -> "Other"
    from cartwise.functions.people import BRAND_AGE_BUCKETS
    from cartwise.operators import clusters as cl
    cent = spark.createDataFrame([(0, 0, 1.0), (0, 1, 1.9), (1, 0, 1.0), (1, 1, 50.0), (2, 1, 3.0)],
                                 "prediction int, pos int, weight double")
    assigned = spark.createDataFrame([(10, 0), (11, 0), (12, 1)], "customer_id int, prediction int")
    labels = spark.createDataFrame([(0, ["A"]), (1, ["B"])], "prediction int, brands array<string>")
    rep = {r.profile_id: r for r in cl.cluster_report(assigned, cent, labels, BRAND_AGE_BUCKETS,
                                                      "brands", 1).collect()}
    assert set(rep) == {0, 1}  # D14: the empty cluster 2 is not reported
    assert (rep[0].number_customers, rep[0].age_interval, rep[0].brands) == (2, "20-24", ["A"])
    assert rep[1].age_interval == "Other"


def test_trend_handles_constant_and_single_month_series(spark):
    # zero variance must not divide by zero under ANSI mode: a flat line through the mean
    for ys in ([5.0], [7.0] * 10):
        s = spark.createDataFrame([(i, y) for i, y in enumerate(ys)], "t int, label double")
        m = fc.fit_trend(s).first()
        assert (m.slope, m.intercept, m.fit_intercept) == (0.0, ys[0], True)
        pred = [r.prediction for r in fc.trend_forecast(fc.fit_trend(s), AS_OF).collect()]
        assert pred == [ys[0]] * 12


def test_mean_age_of_an_empty_group_is_null(spark):
    t = make_tables(spark, customers=[(1, "a", D("1971-07-15"), "M", "Ohio")])
    m = cu.customers_mean_age(t, AS_OF).first()
    assert m.average_age_female is None and m.average_age_male == m.average_age


def test_sizing_respects_settings_made_by_the_application(spark):
    from cartwise.session import size_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    changed = size_for_input(spark, ["/root/testdata/sf0.001"])
    assert "spark.sql.shuffle.partitions" not in changed      # set by the test session
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_share_vectors_use_the_used_vocabulary_and_raw_age_code(spark):
    # slots = sorted ids that occur (7 and 42, not 0..42); D11: age code last, unnormalized
    from cartwise.operators import clusters as cl
    shares = spark.createDataFrame(
        [(1, 3, 42, 0.25), (1, 3, 7, 0.75), (2, 99, 42, 1.0)],
        "customer_id int, age_code int, profile_id int, share double")
    vocab = cl.vocabulary(shares, "profile_id")
    assert sorted((r.profile_id, r.idx) for r in vocab.collect()) == [(7, 0), (42, 1)]
    vecs = {r.customer_id: r.features.toArray().tolist()
            for r in cl.share_vectors(shares, vocab, "profile_id", "customer_id").collect()}
    assert vecs == {1: [0.75, 0.25, 3.0], 2: [0.0, 1.0, 99.0]}


def test_also_bought_attributes_are_not_shuffled_with_the_pairs(spark, monkeypatch):
    # two rows of item 2, an item without attributes, lines of an unknown item and of no order; several blocks of items
    lines = [(o, i, 1 + (o * i) % 4) for o in range(30) for i in range(1, 9) if (o + i) % 3] + [(None, 1, 5), (None, 2, 5), (3, 99, 1)]
    t = make_tables(spark, lines=lines, items=[*[item_row(i) for i in range(1, 8)], item_row(2, "B2"), (8, None, None, None, None, None)])
    monkeypatch.setattr(rc, "PAIRS_PER_TASK", 1)
    want = sorted(map(str, rc.also_bought_pairs(t).collect()))
    doc = rc.also_bought(t)
    assert "_block" not in doc.columns and sorted(map(str, rc.also_bought_rows(doc).collect())) == want and len(want) == 63
    assert all([x.item_id for x in r.alsoBought] == sorted(x.item_id for x in r.alsoBought) for r in doc.collect())
    assert doc.groupBy("item_id", "bucket").count().filter("count > 1").count() == 0
    plan = rc.also_bought(t)._jdf.queryExecution().executedPlan().toString()
    lists, below = plan.split("Window", 1)
    assert "Exchange" not in lists and "_block" in below.split("Exchange", 1)[1].split("\n", 1)[0]
    assert "Join" not in below.split("Union", 1)[0]


def test_lines_of_ordinary_orders_are_shuffled_once(spark):
    t = make_tables(spark, lines=[(1, 1, 1), (1, 2, 1)], items=[item_row(1), item_row(2)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pairs = rc.also_bought_pairs(t)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert sum("Exchange hashpartitioning(order_id" in x for x in plan.split("\n")) == 2     # one for either side, the same
        assert len(pairs.collect()) == 2
        done = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ReusedExchange" in done
