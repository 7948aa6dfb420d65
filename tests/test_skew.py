"""A hot order (most of all lines) is split by AQE's skew join, results unchanged."""

from __future__ import annotations

from cartwise.operators import stock as st
from store_fixtures import AS_OF, D, item_row, make_tables

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_order_is_split_and_sums_stay_exact(spark):
    # order 1 holds 20,000 of 20,030 lines; 30 other orders hold one line each.
    # Quantities vary so the hot shuffle block does not compress below the threshold.
    lines = [(1, i % 50, (i * 7919) % 997 + 1) for i in range(20000)] + [(o, 7, 2) for o in range(2, 32)]
    orders = [(o, 1 + o % 3, D("2001-01-10"), 1.0) for o in range(1, 32)]
    t = make_tables(spark, customers=[(c, f"c{c}", None, "M", "Ohio") for c in (1, 2, 3)],
                    orders=orders, lines=lines, items=[item_row(i) for i in range(50)])
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        series = st.unit_series(t, AS_OF)   # lines join orders on the order id
        rows = series.collect()
        plan = series._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert [(r.year, r.month, r.label) for r in rows] == [(2001, 1, float(sum(q for _, _, q in lines)))]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
