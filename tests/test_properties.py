"""Property tests for the two hand-built distributed pieces."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwise.functions.indexing import dense_index
from cartwise.operators import recommend as rc
from store_fixtures import item_row, make_tables

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

lines_strategy = st.lists(st.tuples(st.integers(1, 4), st.integers(1, 6), st.integers(1, 9)),
                          min_size=1, max_size=25)


@settings(**SETTINGS)
@given(lines=lines_strategy, block=st.integers(1, 6))
def test_also_bought_equals_naive_self_join(spark, lines, block):
    # items 1..5 are in the catalog, item 6 is not (dropped on both sides)
    t = make_tables(spark, lines=lines, items=[item_row(i) for i in range(1, 6)])
    known = {1, 2, 3, 4, 5}
    want: dict[tuple[int, int], int] = {}
    for o1, i1, _ in lines:
        for o2, i2, q2 in lines:
            if o1 == o2 and i1 != i2 and i1 in known and i2 in known:
                want[(i1, i2)] = want.get((i1, i2), 0) + q2
    got = {(r.item_id, r.r_item_id): r.quantity
           for r in rc.also_bought_pairs(t, block=block).collect()}
    assert got == want


@settings(**SETTINGS)
@given(keys=st.lists(st.integers(-50, 50), min_size=1, max_size=60, unique=True),
       parts=st.integers(1, 9))
def test_dense_index_is_the_sorted_position(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = {r.k: r.i for r in dense_index(df, ["k"], "i", num_partitions=parts).collect()}
    assert got == {k: pos for pos, k in enumerate(sorted(keys))}
    small = {r.k: r.i for r in dense_index(df, ["k"], "i", bounded=True).collect()}
    assert small == got


def test_dense_index_two_columns(spark):
    df = spark.createDataFrame([(2001, 1), (2000, 12), (2000, 2), (2001, 3)], "year int, month int")
    got = [(r.year, r.month, r.t) for r in dense_index(df, ["year", "month"], "t", num_partitions=3)
           .orderBy("t").collect()]
    assert got == [(2000, 2, 0), (2000, 12, 1), (2001, 1, 2), (2001, 3, 3)]
