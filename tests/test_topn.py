"""Top items by inner product, pruned by norm, against scoring everything."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.operators import recommend as rc
from cartwise.operators.topn import TopItems
from store_fixtures import D, item_row, make_tables


def frames(spark, users: np.ndarray, items: np.ndarray):
    make = lambda m, key: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{key} int, features array<double>")
    return make(users, "user_idx"), make(items, "item_idx")


def brute(users: np.ndarray, items: np.ndarray, n: int) -> dict:
    out = {}
    for u, vector in enumerate(users):
        scores = items @ vector
        out[u] = [(int(i), float(scores[i])) for i in np.lexsort((np.arange(len(items)), -scores))[:n]]
    return out


def found(df) -> dict:
    out: dict = {}
    for r in df.orderBy("user_idx", "rank").collect():
        out.setdefault(r.user_idx, []).append((r.item_idx, r.rating))
        assert r.rank == len(out[r.user_idx])
    return out


@pytest.mark.parametrize("shape", ["spread", "equal", "integers", "negative", "few"])
def test_equals_scoring_every_item(spark, shape):
    rng = np.random.default_rng(1)
    users, items = rng.normal(size=(60, 4)), rng.normal(size=(500, 4))
    if shape == "spread":
        items *= np.exp(rng.normal(size=(500, 1)))
    elif shape == "equal":
        items /= np.linalg.norm(items, axis=1, keepdims=True)
    elif shape == "integers":       # many ties
        users, items = rng.integers(-2, 3, (60, 4)).astype(float), rng.integers(-2, 3, (500, 4)).astype(float)
    elif shape == "negative":       # no score is positive: nothing can be skipped
        users, items = np.abs(users), -np.abs(items)
    else:
        items = items[:5]
    u, i = frames(spark, users, items)
    top = TopItems(i, block=32)
    got, want = found(top.best(u, 7, per_group=16)), brute(users, items, 7)
    assert {k: [x for x, _ in v] for k, v in got.items()} == {k: [x for x, _ in v] for k, v in want.items()}
    assert all(abs(a - b) < 1e-9 for k in want for (_, a), (_, b) in zip(got[k], want[k]))
    if shape == "spread":
        assert top.scored_share() < 0.5
    assert top.scored_share() <= 1


def test_nothing_to_score(spark):
    u, i = frames(spark, np.ones((3, 2)), np.ones((4, 2)))
    assert TopItems(i.limit(0)).best(u, 3).count() == 0
    assert TopItems(i).best(u.limit(0), 3).count() == 0
    assert TopItems(i).best(u, 3).count() == 9


def test_equals_the_model_s_own_recommendations(spark):
    rng = np.random.default_rng(2)
    reviews = [(int(c), int(i), float(rng.integers(1, 6)), 0, 0, D("2001-01-01")) for c in range(40) for i in rng.choice(120, 15, False)]
    t = make_tables(spark, reviews=reviews, items=[item_row(i) for i in range(120)])
    made = rc.train_collaborative_filtering(t, rank=4, max_iter=3)
    features = lambda df, key: df.select(F.col("id").alias(key), "features")
    got = found(TopItems(features(made.model.itemFactors, "item_idx"), block=16).best(features(made.model.userFactors, "user_idx"), 10))
    for r in made.model.recommendForAllUsers(10).collect():
        assert np.allclose([x.rating for x in r.recommendations], [s for _, s in got[r.user_idx]], atol=1e-4)
        clear = [x.item_idx for a, x in enumerate(r.recommendations[:-1])
                 if all(abs(x.rating - y.rating) > 1e-3 for b, y in enumerate(r.recommendations) if a != b)]
        assert set(clear) <= {i for i, _ in got[r.user_idx]}


def test_scores_in_memory_do_not_follow_the_request():
    import tracemalloc

    import pyarrow as pa

    from cartwise.operators import topn
    rng = np.random.default_rng(3)
    factors, vectors, items = rng.integers(-3, 4, (6000, 3)).astype(float), rng.integers(-3, 4, (4096, 3)).astype(float), rng.permutation(4096)
    tracemalloc.start()
    got = pa.Table.from_batches(topn._parts(pa.array(np.arange(6000, dtype=np.int32)), factors, items.astype(np.int32), vectors, 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6                 # all scores at once are 197 MB, sorted 786
    by_user = got.to_pandas().groupby("user_idx", sort=True)
    assert got.num_rows == 6000 * 20 and len(by_user) == 6000
    for u in (0, 127, 128, 5999):       # many ties; at and beside the borders of the parts
        want = np.lexsort((items, -(vectors @ factors[u])))[:20]
        part = by_user.get_group(u)
        assert [*part.item_idx] == [*items[want]] and [*part.rating] == [*(vectors @ factors[u])[want]]


def test_scores_that_are_no_numbers_come_last():
    from cartwise.operators.topn import _best
    row, at = _best(np.array([[np.nan, 1.0, np.nan, 2.0, 2.0], [np.nan] * 5]), np.array([5, 4, 3, 2, 1]), 3)
    assert [*row] == [0, 0, 0, 1, 1, 1] and [*at] == [4, 3, 1, 4, 3, 2]
