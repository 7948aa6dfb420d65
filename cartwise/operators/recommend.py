"""Recommenders: also-bought, six-month rankings, profile lists, ALS."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.functions.calendar import add_months, last_months, month_prefilter
from cartwise.functions.holding import hold
from cartwise.functions.indexing import dense_index
from cartwise.functions.pruning import lines_in_key_range
from cartwise.operators.topn import TopItems
from cartwise.session import MAX_SHUFFLE_PARTITIONS
from cartwise.sources import sinks
from cartwise.sources.snapshots import Snapshots
from cartwise.sources.tables import StoreTables

RANKING_MONTHS = 6
TOP_ITEMS = 50
BAYES_M = 1
ALS_RANK, ALS_ITERS, ALS_REG = 10, 10, 0.01
# About how many ratings a block of ALS holds: a task builds one in memory, at some 50 bytes a rating.
RATINGS_PER_BLOCK = 4_000_000
TOP_RECS = 20
MIN_RATING = 3.0

# An order of n distinct items is paired in a grid of ceil(n / PAIR_BLOCK)**2 cells.
PAIR_BLOCK = 4_000
# Every item's also-bought list is kept in this many hash buckets.
ALSO_BOUGHT_BUCKETS = 16
# About how many pairs, in both directions, a task joins or lists.
PAIRS_PER_TASK = 1_000_000

RECOMMENDATION_SCHEMA = ("customer_id bigint, items array<struct<id: bigint, title: string, brand: string, "
                         "imUrl: string, price: double>>")

ITEM_COLUMNS = ["item_id", "item_brand", "item_description", "item_imUrl", "item_price", "item_title"]


def _item_attributes(t: StoreTables) -> DataFrame:
    return t.item.select(F.col("id").alias("item_id"), F.col("brand").alias("item_brand"),
                         F.col("description").alias("item_description"),
                         F.col("imUrl").alias("item_imUrl"), F.col("price").alias("item_price"),
                         F.col("title").alias("item_title"))


# ---------------------------------------------------------------------------
# also bought
# ---------------------------------------------------------------------------

def _pair_sums(t: StoreTables, block: int = PAIR_BLOCK) -> tuple[DataFrame, int]:
    """(item_id, r_item_id, _fw, _bw) for item_id < r_item_id: units of r_item
    paired with item (_fw) and of item paired with r_item (_bw); and the number of
    pairs of lines, no less than the pairs of items in both directions.

    Plan, for scale:

    * Lines are reduced to (order, item, n_lines, qty) first: the naive
      self-join on lines sums qty(r) over line pairs, which equals the sum over
      orders of n_lines(item) * qty(r_item). The self-join then runs on
      distinct items per order.
    * The join emits each unordered pair once (item_id < r_item_id) and
      aggregates both directions at the same time, which halves the join
      output.
    * Orders of at most ``block`` lines are dealt out by order id once, and this one
      shuffle serves the reduction and both sides of the self-join.
    * The items of a larger order are cut into r = ceil(n / ``block``) hash blocks on
      both sides, and its pairs into r x r cells: left rows of block i go to
      cells (i, 0..r-1), right rows of block j to cells (0..r-1, j). Every cell
      is a join key of its own with about ``block`` rows a side, so neither
      side of a basket that holds a third of all lines meets in one task; each
      row is sent r times.
    * The lines per order are counted beforehand: if no order is large, there is no
      second branch, and the pairs they can make give the number of partitions.
    """
    known = t.item.select(F.col("id").alias("item_id"))
    counts = t.ordereditem.filter("order_id IS NOT NULL").groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    pairs, most = counts.agg(F.sum(F.col("_n").cast("decimal(19,0)") * (F.col("_n") - 1)), F.max("_n")).first()
    spark, pairs = t.item.sparkSession, int(pairs or 0)
    tasks = min(MAX_SHUFFLE_PARTITIONS, max(spark.sparkContext.defaultParallelism, pairs // PAIRS_PER_TASK))
    lines = t.ordereditem.filter("order_id IS NOT NULL").join(known, "item_id", "left_semi").select("order_id", "item_id", "quantity")
    sums = (F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("quantity").cast("bigint")).alias("qty"))
    side = lambda df: df.select(F.col("order_id").alias("r_order_id"), F.col("item_id").alias("r_item_id"),
                                F.col("n_lines").alias("r_n_lines"), F.col("qty").alias("r_qty"), *df.columns[4:])
    ahead = (F.col("order_id") == F.col("r_order_id")) & (F.col("item_id") < F.col("r_item_id"))
    pair = ("item_id", "r_item_id", "n_lines", "qty", "r_n_lines", "r_qty")

    large = hold(counts.filter(F.col("_n") > block).select("order_id")) if (most or 0) > block else None
    ordinary = lines if large is None else lines.join(large, "order_id", "left_anti")
    per = ordinary.repartition(tasks, "order_id").groupBy("order_id", "item_id").agg(*sums)
    met = per.join(side(per), ahead).select(*pair)
    if large is not None:
        per = hold(lines.join(large, "order_id", "left_semi").groupBy("order_id", "item_id").agg(*sums))
        blocks = per.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("_r"))
        dealt = per.join(blocks, "order_id").withColumn("_block", F.pmod(F.xxhash64("item_id"), F.col("_r")).cast("int"))
        cells = F.explode(F.sequence(F.lit(0), F.col("_r") - 1))
        columns = ("order_id", "item_id", "n_lines", "qty")
        left = dealt.select(*columns, F.col("_block").alias("_i"), cells.alias("_j"))
        right = side(dealt.select(*columns, cells.alias("_r_i"), F.col("_block").alias("_r_j")))
        met = met.unionByName(left.join(right, ahead & (F.col("_i") == F.col("_r_i")) & (F.col("_j") == F.col("_r_j"))).select(*pair))
    half = met.groupBy("item_id", "r_item_id").agg(F.sum(F.col("n_lines") * F.col("r_qty")).alias("_fw"),
                                                   F.sum(F.col("r_n_lines") * F.col("qty")).alias("_bw"))
    return half, pairs


def _directed(half: DataFrame) -> DataFrame:
    """(item_id, r_item_id, quantity): both directions of every unordered pair."""
    return half.select(F.explode(F.array(
        F.struct(F.col("item_id").alias("a"), F.col("r_item_id").alias("b"), F.col("_fw").alias("q")),
        F.struct(F.col("r_item_id").alias("a"), F.col("item_id").alias("b"), F.col("_bw").alias("q"))))
        .alias("p")).select(F.col("p.a").alias("item_id"), F.col("p.b").alias("r_item_id"),
                            F.col("p.q").alias("quantity"))


def _with_partner_attributes(t: StoreTables, pairs: DataFrame) -> DataFrame:
    attrs = t.item.select(F.col("id").alias("r_item_id"), "title", "brand", "imUrl")
    return pairs.join(attrs, "r_item_id").select("item_id", "r_item_id", "title", "brand", "imUrl", "quantity")


def also_bought_pairs(t: StoreTables, block: int = PAIR_BLOCK) -> DataFrame:
    """(item_id, r_item_id, title, brand, imUrl, quantity), one row per pair of
    different items bought in a common order; quantity = units of r_item over
    every pairing of their lines. See ``_pair_sums`` for the plan."""
    return _with_partner_attributes(t, _directed(_pair_sums(t, block)[0]))


def also_bought(t: StoreTables, buckets: int = ALSO_BOUGHT_BUCKETS) -> DataFrame:
    """(item_id, bucket, alsoBought: array<struct(item_id, title, brand, imUrl, quantity)>).

    The reference's document keeps one list per item. A popular item can be
    bought with a large part of the catalog, so every item's list is kept in
    ``buckets`` parts by a hash of the partner's id, each sorted by it; parts
    without a partner have no row. The parts of an item together hold its
    whole list, and the layout is the same for every item.

    Attributes are attached where the lists are made, so that they aren't shuffled with
    every pair: items are cut into blocks, pairs go to the cell of the item's block and
    the partner's bucket, and an item's attributes once to each cell of its bucket,
    which makes at most a quarter as many rows as there are pairs. In a cell, sorted by
    partner, they stand before the partner's pairs.
    """
    half, pairs = _pair_sums(t)
    blocks = max(1, min(pairs // (4 * max(1, t.item.count())), pairs // (PAIRS_PER_TASK * buckets)))
    bucket = F.pmod(F.xxhash64("r_item_id"), F.lit(buckets)).cast("int").alias("bucket")
    rows = _directed(half).select(bucket, F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("_block"),
                                  "r_item_id", "item_id", "quantity")
    attrs = (t.item.filter("id IS NOT NULL").groupBy(F.col("id").alias("r_item_id"))
             .agg(F.collect_list(F.struct("title", "brand", "imUrl")).alias("_attrs"))
             .select(bucket, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), "r_item_id", "_attrs"))
    before = (Window.partitionBy("bucket", "_block", "r_item_id").orderBy(F.col("item_id").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    dealt = rows.unionByName(attrs, allowMissingColumns=True).repartition(
        min(MAX_SHUFFLE_PARTITIONS, 2 * buckets * blocks), "bucket", "_block")
    listed = (dealt.withColumn("_attrs", F.first("_attrs", ignorenulls=True).over(before)).filter("item_id IS NOT NULL")
              .select("item_id", "bucket", "_block", "r_item_id", "quantity", F.explode("_attrs").alias("_of")))
    return (listed.groupBy("item_id", "bucket", "_block")
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("r_item_id").alias("item_id"), "_of.title", "_of.brand", "_of.imUrl", "quantity")))
                 .alias("alsoBought"))
            .drop("_block"))


def write_also_bought(t: StoreTables, path: str, buckets: int | None = None) -> None:
    """Replace the stored pairs: an item's list as consecutive rows of one bucket, by partner.

    The form for any size: nothing is collected per item, however popular.
    """
    sinks.replace_by_key(also_bought_pairs(t), path, "item_id", ["r_item_id"], buckets)


def also_bought_of(spark: SparkSession, path: str, item_ids: list[int]) -> DataFrame:
    """The stored lists of some items, as rows; only the buckets of these items are read."""
    return sinks.read_by_key(spark, path).filter(F.col("item_id").isin([int(i) for i in item_ids]))


def also_bought_rows(document: DataFrame) -> DataFrame:
    """The pairs of an also-bought document, as ``also_bought_pairs`` has them."""
    return document.select("item_id", F.explode("alsoBought").alias("p")).select(
        "item_id", F.col("p.item_id").alias("r_item_id"), "p.title", "p.brand", "p.imUrl", "p.quantity")


# ---------------------------------------------------------------------------
# six-month rankings
# ---------------------------------------------------------------------------

def most_sold(t: StoreTables, as_of, months: int = RANKING_MONTHS, n: int = TOP_ITEMS) -> DataFrame:
    """Item columns + quantity: the n items with most units in [as_of - months, as_of).

    Aggregates on the item id, checks the catalog on those sums, keeps the top
    n (ties by item id), then attaches the item attributes to those n rows only.
    """
    orders = t.order.filter(last_months(F.col("date"), as_of, months))
    known = t.item.select(F.col("id").alias("item_id"))
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    lines = (month_prefilter(t.ordereditem, add_months(d, -months), d) if t.colocated
             else lines_in_key_range(t.ordereditem, orders))
    qty = (lines.join(orders.select(F.col("id").alias("_oid")), F.col("order_id") == F.col("_oid"))
           .groupBy("item_id").agg(F.sum(F.col("quantity").cast("bigint")).alias("quantity"))
           .join(known, "item_id", "left_semi"))
    top = qty.orderBy(F.col("quantity").desc(), F.col("item_id").asc()).limit(n)
    return top.join(_item_attributes(t), "item_id").select(*ITEM_COLUMNS, "quantity")


def best_reviewed(t: StoreTables, as_of, months: int = RANKING_MONTHS, m: int = BAYES_M,
                  n: int = TOP_ITEMS) -> DataFrame:
    """Item columns + averageOverall: Bayesian mean (count*avg + m*C) / (count + m)
    where C is the mean rating of all reviews in the window; top n, ties by id.

    Reviews are summed per item first and checked against the catalog on those
    sums; C is a scalar subquery over the same sums (one value, computed once).
    """
    known = t.item.select(F.col("id").alias("item_id"))
    rv = t.review.filter(last_months(F.col("date"), as_of, months))
    per = (rv.groupBy("item_id").agg(F.sum("overall").alias("_s"), F.count(F.lit(1)).cast("double").alias("_n"))
           .join(known, "item_id", "left_semi"))
    per = hold(per)
    # C is the mean of the same reviews, rolled up from the per-item sums
    c = per.select((F.sum("_s") / F.sum("_n")).alias("c")).scalar()
    score = (F.lit(1.0) / (F.col("_n") + F.lit(float(m)))) * (F.col("_n") * (F.col("_s") / F.col("_n"))
                                                             + F.lit(float(m)) * c)
    top = (per.select("item_id", score.alias("averageOverall"))
           .orderBy(F.col("averageOverall").desc(), F.col("item_id").asc()).limit(n))
    return top.join(_item_attributes(t), "item_id").select(*ITEM_COLUMNS, "averageOverall")


# ---------------------------------------------------------------------------
# item-profile recommender
# ---------------------------------------------------------------------------

def profile_members(profile_map: DataFrame) -> DataFrame:
    """(profile_id, id, title, brand, imUrl, price): the items of each profile, as rows."""
    return profile_map.select("profile_id", F.col("item_id").alias("id"), F.col("item_title").alias("title"),
                              F.col("item_brand").alias("brand"), F.col("item_imUrl").alias("imUrl"),
                              F.col("item_price").alias("price"))


def item_profile_recommender(profile_map: DataFrame) -> DataFrame:
    """(item_id, categories, profile_id, n_items): per item, its categories and the
    profile whose members (``profile_members``) are its recommendations, itself
    included, with the list length.

    The reference embeds the whole member list in every item's row, which is
    quadratic in the profile size; here the list is stored once per profile and
    each item points to it, so output grows linearly with the catalog.
    """
    sizes = profile_map.groupBy("profile_id").agg(F.count(F.lit(1)).alias("n_items"))
    return profile_map.select("item_id", "categories", "profile_id").join(sizes, "profile_id") \
        .select("item_id", "categories", "profile_id", "n_items")


# ---------------------------------------------------------------------------
# collaborative filtering
# ---------------------------------------------------------------------------

def ratings(t: StoreTables) -> DataFrame:
    """(customer_id, item_id, overall) explicit ratings."""
    return t.review.select("customer_id", "item_id", F.col("overall").cast("float").alias("overall"))


@dataclass(frozen=True)
class Recommender:
    """An ALS model with the 64-bit ids behind its dense indexes.

    ``users``: (customer_id, user_idx), ``items``: (item_id, item_idx).
    """

    model: ALSModel
    users: DataFrame
    items: DataFrame

    def save(self, path: str) -> None:
        """Put this model and its two indexes in place of what is saved at ``path``.

        The three are one snapshot, current only when all are written: factors are
        never read with the indexes of another training.
        """
        versions = Snapshots(self.users.sparkSession, path)
        place = versions.begin()
        self.model.write().save(f"{place}/model")
        self.users.write.parquet(f"{place}/users")
        self.items.write.parquet(f"{place}/items")
        versions.finish(place)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Recommender:
        """The newest whole snapshot of a saved model."""
        place = Snapshots(spark, path).current()
        if place is None:
            raise FileNotFoundError(f"no whole model in {path}")
        return cls(ALSModel.load(f"{place}/model"), spark.read.parquet(f"{place}/users"),
                   spark.read.parquet(f"{place}/items"))


def train_collaborative_filtering(t: StoreTables, rank: int = ALS_RANK, max_iter: int = ALS_ITERS,
                                  reg: float = ALS_REG, seed: int = 42, path: str | None = None,
                                  recommendations_path: str | None = None,
                                  per_block: int = RATINGS_PER_BLOCK) -> Recommender:
    """Explicit ALS on the reviews. If ``path`` is given the model replaces the one
    saved there, which is how the recommender reads it; if
    ``recommendations_path`` is given, the cached recommendations made by the
    previous model are cleared (an empty collection with the same schema).

    ALS takes 32-bit ids, so customers and items are numbered densely first and
    keep their own 64-bit ids; reviews without either id teach nothing.

    A task of ALS holds one block: its ratings, and the factors that they name. So the
    number of blocks follows the ratings, about ``per_block`` in each.
    """
    data = ratings(t).dropna()
    counted = dense_index(data.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n")), ["customer_id"], "user_idx")
    users, n = counted.drop("_n"), counted.agg(F.sum("_n")).first()[0] or 0
    items = dense_index(data.select("item_id").distinct(), ["item_id"], "item_idx")
    indexed = data.join(users, "customer_id").join(items, "item_id").select("user_idx", "item_idx", "overall")
    # at least one block per core of the cluster (and ALS's default of 10): each
    # iteration updates factor blocks in parallel, so 10 blocks would cap a
    # large cluster at 10 tasks per step. More blocks exchange more factors, so lineage
    # is cut in the session's checkpoint folder at every iteration (checkpointInterval):
    # the shuffles of the one before are deleted then, else all stay until the end.
    blocks = max(10, data.sparkSession.sparkContext.defaultParallelism, -(-n // per_block))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="user_idx", itemCol="item_idx",
              ratingCol="overall", coldStartStrategy="drop", seed=seed, numUserBlocks=blocks,
              numItemBlocks=blocks, checkpointInterval=1)
    made = Recommender(als.fit(indexed), users, items)
    if path:
        made.save(path)
    if recommendations_path:
        sinks.clear_collection(t.item.sparkSession, RECOMMENDATION_SCHEMA, recommendations_path)
    return made


def recommend_products_flat(recommender: Recommender, t: StoreTables, users: DataFrame, n: int = TOP_RECS,
                            min_rating: float = MIN_RATING) -> DataFrame:
    """(customer_id, rank, id, rating, title, brand, imUrl, price): up to n items per
    requested user with predicted rating >= min_rating.

    ``users`` is the request (``customer_id``; repeated and unknown ids do no
    harm), which should be what is going to be shown.
    """
    return recommend_from_factors(recommender.model.userFactors, recommender.model.itemFactors, recommender.users,
                                  recommender.items, t, users, n, min_rating)


def recommend_from_factors(user_factors: DataFrame, item_factors: DataFrame, user_index: DataFrame, item_index: DataFrame,
                           t: StoreTables, users: DataFrame, n: int = TOP_RECS, min_rating: float = MIN_RATING) -> DataFrame:
    """``recommend_products_flat`` from factor tables (id, features) and the ids behind their indexes.

    Items whose factors are too short to reach a user's n-th place are not scored (``TopItems``).
    """
    asked = users.select(F.col("customer_id").cast("bigint").alias("customer_id")).distinct()
    wanted = user_index.join(asked, "customer_id", "left_semi")
    vectors = user_factors.select(F.col("id").alias("user_idx"), "features").join(wanted.select("user_idx"), "user_idx", "left_semi")
    recs = TopItems(item_factors.select(F.col("id").alias("item_idx"), "features")).best(vectors, n)
    flat = recs.filter(F.col("rating") >= min_rating).join(wanted, "user_idx").join(item_index, "item_idx")
    attrs = t.item.select("id", "title", "brand", "imUrl", "price")
    return (flat.join(attrs, F.col("item_id") == F.col("id"))
            .select("customer_id", "rank", "id", "rating", "title", "brand", "imUrl", "price"))


def recommend_products(recommender: Recommender, t: StoreTables, users: DataFrame, n: int = TOP_RECS,
                       min_rating: float = MIN_RATING, path: str | None = None,
                       json_path: str | None = None) -> DataFrame:
    """(customer_id, items: array<struct(id, title, brand, imUrl, price)>, json).

    The list holds at most n entries, ordered by predicted rating; ``json`` is the
    row as the reference's JSON response. With ``path`` the (customer_id, items)
    rows are also appended to that collection, in place of what an earlier request for the
    same customers appended; with ``json_path`` the responses are written there
    as text, one a line.
    """
    flat = recommend_products_flat(recommender, t, users, n, min_rating)
    doc = (flat.groupBy("customer_id")
           .agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id", "title", "brand", "imUrl", "price"))),
                            lambda r: F.struct(r["id"].alias("id"), r["title"].alias("title"),
                                               r["brand"].alias("brand"), r["imUrl"].alias("imUrl"),
                                               r["price"].alias("price"))).alias("items")))
    out = doc.select("customer_id", "items", F.to_json(F.struct("customer_id", "items")).alias("json"))
    if path or json_path:
        out = hold(out)
    if path:
        sinks.append_collection(out.select("customer_id", "items"), path, request=sinks.request_id(users))
    if json_path:
        sinks.replace_collection(out.select(F.col("json").alias("value")), json_path, "text")
    return out
