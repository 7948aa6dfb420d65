"""Item profiles: multi-hot category vectors clustered with KMeans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.holding import hold
from cartwise.functions.indexing import dense_index
from cartwise.operators import clusters as cl
from cartwise.sources.tables import StoreTables

ITEM_K, ITEM_ITERS = 150, 20
LABEL_THRESHOLD = 0.5

PROFILE_MAP_COLUMNS = ["profile_id", "item_id", "categories", "item_brand", "item_description",
                       "item_imUrl", "item_title", "item_price"]


def item_category_features(t: StoreTables) -> DataFrame:
    """(item_id, category_id, category): the multi-hot features in long form.

    Items without categories have no row (inner join), as in the reference.
    """
    cats = t.category.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    return (t.item_category.join(cats, F.col("categories_id") == F.col("category_id"))
            .join(t.item.select(F.col("id").alias("item_id")), F.col("items_id") == F.col("item_id"))
            .select("item_id", "category_id", "category"))


def _item_attributes(t: StoreTables) -> DataFrame:
    return t.item.select(F.col("id").alias("item_id"), F.col("brand").alias("item_brand"),
                         F.col("description").alias("item_description"),
                         F.col("imUrl").alias("item_imUrl"), F.col("title").alias("item_title"),
                         F.col("price").alias("item_price"))


def item_profiles(t: StoreTables, k: int = ITEM_K, max_iter: int = ITEM_ITERS,
                  seed: int = cl.SEED) -> tuple[DataFrame, DataFrame]:
    """Return (item_profiles, item_profile_map).

    item_profiles: (profile_id, number_items, categories) per non-empty cluster;
    categories are the slots whose centroid weight is >= 0.5, in category order.
    item_profile_map: one row per item with categories, its profile and attributes.
    """
    feats, vocab = item_vectors(t)
    model, assigned = cl.fit_kmeans(feats, k, max_iter, seed)
    return profile_reports(t, assigned, cl.centroids_long(model, feats.sparkSession), vocab)


def item_vectors(t: StoreTables) -> tuple[DataFrame, DataFrame]:
    """((item_id, features), (category_id, category, idx)): multi-hot vectors over every category, numbered in id order."""
    vocab = hold(dense_index(t.category.select(F.col("id").alias("category_id"), F.col("name").alias("category")),
                             ["category_id"], "idx", bounded=True))
    feats = cl.multi_hot_vectors(item_category_features(t), vocab.drop("category"), "category_id", "item_id",
                                 cl.vocab_size(vocab))
    return feats, vocab


def profile_reports(t: StoreTables, assigned: DataFrame, cent: DataFrame, vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``item_profiles``'s two frames, from any clusters: (item_id, prediction) and long centroids."""
    labels = (cent.filter(F.col("weight") >= LABEL_THRESHOLD)
              .join(vocab.withColumnRenamed("idx", "pos"), "pos")
              .groupBy("prediction")
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "category"))),
                               lambda r: r["category"]).alias("categories")))
    cats = F.coalesce(F.col("categories"), F.array().cast("array<string>"))
    sizes = assigned.groupBy("prediction").agg(F.count(F.lit(1)).alias("number_items"))
    profiles = (sizes.join(labels, "prediction", "left")
                .select(F.col("prediction").alias("profile_id"), "number_items", cats.alias("categories")))
    profile_map = (assigned.join(labels, "prediction", "left").join(_item_attributes(t), "item_id")
                   .select(F.col("prediction").alias("profile_id"), "item_id", cats.alias("categories"),
                           "item_brand", "item_description", "item_imUrl", "item_title", "item_price"))
    return profiles, profile_map


def fixed_profile_map(t: StoreTables) -> DataFrame:
    """A deterministic profile map for checks: profile = the item's type.

    profile_id is the category id of the type tag, categories = [type]. Same
    columns as the KMeans map, so every reader of a profile map accepts it.
    """
    cats = t.category.select(F.col("id").alias("profile_id"), F.col("name").alias("kind"))
    return (t.item_kind.join(cats, "kind").join(_item_attributes(t), "item_id")
            .select("profile_id", "item_id", F.array("kind").alias("categories"), "item_brand",
                    "item_description", "item_imUrl", "item_title", "item_price"))
