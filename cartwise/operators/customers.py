"""Customer jobs: best reviewers, demographics overview, segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.holding import hold
from cartwise.functions.people import (BRAND_AGE_BUCKETS, PROFILE_AGE_BUCKETS, SECONDS_PER_YEAR,
                                       age_code, age_seconds, known_states,
                                       state_code, whole_age)
from cartwise.operators import clusters as cl
from cartwise.sources.tables import StoreTables

TOP_REVIEWERS = 20
BRAND_K, BRAND_ITERS = 5, 100
PROFILE_K, PROFILE_ITERS = 5, 20
TOP_BRANDS = 7


def best_reviewers(t: StoreTables, n: int = TOP_REVIEWERS) -> DataFrame:
    """(name, customerId, usefullness, numberOfReviews): top n by helpful - unhelpful.

    Reviews are reduced to one row per customer before the customer join, so
    the join and the top-n see #customers rows, not #reviews. Ties by id.
    """
    per = (t.review.groupBy("customer_id")
           .agg(F.sum((F.col("helpful") - F.col("unhelpful")).cast("bigint")).alias("usefullness"),
                F.count(F.lit(1)).alias("numberOfReviews")))
    cust = t.customer.select(F.col("id").alias("customer_id"), "name")
    return (per.join(cust, "customer_id")
            .orderBy(F.col("usefullness").desc(), F.col("customer_id").asc()).limit(n)
            .select("name", F.col("customer_id").alias("customerId"), "usefullness", "numberOfReviews"))


# ---------------------------------------------------------------------------
# overview
# ---------------------------------------------------------------------------

def _age_sums_by_state(t: StoreTables, as_of) -> DataFrame:
    """One pass: per known state, exact integer sums of age seconds and counts,
    overall and for sex M and F. Everything else rolls up from these rows."""
    c = known_states(t.customer.dropna(subset=["birthdate"]), "state", t.state_map)
    secs = age_seconds(F.col("birthdate"), as_of)
    male, female = F.col("sex") == "M", F.col("sex") == "F"
    return (c.groupBy("state", "abbreviation")
            .agg(F.sum(secs).alias("s_all"), F.count(F.lit(1)).alias("n_all"),
                 F.sum(F.when(male, secs)).alias("s_m"), F.count(F.when(male, 1)).alias("n_m"),
                 F.sum(F.when(female, secs)).alias("s_f"), F.count(F.when(female, 1)).alias("n_f")))


def _mean_age(s: F.Column, n: F.Column) -> F.Column:
    """Mean of fractional ages from the exact sum of seconds."""
    # null (not an ANSI division error) when the group is empty, e.g. no 'F' customers
    return F.try_divide(s.cast("double"), n.cast("double")) / F.lit(float(SECONDS_PER_YEAR))


def customers_mean_age(t: StoreTables, as_of) -> DataFrame:
    """(average_age, average_age_male, average_age_female): one row."""
    s = _age_sums_by_state(t, as_of)
    tot = s.agg(*[F.sum(c).alias(c) for c in ("s_all", "n_all", "s_m", "n_m", "s_f", "n_f")])
    return tot.select(_mean_age(F.col("s_all"), F.col("n_all")).alias("average_age"),
                      _mean_age(F.col("s_m"), F.col("n_m")).alias("average_age_male"),
                      _mean_age(F.col("s_f"), F.col("n_f")).alias("average_age_female"))


def customers_age_by_state(t: StoreTables, as_of) -> DataFrame:
    """(name, abbreviation, age): mean age per known state."""
    s = _age_sums_by_state(t, as_of)
    return s.select(F.col("state").alias("name"), state_code(F.col("abbreviation")).alias("abbreviation"),
                    _mean_age(F.col("s_all"), F.col("n_all")).alias("age"))


def customers_by_state(t: StoreTables, as_of) -> DataFrame:
    """(name, abbreviation, totalCustomers): customers with a birthdate per known state."""
    s = _age_sums_by_state(t, as_of)
    return s.select(F.col("state").alias("name"), state_code(F.col("abbreviation")).alias("abbreviation"),
                    F.col("n_all").alias("totalCustomers"))


def customers_overview(t: StoreTables, as_of) -> DataFrame:
    """The one-row document; the per-state lists are bounded by the state map."""
    s = _age_sums_by_state(t, as_of)
    tot = s.agg(*[F.sum(c).alias(c) for c in ("s_all", "n_all", "s_m", "n_m", "s_f", "n_f")],
                F.sort_array(F.collect_list(F.struct(
                    F.col("state").alias("name"), state_code(F.col("abbreviation")).alias("abbreviation"),
                    _mean_age(F.col("s_all"), F.col("n_all")).alias("age")))).alias("average_age_by_state"),
                F.sort_array(F.collect_list(F.struct(
                    F.col("state").alias("name"), state_code(F.col("abbreviation")).alias("abbreviation"),
                    F.col("n_all").alias("totalCustomers")))).alias("customers_by_state"))
    return tot.select(_mean_age(F.col("s_all"), F.col("n_all")).alias("average_age"),
                      _mean_age(F.col("s_m"), F.col("n_m")).alias("average_age_male"),
                      _mean_age(F.col("s_f"), F.col("n_f")).alias("average_age_female"),
                      "average_age_by_state", "customers_by_state")


# ---------------------------------------------------------------------------
# segmentation
# ---------------------------------------------------------------------------

def _units_by_customer(t: StoreTables, keyed_items: DataFrame, key: str) -> DataFrame:
    """(customer_id, <key>, quantity): units per customer and key (brand or profile).

    Lines meet their order's buyer and their item's key, and are summed per
    (customer, key) with map-side combining; customers (for the birthdate) are
    joined to those sums only, so that join sees one row per customer and key.
    """
    orders = t.order.select(F.col("id").alias("_oid"), F.col("customer_id"))
    return (t.ordereditem.join(orders, F.col("order_id") == F.col("_oid"))
            .join(keyed_items, "item_id")
            .groupBy("customer_id", key).agg(F.sum(F.col("quantity").cast("bigint")).alias("quantity")))


def _shares(units: DataFrame, t: StoreTables, key: str, as_of, buckets) -> DataFrame:
    """(customer_id, age_code, <key>, quantity, share): quantity share per key,
    for customers with a birthdate.

    The customer's total is a window over the (customer, key) sums, whose
    partition per customer is bounded by the vocabulary (brands or profiles),
    not by the lines; a customer holding a third of all lines arrives as a few
    partial sums per task.
    """
    cust = t.customer.dropna(subset=["birthdate"]).select(F.col("id").alias("customer_id"), "birthdate")
    per = units.join(cust, "customer_id")
    total = F.sum("quantity").over(Window.partitionBy("customer_id"))
    # as the reference: normalize only when the customer's total is positive
    share = F.when(total > 0, F.col("quantity").cast("double") / total.cast("double")) \
        .otherwise(F.col("quantity").cast("double"))
    return per.select("customer_id", age_code(whole_age(F.col("birthdate"), as_of), buckets).alias("age_code"),
                      key, "quantity", share.alias("share"))


def customer_brand_shares(t: StoreTables, as_of) -> DataFrame:
    """(customer_id, age_code, brand, quantity, share); null and blank brands dropped."""
    items = t.item.filter(F.col("brand").isNotNull() & (F.col("brand") != "")) \
        .select(F.col("id").alias("item_id"), "brand")
    return _shares(_units_by_customer(t, items, "brand"), t, "brand", as_of, BRAND_AGE_BUCKETS)


def customer_profile_shares(t: StoreTables, profile_map: DataFrame, as_of) -> DataFrame:
    """(customer_id, age_code, profile_id, quantity, share) over a profile map."""
    pm = profile_map.select("item_id", "profile_id")
    return _shares(_units_by_customer(t, pm, "profile_id"), t, "profile_id", as_of, PROFILE_AGE_BUCKETS)


def segments_age_brand(t: StoreTables, as_of, k: int = BRAND_K, max_iter: int = BRAND_ITERS,
                       seed: int = cl.SEED) -> DataFrame:
    """(profile_id, number_customers, age_interval, brands): KMeans over share
    vectors with the age code as last coordinate; top 7 brands per centroid."""
    shares = hold(customer_brand_shares(t, as_of))
    vocab = cl.vocabulary(shares, "brand")
    n = cl.vocab_size(vocab)
    feats = cl.share_vectors(shares, vocab, "brand", "customer_id", n)
    model, assigned = cl.fit_kmeans(feats, k, max_iter, seed)
    return brand_report(assigned, cl.centroids_long(model, feats.sparkSession), vocab, n)


def brand_report(assigned: DataFrame, cent: DataFrame, vocab: DataFrame, n: int) -> DataFrame:
    """The brand segmentation's rows, from any clusters: (.., prediction) rows and long centroids."""
    dims = cent.filter(F.col("pos") < F.lit(n))
    top = cl.top_slots(dims, TOP_BRANDS).join(vocab.withColumnRenamed("idx", "pos"), "pos")
    brands = top.groupBy("prediction").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "brand"))), lambda r: r["brand"])
        .alias("brands"))
    return cl.cluster_report(assigned, cent, brands, BRAND_AGE_BUCKETS, "brands", n)


def segments_age_profile(t: StoreTables, profile_map: DataFrame, as_of, k: int = PROFILE_K,
                         max_iter: int = PROFILE_ITERS, seed: int = cl.SEED) -> DataFrame:
    """(profile_id, number_customers, age_interval, categories): as the brand
    segmentation; the label is the categories of the heaviest item profile."""
    shares = hold(customer_profile_shares(t, profile_map, as_of))
    vocab = cl.vocabulary(shares, "profile_id")
    n = cl.vocab_size(vocab)
    feats = cl.share_vectors(shares, vocab, "profile_id", "customer_id", n)
    model, assigned = cl.fit_kmeans(feats, k, max_iter, seed)
    return profile_report(assigned, cl.centroids_long(model, feats.sparkSession), vocab, profile_map, n)


def profile_report(assigned: DataFrame, cent: DataFrame, vocab: DataFrame, profile_map: DataFrame, n: int) -> DataFrame:
    """The profile segmentation's rows, from any clusters: (.., prediction) rows and long centroids."""
    dims = cent.filter(F.col("pos") < F.lit(n))
    heaviest = dims.groupBy("prediction").agg(
        F.max_by("pos", F.struct("weight", -F.col("pos"))).alias("pos"))
    cats = profile_map.groupBy("profile_id").agg(F.first("categories").alias("categories"))
    labels = (heaviest.join(vocab.withColumnRenamed("idx", "pos"), "pos").join(cats, "profile_id")
              .select("prediction", "categories"))
    return cl.cluster_report(assigned, cent, labels, PROFILE_AGE_BUCKETS, "categories", n)
