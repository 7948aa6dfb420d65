"""Store tables derived from the driver's parquet files.

The jobs work on an online store's tables: ``customer``, ``order``,
``ordereditem``, ``item``, ``category``, ``item_category``, ``review`` and the
``state_map`` dimension (state name -> abbreviation). The test data is a
TPC-H-like star schema, so each store table is a projection of one or two
parquet tables. Missing attributes come from integer arithmetic on the keys, so
the same definitions can be written in DuckDB SQL (see ``cartwise.plans.oracle``).

Every table is a lazy DataFrame: Catalyst prunes the columns a job does not use
and pushes its filters into the parquet scan. Keys stay 64-bit so the adapter
holds at any scale factor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")

# Fixed values of the adapter (shared with the oracle SQL).
BIRTHDATE_ANCHOR = "1995-12-31"   # birthdate = anchor - ((custkey * 7919) % 25000) days
STATE_MAP_NATIONS = 20            # nations with key < 20 form the known-state map


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class StoreTables:
    customer: DataFrame
    order: DataFrame
    ordereditem: DataFrame
    item: DataFrame
    category: DataFrame
    item_category: DataFrame
    review: DataFrame
    state_map: DataFrame
    item_tag: DataFrame
    item_kind: DataFrame | None = None   # only the test-data adapter knows an item's type
    colocated: bool = False              # order and ordereditem bucketed alike by order id


def _customer(raw_customer: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    birth = F.when(key % 17 == 0, F.lit(None).cast("date")).otherwise(
        F.date_sub(F.lit(BIRTHDATE_ANCHOR).cast("date"), ((key * 7919) % 25000).cast("int")))
    sex = (F.when(key % 5 == 0, F.lit(None).cast("string"))
           .when(key % 5 <= 2, F.lit("M")).otherwise(F.lit("F")))
    return (raw_customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(key.cast("bigint").alias("id"), F.col("c_name").alias("name"),
                    birth.alias("birthdate"), sex.alias("sex"), F.col("n_name").alias("state")))


def _state_map(nation: DataFrame) -> DataFrame:
    return (nation.filter(F.col("n_nationkey") < STATE_MAP_NATIONS)
            .select(F.col("n_name").alias("name"),
                    F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                    .alias("abbreviation")))


def _item(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    brand = (F.when(key % 31 == 0, F.lit(None).cast("string"))
             .when(key % 29 == 0, F.lit("")).otherwise(F.col("p_brand")))
    return part.select(
        key.cast("bigint").alias("id"), F.col("p_name").alias("title"), brand.alias("brand"),
        F.concat(F.col("p_type"), F.lit(" size "), F.col("p_size").cast("string")).alias("description"),
        F.concat(F.lit("img/"), key.cast("string"), F.lit(".jpg")).alias("imUrl"),
        F.col("p_retailprice").alias("price"))


def _item_tag(part: DataFrame) -> DataFrame:
    """(item_id, tag): the two words of the part name plus its type, as a set."""
    words = F.split(F.col("p_name"), " ", -1)
    tags = F.array(F.get(words, 0), F.get(words, 1), F.col("p_type"))
    return (part.select(F.col("p_partkey").cast("bigint").alias("item_id"),
                        F.explode(F.array_distinct(tags)).alias("tag"))
            .filter(F.col("tag").isNotNull()))


def _category(item_tag: DataFrame) -> DataFrame:
    """Category id = 100 + rank of the tag name; tags are a catalog dimension."""
    from cartwise.functions.indexing import dense_index
    tags = item_tag.select("tag").distinct()
    return (dense_index(tags, ["tag"], "rank0", bounded=True)
            .select((F.col("rank0") + 101).cast("int").alias("id"), F.col("tag").alias("name")))


def load_tables(spark: SparkSession, sf_dir: str) -> StoreTables:
    """Store tables adapted from the benchmark star schema in ``sf_dir``."""
    nation = read_raw(spark, sf_dir, "nation")
    part = read_raw(spark, sf_dir, "part")
    orders = read_raw(spark, sf_dir, "orders")
    lineitem = read_raw(spark, sf_dir, "lineitem")
    item_tag = _item_tag(part)
    category = _category(item_tag)
    item_category = (item_tag.join(category, item_tag["tag"] == category["name"])
                     .select(F.col("item_id").alias("items_id"), F.col("id").alias("categories_id")))
    order = orders.select(
        F.col("o_orderkey").cast("bigint").alias("id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("totalPrice"))
    ordereditem = lineitem.select(
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        F.col("l_quantity").cast("int").alias("quantity"))
    lk, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    review = (lineitem.join(orders, lk == F.col("o_orderkey"))
              .select(F.col("o_custkey").cast("bigint").alias("customer_id"),
                      pk.cast("bigint").alias("item_id"),
                      (1 + (lk * 7 + pk * 3 + ln) % 5).cast("double").alias("overall"),
                      F.col("l_quantity").cast("int").alias("helpful"),
                      ((lk + ln * 11) % 40).cast("int").alias("unhelpful"),
                      F.col("l_shipdate").cast("date").alias("date")))
    return StoreTables(
        customer=_customer(read_raw(spark, sf_dir, "customer"), nation),
        order=order, ordereditem=ordereditem, item=_item(part), category=category,
        item_category=item_category, review=review, state_map=_state_map(nation),
        item_tag=item_tag,
        item_kind=part.select(F.col("p_partkey").cast("bigint").alias("item_id"),
                              F.col("p_type").alias("kind")))


# ---------------------------------------------------------------------------
# the store's own schema (what a user of the reference has)
# ---------------------------------------------------------------------------

# The store's table names.
STORE_TABLES = ("customer", "order_", "ordereditem", "item", "category", "item_category", "review",
                "map_state_name_abbreviation")


def store_tables(read: Callable[[str], DataFrame]) -> StoreTables:
    """StoreTables from a reader of the store's own tables (name -> DataFrame).

    Only the columns the jobs use are selected, so the reader prunes the rest.
    Date and birthdate keep their source type (date or datetime): the
    comparisons with as-of dates and ``unix_timestamp`` accept both.
    """
    customer = read("customer").select(F.col("id").cast("bigint").alias("id"), "name", "birthdate", "sex", "state")
    order = read("order_").select(F.col("id").cast("bigint").alias("id"),
                                  F.col("customer_id").cast("bigint").alias("customer_id"), "date",
                                  F.col("totalPrice").cast("double").alias("totalPrice"))
    ordereditem = read("ordereditem").select(F.col("order_id").cast("bigint").alias("order_id"),
                                             F.col("item_id").cast("bigint").alias("item_id"),
                                             F.col("quantity").cast("int").alias("quantity"))
    item = read("item").select(F.col("id").cast("bigint").alias("id"), "title", "brand", "description", "imUrl",
                               F.col("price").cast("double").alias("price"))
    category = read("category").select(F.col("id").cast("int").alias("id"), "name")
    item_category = read("item_category").select(F.col("items_id").cast("bigint").alias("items_id"),
                                                 F.col("categories_id").cast("int").alias("categories_id"))
    review = read("review").select(F.col("customer_id").cast("bigint").alias("customer_id"),
                                   F.col("item_id").cast("bigint").alias("item_id"),
                                   F.col("overall").cast("double").alias("overall"),
                                   F.col("helpful").cast("int").alias("helpful"),
                                   F.col("unhelpful").cast("int").alias("unhelpful"), "date")
    state_map = read("map_state_name_abbreviation").select("name", "abbreviation")
    item_tag = (item_category.join(category, F.col("categories_id") == F.col("id"))
                .select(F.col("items_id").alias("item_id"), F.col("name").alias("tag")))
    return StoreTables(customer=customer, order=order, ordereditem=ordereditem, item=item, category=category,
                       item_category=item_category, review=review, state_map=state_map, item_tag=item_tag)


def load_store_parquet(spark: SparkSession, folder: str, fmt: str = "parquet") -> StoreTables:
    """The store's tables saved as ``<folder>/<table>`` in a Spark file format."""
    return store_tables(lambda name: spark.read.format(fmt).load(f"{folder.rstrip('/')}/{name}"))


def load_store_jdbc(spark: SparkSession, url: str, properties: dict[str, str],
                    partitioning: dict[str, tuple[str, int, int, int]] | None = None) -> StoreTables:
    """The store's tables read with Spark's JDBC source (the driver jar must be on
    the classpath). ``partitioning`` maps a table to (column, lower, upper,
    partitions) so a large table is read by many tasks in parallel ranges
    instead of one connection; the reference read every query through one."""
    parts = partitioning or {}

    def read(name: str) -> DataFrame:
        if name in parts:
            col, lo, hi, n = parts[name]
            return spark.read.jdbc(url, name, column=col, lowerBound=lo, upperBound=hi, numPartitions=n,
                                   properties=properties)
        return spark.read.jdbc(url, name, properties=properties)
    return store_tables(read)
