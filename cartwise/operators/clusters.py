"""Feature vectors, KMeans and centroid labelling shared by the segmentation jobs.

Vectors are sparse: a row holds its own slots of a vocabulary (brands, item
profiles or categories), however large that is. They are built with native
expressions (no Python UDF). Centroids are read as rows from the model's own
written data.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.holding import hold
from cartwise.functions.indexing import dense_index
from cartwise.functions.people import age_label
from cartwise.functions.scratch import scratch_path

SEED = 42


def vocabulary(df: DataFrame, key: str) -> DataFrame:
    """(key, idx): distinct keys numbered 0.. in ascending order.

    Held: it is a dimension-sized frame read by the vectors, the labels and
    the report.
    """
    keys = df.select(key).distinct().filter(F.col(key).isNotNull())
    return hold(dense_index(keys, [key], "idx", bounded=True))


def vocab_size(vocab: DataFrame) -> int:
    """Slots of a vocabulary, 0 if it is empty."""
    top = vocab.agg(F.max("idx")).first()[0]
    return 0 if top is None else int(top) + 1


def with_sparse_vectors(rows: DataFrame, slots: str, size: int, name: str = "features") -> DataFrame:
    """``rows`` with the ascending (idx, _value) of ``slots`` as a sparse ``pyspark.ml`` vector, ``name``.

    There is no SQL function for one. A vector is stored as four plain fields,
    so these are written to the shared checkpoint folder and read back with the
    vector's type: no text, no Python, and a lost executor costs a read.
    """
    spark = rows.sparkSession
    fields = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform(slots, lambda s: s["idx"]).alias("indices"),
                      F.transform(slots, lambda s: s["_value"]).alias("values"))
    kept = [c for c in rows.columns if c != slots]
    path = scratch_path(spark, "vectors")
    rows.select(*kept, fields.alias(name)).write.parquet(path)
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(name, VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def _slots(rows: DataFrame, by: list[str], value: F.Column) -> DataFrame:
    """(by..., slots): the (idx, value) of each row group, by slot; a slot that repeats counts once."""
    once = rows.groupBy(*by, "idx").agg(F.max(value).alias("_value"))
    return once.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("idx", "_value"))).alias("_slots"))


def share_vectors(shares: DataFrame, vocab: DataFrame, key: str, id_col: str,
                  n: int | None = None) -> DataFrame:
    """(id_col, age_code, features): share per vocabulary slot, then the age code.

    The age code is appended unnormalized, as in the reference (it dominates
    the distance; kept on purpose).
    """
    n = n if n is not None else vocab_size(vocab)
    per = _slots(shares.join(vocab, key), [id_col, "age_code"], F.col("share"))
    age = F.struct(F.lit(n).alias("idx"), F.col("age_code").cast("double").alias("_value"))
    return with_sparse_vectors(per.withColumn("_slots", F.concat("_slots", F.array(age))), "_slots", n + 1)


def multi_hot_vectors(pairs: DataFrame, vocab: DataFrame, key: str, id_col: str,
                      n: int | None = None) -> DataFrame:
    """(id_col, features): 1.0 in every slot of a key the id has, else 0.0."""
    n = n if n is not None else vocab_size(vocab)
    per = _slots(pairs.join(vocab, key), [id_col], F.lit(1.0))
    return with_sparse_vectors(per, "_slots", n)


def fit_kmeans(feats: DataFrame, k: int, max_iter: int, seed: int = SEED):
    """Seeded KMeans (k-means||). Returns (model, (id..., prediction) frame);
    without any row there is no model, and the frame is empty.

    The input is a written table, which KMeans keeps in memory for its iterations; every
    iteration is a distributed pass.
    """
    if feats.isEmpty():
        return None, feats.drop("features").withColumn("prediction", F.lit(0))
    model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features",
                   predictionCol="prediction").fit(feats)
    assigned = model.transform(feats).drop("features")
    return model, assigned


def centroids_long(model, spark: SparkSession) -> DataFrame:
    """(prediction, pos, weight): one row per centroid coordinate (k x dims), from the model's written data."""
    if model is None:
        return spark.createDataFrame([], "prediction int, pos int, weight double")
    path = scratch_path(spark, "kmeans")
    model.write().save(path)
    centers = spark.read.parquet(f"{path}/data")
    return centers.select(F.col("clusterIdx").alias("prediction"),
                          F.posexplode(vector_to_array("clusterCenter")).alias("pos", "weight"))


def top_slots(dims: DataFrame, n: int) -> DataFrame:
    """(prediction, pos, rank): the n heaviest slots; ties go to the higher slot."""
    w = Window.partitionBy("prediction").orderBy(F.col("weight").desc(), F.col("pos").desc())
    return (dims.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("prediction", "pos", "rank"))


def cluster_report(assigned: DataFrame, cent: DataFrame, labels: DataFrame, buckets,
                   label_col: str, n: int) -> DataFrame:
    """(profile_id, number_customers, age_interval, label_col) per non-empty cluster.

    ``n`` is the vocabulary size: the age code sits in slot n. The age label
    comes from that centroid coordinate, truncated.
    """
    sizes = assigned.groupBy("prediction").agg(F.count(F.lit(1)).alias("number_customers"))
    ages = cent.filter(F.col("pos") == n).select(
        "prediction", age_label(F.floor("weight").cast("int"), buckets).alias("age_interval"))
    return (sizes.join(ages, "prediction").join(labels, "prediction", "left")
            .select(F.col("prediction").alias("profile_id"), "number_customers", "age_interval",
                    label_col))
