"""From raw documents to packed training sequences, stage by stage.

Every stage works on all that its predecessor kept and returns the columns of
the documents, the last one the packed pieces. Between stages the documents are
written as Parquet to the shared checkpoint folder and read again, so a lost
executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, exact_dedup, language_id, ngram_join, packing
from cartwise.llm.common import documents, fresh, learnable, written
from cartwise.llm.queries import tokenizer_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no letter in them, or too narrow a margin."""
    all_docs = documents(spark, sf_dir)
    fitted = language_id.fit(all_docs.filter(learnable(all_docs, 4, 2)))
    found, = fresh(docs, "_language")
    return (docs.withColumn(found, language_id.identify(fitted, F.col("text").cast("string")))
            .filter(F.col(found)["accepted"]).select(*docs.columns))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs, exact_dedup.exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect one row with the smallest doc_id stays.

    It is rows that go, not ids: another text of the same doc_id stays if nothing
    links it. Documents without a word, and rows without a doc_id, stay. Rows
    repeating a (doc_id, text) are one document and go or stay together.
    """
    key, row = fresh(docs, "_near_copy_id", "_near_copy_row")
    found = written(ngram_join.near_duplicates(docs, by_row=True).filter("vertex IS NOT NULL AND doc_id IS NOT NULL")
                    .select("doc_id", "row", "component_id", "label"), "near_rows")
    least = found.filter("doc_id = component_id")
    several = (least.groupBy("label").agg(F.min("row").alias("_first"), F.max("row").alias("_last"))
               .filter("_first < _last").select(F.col("label").alias("_label"), "_first"))
    later = least.join(several, F.col("label") == F.col("_label")).filter("row <> _first")
    gone = written(found.filter("doc_id <> component_id").select("doc_id", "row").unionByName(later.select("doc_id", "row"))
                   .select(F.col("doc_id").alias(key), F.col("row").alias(row)).distinct(), "near_copies")
    same = (F.col("doc_id").cast("long") == F.col(key)) & (F.xxhash64(F.col("text").cast("string")) == F.col(row))
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window in them go."""
    found, = fresh(docs, "_contamination")
    hits = decontaminate.find_contamination(docs, documents(spark, sf_dir, "benchmark"), found,
                                            F.col("text").cast("string"))
    return hits.filter(F.size(F.col(found)["spans"]) == 0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Compression, tokenizing and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
