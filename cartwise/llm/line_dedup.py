"""Line deduplication over overlapping windows of three consecutive lines.

Every window of ``WINDOW`` lines is hashed (two 64-bit words). Windows that
occur more than once are found by one pre-aggregated count over all documents,
which also keeps the first occurrence of each by (doc_id, position); a window
that a third of all documents hold costs a row per task there. Each occurrence
of a repeated window but the first covers its lines, and the covered positions
of a document are merged and its lines there removed. Lines that the first
occurrence covers itself (a line repeating on the spot) stay. Whatever is
removed is still there at an earlier place.

Only window hashes and positions are shuffled: texts are read where they lie,
and joined at the end with the positions of the documents that lose lines.

Defined results: lines are separated by a line feed. A null text stays null,
with 0 lines; an empty one is one empty line. Texts of fewer lines than a
window are left alone, and so are windows without any word character. Rows of
one doc_id are told apart by their texts; rows repeating a (doc_id, text) are
one document and come out as often as they went in. Rows with a null doc_id
count as the first of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import fresh, texts, written

#: Consecutive lines of a window.
WINDOW = 3


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, row, pos, h1, h2): every window of every document; ``row`` tells its texts apart."""
    own = docs.select("doc_id", F.xxhash64("text").alias("row"), lines(F.col("text")).alias("line"))
    own = own.filter(F.size("line") >= size)
    hashed = own.select("doc_id", "row", F.transform("line", lambda x: F.struct(
        F.xxhash64(x).alias("p"), F.xxhash64(F.lit(1), x).alias("q"), x.rlike(r"[^\W_]|[^\x00-\x7F]").alias("text"))
    ).alias("line"))
    parts = [F.expr(f"slice(line, {k + 1}, size(line) - {size - 1})") for k in range(size)]
    zipped = F.arrays_zip(*[p.alias(f"l{k}") for k, p in enumerate(parts)])
    w = hashed.select("doc_id", "row", F.posexplode(zipped).alias("pos", "w"))
    some = F.lit(False)
    for k in range(size):
        some = some | F.col(f"w.l{k}.text")
    return w.filter(some).select("doc_id", "row", "pos",
                                 F.xxhash64(*[F.col(f"w.l{k}.p") for k in range(size)]).alias("h1"),
                                 F.xxhash64(*[F.col(f"w.l{k}.q") for k in range(size)]).alias("h2"))


def covered(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, row, positions): the lines that each document loses, ascending."""
    distinct = texts(docs).filter("text IS NOT NULL")
    place = F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long")).alias("doc_id"), F.col("row"), F.col("pos"))
    windows = _windows(distinct, size).select(place.alias("place"), "h1", "h2")
    # a row that repeats has each window at the same place: more than one place means repeated
    repeated = written(windows.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                       .filter("first < last").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first"),
                       "repeated_windows")
    later = (windows.join(repeated, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
             .filter(F.col("place") != F.col("first")))
    same = (F.col("place.doc_id") == F.col("first.doc_id")) & (F.col("place.row") == F.col("first.row"))
    start = F.when(same, F.greatest(F.col("place.pos"), F.col("first.pos") + size)).otherwise(F.col("place.pos"))
    stop = F.col("place.pos") + size - 1
    spans = later.select("place.doc_id", "place.row", start.alias("start"), stop.alias("stop")).filter("start <= stop")
    positions = spans.select("doc_id", "row", F.explode(F.sequence("start", "stop")).alias("at"))
    # of one document: no more positions than its own lines
    return positions.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("positions"))


def line_dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and ``n_lines``, ``n_removed``."""
    gone = written(covered(docs, size), "covered_lines")
    key, row, at, n_lines, n_removed = fresh(docs, "_doc", "_row", "_at", "n_lines", "n_removed")
    gone = gone.select(F.col("doc_id").alias(key), F.col("row").alias(row), F.col("positions").alias(at))
    text = F.col("text").cast("string")
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    # a sort-merge join at every size: what is joined grows with the corpus
    joined = docs.join(gone.hint("merge"), (place == F.col(key)) & (F.xxhash64(text) == F.col(row)), "left")
    kept = F.filter(lines(text), lambda _, i: ~F.array_contains(F.col(at), i))
    return joined.select(*[F.when(F.col(at).isNull(), text).otherwise(F.array_join(kept, "\n")).alias(c)
                           if c.lower() == "text" else F.col(c) for c in docs.columns],
                         F.coalesce(F.size(lines(text)), F.lit(0)).cast("long").alias(n_lines),
                         F.coalesce(F.size(at), F.lit(0)).cast("long").alias(n_removed))
