"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its distinct runs of five consecutive words (lower-cased
A-Z); fewer words are one shingle. Each is hashed to 60 bits, 15 hexadecimal digits of
its MD5 (which plain SQL engines have too), and the ``K`` smallest hashes are the sketch. Sketches of the parts of a collection merge into
the sketch of the whole: the ``K`` smallest of all. From sketches alone follow

* the number of distinct shingles: exact below ``K``, else from how densely the
  smallest hashes lie (relative error about 1 / sqrt(K)),
* the resemblance of two sets (Jaccard): the share of common hashes among the
  ``K`` smallest of both together (error at most about 0.5 / sqrt(K)),
* the containment of one set in another: the share of its hashes, up to where
  both sketches are complete, that the other one has.

Everything is SQL functions on one row, or, for merging, a ranking within keys
that every task applies before it shuffles.

Defined results: a null text is an empty one. Texts without a word have the
empty sketch, whose fingerprint is the empty string; two of them are alike (1),
one of them is like no other text (0), and is contained in every text. Rows with a null
doc_id come before all others; rows of one doc_id follow each other by their
texts, and rows repeating a (doc_id, text) each count. A single row is its own
successor. An empty table gives an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import texts
from cartwise.llm.exact_dedup import normalised
from cartwise.llm.ordered import RANGE_ROWS, by_ranges

#: Hashes in a sketch. Spark ranks within a key before the shuffle for up to 1,000.
K = 256
#: Consecutive words of a shingle.
SHINGLE = 5

#: Hexadecimal digits of a hash.
DIGITS = 15


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of a text's shingles, in the text's order, repeats included."""
    words = F.filter(F.split(normalised(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashed(words: Column) -> Column:
        last = F.greatest(F.size(words) - (size - 1), F.lit(1))
        starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(
            F.md5(F.array_join(F.slice(words, i, F.lit(size)), " ").cast("binary")), 1, DIGITS))

    return _once(words, hashed)


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` computed once, not again for each element that a lambda in ``of`` sees."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def sketch(text: Column | str, k: int = K, size: int = SHINGLE) -> Column:
    """The ``k`` smallest distinct shingle hashes of a text, ascending."""
    text = F.col(text) if isinstance(text, str) else text
    return F.slice(F.sort_array(F.array_distinct(shingles(text, size))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both sets together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(rows: DataFrame, key: str, of: str = "sketch", k: int = K) -> DataFrame:
    """(key, sketch): one sketch for all rows of a key.

    Hashes are made distinct and ranked in each task first, so a hot key sends
    ``k`` hashes a task (``k`` up to 1,000), and no list is longer than ``k``.
    """
    keys = rows.select(key).distinct()
    hashes = rows.select(key, F.explode(of).alias("_hash")).distinct()
    least = hashes.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy("_hash"))).filter(F.col("_rank") <= k)
    lists = least.groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_list("_hash")).alias("_list"))
    return keys.join(lists, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key, F.coalesce("_list", F.array().cast("array<string>")).alias(of))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Number of distinct shingles behind a sketch; exact where it has fewer than ``k`` hashes."""
    reach = (F.conv(F.try_element_at(a, F.lit(k)), 16, 10).cast("bigint").cast("double") + 1) / float(16 ** DIGITS)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sets, 0 to 1."""
    both = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.greatest(F.size(both), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the set of ``a`` that lies in the set of ``b``, 0 to 1."""
    far = F.lit("g")        # beyond every hash
    reach = F.least(F.when(F.size(a) < k, far).otherwise(F.array_max(a)), F.when(F.size(b) < k, far).otherwise(F.array_max(b)))
    seen = _once(reach, lambda r: F.filter(a, lambda h: h <= r))
    return F.when(F.size(a) == 0, 1.0).when(F.size(seen) == 0, 0.0).otherwise(
        F.size(F.array_intersect(seen, b)) / F.greatest(F.size(seen), F.lit(1)))


def fingerprint(a: Column) -> Column:
    """A sketch as text: its hashes, ascending, comma-joined."""
    return F.array_join(a, ",")


def parsed(text: Column) -> Column:
    """The sketch that ``fingerprint`` wrote."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def edited_fingerprints(docs: DataFrame, k: int = K, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, sketch, edited, edited_sketch, next_sketch): each text, its edited form and its successor.

    The edited text ends, instead of in its last floor(n / 2) code points, in the
    first as many (or all) of the next document's, by ascending doc_id. Whole texts
    are shuffled once, dealt by ranges of ids.
    """
    rows = texts(docs).select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("id"),
                              F.coalesce("text", F.lit("")).alias("text"))
    dealt, order = by_ranges(rows, range_rows)
    own = (dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("sketch", sketch("text", k))
           .withColumn("next_sketch", F.lead("sketch").over(order)).filter("copy = 0"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    return (own.select("doc_id", "text", "sketch", edited.alias("edited"), "next_sketch")
            .withColumn("edited_sketch", sketch("edited", k)))
