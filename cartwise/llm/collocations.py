"""Phrase collocations from count streams in word order, merge-joined.

One pass over the texts makes the *stream*: each task counts, in bounded chunks,
the runs of up to ``LONGEST`` words that start at every word (shorter only where
their piece of text ends), in word order, and deals them out by ranges of that
order. A range is sorted and read once: in word order all runs that begin
alike lie together, so the counts of every shorter phrase come from the same
sequential pass, with one open sum a length and nothing hashed. A phrase that
begins before its range or ends after it leaves a partial sum, and those are
added up at the end; so a hot word or phrase is split like any other. Where
ranges begin is taken from the runs of a sample of the texts; it decides which task counts
what, and nothing else.

What is frequent is kept in two streams. The *prefix stream* has phrases beside
their first parts, the *suffix stream* beside what follows those; each is
sort-merge joined with the counts (left and right), and phrases with one more word in front or
behind give the extension counts. Parts of a frequent phrase are frequent, and a
phrase that covers another one also covers it with one more word only, at least as
often; so the frequent phrases are all that is needed.

The score of a cut is floor(2,000,000 * a / (l + r)), a phrase's is its lowest.
All arithmetic is on integers and decimals.

Defined results: a null text is an empty one and gives nothing; a null language
is ``und``. Each row counts, repeated ones too; doc_id and other columns are not looked
at. Ties in score and count go by the phrase's UTF-8 bytes. Words may hold any
character that separates neither words nor pieces, control characters included.
An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import written

#: Words of the longest candidate, and the least count of one.
LONGEST = 4
LEAST = 30
#: An extension that occurs this often, in percent, makes a phrase redundant.
COVERED = 80
#: Results a language.
TOP = 2000
#: Tasks' first ranking of a language is dealt to so many parts.
PARTS = 64

#: Bytes of text that a task counts at a time; a longer text is counted alone.
CHUNK_BYTES = 12 << 20
#: Rows of the sorted stream that a task looks at at a time.
STREAM_ROWS = 1 << 16

#: One text of so many gives runs to choose ranges from, so many ranges there are for each shuffle partition,
#: and so many runs the driver chooses each from.
SAMPLED = 64
RANGES = 8
CHOICE = 4

#: Separates words within a key; no word holds it, and no word's character sorts below it once escaped.
SEP = "\t"
ESCAPE = "\x0e"
_LOW = [chr(c) for c in (*range(9), 14)]


def escaped(values: pa.Array) -> pa.Array:
    """``values`` without characters below the separator: word order is then the order of the joined text."""
    if pc.any(pc.match_substring_regex(values, "[\\x00-\\x08\\x0E]")).as_py():
        values = pc.replace_substring(values, ESCAPE, ESCAPE + chr(ord(ESCAPE) + 0x20))
        for c in _LOW[:-1]:
            values = pc.replace_substring(values, c, ESCAPE + chr(ord(c) + 0x20))
    return values


def unescaped(phrase: Column) -> Column:
    for c in _LOW:
        phrase = F.replace(phrase, F.lit(ESCAPE + chr(ord(c) + 0x20)), F.lit(c))
    return phrase


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Ranks of all words in order, 0 where a piece ends, and the words by rank (from 1)."""
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), "[.,;:!?\\x0A-\\x0D]+", " . ")
    ended = pc.binary_join_element_wise(marked, pa.scalar(" . "), "")
    coded = pc.ascii_split_whitespace(ended).flatten().dictionary_encode()
    words = coded.dictionary
    ends = pc.is_in(words, pa.array([".", ""])).to_numpy(zero_copy_only=False)
    safe = escaped(words)
    order = pc.array_sort_indices(safe.cast(pa.binary())).to_numpy()
    order = order[~ends[order]]
    rank = np.zeros(len(words), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return rank[coded.indices.to_numpy()], pa.concat_arrays([pa.array([""]), safe.take(pa.array(order))])


def _counted(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The runs of up to four words that start at each word, joined, in word order, and how often each occurs."""
    ranks, words = _words(texts)
    ranks = np.concatenate([ranks, np.zeros(LONGEST, np.int64)])
    size = len(words) + 1
    pairs = ranks[:-1] * size + ranks[1:]
    pairs[ranks[:-1] == 0] = 0
    distinct, pair = np.unique(pairs, return_inverse=True)      # the zeros at the end make 0 the first
    n = len(ranks) - LONGEST + 1
    then = pair[2:].copy()
    then[ranks[1:n + 1] == 0] = 0       # the piece ended: what follows is another one
    runs, counts = np.unique((pair[:n] * len(distinct) + then)[ranks[:n] > 0], return_counts=True)
    for start in range(0, len(runs), STREAM_ROWS):
        part = runs[start:start + STREAM_ROWS]
        first, second = distinct[part // len(distinct)], distinct[part % len(distinct)]
        columns = [words.take(pa.array(c)) for c in (first // size, first % size, second // size, second % size)]
        yield pc.utf8_rtrim(pc.binary_join_element_wise(*columns, SEP), SEP), counts[start:start + STREAM_ROWS]


def _stream(batches: Iterator[pa.RecordBatch], starts: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs with their counts and their ranges; ``starts`` are the keys at which ranges after the first begin."""
    opens = [k.encode() for k in starts]
    held: list[pa.RecordBatch] = []

    def ranges(keys: pa.Array) -> np.ndarray:
        """Which range each of some ascending keys lies in: only the starts between the first and the last are looked up."""
        first, last = (bisect_right(opens, keys[i].as_buffer().to_pybytes()) for i in (0, len(keys) - 1))
        cuts = [bisect_left(range(len(keys)), k, key=lambda i: keys[i].as_buffer().to_pybytes()) for k in opens[first:last]]
        return np.repeat(np.arange(first, last + 1), np.diff([0, *cuts, len(keys)])).astype(np.int32)

    def counted() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        for lang in pc.unique(table["lang"]).to_pylist():
            texts = table.filter(pc.equal(table["lang"], lang))["text"].combine_chunks()
            for runs, n in _counted(texts):
                keys = pc.binary_join_element_wise(pa.scalar(lang), runs, SEP)
                yield pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(ranges(keys))], ["key", "n", "range"])

    size = 0
    for batch in batches:
        if held and size + batch.nbytes > CHUNK_BYTES:
            yield from counted()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from counted()


def _sums(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Counts of all phrases that begin a run, from sorted ranges of runs: one pass, one open sum a length.

    Given away are sums of at least ``least`` and whatever touches a range's ends.
    """
    open_: list[tuple[tuple, int] | None] = [None] * (LONGEST + 1)     # by length: (words of the phrase, sum so far)
    touches = [True] * (LONGEST + 1)                                   # the open phrase may have begun before the range

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([SEP.join(f[0]) for f in found], pa.string()),
                                           pa.array([len(f[0]) - 1 for f in found], pa.int32()),
                                           pa.array([f[1] for f in found], pa.int64())], ["key", "size", "f"])

    def closed() -> list[tuple]:
        last = [o for o in open_ if o]
        open_[:], touches[:] = [None] * len(open_), [True] * len(touches)
        return last

    at_range = None
    for table in _rows_of(batches):
        column = table["range"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(column)) + 1), len(column)]
        for start, stop in pairwise(edges):
            if at_range is not None and column[start] != at_range:
                yield rows(closed())
            at_range = column[start]
            found = _advance(table.slice(start, stop - start), open_, touches, least)
            if found:
                yield rows(found)
    last = closed()
    if last:
        yield rows(last)


def _advance(table: pa.Table, open_: list, touches: list[bool], least: int) -> list[tuple]:
    """Take the next rows of a range into the open sums; the phrases that end here, as ``_sums`` gives them away."""
    n = table["n"].to_numpy()
    parts = pc.split_pattern(table["key"].combine_chunks(), SEP)
    offsets, flat = parts.offsets.to_numpy(), parts.values
    length = np.diff(offsets)
    found: list[tuple] = []
    changed = np.zeros(len(n), bool)
    changed[0] = True
    for k in range(LONGEST + 1):
        at = np.flatnonzero(length > k)
        if not len(at):
            break
        # a shorter run is another phrase at this length; a longer one continues if its word is the same
        words = flat.take(pa.array(np.where(length > k, offsets[:-1] + k, 0)))
        changed[1:] |= pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        changed[1:] |= (length[1:] > k) != (length[:-1] > k)
        starts = at[changed[at]]
        sums = np.add.reduceat(np.where(length > k, n, 0), starts)
        keep = sums >= least
        keep[[0, -1]] = True
        for i in np.flatnonzero(keep):
            phrase, total = tuple(flat.slice(offsets[starts[i]], k + 1).to_pylist()), int(sums[i])
            if i == 0 and open_[k]:
                if open_[k][0] == phrase:
                    total += open_[k][1]
                else:
                    if touches[k] or open_[k][1] >= least:
                        found.append(open_[k])
                    touches[k] = False
            if i == len(sums) - 1:
                open_[k] = (phrase, total)
                touches[k] = touches[k] and i == 0
            else:
                if total >= least or (i == 0 and touches[k]):
                    found.append((phrase, total))
                touches[k] = False
    return found


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) >= STREAM_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if any(len(b) for b in held):
        yield pa.Table.from_batches(held)


def _range_starts(source: DataFrame) -> list[str]:
    """Keys that open the ranges after the first, ascending: equally many distinct runs of the sampled texts lie between them."""
    sample = source.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    n = RANGES * int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    thin = max(1, size // (5 * CHOICE * n))     # about a run for five bytes of text
    keys = sample.mapInArrow(lambda batches: _stream(batches, []), "key string, n long, range int").select("key")
    chosen = keys.filter(F.pmod(F.xxhash64("key"), F.lit(thin)) == 0).distinct()
    found = sorted((r.key for r in chosen.collect()), key=str.encode)
    step = max(1, -(-len(found) // n))
    return found[step::step]


def frequent(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, words, f): phrases of 1 to 4 words that occur ``least`` times in a language; no words: all word occurrences."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    safe = F.replace(F.replace(lang, F.lit("\x0f"), F.lit("\x0f2")), F.lit(SEP), F.lit("\x0f1"))
    source = docs.select(safe.alias("lang"), F.col("text").cast("string").alias("text")).filter("length(text) > 0")
    starts = _range_starts(source)
    runs = source.mapInArrow(lambda batches: _stream(batches, starts), "key string, n long, range int")
    ordered = runs.repartition("range").sortWithinPartitions("key")
    sums = ordered.mapInArrow(lambda batches: _sums(batches, least), "key string, size int, f long"
                              ).groupBy("key", "size").agg(F.sum("f").alias("f"))
    words = F.split("key", SEP)
    raw = F.replace(F.replace(words[0], F.lit("\x0f1"), F.lit(SEP)), F.lit("\x0f2"), F.lit("\x0f"))
    return written(sums.filter((F.col("size") == 0) | (F.col("f") >= least)).select(
        raw.alias("lang"), F.slice(words, 2, LONGEST).alias("words"), "f"), "phrase_counts")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best-scoring phrases, see the module."""
    counts = frequent(docs)
    size = F.size("words")
    phrases = counts.filter(size >= 2)
    # one more word in front or behind: the most frequent such phrase decides
    longer = phrases.filter(size >= 3)
    extended = longer.select("lang", "f", F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
                                                    ).alias("words")).groupBy("lang", "words").agg(F.max("f").alias("extension"))
    cut = phrases.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    part = counts.filter(size >= 1).select(F.col("lang").alias("_lang"), F.col("words").alias("_words"), F.col("f").alias("_f"))

    def beside(stream: DataFrame, piece: Column, name: str) -> DataFrame:
        """The stream in the order of a part of its phrases, merge-joined with the counts in theirs."""
        keyed = stream.withColumn("_piece", piece)
        joined = keyed.join(part.hint("merge"), (F.col("lang") == F.col("_lang")) & (F.col("_piece") == F.col("_words")))
        return joined.withColumnRenamed("_f", name).drop("_lang", "_words", "_piece")

    prefixes = beside(cut, F.slice("words", F.lit(1), F.col("k")), "l")
    suffixes = beside(cut.drop("a"), F.slice("words", F.col("k") + 1, size - F.col("k")), "r")
    cuts = prefixes.join(suffixes.hint("merge"), ["lang", "words", "k"])
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(2000000 as {wide}) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    covered = (F.lit(100).cast("decimal(19,0)") * F.col("extension").cast("decimal(19,0)")
               >= F.lit(COVERED).cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)"))
    free = lowest.join(extended.hint("merge"), ["lang", "words"], "left").filter(~F.coalesce(covered, F.lit(False)))
    named = free.select("lang", unescaped(F.array_join("words", " ")).alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: its parts are ranked first, what they keep is bounded
    parts = named.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = (parts.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
            .filter(F.col("_rank") <= top).drop("_rank", "_part"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter(size == 0).select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    return (ranked.join(totals, F.col("lang") == F.col("_lang"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
