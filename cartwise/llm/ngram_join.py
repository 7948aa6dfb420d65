"""Near duplicates by an n-gram Jaccard join on parity sketches.

A document is the set of its distinct word shingles, hashed to 64 bits. Two
sets link when their Jaccard similarity is at least ``THRESHOLD`` percent.

*Parity.* XOR-ing all hashes of a set, or toggling one bit per token, gives a
sketch in which tokens common to two sets cancel: the sketches of A and B differ
only through their symmetric difference, so a Hamming distance between sketches
never exceeds its size. At similarity s, |A xor B| <= (|A| + |B|)(1-s)/(1+s).

*Pigeonhole.* Within a band of set sizes that bound is a number k. Tokens are
dealt by hash to more than k blocks, each XOR-ed to one word: at most k blocks
of two linked sets differ, so one that holds tokens agrees, and equality of
(band, block, word) finds the pair. A set near a band's lower edge joins the
band below as well, which makes every pair of sizes meet. A set that fills k
blocks at most (small ones) might agree only where both are empty; it also
gives the tokens of its prefix in a fixed order, one of which two linked sets
share. Tokens that very many documents hold are left out of the blocks, and come
last in that order. No pair is lost, and nothing is capped.

*Groups.* Equal sets are one vertex from the start. Each task joins what shares
a word there and then and passes one row per word on, so that a word that a
third of all documents hold costs one row per task. The vertices under a word
then form a star, not all pairs. Candidates are verified on whole texts. Pairs
which already lie in one component need no test; a word whose vertices still
lie in several components is resolved exactly: more stars join what is dense,
and the pairs that are left across components are filtered by sizes and bit
sketches, and tested.

Defined results: texts are lower-cased A-Z and split at ASCII white space; with
fewer than ``WORDS`` words the whole sequence is the one shingle; a null or
empty text and one without words is an empty set and linked with nothing. Rows
of one doc_id are rows of their own, joined where their sets are. A null doc_id
never names a component: it gets the smallest other doc_id, and a set that only
rows without doc_id have is linked with no other, its component null.
Hashes have 64 bits: two different shingles, words or sets are mistaken for one
another with a probability of 2**-64 per pair.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import mapped, texts, written
from cartwise.llm.components import components

#: Words of a shingle; percent of similarity that links.
WORDS, THRESHOLD = 5, 80
#: Ratio of a band's edges; blocks per possible difference.
BAND, SPARE = 1.6, 1.12
#: Bits of the sketch that filters pairs before their texts are read.
BITS = 1024
#: Block words that a task joins at once, tokens that it counts at once.
HELD, COUNTED = 1_000_000, 4_000_000
#: Pairs a vertex up to which the vertices of a word under several components are all paired.
PAIRED = 4
#: Share of documents from which a token is common, and the fewest in a task's count.
COMMON, FEWEST = 1 / 2000, 4

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed in one go (a longer word is still hashed whole).
CHUNK = 1 << 20


class _Powers:
    """Powers of an odd base modulo 2**64, and of its inverse."""

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            base = 0x9E3779B97F4A7C15
            for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
                steps = np.full(2 * n, U(factor))
                steps[0] = U(1)
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word: the polynomial of its bytes, from running sums over the text."""
    out = []
    at = 0
    while at < len(data):
        stop = min(len(data), at + CHUNK)
        if stop < len(data):    # a chunk ends where a word does
            while stop > at and not _SPACE[data[stop]]:
                stop -= 1
            if stop == at:
                stop = min(len(data), at + CHUNK)
                while stop < len(data) and not _SPACE[data[stop]]:
                    stop += 1
        b = np.frombuffer(data, np.uint8, stop - at, at)
        inside = ~_SPACE[b]
        edge = np.diff(np.r_[False, inside, False].astype(np.int8))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            up, down = _POWERS.to(len(b) + 1)
            sums = np.empty(len(b) + 1, U)
            sums[0] = 0
            np.cumsum((b.astype(U) + U(1)) * up[:len(b)], out=sums[1:])
            out.append(mixed((sums[end] - sums[first]) * down[first] ^ (end - first).astype(U) * _ODD))
        at = stop
    return np.concatenate(out) if out else np.empty(0, U)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of MurmurHash3)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = word_hashes(text.encode("utf-8", "surrogatepass").lower()) if text else np.empty(0, U)
    if not len(w):
        return w
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, U)
    for k in range(size):
        h = h * _ODD + w[k:len(w) - size + 1 + k]
    return np.unique(mixed(h))


def similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    if not len(a) or not len(b):
        return False
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def vertex(s: np.ndarray) -> int:
    """64 bits for a whole set: equal sets, equal vertices."""
    with np.errstate(over="ignore"):
        return int(mixed(np.array([np.bitwise_xor.reduce(s) ^ mixed(s * _ODD).sum(dtype=U) * _ODD
                                   ^ U(len(s))], U))[0].astype(np.int64))


def sketch(s: np.ndarray) -> np.ndarray:
    """A bit per token, toggled: ``BITS`` bits as 64-bit words."""
    odd = (np.bincount((s & U(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def held_in(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which tokens of ``s`` are in the sorted ``common``."""
    if not len(common):
        return np.zeros(len(s), bool)
    return common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s


class Bands:
    """Sizes of sets by band: lower edges, the most differences, the blocks."""

    def __init__(self, threshold: int = THRESHOLD):
        self.threshold = threshold
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND)))
        self.most = [self.differences(e - 1, self.partner(e - 1)) for e in self.edges[1:]]
        self.blocks = [int(SPARE * (k + 1)) + 1 for k in self.most]

    def partner(self, n: int) -> int:
        """Size of the largest set that one of n tokens can link with."""
        return 100 * n // self.threshold

    def differences(self, a: int, b: int) -> int:
        """Most tokens in which linked sets of a and b tokens differ."""
        return (a + b) * (100 - self.threshold) // (100 + self.threshold)

    def of(self, n: int) -> list[int]:
        """The bands that a set of n tokens joins."""
        own = bisect.bisect_right(self.edges, n) - 1
        below = own - 1
        out = [own]
        while below >= 0 and n <= self.partner(self.edges[below + 1] - 1):
            out.append(below)
            below -= 1
        return out

    def words(self, s: np.ndarray, common: np.ndarray) -> np.ndarray:
        """The block words of a sorted set; equal words of two sets make them candidates."""
        n, out, short = len(s), [], False
        if self.differences(n, self.partner(n)) == 0:
            return np.empty(0, U)      # such sets link with equal ones only
        whole, often = s, held_in(s, common)
        s = s[~often]
        for band in self.of(n):
            if not self.most[band]:
                continue
            if not len(s):
                short = True
                break
            m = U(self.blocks[band])
            block = ((s >> U(32)) * m) >> U(32)
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            word = np.bitwise_xor.reduceat(s, first)
            out.append(mixed(word ^ mixed(block[first] * U(64) + U(band + 1))))
            short |= len(first) <= self.most[band]
        if short:
            prefix = n - -(-self.threshold * n // 100) + 1
            out.append(mixed(np.r_[s, whole[often]][:prefix] * _ODD))
        return np.concatenate(out) if out else np.empty(0, U)


def sets(docs: DataFrame, n: int = WORDS, by_row: bool = False) -> DataFrame:
    """(doc_id, n_shingles, vertex) of every row; and rows of (token, n) for tokens that are common in a task.

    With ``by_row`` also ``row``, a hash of the row's text.

    A token that ``COMMON`` of all documents hold is held by as many of some
    task's, so each task needs to tell only of those.
    """
    names = ["doc_id", "n_shingles", "vertex", "token", "n"] + ["row"] * by_row
    schema = pa.schema([(name, pa.int64()) for name in names])

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        token, n_docs = np.unique(np.concatenate(held), return_counts=True)
        often = n_docs >= max(FEWEST, COMMON * len(held))
        k = int(often.sum())
        return pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64())] * 3 + [
            pa.array(token[often].view(np.int64)), pa.array(n_docs[often].astype(np.int64))]
            + [pa.nulls(k, pa.int64())] * by_row, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seen = [], 0, set()
        for batch in batches:
            found = [shingles(t, n) for t in batch["text"].to_pylist()]
            vertices = [vertex(s) if len(s) else None for s in found]
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(s) for s in found], pa.int64()),
                                              pa.array(vertices, pa.int64()), none, none]
                                             + ([batch["row"]] if by_row else []), schema=schema)
            for s, v in zip(found, vertices, strict=True):
                if v is not None and v not in seen:
                    seen.add(v)
                    held.append(s)
                    count += len(s)
            if count >= COUNTED:
                yield counted(held)
                held, count = [], 0
                seen.clear()
        if held:
            yield counted(held)

    given = texts(docs)
    if by_row:
        given = given.withColumn("row", F.xxhash64("text"))
    return mapped(given, run, ", ".join(f"{name} long" for name in names))


def common_tokens(found: DataFrame) -> np.ndarray:
    """Tokens that ``COMMON`` of all documents hold, sorted.

    They are left out of the blocks: that takes nothing from the bound on
    differences, and a passage that many documents share makes no candidates of
    them. Their number is at most the mean size of a set over ``COMMON``,
    however large the corpus is, so they can be sent to every task.
    """
    total = found.filter("vertex IS NOT NULL").count()
    often = (found.filter("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= max(FEWEST, COMMON * total)))
    return np.sort(np.array([r.token for r in often.select("token").collect()], np.int64).view(U))


_ROWS = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _rows(key: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(a), other], schema=_ROWS)


def _stars(key: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by (key, a): which is the first of its key, each row's first, and which rows differ from it."""
    head = np.r_[True, key[1:] != key[:-1]]
    hub = a[head][np.cumsum(head) - 1]
    return head, hub, hub != a


def candidates(docs: DataFrame, common, n: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(key, a, b): for each block word, edges that join the vertices under it to a tree; a < b.

    ``common`` is a broadcast array. A word's edges hold every vertex under it,
    unless there is only one.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(threshold), set()
        held: list[tuple[np.ndarray, int]] = []
        count = 0

        def flush():
            key = np.concatenate([w for w, _ in held])
            a = np.repeat(np.array([v for _, v in held], np.int64), [len(w) for w, _ in held])
            order = np.lexsort((a, key))
            key, a = key[order], a[order]
            head, hub, other = _stars(key, a)
            # rows of a vertex next to each other pack better
            first = np.flatnonzero(head)
            first = first[np.argsort(a[first], kind="stable")]
            for at in range(0, len(first), 200_000):
                part = first[at:at + 200_000]
                yield _rows(key[part], a[part], None)
            if other.any():
                yield _rows(key[other], hub[other], a[other])
            held.clear()

        for batch in batches:
            for text in batch["text"].to_pylist():
                s = shingles(text, n)
                if len(s):
                    v = vertex(s)
                    if v not in seen:       # copies in one task give their words once
                        seen.add(v)
                        words = bands.words(s, common.value)
                        if len(words):
                            held.append((words, v))
                            count += len(words)
            if count >= HELD:
                yield from flush()
                count = 0
        if held:
            yield from flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_hub = None, None     # a run may go on in the next batch
        for batch in batches:
            key = batch["key"].to_numpy(zero_copy_only=False)
            a = batch["a"].to_numpy(zero_copy_only=False)
            edge = ~batch["b"].is_null().to_numpy(zero_copy_only=False)
            if edge.any():
                yield batch.filter(pa.array(edge))
            key, a = key[~edge], a[~edge]
            if len(key):
                if last_key is not None and key[0] == last_key:
                    key, a = np.r_[last_key, key], np.r_[last_hub, a]
                _, hub, other = _stars(key, a)
                last_key, last_hub = key[-1], hub[-1]
                if other.any():
                    yield _rows(key[other], hub[other], a[other])

    kind = "key long, a long, b long"
    rows = mapped(texts(docs).select("text"), emit, kind)
    shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(shuffle, "key").sortWithinPartitions("key", "a")
    return mapped(dealt, join, kind)


def _fits(threshold: int) -> Column:
    """Whether sizes and sketches of two sets (x_*, y_*) leave a link possible."""
    total, s = F.col("x_size") + F.col("y_size"), threshold
    hamming = F.aggregate(F.zip_with("x_sketch", "y_sketch", lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("long")),
                          F.lit(0).cast("long"), lambda t, c: t + c)
    return ((100 * F.least("x_size", "y_size") >= s * F.greatest("x_size", "y_size"))
            & (hamming * (100 + s) <= total * (100 - s)))


def plausible(pairs: DataFrame, members: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    x = members.select(*[F.col(c).alias(f"x_{c}") for c in ("vertex", "size", "sketch")])
    y = members.select(*[F.col(c).alias(f"y_{c}") for c in ("vertex", "size", "sketch")])
    return (pairs.join(x, F.col("a") == F.col("x_vertex")).join(y, (F.col("b") == F.col("y_vertex")) & _fits(threshold))
            .select("a", "b"))


def verified(pairs: DataFrame, members: DataFrame, n: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of vertices whose texts are similar; ``members`` has a text for each vertex."""
    text_b = members.select(F.col("vertex").alias("_b"), F.col("text").alias("text_b"))
    text_a = members.select(F.col("vertex").alias("_a"), F.col("text").alias("text_a"))
    both = (pairs.select("a", "b").join(text_b, F.col("b") == F.col("_b"))
            .join(text_a, F.col("a") == F.col("_a")).select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for batch in batches:
            a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
            keep = []
            for i, (x, other) in enumerate(zip(a, batch["text_b"].to_pylist(), strict=True)):
                if x != last:
                    last, mine = x, shingles(batch["text_a"][i].as_py(), n)
                keep.append(similar(mine, shingles(other, n), threshold))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(a, keep, strict=True) if k], pa.int64()),
                                              pa.array([x for x, k in zip(b, keep, strict=True) if k], pa.int64())],
                                             names=["a", "b"])

    return mapped(both, run, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = WORDS, threshold: int = THRESHOLD, by_row: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, vertex) of every row; component_id is its least doc_id.

    With ``by_row`` also ``row``, a hash of the row's text, and ``label``, which
    tells components apart whose least doc_id is the same.
    """
    docs = texts(docs)
    found = written(sets(docs, n, by_row), "sets")
    row, own = (["row"], ["label"]) if by_row else ([], [])
    rows = found.filter("token IS NULL").select("doc_id", "n_shingles", "vertex", *row)
    common = docs.sparkSession.sparkContext.broadcast(common_tokens(found))
    vertices = rows.filter("vertex IS NOT NULL").groupBy("vertex").agg(F.min("doc_id").alias("doc_id"))
    edges = written(candidates(docs, common, n, threshold), "candidates")
    tree = written(edges.select("a", "b").distinct(), "tree")
    touched = tree.select(F.col("a").alias("vertex")).unionByName(tree.select(F.col("b").alias("vertex"))).distinct()
    owners = vertices.join(touched, "vertex").filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), "vertex")
    # a doc_id that repeats brings all its texts; the right one is told by its own vertex
    members = written(_members(docs.join(owners, F.col("doc_id") == F.col("_id")), n), "members")

    # first one pair for each vertex, then those that are still in different components
    likely = written(plausible(tree, members, threshold), "likely")
    firsts = written(likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "stars")
    label = merged(None, written(verified(firsts, members, n, threshold), "links"))
    second = written(across(likely.join(firsts, ["a", "b"], "left_anti"), label).select("a", "b"), "pairs")
    label = merged(label, written(verified(second, members, n, threshold), "links"))
    label = resolved(edges, tree, label, members, n, threshold)

    named = vertices.join(label, F.col("vertex") == F.col("node"), "left").select(
        "vertex", "doc_id", F.coalesce("label", "vertex").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of = written(named.join(least, "label").select(F.col("vertex").alias("_vertex"), "component_id", *own), "components")
    filled = rows.filter("vertex IS NOT NULL").join(of, F.col("vertex") == F.col("_vertex"))
    empty = rows.filter("vertex IS NULL").withColumn("component_id", F.col("doc_id"))
    if by_row:
        empty = empty.withColumn("label", F.lit(None).cast("long"))
    columns = ["doc_id", "n_shingles", "component_id", "vertex", *row, *own]
    return filled.select(*columns).unionByName(empty.select(*columns))


def _members(found: DataFrame, n: int) -> DataFrame:
    """(vertex, size, sketch, text) of the rows whose text is their vertex's."""
    schema = pa.schema([("vertex", pa.int64()), ("size", pa.int64()), ("sketch", pa.list_(pa.int64())), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for v, text in zip(batch["vertex"].to_pylist(), batch["text"].to_pylist(), strict=True):
                s = shingles(text, n)
                if len(s) and vertex(s) == v:
                    rows.append((v, len(s), sketch(s), text))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return mapped(found.select("vertex", "text"), run, "vertex long, size long, sketch array<long>, text string")


def across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose vertices lie in different components, with their labels."""
    of_a = label.select(F.col("node").alias("_na"), F.col("label").alias("label_a"))
    of_b = label.select(F.col("node").alias("_nb"), F.col("label").alias("label_b"))
    named = (pairs.join(of_a, F.col("a") == F.col("_na"), "left").join(of_b, F.col("b") == F.col("_nb"), "left")
             .select("a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b")))
    return named.filter("label_a <> label_b")


def merged(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, label) after ``links`` (a, b) have joined components; nodes alone in theirs may be missing."""
    if label is None:
        return written(components(links), "labels")
    over = across(links, label).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    up = written(components(over), "labels").withColumnsRenamed({"node": "_old", "label": "_new"})
    moved = label.join(up, F.col("label") == F.col("_old"), "left").select("node", F.coalesce("_new", "label").alias("label"))
    # labels that were nodes alone so far
    known = label.select(F.col("node").alias("_known"))
    first = up.join(known, F.col("_old") == F.col("_known"), "left_anti").select(F.col("_old").alias("node"), F.col("_new").alias("label"))
    return written(moved.unionByName(first), "labels")


def relabelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` (key, vertex, size) with the labels of their vertices."""
    return (rows.select("key", "vertex", "size").join(label, F.col("vertex") == F.col("node"), "left")
            .select("key", "vertex", "size", F.coalesce("label", "vertex").alias("label")))


def words_with(rows: DataFrame, pairs: Column) -> DataFrame:
    """The rows of those words whose pairs across components, ``across``, are as asked; ``n`` is a word's vertices."""
    per = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
    per = per.groupBy("key").agg(F.sum("n").alias("n"), ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("across"))
    return rows.join(per.filter(pairs).select("key"), "key", "left_semi")


def resolved(edges: DataFrame, tree: DataFrame, label: DataFrame, members: DataFrame, n: int, threshold: int) -> DataFrame:
    """Labels when no two similar sets under a word are in different components any more.

    A word whose vertices lie in several components has a tree edge across
    them. Where pairing a word's vertices would cost much more than reading
    them, one vertex of each such word, another in each round, is tested
    against those of other components, which is linear and joins dense groups
    in few rounds. What is left when a round finds few links is paired.
    """
    failed = written(across(tree, label).select("a", "b"), "failed")
    words = edges.join(failed, ["a", "b"], "left_semi").select("key").distinct()
    under = (edges.join(words, "key", "left_semi").select("key", F.explode(F.array("a", "b")).alias("vertex")).distinct())
    sizes = members.select(F.col("vertex").alias("_vertex"), "size")
    rows = written(relabelled(under.join(sizes, F.col("vertex") == F.col("_vertex")), label), "open_words")
    dense, turn, found, most = rows, 0, 1, 0
    while found > most / 10:
        dense = written(words_with(dense, F.col("across") > PAIRED * F.col("n")), "dense_words")
        if dense.isEmpty():
            break
        turn += 1
        x = (dense.groupBy("key")
             .agg(F.min_by(F.struct("vertex", "label", "size"), F.xxhash64("vertex", "key", F.lit(turn))).alias("x"))
             .select(F.col("key").alias("x_key"), *[F.col(f"x.{c}").alias(f"x_{c}") for c in ("vertex", "label", "size")]))
        y = dense.select(F.col("key").alias("y_key"), *[F.col(c).alias(f"y_{c}") for c in ("vertex", "label", "size")])
        near = 100 * F.least("x_size", "y_size") >= threshold * F.greatest("x_size", "y_size")
        both = x.join(y, (F.col("x_key") == F.col("y_key")) & (F.col("x_label") != F.col("y_label")) & near)
        pairs = both.select(F.least("x_vertex", "y_vertex").alias("a"), F.greatest("x_vertex", "y_vertex").alias("b")).distinct()
        fit = written(plausible(pairs.join(tree, ["a", "b"], "left_anti"), members, threshold), "open_pairs")
        links = written(verified(fit, members, n, threshold), "links")
        found = links.count()
        most = max(most, found)
        label = merged(label, links)
        dense = relabelled(dense, label)

    rows = words_with(relabelled(rows, label) if turn else rows, F.col("across") > 0)
    sketches = members.select(F.col("vertex").alias("_vertex"), "sketch")
    full = written(rows.join(sketches, F.col("vertex") == F.col("_vertex")).drop("_vertex"), "open_rows")
    x, y = (full.select(*[F.col(c).alias(f"{side}_{c}") for c in ("key", "vertex", "label", "size", "sketch")]) for side in "xy")
    # sizes and sketches are part of the join's own condition: pairs they rule out are never rows
    apart = ((F.col("x_key") == F.col("y_key")) & (F.col("x_label") != F.col("y_label"))
             & (F.col("x_vertex") < F.col("y_vertex")) & _fits(threshold))
    pairs = x.join(y, apart).select(F.col("x_vertex").alias("a"), F.col("y_vertex").alias("b")).distinct()
    fit = written(pairs.join(tree, ["a", "b"], "left_anti"), "open_pairs")
    return merged(label, written(verified(fit, members, n, threshold), "links"))
