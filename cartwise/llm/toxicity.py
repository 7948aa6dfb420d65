"""Toxicity by subword-bag embeddings, averaged into a linear softmax.

A word is the bag of its character n-grams (with word ends marked) and itself;
its vector is the mean of theirs, a window of words has the mean of its words',
and two softmax outputs on that say how likely the window is toxic. A label
speaks of a whole document, whose toxic words may be few among thousands, so a
document is toxic unless none of its windows is: 1 - prod(1 - p). Embeddings
and output weights are trained jointly under that by Adam, in numpy. A
misspelling never seen shares most n-grams with the word it stands for.

The model is fitted on a bounded sample: ``DOCS_PER_LABEL`` labelled documents
of each label, chosen by a hash of their ids, each as a whole text and weighted
back to the labels' frequencies. Scoring reads whole texts where they lie.

Defined results: a null or empty text, and one without words, scores 0. Without
labelled documents of both labels everything scores 0. A document labelled more
than once is toxic if any label says so; null labels and ids teach nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import sample_by, text_column

#: Labelled documents sampled for each label.
DOCS_PER_LABEL = 2500
#: Hash buckets of n-grams, their lengths, the embedding's size.
BUCKETS, GRAMS, SIZE = 1 << 17, (3, 4, 5), 8
#: Words of a window and between the starts of two.
WINDOW, STRIDE = 8, 4
#: Passes over the sample, step size, decay of weights.
EPOCHS, STEP, DECAY = 120, 0.05, 1e-6
#: Words whose scores a worker keeps.
MEMO = 500_000

_EDGES = ".,;:!?\"'()[]{}<>|*#$%&~`-_=+/\\"


def words(text: str | None) -> list[str]:
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w] if text else []


def grams(word: str) -> list[int]:
    """Buckets of a word and its n-grams."""
    w = f"<{word}>"
    parts = dict.fromkeys([w, *[w[i:i + n] for n in GRAMS for i in range(len(w) - n + 1)]])
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


def window_starts(n: int) -> np.ndarray:
    """Where windows over n words start; the last window ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    starts[-1] = min(starts[-1], n - WINDOW)
    return starts


def window_means(values: np.ndarray) -> np.ndarray:
    """Means over windows of consecutive words."""
    starts, span = window_starts(len(values)), min(WINDOW, len(values))
    total = np.r_[0.0, np.cumsum(values)]
    return (total[starts + span] - total[starts]) / span


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


class Model:
    """The value of each n-gram bucket for the toxic output over the other, and the bias."""

    def __init__(self, values: np.ndarray, bias: float):
        self.values, self.bias = values, bias
        self.memo: dict[str, float] = {}

    def word(self, w: str) -> float:
        got = self.memo.get(w)
        if got is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            got = self.memo[w] = float(self.values[grams(w)].mean())
        return got

    def score(self, text: str | None) -> float:
        ws = words(text)
        if not ws:
            return 0.0
        z = window_means(np.array([self.word(w) for w in ws])) + self.bias
        return float(-np.expm1(-softplus(z).sum()))


def train(texts: list[str], toxic: list[int], weight: tuple[float, float] = (1.0, 1.0), seed: int = 7) -> Model:
    """Embeddings and output weights, jointly; ``weight`` by label."""
    vocabulary: dict[str, int] = {}
    tokens = []
    for t in texts:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(t)]
        tokens.append(np.array(ids, np.int32))
    y = np.array([k for k, t in zip(toxic, tokens, strict=True) if len(t)], float)
    tokens = [t for t in tokens if len(t)]
    bags = [grams(w) for w in vocabulary]
    size = np.array([len(b) for b in bags])
    bag, at = np.fromiter((g for b in bags for g in b), np.int32, size.sum()), np.r_[0, np.cumsum(size)[:-1]]
    del bags, vocabulary
    first, span, doc, base = [], [], [], 0
    for d, t in enumerate(tokens):
        n = len(t)
        starts = window_starts(n)
        first.append(starts + base)
        span.append(np.full(len(starts), min(n, WINDOW)))
        doc.append(np.full(len(starts), d))
        base += n
    token = np.concatenate(tokens)
    first, span, doc = np.concatenate(first), np.concatenate(span), np.concatenate(doc)
    head = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    w_doc = np.where(y == 1, weight[1], weight[0])
    w_doc = w_doc / w_doc.sum()
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, SIZE))
    out = rng.normal(0, 0.5, (SIZE, 2))
    bias = np.array([0.0, -4.0])
    params = [emb, out, bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, EPOCHS + 1):
        lean = out[:, 1] - out[:, 0]        # the softmax of two outputs is the logistic of their difference
        gram = emb @ lean
        word = np.add.reduceat(gram[bag], at) / size
        total = np.r_[0.0, np.cumsum(word[token])]
        z = (total[first + span] - total[first]) / span + bias[1] - bias[0]
        s = np.add.reduceat(softplus(z), head)
        # loss: sum of s over clean documents, -log(1 - exp(-s)) over toxic ones
        per_doc = w_doc * np.where(y == 1, -np.exp(-s) / np.maximum(-np.expm1(-s), 1e-12), 1.0)
        g_z = per_doc[doc] / (1 + np.exp(-z))
        steps = np.zeros(len(token) + 1)
        np.add.at(steps, first, g_z / span)
        np.add.at(steps, first + span, -g_z / span)
        g_word = np.bincount(token, np.cumsum(steps)[:-1], len(size))
        g_gram = np.bincount(bag, np.repeat(g_word / size, size), BUCKETS)
        g_lean = emb.T @ g_gram
        g_bias = g_z.sum()
        grads = [g_gram[:, None] * lean + DECAY * emb, np.stack([-g_lean, g_lean], 1), np.array([-g_bias, g_bias])]
        for p, g, mm, vv in zip(params, grads, m, v, strict=True):
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            p -= STEP * (mm / (1 - 0.9 ** epoch)) / (np.sqrt(vv / (1 - 0.999 ** epoch)) + 1e-12)
    return Model(emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, docs_per_label: int = DOCS_PER_LABEL) -> Model | None:
    """Train on a bounded sample of (doc_id, text) joined with (doc_id, toxic)."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return None
    chosen = sample_by(marked, "toxic", docs_per_label)      # at most twice docs_per_label ids
    rows = (docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), F.col("_id") == F.col("doc_id")).select("doc_id", "text", "toxic").collect())
    rows = sorted(rows, key=lambda r: (r.doc_id, r.text or ""))
    here = [sum(r.toxic == k for r in rows) for k in (0, 1)]
    if not min(here):
        return None
    return train([r.text or "" for r in rows], [r.toxic for r in rows],
                 (total[0] / here[0] / (total[0] + total[1]), total[1] / here[1] / (total[0] + total[1])))


def toxicity(model: Model | None, text: Column | str = "text") -> Column:
    """Column of scores between 0 and 1 for whole texts."""
    values, bias = (None, 0.0) if model is None else (model.values.astype(np.float32), model.bias)

    def make() -> Callable[[list], pa.Array]:
        own = None if values is None else Model(values, bias)
        return lambda batch: pa.array([own.score(t) if own else 0.0 for t in batch], pa.float64())

    return text_column(F.col(text) if isinstance(text, str) else text, "double", make)
