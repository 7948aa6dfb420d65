"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of sampled texts.
A text, reduced to lower-case words of letters, is encoded with every
dictionary, in chunks of ``CHUNK`` bytes so that the dictionary and not the
text's own repetitions decides on long texts too, and gets the language of the
smallest total. The margin to the second smallest, as a share of the smallest,
says how sure that is; ``accepted`` is false where it is below ``MIN_MARGIN``.
A few words may be too short for any match; where sizes tie, the dictionary
that holds the text's words more often decides.

The dictionaries are fitted on a bounded sample: ``DOCS_PER_LANGUAGE`` labelled
documents of each language, chosen by a hash of their ids, of each a passage of
at most ``SHARE_BYTES`` that starts where another hash says, anywhere in the
text, and at most ``DICTIONARY_BYTES`` a language (small enough to be sent to
every task), to which all the passages give alike.
Each language keeps all that its sample gives. Where that is less than others
have, it is credited, text by text, with what the others' greater length gains
on a text that isn't theirs: of the longer dictionaries other than the best, the
one farthest from the text is cut to the shorter one's size (rounded up to a
power of two), and the bytes that the cut costs it are taken off.
Prediction reads whole texts where they lie, without a shuffle.

Defined results: a null text, and one without a letter, is ``und`` with score 0
and not accepted. Without any labelled row everything is ``und``. A tie that
the words don't decide goes to the language first by name and is not accepted. Rows with
null ``lang`` or null id, or without a letter, teach nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import sample_by, text_column

UNKNOWN = "und"
#: Labelled documents sampled for each language.
DOCS_PER_LANGUAGE = 100
#: Bytes of a language's dictionary, and of a sampled text's part in it.
DICTIONARY_BYTES, SHARE_BYTES = 56 << 10, 1 << 10
#: Bytes encoded at once; zstandard's level.
CHUNK, LEVEL = 4 << 10, 12
#: Least margin for an accepted prediction.
MIN_MARGIN = 0.001

PREDICTION = "struct<lang:string,score:double,margin:double,accepted:boolean>"
_PREDICTION = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("margin", pa.float64()),
                         ("accepted", pa.bool_())])
_LETTER = regex.compile(r"\p{L}")
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def letters(text: str) -> bytes:
    """Lower-case words, without ASCII digits and punctuation."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def shares(sizes: list[int], total: int) -> list[int]:
    """What each of ``sizes`` may have so that they and the spaces between them fit into ``total``: all alike, or all it is."""
    out, left = [0] * len(sizes), total - len(sizes) + 1
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    for k, i in enumerate(order):
        out[i] = max(0, min(sizes[i], left // (len(sizes) - k)))
        left -= out[i]
    return out


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE,
        dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw dictionary content by language, from (doc_id, text, lang)."""
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    chosen = sample_by(rows, "lang", docs_per_language).withColumnRenamed("lang", "_lang")
    # at most docs_per_language ids a language: few enough to be sent to every task
    own = rows.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), (F.col("doc_id") == F.col("_id"))
                    & (F.col("lang") == F.col("_lang")))
    # of each text at most SHARE_BYTES characters travel, from a place that a hash of the id chooses
    words = F.trim(F.regexp_replace("text", r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", " "))
    start = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.length("words") - SHARE_BYTES + 1, F.lit(1)))
    part = (own.select("lang", "doc_id", F.xxhash64("doc_id").alias("turn"), words.alias("words"))
            .select("lang", "turn", "doc_id", F.substr("words", (start + 1).cast("int"), F.lit(SHARE_BYTES)).alias("part")))
    texts: dict[str, list[tuple[int, int, bytes]]] = {}
    for r in part.collect():
        texts.setdefault(r.lang, []).append((r.turn, r.doc_id, letters(r.part)[:SHARE_BYTES]))
    made = {}
    for lang, own_parts in sorted(texts.items()):
        parts = [part for *_, part in sorted(own_parts) if part]
        made[lang] = b" ".join(p[:n] for p, n in zip(parts, shares([len(p) for p in parts], dictionary_bytes), strict=True))
    return {lang: content for lang, content in made.items() if content.strip()}


def encoder(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False)


def size(e: zstandard.ZstdCompressor, data: bytes) -> int:
    return sum(len(e.compress(data[i:i + CHUNK])) for i in range(0, len(data), CHUNK))


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN):
        self.min_margin = min_margin
        self.languages = sorted(dictionaries)
        self.contents = [b" " + dictionaries[lang] + b" " for lang in self.languages]
        self.encoders = [encoder(dictionaries[lang]) for lang in self.languages]
        # by powers of two that hold a dictionary: whose they hold, and parts of that size of the longer ones
        steps = [1 << (len(dictionaries[lang]) - 1).bit_length() for lang in self.languages]
        self.parts = [(
            [i for i, s in enumerate(steps) if s == step],
            {i: encoder(dictionaries[lang][:step]) for i, lang in enumerate(self.languages) if len(dictionaries[lang]) > step}
        ) for step in sorted(set(steps))]

    def sizes(self, data: bytes) -> list[int]:
        """Encoded sizes; smaller dictionaries are credited with what a longer one of another language gains by length."""
        found = [size(e, data) for e in self.encoders]
        best, out = found.index(min(found)), list(found)
        for held, longer in self.parts:
            others = [i for i in longer if i != best]
            if others:
                far = max(others, key=found.__getitem__)
                gain = max(0, size(longer[far], data) - found[far])
                for i in held:
                    out[i] -= gain
        return out

    def predict(self, text: str | None) -> dict:
        if not text or not self.languages or not _LETTER.search(text):
            return {"lang": UNKNOWN, "score": 0.0, "margin": 0.0, "accepted": False}
        data = letters(text)
        sizes: list[float] = self.sizes(data)
        best = min(sizes) or 1
        tied = [i for i, s in enumerate(sizes) if s == best]
        if len(tied) > 1:
            own = set(data.split())
            held = {i: sum(self.contents[i].count(b" " + w + b" ") for w in own) for i in tied}
            most = max(held.values())
            for i in tied:     # less than a byte: ties only
                sizes[i] += (most - held[i]) / (1 + most)
        lang = self.languages[sizes.index(min(sizes))]
        rest = sorted(sizes)[1:]
        margin = (rest[0] - min(sizes)) / best if rest else 1.0
        # a margin of 5 % makes a language e times likelier
        score = 1 / sum(math.exp(-min(700.0, (s - min(sizes)) / best / 0.05)) for s in sizes)
        return {"lang": lang, "score": score, "margin": margin, "accepted": margin >= self.min_margin}


def identify(dictionaries: dict[str, bytes], text: Column | str = "text", min_margin: float = MIN_MARGIN) -> Column:
    """Column of :data:`PREDICTION` for whole texts."""

    def make() -> Callable[[list], pa.Array]:
        classifier = Classifier(dictionaries, min_margin)
        return lambda batch: pa.array([classifier.predict(t) for t in batch], _PREDICTION)

    return text_column(F.col(text) if isinstance(text, str) else text, PREDICTION, make)
