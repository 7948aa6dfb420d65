"""Fingerprints, collocations and lexical search against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import floor, log

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwise.llm import collocations, exact_dedup, fingerprints, lexical_search, queries
from cartwise.llm.ordered import by_ranges
from test_llm_operators import SCHEMA, lower, odd_rows, sentence


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def stored(spark, tmp_path):
    """Tables written so that a registered query can read them."""
    def store(**tables) -> str:
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return store


# ---- fingerprints


def brute_hashes(text: str | None) -> set[str]:
    w = re.findall("[^\x20\x09-\x0D]+", lower(text))
    return {hashlib.md5(" ".join(w[i:i + 5]).encode()).hexdigest()[:15] for i in range(max(1, len(w) - 4) if w else 0)}


def brute_near(a: list[str], b: list[str], k: int) -> float:
    both = sorted(set(a) | set(b))[:k]
    return sum(h in a and h in b for h in both) / len(both) if both else 1.0


def brute_fingerprints(rows: list[tuple], k: int) -> Counter:
    docs = sorted(((-1 << 63 if i is None else i, t or "", i) for i, t in rows), key=lambda d: (d[0], d[1].encode()))
    out = []
    for at, (_, text, i) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, new, other = (sorted(brute_hashes(t))[:k] for t in (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), ",".join(own), ",".join(new),
                    brute_near(own, new, k), brute_near(own, other, k)))
    return Counter(out)


def fingerprint_rows(df) -> Counter:
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
                   for r in df.collect())


def test_fingerprints_of_odd_rows(spark, odd, stored):
    got = queries.op11_document_fingerprints(spark, stored(documents=odd))
    assert fingerprint_rows(got) == brute_fingerprints([r[:2] for r in odd_rows()], fingerprints.K)
    assert [t for _, t in got.dtypes[:7]] == ["bigint", "bigint", "string", "string", "string", "double", "double"]


def test_fingerprints_of_the_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert fingerprint_rows(queries.op11_document_fingerprints(spark, sf)) == brute_fingerprints(rows, fingerprints.K)


@pytest.mark.parametrize("range_rows", [1, 2, 7])
def test_next_rows_across_ranges(spark, range_rows):
    rng = random.Random(range_rows)
    rows = [(rng.choice([i, i * 10 ** 15, -i]), sentence(rng, 12)) for i in range(60)] + [(5, "a b"), (5, "a b"), (5, "c"), (None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text, r.edited) for r in fingerprints.edited_fingerprints(df, range_rows=range_rows).collect())
    docs = sorted(((-1 << 63 if i is None else i, t, i) for i, t in rows), key=lambda d: d[:2])
    want = Counter()
    for at, (_, t, i) in enumerate(docs):
        want[(i, t, t[:len(t) - len(t) // 2] + docs[(at + 1) % len(docs)][1][:len(t) // 2])] += 1
    assert got == want


def test_one_row_follows_itself_and_no_rows(spark, empty):
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert (one.edited, one.sketch) == ("abab", one.next_sketch)
    assert fingerprints.edited_fingerprints(empty).count() == 0


def test_rows_are_shuffled_once_and_without_python(spark, odd):
    df = fingerprints.edited_fingerprints(odd)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(place") == 1 and "Python" not in plan
    dealt, _ = by_ranges(odd.select(F.col("doc_id").alias("id"), "text").dropna(), 1)
    assert dealt.filter("copy = 0").count() == odd.dropna(subset=["doc_id", "text"]).count()


def test_sketches_estimate(spark):
    rng = random.Random(1)
    words = sentence(rng, 6000).split()
    pairs = [(" ".join(words[:m]), " ".join(words[s:s + m])) for m, s in ((3000, 300), (3000, 1500), (2000, 0), (1000, 4000), (100, 20))]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", fingerprints.sketch("a").alias("x"), fingerprints.sketch("b").alias("y"))
    x, y = F.col("x"), F.col("y")
    for r in df.select("a", "b", fingerprints.resemblance(x, y).alias("near"), fingerprints.containment(x, y).alias("inside"),
                       fingerprints.distinct_shingles(x).alias("n"), fingerprints.parsed(fingerprints.fingerprint(x)).alias("back"),
                       x).collect():
        a, b = brute_hashes(r.a), brute_hashes(r.b)
        assert abs(r.near - len(a & b) / len(a | b)) < 0.1
        assert abs(r.inside - len(a & b) / len(a)) < 0.12
        assert abs(r.n - len(a)) <= (0 if len(a) < fingerprints.K else 0.2 * len(a))
        assert r.back == r.x


def test_sketches_of_parts_merge(spark, odd):
    sketched = odd.select("doc_id", "digest", "text", fingerprints.sketch("text", 20).alias("sketch"))
    merged = fingerprints.merge_by(sketched, "digest", k=20).collect()
    everything = sorted(set().union(*(brute_hashes(r[1]) for r in odd_rows())))[:20]
    assert [(r.digest, r.sketch) for r in merged] == [(1, everything)]
    by_id = {r.doc_id: r.sketch for r in fingerprints.merge_by(sketched, "doc_id", k=20).collect()}
    for i in {r[0] for r in odd_rows()}:
        assert by_id[i] == sorted(set().union(*(brute_hashes(t) for j, t, *_ in odd_rows() if i == j)))[:20]
    two = spark.createDataFrame([("a b c d e f g", "e f g h i j k l")], "a string, b string")
    got = two.select(fingerprints.merge(fingerprints.sketch("a"), fingerprints.sketch("b")).alias("m")).first().m
    assert got == sorted(brute_hashes("a b c d e f g") | brute_hashes("e f g h i j k l"))


# ---- collocations


def brute_collocations(rows: list[tuple], least: int = 30, top: int = 2000) -> set:
    f: dict = defaultdict(Counter)
    n: Counter = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in (1, 2, 3, 4):
                for i in range(len(ws) - m + 1):
                    f[lang][tuple(ws[i:i + m])] += 1
    out = set()
    for lang, counts in f.items():
        found = []
        longer: Counter = Counter()
        for p, a in counts.items():
            if a >= least:
                for m in range(2, len(p)):
                    for i in range(len(p) - m + 1):
                        longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        for p, a in counts.items():
            if len(p) < 2 or a < least or (p in longer and 100 * longer[p] >= 80 * a):
                continue
            cut = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-cut[0], -a, " ".join(p).encode(), counts[p[:cut[1]]], counts[p[cut[1]:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return out


def collocation_rows(rng: random.Random) -> list[tuple]:
    words = ["the", "New", "york", "times", "of", "a", "É", "中文", "x\x01y", "x", "x\x0ey", "\x00", "\x0e#", "l'eau", "\x05\x0e"]
    def text() -> str:
        parts = [rng.choices(words, [9, 8, 7, 6, 5, 4, 4, 4, 4, 3, 3, 3, 2, 2, 2], k=rng.randint(0, 14)) for _ in range(rng.randint(0, 8))]
        if rng.random() < 0.5:
            parts.append(["New", "York", "Times", "of", "London"][:rng.randint(1, 5)])
        return rng.choice([". ", "!?", "\n", "\r\n\x0b", " ;  "]).join(rng.choice([" ", "  ", "\t"]).join(p) for p in parts)
    rows = [(text(), rng.choice(["en", "en", "en", None, "und", "de\tx", "\x0f2"])) for _ in range(1500)]
    return rows + [(None, "en"), ("", None), ("... ,", "zz"), ("the of " * 20_000, "en"), ("word", "fr")]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations(spark, seed):
    rows = collocation_rows(random.Random(seed))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, n int, words string").repartition(5)
    got = {tuple(r) for r in collocations.collocations(df).collect()}
    want = brute_collocations(rows)
    assert len(want) > 100 and got == want


def test_collocations_keep_the_first_of_each_language(spark, monkeypatch):
    rows = collocation_rows(random.Random(3))
    df = spark.createDataFrame(rows, "text string, lang string")
    assert {tuple(r) for r in collocations.collocations(df, top=7).collect()} == brute_collocations(rows, top=7)


def test_phrase_counts_are_the_same_however_the_stream_is_cut(monkeypatch):
    """Sums over any cuts of the sorted stream, and over any batches of it, add up to the same counts."""
    rng = random.Random(5)
    runs = Counter()
    for _ in range(3000):
        runs["\t".join(["en", *rng.choices("abc", k=rng.randint(1, 4))])] += rng.randint(1, 3)
    want: Counter = Counter()
    for key, n in runs.items():
        for k in range(1, key.count("\t") + 2):
            want["\t".join(key.split("\t")[:k])] += n
    stream = sorted(runs.items(), key=lambda r: r[0].encode())
    for rows, parts, tasks, least in ((1, 1, 1, 1), (3, 4, 2, 1), (50, 7, 3, 30), (1000, 2, 2, 30), (1000, 9, 1, 30), (7, 40, 6, 500)):
        monkeypatch.setattr(collocations, "STREAM_ROWS", rows)
        got: Counter = Counter()
        for task in range(tasks):       # a task has some of the ranges, not always neighbours
            piece = [(k, n, p) for p in range(task, parts, tasks) for k, n in
                     stream[len(stream) * p // parts:len(stream) * (p + 1) // parts]]
            batches = [pa.RecordBatch.from_pydict(dict(zip(("key", "n", "range"), map(list, zip(*piece[i:i + rows])))))
                       for i in range(0, len(piece), rows)]
            for batch in collocations._sums(iter(batches), least):
                for r in batch.to_pylist():
                    assert r["size"] == r["key"].count("\t")
                    got[r["key"]] += r["f"]
        assert all(got[k] == n for k, n in want.items() if n >= least)
        assert all(got[k] <= want[k] for k in got)


def test_ranges_of_a_stream():
    starts = ["en\tb", "en\tb\tc", "en\tz"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en", "de"], "text": ["a b c. b", "zz z", "q"]})
    got = {r["key"]: r["range"] for b in collocations._stream(iter([batch]), starts) for r in b.to_pylist()}
    assert got == {k: sum(s <= k for s in starts) for k in got} and set(got.values()) == {0, 1, 2, 3}


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, "en"), ("", None), (" \t\n.", "en")], "text string, lang string")).count() == 0


# ---- lexical search


def brute_terms(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_search(docs: list[tuple], items: list[tuple], top: int = 10) -> Counter:
    counted = [(i, Counter(brute_terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    big_n, big_l = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out: Counter = Counter()
    for item, text in set(items):
        scored = []
        for i, c, n in counted:
            m = 100 - 75 + (75 * n * big_n) // big_l
            s = sum(floor(1000 * log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in brute_terms(text) if t in c)
            if s > 0:
                scored.append((-s, -1 << 63 if i is None else i, i))
        for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:top], 1):
            out[(item, rank, i, -s)] += 1
    return out


ITEMS = [(1, "hello world"), (2, None), (3, "..."), (4, "É é a a a b"), (5, "l1 l3 zzz"), (1, "hello world"), (1, "12 x y"), (None, "c d")]


def test_search_on_odd_rows(spark, odd):
    items = spark.createDataFrame([(*i, 0, "s") for i in ITEMS], "item_id long, text string, rank int, score string")
    got = Counter(tuple(r) for r in lexical_search.search(odd, items).collect())
    assert got == brute_search([r[:2] for r in odd_rows()], ITEMS)
    small = Counter(tuple(r) for r in lexical_search.search(odd, items, block_bytes=8).collect())
    assert small == got


@pytest.mark.parametrize("bucket", [4, 512])
def test_search_prunes_and_loses_nothing(spark, monkeypatch, bucket):
    monkeypatch.setattr(lexical_search, "BUCKET", bucket)
    rng = random.Random(bucket)
    words = sentence(rng, 300).split()
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 200])))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]          # a group of copies: ties
    items = [(i, docs[rng.randrange(400)][1][:200]) for i in range(25)]
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute_search(docs, items)


def test_buckets_are_skipped_by_length():
    block = lexical_search.Block.of([(1, "a b")])
    search = lexical_search.Search(block, [10, 10], top=1)
    def bucket(ids, impact):
        batch = pa.RecordBatch.from_pydict({"doc_id": ids, "norm": [float(i) for i in impact], "term": [[0]] * len(ids),
                                            "impact": [[i] for i in impact]},
                                           schema=pa.schema([("doc_id", pa.int64()), ("norm", pa.float64()),
                                                             ("term", pa.list_(pa.int32())), ("impact", pa.list_(pa.int64()))]))
        search.through(iter([batch]))
    bucket([5, 6], [100, 90])
    assert search.best[0][0][::2] == (-1000, 5)
    seen = search.scored
    bucket([1, 2], [50, 40])                                     # 50 * |q| < 1000: no vector is looked at
    assert search.scored == seen
    bucket([3], [100])                                           # a tie with a smaller doc_id takes the place
    assert search.best[0][0][::2] == (-1000, 3)


def test_search_in_empty_tables(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(empty, items).count() == 0
    none = lexical_search.search(odd, items.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


# ---- the registered queries and their twins


def test_exact_dedup_gives_a_row_for_each_row(spark, odd, stored, monkeypatch):
    """The registered query and its twin, on repeated rows."""
    docs = odd.select("doc_id", "text").filter("doc_id IS NOT NULL").unionByName(
        spark.createDataFrame([(70, "again")] * 25 + [(71, "AGAIN"), (70, "other")], "doc_id long, text string"))
    path = stored(documents=docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    twin = con.sql(queries.ORACLE_SQL["op10_exact_dedup"])
    want = Counter(twin.fetchall())
    assert sum(want.values()) == docs.count()
    for repeats in (exact_dedup.REPEATS, 10, 1):
        monkeypatch.setattr(exact_dedup, "REPEATS", repeats)
        got = queries.op10_exact_dedup(spark, path)
        assert sorted(got.columns) == sorted(twin.columns)
        assert Counter(tuple(r[c] for c in twin.columns) for r in got.collect()) == want


@pytest.mark.parametrize("name", ["op11_document_fingerprints", "op12_phrase_collocations", "op13_lexical_search"])
def test_registered_query_and_twin_agree_on_odd_rows(spark, odd, stored, name):
    rng = random.Random(9)
    many = spark.createDataFrame([(100 + i, t, lang) for i, (t, lang) in enumerate(collocation_rows(rng)[:700]) if "\x00" not in (t or "")],
                                 "doc_id long, text string, lang string")
    docs = odd.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL").unionByName(many)
    if "op11" in name:
        docs = docs.dropDuplicates(["doc_id"])      # the twin has no order among equal ids
    items = spark.createDataFrame(list({i for i in ITEMS if i[0] != 1}) + [(1, "hello New York")], "item_id long, text string")
    path = stored(documents=docs, benchmark=items)
    got = queries.QUERIES[name](spark, path)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    twin = con.sql(queries.ORACLE_SQL[name])
    assert sorted(twin.columns) == sorted(got.columns)
    assert Counter(tuple(r[c] for c in twin.columns) for r in got.collect()) == Counter(twin.fetchall())
