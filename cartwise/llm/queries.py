"""The registered ``opN_*`` queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import (collocations, decontaminate, exact_dedup, fingerprints, language_id, lexical_search, line_dedup,
                          ngram_join, packing, pii, secret_scan, token_counts, toxicity)
from cartwise.llm.common import documents, learnable, texts

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def of_kind(spans: str, kind: str):
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of repeated three-line windows."""
    return line_dedup.line_dedup(texts(documents(spark, sf_dir)))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of each document."""
    return ngram_join.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learned from the labelled rows not held out."""
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(learnable(labels, 5, 0)))
    return (texts(docs).withColumn("score", toxicity.toxicity(model))
            .select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word-piece tokens of each document."""
    docs = texts(documents(spark, sf_dir))
    counts = token_counts.token_counts(tokenizer_path("byte_bpe_50k.json"))
    return docs.select("doc_id", "text").withColumn("counts", counts).select("doc_id", "counts.n_words", "counts.n_tokens")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens; a row per piece."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: the base spans, and tokens that look random."""
    docs = texts(documents(spark, sf_dir))
    found = docs.withColumn("all", secret_scan.scan(secret_scan.fit(docs)))
    base = F.filter("all", lambda s: s["kind"] != "random")
    n = [of_kind("all", k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *n, F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("all")).alias("spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document: the base spans, and what the trained classifier adds."""
    found = pii.personal_spans(documents(spark, sf_dir)).withColumnRenamed("spans", "all")
    base = F.filter("all", lambda s: s["base"])
    return found.select("doc_id", *[of_kind("all", k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("all")).alias("spans"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in benchmark windows, and the items found."""
    hits = decontaminate.find_contamination(texts(documents(spark, sf_dir)), documents(spark, sf_dir, "benchmark"))
    items = F.col("contamination")["items"]
    return hits.select("doc_id", F.col("contamination")["n_words"].alias("n_words"),
                       decontaminate.n_hit().alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256")
                       ).withColumn("contaminated", F.col("n_hit") > 0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by compression, learned from the rows not held out."""
    docs = documents(spark, sf_dir)
    fitted = language_id.fit(docs.filter(learnable(docs, 4, 2)))
    return (texts(docs).withColumn("found", language_id.identify(fitted))
            .select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
                    F.col("found")["lang"].alias("lang_pred"), F.col("found")["score"].alias("score"),
                    F.col("found")["margin"].alias("margin"), F.col("found")["accepted"].alias("accepted")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of equal texts stays; a row per row of the table."""
    return exact_dedup.per_row(exact_dedup.exact_dedup(documents(spark, sf_dir)))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and of its edited text, and their likeness to it and to the next document."""
    sketched = fingerprints.edited_fingerprints(documents(spark, sf_dir))
    return sketched.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprints.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct_shingles(F.col("sketch")).alias("n_shingles"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best collocations of two to four words."""
    return collocations.collocations(documents(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical_search.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_line_dedup, op2_ngram_jaccard_join, op3_toxicity, op4_token_counts, op5_best_fit_packing, op6_secret_scan, op7_pii,
    op8_benchmark_decontamination, op9_language_id, op10_exact_dedup, op11_document_fingerprints, op12_phrase_collocations, op13_lexical_search)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS g
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3)),
v AS (SELECT * FROM w WHERE regexp_matches(g, '[0-9A-Za-z]|[^\x00-\x7F]')),
f AS (SELECT g, min((doc_id, i)) AS first FROM v GROUP BY g HAVING count(*) > 1),
c AS (SELECT doc_id, unnest(range(CASE WHEN doc_id = first[1] THEN greatest(i, first[2] + 3) ELSE i END, i + 3)) AS p
      FROM v JOIN f USING (g) WHERE (doc_id, i) <> first),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM c GROUP BY 1)
SELECT d.doc_id, CASE WHEN ps IS NULL THEN text
         ELSE array_to_string([x.s FOR x IN list_zip(l, range(1, len(l) + 1)) IF NOT list_contains(ps, x[2])], chr(10))
         END AS text,
       coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(ps), 0)::BIGINT AS n_removed
FROM d LEFT JOIN gone USING (doc_id)""".replace("x.s FOR", "x[1] FOR"),
    "op8_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT dw.doc_id, dw.m, dw.i, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op10_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM d""",
    "op11_document_fingerprints": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS after FROM d),
e AS (SELECT *, left(text, (length(text) - length(text) // 2)::INTEGER) || left(after, (length(text) // 2)::INTEGER) AS edited FROM n),
words AS (SELECT doc_id, kind, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x20\x09-\x0D]+') AS ws
          FROM (SELECT doc_id, 'own' AS kind, text AS t FROM e UNION ALL SELECT doc_id, 'edited', edited FROM e
                UNION ALL SELECT doc_id, 'after', after FROM e)),
h AS (SELECT DISTINCT doc_id, kind, left(md5(array_to_string(ws[i:i + 4], ' ')), 15) AS h
      FROM (SELECT doc_id, kind, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM words WHERE len(ws) > 0)),
s AS (SELECT doc_id, kind, list(h ORDER BY h) AS s
      FROM (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY doc_id, kind ORDER BY h) <= 256) GROUP BY ALL),
three AS (SELECT e.doc_id, e.text, e.edited, coalesce(a.s, []) AS a, coalesce(b.s, []) AS b, coalesce(c.s, []) AS c
          FROM e LEFT JOIN s a ON a.doc_id = e.doc_id AND a.kind = 'own' LEFT JOIN s b ON b.doc_id = e.doc_id AND b.kind = 'edited'
          LEFT JOIN s c ON c.doc_id = e.doc_id AND c.kind = 'after'),
u AS (SELECT *, list_sort(list_distinct(a || b))[:256] AS ab, list_sort(list_distinct(a || c))[:256] AS ac FROM three)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, ',') AS fingerprint,
       array_to_string(b, ',') AS edited_fingerprint,
       CASE WHEN len(ab) = 0 THEN 1.0::DOUBLE
            ELSE len(list_intersect(list_intersect(a, b), ab))::DOUBLE / len(ab) END AS near_edited,
       CASE WHEN len(ac) = 0 THEN 1.0::DOUBLE
            ELSE len(list_intersect(list_intersect(a, c), ac))::DOUBLE / len(ac) END AS near_next,
       CASE WHEN len(a) < 256 THEN len(a)::DOUBLE
            ELSE 255 / ((('0x' || a[256])::BIGINT::DOUBLE + 1) / 1152921504606846976) END AS n_shingles
FROM u""",
    "op12_phrase_collocations": rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
g AS (SELECT lang, ws[i:i + m - 1] AS ph, count(*) AS f
      FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m)
      GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE len(ph) = 1 GROUP BY 1),
c AS (SELECT lang, ph, f AS a FROM g WHERE len(ph) > 1 AND f >= 30),
cut AS (SELECT lang, ph, a, unnest(range(1, len(ph))) AS k FROM c),
scored AS (SELECT cut.lang, cut.ph, a, k, x.f AS l, y.f AS r,
                  ((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f))::BIGINT AS score
           FROM cut JOIN g x ON x.lang = cut.lang AND x.ph = cut.ph[:k] JOIN g y ON y.lang = cut.lang AND y.ph = cut.ph[k + 1:]),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
inner_ AS (SELECT lang, f, unnest(list_transform(range(1, len(ph) - m + 2), lambda i: ph[i:i + m - 1])) AS ph
           FROM (SELECT lang, ph, a AS f, unnest(range(2, len(ph))) AS m FROM c WHERE len(ph) > 2)),
ext AS (SELECT lang, ph, max(f) AS f FROM inner_ GROUP BY 1, 2),
kept AS (SELECT low.*, array_to_string(low.ph, ' ') AS phrase FROM low LEFT JOIN ext USING (lang, ph)
         WHERE ext.f IS NULL OR 100::HUGEINT * ext.f < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
    "op13_lexical_search": rf"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM documents),
size AS (SELECT count(*) AS nd, sum(len(ws))::BIGINT AS nl FROM t WHERE len(ws) > 0),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(ws) AS n, unnest(ws) AS term FROM t) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS qtf
      FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, size WHERE term IN (SELECT term FROM q) GROUP BY term, nd),
s AS (SELECT item_id, row, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nl))))::BIGINT AS score
      FROM q JOIN weight USING (term) JOIN tf USING (term), size GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM s WHERE score > 0)
WHERE rank <= 10""",
}
