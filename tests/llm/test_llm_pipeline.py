"""The pipeline, stage by stage and whole, and the entry point with and without the package."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import duckdb
import pytest
from test_llm_operators import SCHEMA, brute_components, brute_hits, lower, odd_rows

import __spark_entry__
import corpus_pipeline
from cartwise.llm import language_id
from cartwise.llm.common import documents, learnable
from cartwise.llm.queries import ORACLE_SQL, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_keep_the_columns(spark, sf):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.count() <= len(odd_rows())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0
    none = docs.limit(0)
    assert [stage(spark, none, sf).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5


def test_pipeline_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    frame = documents(spark, sf)
    classifier = language_id.Classifier(language_id.fit(frame.filter(learnable(frame, 4, 2))))
    left = [(i, t) for i, t in docs if classifier.predict(t)["accepted"]]
    last = {lower(t): i for i, t in sorted(left)}
    left = [(i, t) for i, t in left if last[lower(t)] == i]
    of = brute_components(left)
    left = [(i, t) for i, t in left if of[i][1] == i]
    items = [(r.item_id, r.text) for r in documents(spark, sf, "benchmark").collect()]
    left = [(i, t) for i, t in left if not brute_hits(t, items)[1]]
    got = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in got.select("doc_id").collect()} == {i for i, _ in left}


def test_near_copies_go_by_row(spark, sf):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(5, a), (10, a + " end"), (10, b),                       # one near copy, one clean text of an id
            (20, c), (20, c + " end"), (21, c + " stop"), (20, d), (22, d + " end"),    # two groups with one least id
            (30, "  one two"), (30, "one two"), (40, ""), (40, None), (None, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _near_copy_row string")
    out = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert out.columns == docs.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(t[0] for t in left if t[0] is not None) == [5, 10, 20, 20, 30, 40, 40]
    assert {(5, a), (10, b), (20, d), (40, ""), (40, None), (None, a)} <= set(left)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_twin(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got, want = QUERIES[name](spark, sf).toPandas(), con.sql(ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda f: sorted(map(repr, f[columns].astype(object).values.tolist()))
    assert rows(got) == rows(want)


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []


def test_entry_works_without_the_package():
    code = """
        import sys

        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name.startswith(("cartwise.llm", "corpus_pipeline")):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)

        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        names = set(e.queries())
        assert "pipeline" not in names and "finances_monthly" in names and set(e.oracle_sql()) <= names
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, check=True, timeout=120)
