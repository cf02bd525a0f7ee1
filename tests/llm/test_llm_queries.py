"""Registered queries of the training-data operators against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import os
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry_points
import corpus_pipeline
from check_queries import TABLES, normal, oracle
from tallyshelf.llm import line_runs, mixture, queries, shared, simhash, toxicity

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_all_are_registered():
    names = set(entry_points.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert set(queries.SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = Counter(tuple(normal(r[c]) for c in columns) for r in df.collect())
    names, _, rows = oracle(con, queries.SQL[name])
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == Counter(tuple(normal(r[i]) for i in order) for r in rows)


def test_pipeline_stage_by_stage(spark):
    docs = shared.table(spark, SF, "documents")
    columns = docs.columns
    scratch = shared.Scratch(spark, "pipeline-test")
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF))
        results.append(docs)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(results) == 5
    assert all(r.columns == columns for r in results[:4])
    given = shared.table(spark, SF, "documents")
    civil, lines, single, mixed, tokens = results

    scored = toxicity.scored(given, shared.table(spark, SF, "labels"), toxicity.learnable(F.col("doc_id")))
    low = {r["doc_id"] for r in scored.where("score < 0.3").collect()}
    assert {r["doc_id"] for r in civil.collect()} == low

    held = Counter(k for r in civil.collect() for k in {line_runs.line_key(x.encode()) for x in r["text"].split("\n")} if k)
    expected = {
        r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if held[line_runs.line_key(x.encode())] < 10 or not line_runs.line_key(x.encode()))
        for r in civil.collect()
    }
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}
    assert got == {i: (t, len(t)) for i, t in expected.items()}

    # Groups of five-word Jaccard similarity 0.8 or more by brute force.
    sets = {i: frozenset(simhash.shingle_hashes(t, 5).tolist()) for i, t in expected.items()}
    alike = lambda x, y: x == y or len(x & y) >= 0.8 * len(x | y) - 1e-9
    root = {i: i for i in sets}
    ordered = sorted(sets)
    for i in ordered:
        for j in ordered:
            if i < j and root[i] != root[j] and alike(sets[i], sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(root.values()))

    plan = mixture.mix(single)[0].where("size > 0").collect()
    copies = Counter({r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in plan})
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies

    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    found = tokens.select("*").collect()
    assert Counter(r["doc_id"] for r in found) == +copies
    import hashlib

    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in found)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in found)
