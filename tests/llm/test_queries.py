"""Every registered query against its SQL, and the pipeline against its stages done plainly."""

import math
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from concord.llm import registry, toxicity
from concord.llm.frames import table

from .conftest import words
from .test_decontaminate import brute as brute_hits
from .test_mixing import brute_targets, nearest
from .test_near import brute as brute_links

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_and_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, SMALL)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(str([r[c] for c in columns]) for r in got.collect()) == sorted(str([r[i] for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql(spark, name):
    got = registry.QUERIES[name](spark, SMALL)
    documents = table(spark, SMALL, "documents").count()
    if name == "op7_substring_dedup":
        assert 0 < got.count() < documents
    elif name == "op13_packing":
        assert got.count() >= documents
    else:
        assert got.count() == documents
    assert not any(kind == "void" for _, kind in got.dtypes)


def test_pipeline(spark):
    docs = {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(table(spark, SMALL, "documents"), table(spark, SMALL, "labels")).collect()}
    left = [d for d in docs if not scores[d]]
    best = defaultdict(int)
    for d in left:
        key = docs[d].text.encode().lower()
        best[key] = max(best[key], d)
    left = sorted(best.values())
    left = sorted(d for d, c, _ in brute_links([(d, docs[d].text) for d in left]) if d == c)
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    left = sorted(d for d, _, hit, _ in brute_hits([(d, docs[d].text) for d in left], items) if not hit)
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == left
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(docs[r.doc_id].text.split())
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= nearest([r.size for r in got if r.source == s], target) + 1
    assert math.isclose(sum(brute_targets(sizes).values()), sum(sizes.values()))
    assert all(words(docs[d].text) for d in left)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SMALL).columns == docs.columns


def test_pipeline_on_empty_tables(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).collect() == []
