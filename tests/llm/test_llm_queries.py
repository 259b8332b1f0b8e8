"""Registered queries on the smallest tables, and the pipeline stage by stage."""

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from tablewright.llm.common import stage
from tablewright.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    import duckdb

    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in ORACLES:
        db = duckdb.connect()
        for table in ("documents", "benchmark", "conversations"):
            db.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
        found = db.execute(ORACLES[name])
        assert counted(df.columns, rows) == counted([d[0] for d in found.description], found.fetchall())
    elif "doc_id" in df.columns:
        assert {r[df.columns.index("doc_id")] for r in rows} == {
            r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()
        }


def test_operators_have_a_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = stage(step(spark, docs, SMALL))
        assert after.dtypes == docs.dtypes, name
        if name != "mixing sources":
            assert 0 < after.count() <= before, name
            assert after.select("doc_id").distinct().count() == after.count()
        before, docs = after.count(), after
    packed = corpus_pipeline.run(spark, SMALL)
    pieces = packed.collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    assert sum(r.length for r in pieces if r.start == 0 and r.length == r.doc_tokens) <= sum(r.doc_tokens for r in pieces)


def test_pipeline_against_plain_python(spark):
    """Line dedup, near-dedup, mixing and packing, each on all that the stage before it kept."""
    from test_near_copies import plain_kept
    from test_text_operators import plain_lines

    from tablewright.llm import mixing, packing
    from tablewright.llm.queries import token_file

    docs = stage(corpus_pipeline.classify(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    docs = stage(corpus_pipeline.drop_shared_lines(spark, docs, SMALL))
    want = {doc: text for doc, text, _, _ in plain_lines(rows, 10)}
    assert {r.doc_id: r.text for r in docs.collect()} == want
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs = stage(corpus_pipeline.drop_near_copies(spark, docs, SMALL))
    assert Counter(r.doc_id for r in docs.collect()) == plain_kept([(d, want[d], "s") for d in sorted(want)])

    copies = {r.doc_id: r.copies for r in mixing.taken(docs).collect() if r.copies}
    docs = stage(corpus_pipeline.mix_sources(spark, docs, SMALL))
    assert Counter(r.doc_id for r in docs.collect()) == copies

    encode, tokens = packing.tokenizer(token_file()), Counter()
    for doc, times in copies.items():
        tokens[doc] = times * (len(encode.encode(want[doc], add_special_tokens=False).ids) + 1)
    found = Counter()
    for r in corpus_pipeline.pack(spark, docs, SMALL).collect():
        found[r.doc_id] += r.length
    assert found == tokens


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.classify(spark, docs, SMALL).select("doc_id").collect()}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    good = [d for d, q in marked.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good)
    assert sum(d in kept for d, q in marked.items() if q == 0) <= 0.2 * sum(q == 0 for q in marked.values())


def test_pipeline_on_empty_and_null_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    empty = docs.limit(0)
    blank = spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, 0)], docs.schema)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SMALL).count() == 0, name
        assert step(spark, blank, SMALL).count() <= 2, name
