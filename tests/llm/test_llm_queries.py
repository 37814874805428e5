"""The registered queries beside their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from forumlens.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import linked
from tools.compare import TABLES, rows_of


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ("op6_licences", "op10_mixing"):
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    got = rows_of(df.columns, df.collect())
    assert got
    if name in ORACLES:
        con = duckdb.connect()
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
        result = con.execute(ORACLES[name])
        assert got == rows_of([d[0] for d in result.description], result.fetchall())


def test_pipeline(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name != "packing":
            assert sorted(docs.columns) == sorted(columns)
        if name == "jaccard_join":
            ordered = sorted(before, key=lambda r: r["doc_id"])
            _, top = linked([r["text"] for r in ordered])
            assert {r["doc_id"] for r in after} == {ordered[t]["doc_id"] for t in top}
        if name == "pseudonyms":
            assert len(after) == len(before)
        if name == "mixing":
            sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in before}
            assert abs(sum(len(r["text"].split()) for r in after) / sum(sizes.values()) - 1.5) < 0.1
            text = {r["doc_id"]: r["text"].split() for r in before}
            assert all(set(r["text"].split()) <= set(text[r["doc_id"]]) for r in after)
        if name == "packing":
            assert sum(r["length"] for r in after) == sum({(r["doc_id"], r["doc_tokens"], r["start"], r["sequence_id"], r["offset"]): r["length"] for r in after}.values())
        before = after
    assert after


def test_near_copies_with_null_and_repeated_ids(spark, small):
    text = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    data = [
        (None, text), (None, text + " end"), (7, text), (3, text + " tail"), (7, text),  # one group
        (3, other), (3, other), (None, other + " x"), (None, "alone here"), (None, "alone here"), (9, ""), (None, None),
    ]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in data]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (df, df.orderBy("text"), df.repartition(5)):
        got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()]
        wanted = [(3, text + " tail"), (3, other), (None, "alone here"), (9, ""), (None, None)]
        assert sorted(got, key=str) == sorted(wanted, key=str)


def test_pipeline_of_nothing(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.isEmpty()
