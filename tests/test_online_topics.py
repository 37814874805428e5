"""Topic models by tables: steps against slow versions, and both ways of the rounds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from forumlens.functions import variational as v
from forumlens.operators import online_topics as ot, topic_tables as tt, topics, vectoriser
from forumlens.session import materialise

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("features", VectorUDT())])


def psi(x):
    h = 1e-5
    return (math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h)


def test_digamma_and_trigamma():
    xs = [0.1, 0.5, 1.0, 3.7, 100.0]
    assert v.digamma_of(xs) == pytest.approx([psi(x) for x in xs], rel=1e-4)
    h = 1e-4
    slope = (v.digamma_of(np.array(xs) + h) - v.digamma_of(np.array(xs) - h)) / (2 * h)
    assert v.trigamma_of(xs) == pytest.approx(slope.tolist(), rel=1e-4)


def slow_document(n, share, prior):
    gamma = np.ones(len(prior))
    while True:
        theta = np.exp([psi(g) - psi(gamma.sum()) for g in gamma])
        new = theta * (share * (n / (share @ theta))[:, None]).sum(0) + prior
        done, gamma = np.abs(new - gamma).mean() <= v.CHANGE, new
        if done:
            theta = np.exp([psi(g) - psi(gamma.sum()) for g in gamma])
            return gamma, theta * share * (n / (share @ theta))[:, None]


def documents(seed, k=3):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 40, 25)
    return counts, rng.integers(1, 6, counts.sum()).astype(float), rng.random((counts.sum(), k)).astype(np.float32)


def test_topics_of_documents_are_those_of_a_slow_version():
    counts, n, share = documents(3)
    prior = np.array([0.2, 0.3, 0.5])
    found, dealt = v.document_topics(n, share, counts, prior)
    ends = np.cumsum(counts)
    for i, (a, b) in enumerate(zip(ends - counts, ends, strict=True)):
        gamma, own = slow_document(n[a:b], share[a:b].astype(float), prior)
        assert found[i] == pytest.approx(gamma.tolist(), rel=1e-3)
        assert dealt[a:b] == pytest.approx(own, rel=1e-3)


@pytest.mark.parametrize("least", [1, 50, 10_000])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_documents_go_on_in_the_next_batch(monkeypatch, least, width):
    """Where batches end, and how many entries are done at once, makes no difference."""
    monkeypatch.setattr(ot, "STEP_ENTRIES", least)
    counts, n, share = documents(4)
    row = np.repeat(np.arange(len(counts)) * 10, counts)
    b = pa.array(list(share), pa.list_(pa.float32()))
    table = pa.table({"_row": row, "idx": pa.array(np.arange(len(row)) % 9, pa.int32()), "n": n, "b": b})
    prior = np.full(3, 1 / 3)
    want, dealt = v.document_topics(n, share, counts, prior)
    got = pa.Table.from_batches(ot._steps(prior, False)(iter(table.to_batches(max_chunksize=width))))
    assert got["_row"].to_pylist() == sorted(set(row.tolist()))
    assert np.array(got["g"].to_pylist()) == pytest.approx(want, rel=1e-6)
    sums = np.zeros((9, 3))
    for batch in ot._steps(prior, True)(iter(table.to_batches(max_chunksize=width))):
        for idx, s in zip(batch["idx"].to_pylist(), batch["s"].to_pylist(), strict=True):
            if idx == -1:
                assert s[3] == len(counts)
            else:
                sums[idx] += s
    assert sums.sum() == pytest.approx(n.sum())
    assert sums == pytest.approx(np.array([dealt[np.arange(len(row)) % 9 == i].sum(0) for i in range(9)]), rel=1e-6)


@pytest.mark.parametrize("em", [False, True])
def test_rounds_by_term_and_by_join_agree(spark, em):
    rows = [(c if c else None, f"t{(c * 7 + w) % 23}", 1 + (c * w) % 4) for c in range(9) for w in range(12)]
    df = spark.createDataFrame([*rows, (3, None, 0)], "id int, term string, n long")
    by_term, by_join = (tt.fit_topic_tables(df, k=3, rounds=4, em=em, max_rows=m) for m in (100, 0))
    assert by_term.totals == pytest.approx(by_join.totals, rel=1e-4)
    first, second = ({r["term"]: r["l"] for r in m.terms.collect()} for m in (by_term, by_join))
    assert first.keys() == second.keys()
    for term, weights in first.items():
        assert weights == pytest.approx(second[term], rel=1e-3, abs=1e-4)


def test_steps_in_parts_are_one(monkeypatch):
    rng = np.random.default_rng(5)
    counts = rng.integers(1, 9, 30)
    where, n, share = rng.integers(0, 6, counts.sum()), rng.random(counts.sum()), rng.random((30, 4))
    state, whole = rng.random((6, 4)), np.zeros((6, 4))
    want = v.dealt_sums(state, where, n, share, counts, whole)
    monkeypatch.setattr(v, "STEP_ENTRIES", 5)
    sums = np.zeros((6, 4))
    assert v.dealt_sums(state, where, n, share, counts, sums) == pytest.approx(want)
    assert sums == pytest.approx(whole) and whole.sum() == pytest.approx(n.sum())


@pytest.mark.parametrize("optimizer", ["online", "em"])
def test_planted_topics(spark, optimizer):
    """Two kinds of documents with terms of their own, equal ids, a dense vector and no terms."""
    rows = [(f"c{i % 50}", Vectors.sparse(10, [(j + 5 * (i % 2), 3.0 + j) for j in range(5)])) for i in range(400)]
    rows += [("dense", Vectors.dense([3.0, 1.0, 2.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0])), ("none", Vectors.sparse(10, []))]
    vectors = materialise(spark.createDataFrame(rows, SCHEMA), "vectors")
    model = topics.fit_topics(vectors, k=2, iterations=40, optimizer=optimizer)
    assert set(model.terms.columns) == {"idx", "l"} and model.vocabSize() == 10  # a table, not a matrix
    found = {frozenset(r["termIndices"]) for r in model.describeTopics(5).collect()}
    assert found == {frozenset(range(5)), frozenset(range(5, 10))}
    assert topics.distributions(model, vectors).count() == 402
    by = {r["id"]: r["topicDistribution"] for r in topics.distributions(model, vectors).collect()}
    assert by["none"] == [0.0, 0.0] and sum(by["dense"]) == pytest.approx(1)
    matrix = model.topicsMatrix().toArray()
    assert matrix.sum(0) == pytest.approx(np.array(model.totals))


def test_shared_and_shuffled_terms_agree(spark, monkeypatch):
    rows = [(f"c{i}", Vectors.sparse(12, [((i + j) % 12, 1.0 + j) for j in range(4)])) for i in range(30)]
    vectors = materialise(spark.createDataFrame(rows, SCHEMA), "vectors")
    results = []
    for shared in (100, 5, 0):
        monkeypatch.setattr(ot, "SHARED_TERMS", shared)
        model = topics.fit_topics(vectors, k=2, iterations=4)
        results.append({r["id"]: r["topicDistribution"] for r in topics.distributions(model, vectors).collect()})
    for other in results[1:]:
        assert all(other[c] == pytest.approx(p, rel=1e-4) for c, p in results[0].items())


def test_pipelines_write_vectors_before_the_iterations(spark):
    """Whatever makes the vectors runs once in a fit."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(text):
        seen.add(1)
        return text

    texts = spark.createDataFrame([(i, "alpha beta gamma") for i in range(20)], "id int, comments string")
    topics.hashing_pipeline(64, k=2, iterations=6).fit(texts.withColumn("comments", same.asNondeterministic()("comments")))
    assert seen.value == 20


def test_no_weights_of_terms_are_broadcast_by_the_driver(spark, monkeypatch):
    """Joins with the weights of terms are shuffled, whatever their size; the first terms' go with the function."""
    monkeypatch.setattr(ot, "SHARED_TERMS", 5)
    rows = [(f"c{i}", Vectors.sparse(12, [((i + j) % 12, 1.0 + j) for j in range(4)])) for i in range(30)]
    vectors = materialise(spark.createDataFrame(rows, SCHEMA), "vectors")
    model = topics.fit_topics(vectors, k=2, iterations=2)
    plan = topics.distributions(model, vectors)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_vectoriser_by_tables_is_sparks(spark, monkeypatch):
    """The same counts as Spark's class, whether terms are joined by shuffle or not, and no list of them on the driver."""
    words = [["b", "a", "b"], [], ["c", "a", "zz", "b"], ["only"], ["a"] * 5]
    df = spark.createDataFrame([(i % 2, w) for i, w in enumerate(words)], "id int, comments array<string>")
    spark_model = CountVectorizer(inputCol="comments", outputCol="features").fit(df)

    def counted(made, vocabulary):
        return sorted((r["id"], sorted((vocabulary[i], float(r["features"][int(i)])) for i in r["features"].indices)) for r in made.collect())

    want = counted(spark_model.transform(df), spark_model.vocabulary)
    monkeypatch.setattr(CountVectorizerModel, "vocabulary", property(lambda self: pytest.fail("all terms on the driver")))
    for shared in (100, 1):
        monkeypatch.setattr(vectoriser, "SHARED_TERMS", shared)
        pipeline = topics.counting_pipeline(k=2, iterations=1).fit(df)
        terms = {r["idx"]: r["term"] for r in topics.vocabulary_of(pipeline).collect()}
        assert [terms[i] for i in range(5)] == ["a", "b", "c", "only", "zz"]
        assert counted(pipeline.stages[0].transform(df), terms) == want
    cut = topics.counting_pipeline(size=2, k=2, iterations=1).fit(df)
    assert sorted(map(tuple, topics.vocabulary_of(cut).collect())) == [(0, "a"), (1, "b")]
    assert topics.distributions(cut, df).count() == 5
