"""The topic model kept as tables: against a slow version, planted topics and Spark's model."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import tables
from forumlens.functions import text
from forumlens.operators import terms, topic_tables as tt, topics
from forumlens.plans import topic_model
from forumlens.session import materialise

ROWS = [(c, f"{'abc'[c % 3]}{w}", 1 + (c * w) % 4) for c in range(12) for w in range(15)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, term string, n long")


def psi(x):
    h = 1e-5
    return (math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h)


def test_digamma(spark):
    numbers = [0.1, 0.5, 1.0, 3.7, 100.0, 1e6]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", tt.digamma(F.col("x")).alias("y"))
    for row in df.collect():
        assert row["y"] == pytest.approx(psi(row["x"]), rel=1e-4, abs=1e-4)


def test_rounds_are_those_of_a_slow_version(spark):
    first = tt.fit_topic_tables(frame(spark, ROWS), k=2, rounds=0)
    weights = {r["term"]: np.array(r["l"]) for r in first.terms.collect()}
    places = {c: np.ones(2) for c in range(12)}
    for _ in range(3):
        total = sum(weights.values())
        b = {w: np.exp([psi(x) - psi(t) for x, t in zip(v, total, strict=True)]) for w, v in weights.items()}
        sums, terms_ = {c: np.full(2, 0.5) for c in places}, {w: np.full(2, 0.5) for w in weights}
        for c, w, n in ROWS:
            share = places[c] * b[w]
            sums[c] = sums[c] + n * share / share.sum()
            terms_[w] = terms_[w] + n * share / share.sum()
        places = {c: np.exp([psi(x) - psi(g.sum()) for x in g]) for c, g in sums.items()}
        weights = terms_
    model = tt.fit_topic_tables(frame(spark, ROWS), k=2, rounds=3)
    for row in model.terms.collect():
        assert row["l"] == pytest.approx(weights[row["term"]].tolist(), rel=1e-3)
    assert model.totals == pytest.approx(sum(weights.values()).tolist(), rel=1e-3)


def test_planted_topics_are_found(spark):
    rows = [*ROWS, (99, None, 0), (None, "a1", 5), (None, "a2", 3)]
    model = tt.fit_topic_tables(frame(spark, rows), k=6, rounds=15)
    firsts = [{w[0] for w in r["term_words"]} for r in model.words(5).collect()]
    assert {next(iter(f)) for f in firsts if len(f) == 1} == set("abc")
    scores = {r["id"]: r["topicDistribution"] for r in model.scores(frame(spark, [*rows, (98, "unknown", 4)])).collect()}
    assert len(scores) == 15 and scores[98] == scores[99] == [0.0] * 6
    assert all(sum(s) == pytest.approx(1) for c, s in scores.items() if c not in (98, 99))
    totals = model.matrix().groupBy("topic").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    assert len(totals) == 6 and all(r["w"] == pytest.approx(1) and r["n"] == 45 for r in totals)


def test_held_out_perplexity_is_not_above_that_of_sparks_model(spark, small):
    tokens = text.ascii_tokens(F.col("comments"), split_compound=True)
    counts = materialise(terms.term_counts(tables.comment_texts(spark, small, True), tokens), "counts")
    held = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    train, test = counts.filter(~held), counts.filter(held)
    vocab = materialise(terms.vocabulary(train), "vocab")
    lda = topics.fit_topics(materialise(terms.count_vectors(train, vocab), "vectors"))
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(lda.topicsMatrix().toArray())]
    known = materialise(spark.createDataFrame(rows, "idx int, l array<double>").join(vocab, "idx").select("term", "l"), "terms")
    theirs = tt.TopicTables(known, tt._totals(known, 10), 0.1).perplexity(test)
    assert tt.fit_topic_tables(train, rounds=8).perplexity(test) < 1.02 * theirs


def test_job_with_tables(spark, tmp_path):
    rows = [(f"c{c}", [f"{'abc'[c % 3]}word"] * 3) for c in range(6)]
    spark.createDataFrame(rows, "id string, comments array<string>").write.parquet(str(tmp_path / "in"))
    topic_model.run(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "words"), "parquet", "counts", None, None,
        tables=True, k=3, iterations=3, seed=1, optimizer="online",
    )
    assert spark.read.csv(str(tmp_path / "out")).count() == 6
    assert spark.read.parquet(str(tmp_path / "words")).count() == 3


def test_nothing_to_learn(spark):
    model = tt.fit_topic_tables(frame(spark, []), k=2, rounds=1)
    assert model.totals == [0.0, 0.0] and not model.matrix().collect()
