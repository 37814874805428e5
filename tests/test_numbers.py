from __future__ import annotations

import random

from pyspark.sql import functions as F

from forumlens.functions import numbers
from forumlens.operators import topics

D = F.col("d")


def values(spark, column, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r["r"] for r in sorted(df.select("i", column.alias("r")).collect(), key=lambda r: r["i"])]


def test_ratio(spark):
    ratio = numbers.comments_per_up(F.col("n"), F.col("ups"))
    rows = [(201, 400), (1, 3), (5, 0), (5, None), (3, -2), (0, 7)]
    assert values(spark, ratio, rows, "n long, ups long") == [0.502, 0.333, 0.0, 0.0, -1.5, 0.0]


def test_ratio_rounds_as_python_does(spark):
    pairs = spark.range(1, 401).withColumnRenamed("id", "n").withColumn(
        "ups", F.explode(F.expr("sequence(-400L, 400L)"))
    )
    ratio = numbers.comments_per_up(F.col("n"), F.col("ups"))
    rows = pairs.select("n", "ups", ratio.alias("r")).toPandas()
    expected = [round(n / u, 3) if u else 0 for n, u in zip(rows["n"], rows["ups"])]
    assert rows["r"].tolist() == expected


def test_fixed_decimals_format_as_python_does(spark):
    sample = [i / 32 for i in range(64)] + [i / 20000 for i in range(300)] + [1e-9, -0.00015]
    for decimals in (4, 5):
        texts = values(spark, numbers.fixed_decimals(D, decimals), [(x,) for x in sample], "d double")
        assert texts == [f"{x:.{decimals}f}" for x in sample]


def test_lurker_score(spark):
    assert values(spark, numbers.lurker_score(D), [(0.5,), (0.0,)], "d double") == [2.0, None]


def test_dominant_topic(spark):
    rows = [([0.1, 0.7, 0.2],), ([0.0, 0.0],), ([0.5, 0.5],), ([-1.0, -2.0],), ([9.1e-05, 0.2],)]
    assert values(spark, numbers.dominant_topic(D), rows, "d array<double>") == [2, 0, 1, 0, 2]


def test_dominance_is_numeric(spark):
    rows = [("a", [0.1, 9.1e-05]), ("b", [0.71, 0.29]), ("c", [0.7, 0.3])]
    df = spark.createDataFrame(rows, "id string, topicDistribution array<double>")
    assert [r["id"] for r in topics.dominated(df).collect()] == ["b"]


def test_full_digits_reads_back(spark):
    rng = random.Random(1)
    sample = [rng.random() * 10 ** rng.randint(-30, 25) * rng.choice([1, -1]) for _ in range(3000)]
    sample += [0.0, 1.0, 1e-05, 1e-04, 0.00012, 1e7, 123456789.5, 1e15, 1e16, 1e22, 1.5e-10]
    texts = values(spark, numbers.full_digits(D), [(x,) for x in sample], "d double")
    assert [float(t) for t in texts] == sample
    assert "E" not in "".join(texts)
    for written, x in zip(texts, sample):
        # The JVM may write digits beyond the shortest that read back; the form is the same.
        shortest = repr(x)
        assert written == shortest or len(written) > len(shortest)
        assert ("e" in written) == ("e" in shortest)


def test_distribution_texts(spark):
    rows = [([0.5, 1e-05, 0.0],)]
    schema = "d array<double>"
    assert values(spark, numbers.distribution_text(D), rows, schema) == ["0.5,1e-05,0.0"]
    fixed = values(spark, numbers.distribution_text_fixed(D), rows, schema)
    assert fixed == ["0.50000,0.00001,0.00000"]
    assert values(spark, numbers.parse_distribution(F.col("t")), [('"0.5,1e-05"',)], "t string") == [
        [0.5, 1e-05]
    ]


def test_small_formats(spark):
    assert values(spark, numbers.four_decimals(D), [(0.12341,), (2.0,)], "d double") == [
        "0.1234",
        "2.0000",
    ]
    assert values(spark, numbers.thousands(F.col("n")), [(1234567,), (-5,)], "n long") == [
        "1,234,567",
        "-5",
    ]
    assert values(spark, numbers.topic_number(F.col("n")), [(0,)], "n int") == [1]


def test_leading_pairs_of_short_topics(spark):
    df = spark.createDataFrame(
        [(0, ["a", "b"], [0.25, 0.125])],
        "topic int, term_words array<string>, term_weight array<double>",
    )
    row = topics.leading_pairs(df).first()
    assert row["topic_num"] == 1
    assert [tuple(p) for p in row["dists"]] == [("a", "0.2500"), ("b", "0.1250")]
