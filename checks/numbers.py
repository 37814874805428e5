"""Distributions as numbers and as text, over a table of doubles that SQL has too."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import tables as t
from checks.registry import query
from forumlens.functions import numbers
from forumlens.operators import topics

DISTRIBUTIONS_SQL = (
    "(SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS d "
    "FROM embeddings)"
)
ARGMAX_SQL = "CASE WHEN list_max(d) > 0 THEN list_position(d, list_max(d)) ELSE 0 END"


def _distribution(function, name: str):
    def run(spark, sf) -> DataFrame:
        value = function(F.col("topicDistribution"))
        return t.fixed_distributions(spark, sf).select("id", value.alias(name))

    return run


@query(
    "SELECT id, array_to_string(list_transform(d, lambda x: CAST(x AS VARCHAR)), ',') AS value "
    f"FROM {DISTRIBUTIONS_SQL}"
)
def distribution_text(spark, sf) -> DataFrame:
    return _distribution(numbers.distribution_text, "value")(spark, sf)


@query(
    "SELECT id, array_to_string(list_transform(d, lambda x: printf('%.5f', x)), ',') AS value "
    f"FROM {DISTRIBUTIONS_SQL}"
)
def distribution_text_fixed(spark, sf) -> DataFrame:
    return _distribution(numbers.distribution_text_fixed, "value")(spark, sf)


@query(
    "SELECT id, CAST(generate_subscripts(d, 1) - 1 AS INTEGER) AS pos, unnest(d) AS value "
    f"FROM {DISTRIBUTIONS_SQL}"
)
def distribution_parsed(spark, sf) -> DataFrame:
    """Text with all digits, quoted, and back to the same doubles."""
    quoted = t.fixed_distributions(spark, sf).select(
        "id",
        F.concat(
            F.lit('"'), numbers.distribution_text(F.col("topicDistribution")), F.lit('"')
        ).alias("value"),
    )
    return quoted.select("id", F.posexplode(numbers.parse_distribution(F.col("value")))).toDF(
        "id", "pos", "value"
    )


@query(f"SELECT id, list_max(d) AS value FROM {DISTRIBUTIONS_SQL}")
def largest_probability(spark, sf) -> DataFrame:
    return _distribution(numbers.largest, "value")(spark, sf)


@query(f"SELECT id, CAST({ARGMAX_SQL} AS BIGINT) AS assignment FROM {DISTRIBUTIONS_SQL}")
def dominant_topic(spark, sf) -> DataFrame:
    return topics.assigned(t.fixed_distributions(spark, sf)).select("id", "assignment")


@query(
    "SELECT id, list_max(d) AS top FROM "
    f"{DISTRIBUTIONS_SQL} WHERE list_max(d) > 0.3"
)
def dominated_fixed(spark, sf) -> DataFrame:
    kept = topics.dominated(t.fixed_distributions(spark, sf), 0.3)
    return kept.select("id", F.array_max("topicDistribution").alias("top"))


@query("SELECT vec_id, label + 1 AS topic_num FROM embeddings")
def topic_number(spark, sf) -> DataFrame:
    return t.table(spark, sf, "embeddings").select(
        "vec_id", numbers.topic_number(F.col("label")).alias("topic_num")
    )


@query(
    "SELECT id, CAST(generate_subscripts(d, 1) - 1 AS INTEGER) AS pos, "
    f"printf('%.4f', unnest(d)) AS value FROM {DISTRIBUTIONS_SQL}"
)
def four_decimals(spark, sf) -> DataFrame:
    exploded = t.fixed_distributions(spark, sf).select("id", F.posexplode("topicDistribution"))
    return exploded.select("id", "pos", numbers.four_decimals(F.col("col")).alias("value"))


@query(
    "SELECT id + 1 AS topic_num, 'w0 ' || printf('%.4f', d[1]) || ', w1 ' || printf('%.4f', d[2]) "
    f"|| ', w2 ' || printf('%.4f', d[3]) AS dists FROM {DISTRIBUTIONS_SQL}"
)
def leading_pairs(spark, sf) -> DataFrame:
    words = t.fixed_distributions(spark, sf).select(
        F.col("id").alias("topic"),
        F.transform(
            "topicDistribution", lambda x, i: F.concat(F.lit("w"), i.cast("string"))
        ).alias("term_words"),
        F.col("topicDistribution").alias("term_weight"),
    )
    pairs = topics.leading_pairs(words)
    shown = F.transform("dists", lambda p: F.concat_ws(" ", p["word"], p["prob"]))
    return pairs.select("topic_num", F.array_join(shown, ", ").alias("dists"))


# -- points nested under their topics --------------------------------------------------------

POINTS_SQL = f"(SELECT id, {ARGMAX_SQL} AS assignment, d[1] AS x, d[2] AS y FROM {DISTRIBUTIONS_SQL})"


def _points(spark, sf) -> DataFrame:
    d = F.col("topicDistribution")
    return topics.assigned(t.fixed_distributions(spark, sf)).select(
        "id", "assignment", d[0].alias("x"), d[1].alias("y")
    )


@query(
    "SELECT s.assignment, 'Topic ' || s.assignment AS meta_label, "
    "coalesce(CAST(p.id AS VARCHAR), '') AS id, p.x, p.y "
    "FROM (SELECT unnest(range(1, 71)) AS assignment) s "
    f"LEFT JOIN {POINTS_SQL} p ON p.assignment = s.assignment"
)
def points_with_topics(spark, sf) -> DataFrame:
    joined = topics.points_with_topics(_points(spark, sf), 70)
    id_ = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id")
    return joined.select("assignment", "meta_label", id_, "x", "y")


@query(
    "SELECT s.assignment, coalesce(p.part, 0) AS part, 'Topic ' || s.assignment AS meta_label, "
    "count(p.id) AS points, coalesce(string_agg(CAST(p.id AS VARCHAR), ',' ORDER BY p.id), '') AS ids, "
    "min(p.x) AS x, max(p.y) AS y "
    "FROM (SELECT unnest(range(1, 71)) AS assignment) s "
    "LEFT JOIN (SELECT *, (row_number() OVER (PARTITION BY assignment ORDER BY id) - 1) // 100000 AS part "
    f"FROM {POINTS_SQL}) p ON p.assignment = s.assignment GROUP BY s.assignment, p.part"
)
def nested_layout(spark, sf) -> DataFrame:
    nested = topics.nested_layout(_points(spark, sf), 70)
    return nested.select(
        "assignment",
        "part",
        "meta_label",
        F.size("data").cast("long").alias("points"),
        F.array_join(F.col("data.id").cast("array<string>"), ",").alias("ids"),
        F.array_min("data.x").alias("x"),
        F.array_max("data.y").alias("y"),
    )
