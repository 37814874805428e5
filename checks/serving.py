"""Leaderboards, their union, and the merged table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import tables as t
from checks.registry import query
from forumlens.operators import communities as com, leaderboards as boards
from forumlens.plans import serving_tables as job
from forumlens.session import materialise, scratch_path
from forumlens.sources import writers


def _lurkers_sql(source: str) -> str:
    return f"(SELECT id, 1 / comm_ups_ratio AS lurker FROM {t.ratio_sql(source)} WHERE comm_ups_ratio > 0)"


def _merged_sql(source: str) -> str:
    return (
        f"(SELECT s.id, s.comm_count, s.ups, l.lurker FROM {t.stats_sql(source)} s "
        f"LEFT JOIN {_lurkers_sql(source)} l ON l.id IS NOT DISTINCT FROM s.id)"
    )


LURKERS_SQL = _lurkers_sql(t.COMMENTS_LANG_SQL)
MERGED_SQL = _merged_sql(t.COMMENTS_LANG_SQL)


def _top_sql(source: str) -> dict[str, str]:
    return {
        "comm_count": f"(SELECT id, comm_count FROM {t.stats_sql(source)} ORDER BY comm_count DESC, id LIMIT {{n}})",
        "ups": f"(SELECT id, ups FROM {t.stats_sql(source)} ORDER BY ups DESC NULLS LAST, id LIMIT {{n}})",
        "lurker": f"(SELECT id, lurker FROM {_lurkers_sql(source)} ORDER BY lurker DESC, id LIMIT {{n}})",
    }


TOP_SQL = _top_sql(t.COMMENTS_LANG_SQL)

# More than 100 groups, to tell what a board shows from what it does not.
LINES_SQL = "(SELECT l_orderkey AS id, l_linenumber - 3 AS ups FROM lineitem)"


def _stats(spark, sf) -> DataFrame:
    return com.with_ratio(com.community_stats(t.comments(spark, sf, True)))


def _written_stats(spark, sf) -> DataFrame:
    """For queries that use the statistics more than once."""
    return materialise(_stats(spark, sf), "stats")


def _merged(stats: DataFrame) -> DataFrame:
    return boards.merged_board(
        stats.select("id", "comm_count"), stats.select("id", "ups"), boards.lurkers(stats)
    )


def _shown_ids(stats: DataFrame) -> DataFrame:
    return boards.shown_ids(boards.top_boards(stats))


def _line_stats(spark, sf) -> DataFrame:
    lines = t.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), (F.col("l_linenumber") - 3).alias("ups")
    )
    return materialise(com.with_ratio(com.community_stats(lines)), "line-stats")


SHOWN_SQL = "(" + " UNION ".join(f"SELECT id FROM {sql.format(n=100)}" for sql in _top_sql(LINES_SQL).values()) + ")"
LINES_MERGED_SQL = _merged_sql(LINES_SQL)


@query(f"SELECT id, ups FROM {t.stats_sql()} ORDER BY ups DESC, id")
def leaderboard_ups(spark, sf) -> DataFrame:
    return boards.by_ups(_stats(spark, sf))


@query(f"SELECT id, comm_count FROM {t.stats_sql()} ORDER BY comm_count DESC, id")
def leaderboard_count(spark, sf) -> DataFrame:
    return boards.by_count(_stats(spark, sf))


@query(f"SELECT id, comm_ups_ratio FROM {t.ratio_sql()} ORDER BY comm_ups_ratio DESC, id")
def leaderboard_ratio(spark, sf) -> DataFrame:
    return boards.by_ratio(_stats(spark, sf))


@query(f"SELECT id, lurker FROM {LURKERS_SQL} ORDER BY lurker DESC, id")
def leaderboard_lurkers(spark, sf) -> DataFrame:
    return boards.by_lurkers(_stats(spark, sf))


@query(f"SELECT id, comm_ups_ratio FROM {t.ratio_sql()} WHERE comm_ups_ratio > 0")
def positive_ratios(spark, sf) -> DataFrame:
    return boards.positive_ratios(_stats(spark, sf)).select("id", "comm_ups_ratio")


@query(f"SELECT id, lurker FROM {LURKERS_SQL}")
def lurker_scores(spark, sf) -> DataFrame:
    return boards.lurkers(_stats(spark, sf))


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS board, id, CAST({name} AS DOUBLE) AS value FROM {sql.format(n=100)}"
        for name, sql in TOP_SQL.items()
    )
)
def top_100_boards(spark, sf) -> DataFrame:
    value = F.when(F.col("board") == "lurker", F.col("lurker"))
    for name in ("comm_count", "ups"):
        value = value.when(F.col("board") == name, F.col(name).cast("double"))
    return boards.top_boards(_stats(spark, sf)).select("board", "id", value.alias("value"))


@query(
    "SELECT o_custkey AS id, count(*) AS comm_count FROM orders GROUP BY o_custkey "
    "ORDER BY comm_count DESC, id LIMIT 100"
)
def top_100_customers(spark, sf) -> DataFrame:
    """A board over more than 100 groups."""
    orders = t.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return boards.top_board(com.count_per_community(orders), "comm_count")


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS board, id FROM {sql.format(n=1)}" for name, sql in TOP_SQL.items()
    )
)
def leaders(spark, sf) -> DataFrame:
    return boards.top_boards(_stats(spark, sf), 1).select("board", "id")


@query(f"SELECT * FROM {MERGED_SQL}")
def merged_board(spark, sf) -> DataFrame:
    return _merged(_written_stats(spark, sf))


@query(f"SELECT id FROM {SHOWN_SQL}")
def shown_communities(spark, sf) -> DataFrame:
    return _shown_ids(_line_stats(spark, sf))


@query(f"SELECT * FROM {LINES_MERGED_SQL} WHERE id IN (SELECT id FROM {SHOWN_SQL})")
def merged_shown(spark, sf) -> DataFrame:
    stats = _line_stats(spark, sf)
    return boards.shown(_merged(stats), _shown_ids(stats))


@query(f"SELECT * FROM {LINES_MERGED_SQL} WHERE id NOT IN (SELECT id FROM {SHOWN_SQL})")
def merged_not_shown(spark, sf) -> DataFrame:
    stats = _line_stats(spark, sf)
    return boards.not_shown(_merged(stats), _shown_ids(stats))


@query(f"SELECT * FROM {MERGED_SQL} WHERE id <> 'src0_en'")
def outlier_excluded(spark, sf) -> DataFrame:
    merged = _merged(_written_stats(spark, sf))
    return boards.without_communities(merged, ["src0_en"])


# -- the tables of the page, written and read back ---------------------------------------------


def _served(spark, sf) -> str:
    """All serving tables, from statistics and with embeddings as distributions and weights."""
    stats = _written_stats(spark, sf)
    vectors = t.fixed_distributions(spark, sf)
    words = vectors.select(
        F.col("id").cast("int").alias("topic"),
        F.transform("topicDistribution", lambda _, i: F.concat(F.lit("term,"), i)).alias("term_words"),
        F.col("topicDistribution").alias("term_weight"),
    )
    tables = job.serving_tables(
        stats.select("id", "comm_count"),
        stats.select("id", "ups"),
        stats.select("id", "comm_ups_ratio"),
        vectors,
        words,
        70,
        ["src0_en"],
    )
    path = scratch_path(spark, "serving")
    writers.write_serving_tables(tables, path)
    return path


@query(
    f"SELECT * FROM {MERGED_SQL} WHERE id <> 'src0_en' AND id IN ("
    + " UNION ".join(f"SELECT id FROM {sql.format(n=100)}" for sql in TOP_SQL.values())
    + ")"
)
def serving_tables(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{_served(spark, sf)}/merged")


@query(
    " UNION ALL ".join(
        f"SELECT '{board}' AS board, id, CAST({name} AS DOUBLE) AS value FROM {TOP_SQL[name].format(n=100)}"
        for board, name in (("comment_board", "comm_count"), ("ups_board", "ups"), ("lurker_board", "lurker"))
    )
)
def serving_boards(spark, sf) -> DataFrame:
    path = _served(spark, sf)
    tops = [
        spark.read.parquet(f"{path}/{board}").select(
            F.lit(board).alias("board"), "id", F.col(name).cast("double").alias("value")
        )
        for board, name in (("comment_board", "comm_count"), ("ups_board", "ups"), ("lurker_board", "lurker"))
    ]
    return tops[0].union(tops[1]).union(tops[2])


@query(
    "SELECT vec_id + 1 AS topic_num, list_transform(range(0, 3), lambda i: 'term,' || i) AS words FROM embeddings"
)
def serving_topic_words(spark, sf) -> DataFrame:
    """Terms with a comma keep it."""
    words = spark.read.parquet(f"{_served(spark, sf)}/topic_words")
    return words.select(F.col("topic_num").cast("long").alias("topic_num"), F.col("dists.word").alias("words"))
