"""Leaderboards and distributions (CSV) and topic words (parquet) to serving tables in parquet.

    spark-submit -m forumlens.plans.serving_tables COUNTS UPS RATIOS DISTRIBUTIONS WORDS OUTPUT
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens import schemas
from forumlens.functions.numbers import parse_distribution
from forumlens.operators import leaderboards as boards, topics
from forumlens.session import build_session, materialise
from forumlens.sources import readers, writers


def serving_tables(
    counts: DataFrame,
    ups: DataFrame,
    ratios: DataFrame,
    distributions: DataFrame,
    words: DataFrame,
    k: int = topics.TOPICS,
    excluded: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All tables of the page, by name. Boards are sorted again, whatever order they had.

    The inputs are read several times each and are therefore written once.
    """
    counts, ups, ratios = (materialise(df, "board") for df in (counts, ups, ratios))
    distributions = materialise(distributions, "distributions")
    lurkers = boards.lurkers(ratios)
    tops = {
        "comment_board": boards.top_board(counts, "comm_count"),
        "ups_board": boards.top_board(ups, "ups"),
        "lurker_board": boards.top_board(lurkers, "lurker"),
    }
    merged = boards.shown(
        boards.merged_board(counts, ups, lurkers), boards.shown_ids(*tops.values())
    )
    points = materialise(topics.layout(distributions), "layout")
    return {
        **tops,
        "totals": boards.totals_text(counts),
        "merged": boards.without_communities(merged, excluded),
        "layout": points,
        "topic_layout": topics.nested_layout(points, k),
        "topic_words": topics.leading_pairs(words),
    }


def run(
    spark: SparkSession,
    counts: str,
    ups: str,
    ratios: str,
    distributions: str,
    words: str,
    output: str,
    k: int = topics.TOPICS,
    excluded: Sequence[str] = (),
    versioned: bool = False,
) -> None:
    """``versioned`` publishes all tables at once, so that no reader sees old and new ones together."""
    parsed = readers.read_result(spark, distributions, schemas.DISTRIBUTIONS).withColumn(
        "topicDistribution", parse_distribution(F.col("topicDistribution"))
    )
    topic_words = spark.read.parquet(words)
    tables = serving_tables(
        readers.read_result(spark, counts, schemas.COUNT_BOARD),
        readers.read_result(spark, ups, schemas.UPS_BOARD),
        readers.read_result(spark, ratios, schemas.RATIO_BOARD),
        parsed,
        topic_words,
        k,
        excluded,
    )
    write = writers.publish_tables if versioned else writers.write_serving_tables
    write(tables, output)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("counts", "ups", "ratios", "distributions", "words", "output"):
        parser.add_argument(name)
    parser.add_argument("--topics", type=int, default=topics.TOPICS)
    parser.add_argument("--exclude", nargs="*", default=(), help="communities left out")
    parser.add_argument("--versioned", action="store_true", help="publish a new version of all tables at once")
    args = parser.parse_args()
    run(
        build_session("serving-tables"),
        args.counts,
        args.ups,
        args.ratios,
        args.distributions,
        args.words,
        args.output,
        args.topics,
        args.exclude,
        args.versioned,
    )


if __name__ == "__main__":
    main()
