"""Headline queries, each timed as the median of some runs after one warm-up.

Prints one JSON line. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` may be set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import tables as t  # noqa: E402
from forumlens.functions import text  # noqa: E402
from forumlens.operators import (  # noqa: E402
    cleaning,
    communities as com,
    leaderboards as boards,
    terms,
    topics,
)
from forumlens.plans.serving_tables import serving_tables  # noqa: E402
from forumlens.session import materialise  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def build() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def benchmarks(spark: SparkSession) -> dict:
    def comments(by_language: bool = False) -> DataFrame:
        return t.comment_texts(spark, SF_DIR, by_language)

    def stats() -> DataFrame:
        return com.with_ratio(com.community_stats(t.comments(spark, SF_DIR, True)))

    tokens = text.ascii_tokens(F.col("comments"))
    single = text.ascii_tokens(F.col("comments"), split_compound=True)
    written: dict[str, object] = {}

    def leaderboards() -> None:
        source = materialise(stats(), "stats")
        for board in (boards.by_ups, boards.by_count, boards.by_ratio):
            compute(board(source))

    def text_concatenation() -> None:
        parted = com.assign_parts(comments()).withColumn(
            "comments", text.plain_text(F.col("comments"))
        )
        compute(com.community_text(parted, drop_empty=True))

    def lemma_text() -> None:
        compute(cleaning.clean_text(comments()))

    def term_vectors() -> None:
        counts = materialise(terms.term_counts(comments(True), single), "counts")
        written["vocab"] = materialise(terms.vocabulary(counts), "vocab")
        vectors = terms.count_vectors(counts, written["vocab"])
        written["vectors"] = materialise(vectors, "vectors")

    def topic_fit() -> None:
        written["model"] = topics.fit_topics(written["vectors"])

    def topic_scores() -> None:
        scored = topics.distributions(written["model"], written["vectors"])
        compute(topics.dominated(scored))
        compute(topics.topic_words(written["model"], written["vocab"]))

    def serving() -> None:
        source = materialise(stats(), "stats")
        made = serving_tables(
            source.select("id", "comm_count"),
            source.select("id", "ups"),
            source.select("id", "comm_ups_ratio"),
            topics.distributions(written["model"], written["vectors"]),
            topics.topic_words(written["model"], written["vocab"]),
            excluded=["src0_en"],
        )
        for df in made.values():
            compute(df)

    return {
        "community_stats": lambda: compute(stats()),
        "leaderboards": leaderboards,
        "clean_tokens": lambda: compute(comments().select("id", tokens.alias("comments"))),
        "community_documents": lambda: compute(com.community_documents(comments(), tokens)),
        "text_concatenation": text_concatenation,
        "lemma_text": lemma_text,
        "term_counts": lambda: compute(terms.term_counts(comments(True), single)),
        "term_vectors": term_vectors,
        "topic_fit": topic_fit,
        "topic_scores": topic_scores,
        "serving_tables": serving,
    }


def main() -> None:
    spark = build()
    seconds = {}
    for name, run in benchmarks(spark).items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
