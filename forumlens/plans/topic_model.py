"""Community documents to topic distributions and topic words: the former as CSV, the latter
with their arrays as parquet, as a term may hold a comma.

    spark-submit -m forumlens.plans.topic_model INPUT DISTRIBUTIONS WORDS
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from forumlens.functions import numbers, text
from forumlens.operators import terms, topic_tables, topics
from forumlens.session import build_session, materialise
from forumlens.sources import readers, writers

INPUTS = ("parquet", "csv", "json")
BAGS = ("counts", "hashed", "regex")


def read_input(
    spark: SparkSession, path: str, kind: str, partitions: int | None = None
) -> DataFrame:
    """``id, comments``: token arrays from parquet, texts from CSV or from JSON comments."""
    if kind == "parquet":
        return readers.read_communities(spark, path, partitions)
    if kind == "csv":
        return readers.read_documents(spark, path, partitions)
    raw = readers.read_comments(spark, path, partitions)
    return raw.select(F.col("subreddit").alias("id"), F.col("body").alias("comments"))


def tokens_of(kind: str, bag: str) -> Column:
    """Tokens of one row; rows of one community add up, whether comments or parts."""
    comments = F.col("comments")
    if kind == "parquet":
        return comments
    if bag == "regex":
        return text.drop_stop_words(
            text.regex_tokens(comments), text.default_stop_words(), any_case=True
        )
    return text.lower_tokens(comments)


def run(
    spark: SparkSession,
    source: str,
    output: str,
    words: str | None = None,
    kind: str = "parquet",
    bag: str = "counts",
    partitions: int | None = None,
    threshold: float | None = topics.DOMINANCE,
    size: int | None = None,
    tables: bool = False,
    **settings,
) -> None:
    """Write ``id, topicDistribution`` and, for bags with a vocabulary, the topics' words.

    With a threshold, only communities that one topic dominates are written. ``tables`` keeps
    the model as a table by term (see ``operators.topic_tables``) for vocabularies of any size.
    """
    rows = read_input(spark, source, kind, partitions)
    counts = materialise(terms.term_counts(rows, tokens_of(kind, bag)), "term-counts")
    if tables:
        model = topic_tables.fit_topic_tables(counts, settings["k"], settings["iterations"], settings["seed"])
        scored = model.scores(counts)
        scored = scored if threshold is None else topics.dominated(scored, threshold)
        text = numbers.distribution_text(F.col("topicDistribution"))
        writers.write_csv(scored.select("id", text.alias("topicDistribution")), output)
        if words:
            writers.write_parquet(model.words(), words)
        return
    if bag == "hashed":
        vocab = None
        vectors = terms.hashed_vectors(counts)
    else:
        vocab = materialise(terms.vocabulary(counts, size), "vocabulary")
        vectors = terms.count_vectors(counts, vocab)
    vectors = materialise(vectors, "vectors").persist()
    model = topics.fit_topics(vectors, **settings)
    scored = topics.distributions(model, vectors)
    if threshold is not None:
        scored = topics.dominated(scored, threshold)
    as_text = (
        numbers.distribution_text_fixed if bag == "hashed" else numbers.distribution_text
    )
    writers.write_csv(
        scored.select("id", as_text(F.col("topicDistribution")).alias("topicDistribution")), output
    )
    if words and vocab is not None:
        writers.write_parquet(topics.topic_words(model, vocab), words)
    vectors.unpersist()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("words", nargs="?", help="not written for hashed bags")
    parser.add_argument("--kind", choices=INPUTS, default="parquet")
    parser.add_argument("--bag", choices=BAGS, default="counts")
    parser.add_argument("--partitions", type=int, help="after input that cannot be split")
    parser.add_argument("--threshold", type=float, default=topics.DOMINANCE)
    parser.add_argument("--all", action="store_true", help="write every community")
    parser.add_argument("--topics", type=int, default=topics.TOPICS)
    parser.add_argument("--iterations", type=int, default=topics.ITERATIONS)
    parser.add_argument("--seed", type=int, default=topics.SEED)
    parser.add_argument("--tables", action="store_true", help="keep the model as a table by term")
    parser.add_argument("--optimizer", choices=("online", "em"), default="online")
    args = parser.parse_args()
    run(
        build_session("topic-model"),
        args.source,
        args.output,
        args.words,
        args.kind,
        args.bag,
        args.partitions,
        None if args.all else args.threshold,
        tables=args.tables,
        k=args.topics,
        iterations=args.iterations,
        seed=args.seed,
        optimizer=args.optimizer,
    )


if __name__ == "__main__":
    main()
