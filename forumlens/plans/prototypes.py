"""The two early topic jobs, over all comments, or the first ones in key order.

    spark-submit -m forumlens.plans.prototypes INPUT OUTPUT [--limit N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens.functions import numbers
from forumlens.operators import cleaning, communities, ranking, terms, topics
from forumlens.session import build_session, materialise
from forumlens.sources import readers, writers


def _first_comments(spark: SparkSession, source: str, limit: int | None) -> DataFrame:
    raw = readers.read_comments(spark, source)
    comments = communities.select_comments(raw, ups=None)
    if limit is not None:
        comments = ranking.top_rows(comments, [F.asc("key")], limit)
    return materialise(comments, "first-comments")


def first_comment_topics(
    spark: SparkSession,
    source: str,
    output: str,
    limit: int | None = None,
    k: int = 5,
    iterations: int = 20,
) -> None:
    """Topics of each community's first comment: lemmas of its single-space tokens."""
    first = communities.first_comment(_first_comments(spark, source, limit))
    cleaned = cleaning.clean_tokens_lemma(first)
    counts = materialise(terms.term_counts(cleaned, F.col("comments")), "term-counts")
    vocab = materialise(terms.vocabulary(counts), "vocabulary")
    vectors = materialise(terms.count_vectors(counts, vocab), "vectors")
    model = topics.fit_topics(vectors, k=k, iterations=iterations)
    scored = topics.distributions(model, vectors).select(
        "id", numbers.distribution_text(F.col("topicDistribution")).alias("topicDistribution")
    )
    writers.write_csv(scored, output)


def indexed_topics(
    spark: SparkSession,
    source: str,
    limit: int | None = None,
    k: int = topics.TOPICS,
    iterations: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """Expectation-maximisation topics over numbered communities.

    Gives ``topic, term, weight`` and the number of each community. Tokens keep
    digits and underscores.
    """
    comments = _first_comments(spark, source, limit)
    index = ranking.index_by_frequency(comments.select("id").distinct()).select("id", "index")
    cleaned = cleaning.clean_tokens_lemma(comments, alpha=False)
    counts = materialise(terms.term_counts(cleaned, F.col("comments")), "term-counts")
    vocab = materialise(terms.vocabulary(counts), "vocabulary")
    numbered = counts.join(index, "id").select(F.col("index").alias("id"), "term", "n")
    vectors = materialise(terms.count_vectors(numbered, vocab), "vectors")
    model = topics.fit_topics(vectors, k=k, iterations=iterations, optimizer="em")
    return topics.topic_term_matrix(model, vocab), index


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--indexed", action="store_true", help="show the topic-term matrix instead")
    parser.add_argument("--limit", type=int, help="take so many comments, in key order")
    args = parser.parse_args()
    spark = build_session("prototypes")
    if args.indexed:
        matrix, _ = indexed_topics(spark, args.source, args.limit)
        writers.write_csv(matrix, args.output)
    else:
        first_comment_topics(spark, args.source, args.output, args.limit)


if __name__ == "__main__":
    main()
