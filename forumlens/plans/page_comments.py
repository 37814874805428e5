"""Page comments as CSV: union, sample and clean; written as CSV.

    spark-submit -m forumlens.plans.page_comments OUTPUT PAGE [PAGE ...]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens.operators import cleaning, communities, ranking
from forumlens.plans import inputs
from forumlens.session import build_session, materialise
from forumlens.sources import readers, writers

SAMPLE_ROWS = 10_000
SAMPLE_SEED = 10


def run(
    spark: SparkSession,
    pages: Sequence[str],
    output: str,
    rows: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
    dictionary: DataFrame | None = None,
) -> None:
    """Comments have no key; the sample depends on what they say, not on files, order or splits."""
    comments = readers.read_pages(spark, pages).filter(F.col("comment_message").isNotNull())
    comments = materialise(comments, "page-comments")  # multi-line CSV is parsed once
    sample = materialise(ranking.content_sample(comments, rows, seed), "sample")
    cleaned = cleaning.clean_page(sample, dictionary=dictionary)
    kept = communities.drop_empty(cleaned, "comment_message")
    writers.write_csv(kept.select("comment_message"), output)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("output")
    parser.add_argument("pages", nargs="+")
    parser.add_argument("--rows", type=int, default=SAMPLE_ROWS)
    parser.add_argument("--seed", type=int, default=SAMPLE_SEED)
    parser.add_argument("--dictionary", help="text file of known nouns, one per line")
    args = parser.parse_args()
    spark = build_session("page-comments")
    nouns = inputs.nouns(spark, args.dictionary)
    run(spark, args.pages, args.output, args.rows, args.seed, nouns)


if __name__ == "__main__":
    main()
