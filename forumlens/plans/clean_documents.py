"""Comments as JSON to one cleaned text per community, as CSV.

    spark-submit -m forumlens.plans.clean_documents INPUT OUTPUT
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from forumlens.operators import cleaning, communities
from forumlens.plans import inputs
from forumlens.session import build_session
from forumlens.sources import writers


def run(
    spark: SparkSession,
    source: str | Sequence[str],
    output: str,
    partitions: int | None = None,
    dictionary: DataFrame | None = None,
) -> None:
    parted = communities.assign_parts(inputs.comments(spark, source, partitions, ups=None))
    cleaned = cleaning.clean_text(parted, dictionary=dictionary)
    texts = communities.community_text(cleaned, drop_empty=True)
    writers.write_csv(texts.select("id", "comments", "part"), output)


def main() -> None:
    args = _arguments().parse_args()
    spark = build_session("clean-documents")
    nouns = inputs.nouns(spark, args.dictionary)
    run(spark, args.source, args.output, args.partitions, nouns)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--partitions", type=int, help="after input that cannot be split")
    parser.add_argument("--dictionary", help="text file of known nouns, one per line")
    return parser


if __name__ == "__main__":
    main()
