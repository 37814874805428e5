"""Comments as JSON to token documents as parquet and three leaderboards as CSV.

    spark-submit -m forumlens.plans.community_statistics INPUT DOCUMENTS COUNTS UPS RATIOS
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens.functions import text
from forumlens.operators import cleaning, communities, leaderboards
from forumlens.plans import inputs
from forumlens.session import build_session, materialise
from forumlens.sources import readers, writers


def run(
    spark: SparkSession,
    source: str | Sequence[str],
    documents: str,
    counts: str,
    ups: str,
    ratios: str,
    partitions: int | None = None,
    lemmas: bool = False,
    dictionary: DataFrame | None = None,
    malformed: str | None = None,
) -> None:
    """The boards refuse targets that exist; the documents replace theirs.

    The documents are written first and the boards are made from their narrow
    columns, so that the comments are cleaned once. With ``malformed``, lines that are no
    comments are written there, as ``file, line``, and count nowhere.
    """
    if malformed is None:
        comments = inputs.comments(spark, source, partitions)
    else:
        records, lines = readers.read_lines_apart(spark, source, partitions=partitions)
        writers.write_parquet(lines, malformed)
        comments = materialise(communities.select_comments(records), "comments")  # parsed once more, not each time
    if lemmas:
        cleaned = cleaning.clean_tokens_lemma(comments, dictionary=dictionary)
        written = materialise(cleaned, "lemma-tokens")
        grouped = communities.community_documents(
            written, F.col("comments"), size=communities.token_chars(F.col("comments"))
        )
    else:
        grouped = communities.community_documents(comments, text.ascii_tokens(F.col("comments")))
    writers.write_parquet(grouped, documents)
    stats = communities.with_ratio(
        communities.stats_of_documents(readers.read_communities(spark, documents))
    )
    writers.write_csv(leaderboards.by_ups(stats), ups, overwrite=False)
    writers.write_csv(leaderboards.by_count(stats), counts, overwrite=False)
    writers.write_csv(leaderboards.by_ratio(stats), ratios, overwrite=False)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("source", "documents", "counts", "ups", "ratios"):
        parser.add_argument(name)
    parser.add_argument("--partitions", type=int, help="after input that cannot be split")
    parser.add_argument("--lemmas", action="store_true", help="letters of any script, lemmatised")
    parser.add_argument("--dictionary", help="text file of known nouns, one per line")
    parser.add_argument("--malformed", help="folder for lines that are no comments")
    args = parser.parse_args()
    spark = build_session("community-statistics")
    nouns = inputs.nouns(spark, args.dictionary)
    run(
        spark,
        args.source,
        args.documents,
        args.counts,
        args.ups,
        args.ratios,
        args.partitions,
        args.lemmas,
        nouns,
        args.malformed,
    )


if __name__ == "__main__":
    main()
