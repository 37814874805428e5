"""What the jobs read first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from forumlens.operators.communities import select_comments
from forumlens.session import materialise
from forumlens.sources.readers import read_comments


def comments(
    spark: SparkSession,
    source: str | Sequence[str],
    partitions: int | None = None,
    ups: str | None = "ups",
) -> DataFrame:
    """``id, comments, ups, key`` of JSON comments, which jobs read more than once.

    Input that cannot be split is parsed and spread once and written; other input is
    read again where it is needed.
    """
    narrow = select_comments(read_comments(spark, source, partitions), ups=ups)
    return materialise(narrow, "comments") if partitions else narrow


def nouns(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A dictionary table from a text file with one noun per line."""
    return spark.read.text(path).toDF("word") if path else None
