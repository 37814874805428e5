"""Positions, top rows and samples that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.session import materialise, small_side

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits
OCCURRENCES = 10_000  # of a repeated row that are numbered at once
SAMPLE_BUCKET_DIGITS = 5  # hexadecimal digits: about a million buckets


def row_in_range() -> Column:
    """Number of a row within its task, from 0."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number all rows from 0 in the given order, which must be total.

    Rows are range-sorted and written once, which fixes the ranges; the offset of
    each range is a running sum over one count per range.
    """
    ranked = df.orderBy(*order).withColumns({"_range": F.spark_partition_id(), "_row": row_in_range()})
    ranked = materialise(ranked, "ranked")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_range")
        .agg(F.count("*").alias("_count"))
        .select("_range", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranked.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_range", "_row", "_offset")
    )


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows; for small ``n``, as each task hands on ``n`` rows at most."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 10) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same ones for the same seed and keys.

    The sample is the ``n`` rows whose seeded key hash is smallest. A histogram of
    the hash gives the bucket in which the n-th falls, so that only about ``n``
    rows are ever sorted.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    hashed = df.withColumn("_hash", F.md5(text)).withColumn(
        "_bucket", F.substring("_hash", 1, SAMPLE_BUCKET_DIGITS)
    )
    histogram = hashed.groupBy("_bucket").agg(F.count("*").alias("_count"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        histogram.withColumn("_before", F.coalesce(F.sum("_count").over(running), F.lit(0)))
        .filter(F.col("_before") < n)
        .agg(F.max("_bucket").alias("_cut"))
    )
    return (
        hashed.filter(F.col("_bucket") <= needed.scalar())
        .orderBy("_hash", *keys)
        .limit(n)
        .drop("_hash", "_bucket")
    )


def content_sample(df: DataFrame, n: int, seed: int = 10) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) of a table without a key, whatever its order or splits.

    A row's key is a digest of its columns, and equal rows are told apart by an occurrence number:
    they are alike, so that only how many of them are taken matters. Digests are counted before
    they are shuffled, each occurrence has a seeded hash, and the ``n`` smallest are found by
    merging each task's smallest. Rows come back by a join with these digests, ``n`` at most.
    """
    content = F.md5(F.concat_ws("|", *[F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-")) for c in df.columns]))
    keyed = df.withColumn("_content", content)
    counts = keyed.groupBy("_content").agg(F.count("*").alias("_count"))
    # two steps, so that no array is long however often a row is repeated
    blocks = counts.withColumn("_first", F.explode(F.sequence(F.lit(1), F.col("_count"), F.lit(OCCURRENCES))))
    last = F.least(F.col("_count"), F.col("_first") + OCCURRENCES - 1)
    each = blocks.select("_content", F.explode(F.sequence("_first", last)).alias("_occurrence"))
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), "_content", F.col("_occurrence").cast("string")))
    smallest = each.orderBy(hashed, "_content", "_occurrence").limit(n)
    taken = materialise(smallest.groupBy("_content").agg(F.count("*").alias("_taken")), "taken")
    rows = keyed.join(small_side(taken), "_content").dropDuplicates(["_content"])
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_taken")))).select(*df.columns)


def index_by_frequency(df: DataFrame, column: str = "id", name: str = "index") -> DataFrame:
    """``column, n, index``: 0 for the most frequent value, ties in alphabetical order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return with_position(counts, [F.desc("n"), F.asc(column)], name)
