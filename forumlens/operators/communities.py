"""Grouping by community: statistics, and community documents in bounded parts.

A community may hold a third of all text, far more than fits one row. Its document
is therefore a set of rows ``(id, part, ...)``. One rule holds at every size: comments
are in key order, and a comment's part is the number of characters before it in its
community, divided by ``part_chars``. So every comment is in exactly one part, and the
parts joined in order are the whole document. Comments of one key, as those without
any, are ordered by a hash of the row between parts, by their text within a part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.functions.numbers import comments_per_up
from forumlens.operators.lookup import lookup_join
from forumlens.operators.ranking import row_in_range
from forumlens.session import BROADCAST_ROWS, materialise

# A task may hold over a hundred parts at once while it collects them.
PART_CHARS = 8_000_000


def select_comments(
    df: DataFrame,
    community: str = "subreddit",
    text: str = "body",
    ups: str | None = "ups",
    key: Sequence[str] | None = ("name", "id"),
) -> DataFrame:
    """Project and rename to ``id, comments, ups, key``; the last two are optional.

    The key is the first of the given fields that the table has and the row fills.
    """
    columns = [F.col(community).alias("id"), F.col(text).alias("comments")]
    if ups:
        columns.append(F.col(ups).alias("ups"))
    if key:
        present = [F.col(k) for k in key if k in df.columns]
        columns.append(F.coalesce(*present).alias("key"))
    return df.select(*columns)


def only_community(df: DataFrame, community: str) -> DataFrame:
    return df.where(F.col("id") == community)


def drop_empty(df: DataFrame, column: str = "comments") -> DataFrame:
    return df.filter(F.col(column) != "")


def with_parts(
    df: DataFrame,
    group: str,
    keys: Sequence[str],
    weight: Column,
    part_weight: int,
    totals: Sequence[Column] = (),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``part``: the weight before a row in its group, in key order, over ``part_weight``.

    In a group of less than ``part_weight`` that is 0 for every row, so that only larger
    groups are put in order; there are at most ``sum(weight) / part_weight`` of those. The
    given group totals, and ``_large``, come along and are null for all other groups.
    """
    large = (
        df.groupBy(F.col(group).alias("_group"))
        .agg(F.sum(weight).alias("_weight"), *totals)
        .filter(F.col("_weight") >= part_weight)
        .withColumn("_large", F.lit(True))
    )
    large = materialise(large, "large-groups")
    marked = lookup_join(df, large, group, "_group", "_weight", max_rows=max_rows)
    small = marked.filter(F.col("_large").isNull()).withColumn("part", F.lit(0).cast("long"))
    if large.isEmpty():
        return small
    return small.unionByName(
        _running_parts(marked.filter("_large"), group, keys, weight, part_weight)
    )


def _running_parts(
    df: DataFrame, group: str, keys: Sequence[str], weight: Column, part_weight: int
) -> DataFrame:
    """Rows are range-sorted and written once; parts are found on narrow columns.

    Only the first group of a range can have begun in an earlier one, so that one number
    per range carries the sums over. A part covers a run of rows of a range, and what
    goes back to the text is where the runs begin: about one step per part.
    """
    tied = df.withColumns(
        {
            "_weight": F.coalesce(weight, F.lit(0)).cast("long"),
            "_hash": F.xxhash64(*df.columns),
            "_tie": F.monotonically_increasing_id(),
        }
    )
    ranked = tied.orderBy(group, *keys, "_hash", "_tie").withColumns(
        {"_range": F.spark_partition_id(), "_row": row_in_range()}
    )
    ranked = materialise(ranked.drop("_hash", "_tie"), "ranked")
    narrow = ranked.select("_range", "_row", F.col(group).alias("_group"), "_weight")
    begun = Window.partitionBy("_group").orderBy("_range")
    bases = (
        narrow.groupBy("_range", "_group")
        .agg(F.sum("_weight").alias("_sum"))
        .withColumn("_base", F.sum("_sum").over(begun.rowsBetween(Window.unboundedPreceding, -1)))
        .filter("_base > 0")
        .select("_range", F.col("_group").alias("_first"), "_base")
    )
    run = Window.partitionBy("_range", "_group").orderBy("_row")
    own = F.sum("_weight").over(run.rowsBetween(Window.unboundedPreceding, -1))
    base = F.when(F.col("_group").eqNullSafe(F.col("_first")), F.col("_base"))
    before = F.coalesce(own, F.lit(0)) + F.coalesce(base, F.lit(0))
    last = F.lag("part").over(Window.partitionBy("_range").orderBy("_row"))
    steps = (
        narrow.repartition("_range")
        .join(F.broadcast(bases), "_range", "left")  # one row per range
        .withColumn("_before", before)
        .withColumn("part", F.expr(f"_before div {part_weight}"))
        .withColumn("_last", F.coalesce(last, F.lit(0)))
        .filter("part != _last")
        .groupBy("_range")
        .agg(F.sort_array(F.collect_list(F.struct("_row", "part"))).alias("_steps"))
    )
    steps = materialise(steps, "steps")
    many = steps.agg(F.sum(F.size("_steps"))).first()[0] or 0
    found = ranked.join(F.broadcast(steps) if many <= BROADCAST_ROWS else steps, "_range", "left")
    passed = F.filter("_steps", lambda step: step["_row"] <= F.col("_row"))
    part = F.coalesce(F.try_element_at(passed, F.lit(-1))["part"], F.lit(0)).cast("long")
    return found.withColumn("part", part).select(*df.columns, "part")


def assign_parts(
    df: DataFrame,
    size: Column | None = None,
    keys: Sequence[str] = ("key",),
    part_chars: int = PART_CHARS,
    totals: Sequence[Column] = (),
) -> DataFrame:
    """Add ``part`` to comments by the length of their text.

    Done on raw comments, before they are cleaned, it needs no cleaning to size them;
    the functions below keep the parts they are given.
    """
    chars = F.coalesce(F.length("comments") if size is None else size, F.lit(0))
    return with_parts(df, "id", keys, chars, part_chars, totals)


def token_chars(tokens: Column) -> Column:
    return F.length(F.array_join(tokens, " "))


def _collected(
    df: DataFrame,
    keys: Sequence[str],
    part_chars: int,
    size: Column | None = None,
    keep: Column | None = None,
) -> DataFrame:
    parted = df if "part" in df.columns else assign_parts(df, size, keys, part_chars)
    # A null value is left out, as collecting it alone would leave it out.
    kept = F.col("comments").isNotNull() if keep is None else keep
    value = F.when(kept, F.struct(*keys, "comments"))
    return parted.groupBy("id", "part").agg(
        F.transform(F.sort_array(F.collect_list(value)), lambda row: row["comments"]).alias(
            "comments"
        )
    )


def community_text(
    df: DataFrame,
    separator: str = " ",
    keys: Sequence[str] = ("key",),
    part_chars: int = PART_CHARS,
    drop_empty: bool = False,
) -> DataFrame:
    """Concatenate the texts of each community, in key order: ``id, part, comments``.

    ``drop_empty`` leaves out empty texts, and communities with nothing else, while
    collecting. A filter on cleaned text in front of this would be pushed below the
    cleaning and clean everything twice.
    """
    keep = F.col("comments") != "" if drop_empty else None
    collected = _collected(df, keys, part_chars, keep=keep)
    if drop_empty:
        collected = collected.filter(F.size("comments") > 0)
    return collected.withColumn("comments", F.array_join("comments", separator))


def community_token_lists(
    df: DataFrame, keys: Sequence[str] = ("key",), part_chars: int = PART_CHARS
) -> DataFrame:
    """Collect the token arrays of each community as an array of arrays."""
    return _collected(df, keys, part_chars, token_chars(F.col("comments")))


def community_tokens(
    df: DataFrame, keys: Sequence[str] = ("key",), part_chars: int = PART_CHARS
) -> DataFrame:
    """Concatenate the token arrays of each community."""
    lists = community_token_lists(df, keys, part_chars)
    return lists.withColumn("comments", F.flatten("comments"))


def first_comment(
    df: DataFrame, column: str = "comments", keys: Sequence[str] = ("key",)
) -> DataFrame:
    """Each community's first comment by key; whatever is made of it is made after this."""
    return df.groupBy("id").agg(F.min_by(column, F.struct(*keys)).alias(column))


def ups_per_community(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.sum("ups").alias("ups"))


def count_per_community(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.count("id").alias("comm_count"))


def community_stats(df: DataFrame) -> DataFrame:
    """``id, ups, comm_count`` in one pass over two narrow columns, with no text."""
    return df.groupBy("id").agg(F.sum("ups").alias("ups"), F.count("id").alias("comm_count"))


def community_documents(
    df: DataFrame,
    tokens: Column,
    keys: Sequence[str] = ("key",),
    part_chars: int = PART_CHARS,
    size: Column | None = None,
) -> DataFrame:
    """``id, part, comments, ups, comm_count``: all tokens with the community's totals.

    Parts are sized by the raw text, so that the tokens are only made once. The
    totals of a community in one part are those of its only part; the totals of
    the larger ones come with their lookup.
    """
    parted = assign_parts(
        df.select("id", *keys, "comments", "ups"),
        size,
        keys,
        part_chars,
        [F.sum("ups").alias("_total_ups"), F.count("id").alias("_total_count")],
    )
    ordered = F.sort_array(F.collect_list(F.struct(*keys, "_tokens")))
    grouped = parted.withColumn("_tokens", tokens).groupBy("id", "part").agg(
        F.flatten(F.transform(ordered, lambda row: row["_tokens"])).alias("comments"),
        F.sum("ups").alias("_part_ups"),
        F.count("id").alias("_part_count"),
        F.first("_large").alias("_large"),
        F.first("_total_ups").alias("_total_ups"),
        F.first("_total_count").alias("_total_count"),
    )

    def total(name: str) -> Column:
        own = F.col(f"_part_{name}")
        return F.when(F.col("_large").isNull(), own).otherwise(F.col(f"_total_{name}"))

    return grouped.select(
        "id", "part", "comments", total("ups").alias("ups"), total("count").alias("comm_count")
    )


def stats_of_documents(documents: DataFrame) -> DataFrame:
    """The statistics carried by community documents, once per community.

    Every part carries the community's totals, so any one of them will do.
    """
    return documents.groupBy("id").agg(
        F.first("ups").alias("ups"), F.first("comm_count").alias("comm_count")
    )


def with_ratio(stats: DataFrame) -> DataFrame:
    return stats.withColumn(
        "comm_ups_ratio", comments_per_up(F.col("comm_count"), F.col("ups"))
    )


def grand_totals(stats: DataFrame) -> DataFrame:
    """Number of comments and of communities."""
    return stats.agg(
        F.sum("comm_count").alias("total_comments"), F.count("*").alias("total_communities")
    )
