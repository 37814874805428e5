"""Leaderboards over community statistics, and the tables that a page shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from forumlens.functions.numbers import lurker_score, thousands
from forumlens.operators.communities import grand_totals
from forumlens.operators.ranking import top_rows

BOARD_SIZE = 100
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _descending(value: str):
    return [F.desc(value), F.asc("id")]


def by_ups(stats: DataFrame) -> DataFrame:
    return stats.select("id", "ups").orderBy(*_descending("ups"))


def by_count(stats: DataFrame) -> DataFrame:
    return stats.select("id", "comm_count").orderBy(*_descending("comm_count"))


def by_ratio(stats_with_ratio: DataFrame) -> DataFrame:
    """By comments per upvote, in numeric order."""
    return stats_with_ratio.select("id", "comm_ups_ratio").orderBy(*_descending("comm_ups_ratio"))


def positive_ratios(ratios: DataFrame) -> DataFrame:
    return ratios.filter(F.col("comm_ups_ratio") > 0)


def lurkers(ratios: DataFrame) -> DataFrame:
    """``id, lurker``: upvotes per comment, for positive ratios only."""
    return positive_ratios(ratios).select("id", lurker_score(F.col("comm_ups_ratio")).alias("lurker"))


def by_lurkers(ratios: DataFrame) -> DataFrame:
    return lurkers(ratios).orderBy(*_descending("lurker"))


def top_board(board: DataFrame, value: str, n: int = BOARD_SIZE) -> DataFrame:
    return top_rows(board, _descending(value), n)


def top_boards(stats_with_ratio: DataFrame, n: int = BOARD_SIZE) -> DataFrame:
    """``board, place, id, comm_count, ups, lurker``: the first ``n`` of each board, from 1, in one pass.

    The boards are ``comm_count``, ``ups`` and ``lurker`` (positive ratios only). The statistics are
    read once. Each task keeps its first ``n`` of every board and only these are shuffled, once, to be
    merged; Spark does so up to the size in ``GROUP_LIMIT``, and a larger ``n`` is refused
    (``top_board`` takes any). Unknown values come last, ties by id. An empty table gives no row.
    """
    most = int(stats_with_ratio.sparkSession.conf.get(GROUP_LIMIT))
    if n > most:
        raise ValueError(f"boards of at most {most} rows are merged in one pass, not {n}")
    lurker = F.when(F.col("comm_ups_ratio") > 0, lurker_score(F.col("comm_ups_ratio")))
    known = stats_with_ratio.select("id", "comm_count", "ups", lurker.alias("lurker"))
    names = F.array(F.lit("comm_count"), F.lit("ups"), F.when(F.col("lurker").isNotNull(), F.lit("lurker")))
    each = known.withColumn("board", F.explode(F.array_compact(names)))
    # whole numbers and scores are ordered by a column each, so that none loses digits
    whole = F.when(F.col("board") == "comm_count", F.col("comm_count")).when(F.col("board") == "ups", F.col("ups"))
    score = F.when(F.col("board") == "lurker", F.col("lurker"))
    order = Window.partitionBy("board").orderBy(F.desc("_whole"), F.desc("_score"), F.asc("id"))
    placed = each.withColumns({"_whole": whole, "_score": score}).withColumn("place", F.row_number().over(order))
    return placed.filter(F.col("place") <= n).select("board", "place", "id", "comm_count", "ups", "lurker")


def leader(board: DataFrame, value: str) -> DataFrame:
    """The first community of a board, as one row; unknown values come last, as on the board."""
    order = F.struct(F.col(value).isNull(), -F.col(value), F.col("id"))
    return board.agg(F.min_by("id", order).alias("id"))


def merged_board(counts: DataFrame, ups: DataFrame, lurker: DataFrame) -> DataFrame:
    """``id, comm_count, ups, lurker``; the lurker score may be missing. Null is a community."""
    joined = _same_community(counts, ups, "inner")
    return _same_community(joined, lurker, "left")


def _same_community(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    named = right.withColumnRenamed("id", "_id")
    return left.join(named, F.col("id").eqNullSafe(F.col("_id")), how).drop("_id")


def shown_ids(*boards: DataFrame) -> DataFrame:
    """Communities on at least one of the boards, each once."""
    ids = boards[0].select("id")
    for board in boards[1:]:
        ids = ids.union(board.select("id"))
    return ids.distinct()


def shown(merged: DataFrame, ids: DataFrame) -> DataFrame:
    return _same_community(merged, ids, "left_semi")


def not_shown(merged: DataFrame, ids: DataFrame) -> DataFrame:
    return _same_community(merged, ids, "left_anti")


def without_communities(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return df.filter(~F.col("id").isin(*excluded)) if excluded else df


def totals_text(stats: DataFrame) -> DataFrame:
    totals = grand_totals(stats)
    return totals.select(*[thousands(F.col(name)).alias(name) for name in totals.columns])
