"""Left joins to a table with one row per key, when some keys may be very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from forumlens.session import BROADCAST_ROWS


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    key: str,
    weight: str,
    needed: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    *,
    count: int | None = None,
) -> DataFrame:
    """``rows`` left-joined, null-safe, to the ``needed`` rows of ``table``, without its weight.

    ``table`` is a written table that holds the weight of every key that may be
    frequent. If its needed rows are counted to be at most ``max_rows``, they are
    broadcast. Beyond that the keys that carry at least ``1 / max_rows`` of the
    whole weight are, and there cannot be more than ``max_rows`` of those. Only the
    other keys are joined by shuffle, however few bytes their file has, and none of them is frequent enough to matter.
    ``count`` is the number of the needed rows, where it is known.
    """
    useful = table if needed is None else table.filter(needed)
    if (useful.count() if count is None else count) <= max_rows:
        return _left(rows, F.broadcast(useful.drop(weight)), on, key).drop(key)
    total = table.agg(F.sum(weight)).first()[0]
    is_frequent = F.col(weight) * max_rows >= total
    frequent = table.filter(is_frequent).select(F.col(key).alias("_frequent")).withColumn(
        "_is_frequent", F.lit(True)
    )
    marked = _left(rows, F.broadcast(frequent), on, "_frequent").drop("_frequent")
    hot = marked.filter("_is_frequent").drop("_is_frequent")
    cold = marked.filter(F.col("_is_frequent").isNull()).drop("_is_frequent")
    return (
        _left(hot, F.broadcast(useful.filter(is_frequent).drop(weight)), on, key)
        .unionByName(_left(cold, useful.filter(~is_frequent).drop(weight).hint("merge"), on, key))
        .drop(key)
    )


def _left(rows: DataFrame, table: DataFrame, on: str, key: str) -> DataFrame:
    return rows.join(table, F.col(on).eqNullSafe(F.col(key)), "left")
