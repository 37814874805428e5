"""Contiguous shards of equal texts with the least possible largest shard.

Groups of equal texts are ordered by a hash of the text. The smallest capacity at which a
greedy cut into so many shards succeeds is found by binary search, and there the groups are
cut. The driver never holds all groups: it holds sums over ranges of the hash, and asks for a
finer division only of those ranges in which some cut may still fall.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.operators.ranking import with_position
from forumlens.session import materialise

SHARDS = 16
FIRST_BITS = 12  # the first division has 4,096 ranges
MORE_BITS = 6  # each range that matters is then divided by 64


def hashed(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _greedy(ends: list[int], capacity: int, shards: int | None) -> list[int] | None:
    """Range boundaries of a greedy cut by running totals; None if there are too many shards."""
    cuts, start, at = [], 0, 0
    while at < len(ends):
        after = bisect_right(ends, start + capacity, at)
        if after == at:
            return None  # a single range exceeds the capacity
        start, at = ends[after - 1], after
        cuts.append(at)
        if shards is not None and len(cuts) > shards:
            return None
    return cuts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity at which the greedy cut needs at most ``shards``."""
    ends, total = [], 0
    for size in sizes:
        total += size
        ends.append(total)
    low, high = max([0, -(-total // shards), *sizes]), total
    while low < high:
        middle = (low + high) // 2
        if _greedy(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def cuts(groups: DataFrame, shards: int = SHARDS) -> list[int]:
    """The first hash of each shard but the first, from a written table ``hash, size``.

    ``groups`` has a row for each hash. At most ``2 ** FIRST_BITS`` rows come to the driver at
    first, and then ``2 ** MORE_BITS`` for each of a few ranges around each cut.
    """
    place = F.shiftright("hash", 64 - FIRST_BITS).alias("place")
    found = groups.groupBy(place).agg(F.sum("size"), F.max("size"), F.count("*"), F.min("hash"))
    # [low, high) of the hash, with its total, its largest group, its number of groups
    ranges = sorted(
        (r[0] << 64 - FIRST_BITS, r[0] + 1 << 64 - FIRST_BITS, r[1], r[2], r[3], r[4]) for r in found.collect()
    )
    while True:
        sizes = [r[2] for r in ranges]
        if not sizes:
            return []
        high = smallest_capacity(sizes, shards)  # feasible also for the groups
        low = max(-(-sum(sizes) // shards), max(r[3] for r in ranges))
        least = _least_positions(ranges, low)
        open_ = _open_ranges(ranges, least, high, shards)
        if not open_:
            break
        ranges = sorted([r for k, r in enumerate(ranges) if k not in open_] + _divided(groups, [ranges[k] for k in open_]))
    capacity = smallest_capacity(sizes, shards)
    ends, total = [], 0
    for size in sizes:
        total += size
        ends.append(total)
    return [ranges[k][5] for k in _greedy(ends, capacity, shards)[:-1]]


def _least_positions(ranges: list[tuple], capacity: int) -> list[int]:
    """A lower bound of each greedy cut's running total at any capacity from this one on.

    A shard that begins at ``s`` ends at or after the last range end up to ``s + capacity``, and
    as it is cut before a group that does not fit, after ``s + capacity - largest`` there.
    """
    ends, total = [], 0
    for r in ranges:
        total += r[2]
        ends.append(total)
    found, start = [], 0
    while start < total:
        k = bisect_right(ends, start + capacity)
        if k == len(ends):
            break
        start = max(ends[k - 1] if k else 0, start + capacity - ranges[k][3] + 1)
        found.append(start)
    return found


def _open_ranges(ranges: list[tuple], least: list[int], high: int, shards: int) -> set[int]:
    """Ranges of several groups in which a cut at a capacity up to ``high`` may fall."""
    open_, begin = set(), 0
    bounds = [(x, (j + 1) * high) for j, x in enumerate(least[:shards])]
    for k, r in enumerate(ranges):
        end = begin + r[2]
        if r[4] > 1 and any(x < end and begin < y for x, y in bounds):
            open_.add(k)
        begin = end
    return open_


def _divided(groups: DataFrame, ranges: list[tuple]) -> list[tuple]:
    """The ranges' parts, by one pass over the groups."""
    out: list[tuple] = []
    by_bits: dict[int, list[tuple]] = {}
    for r in ranges:
        by_bits.setdefault((r[1] - r[0]).bit_length() - 1, []).append(r)
    for bits, same in by_bits.items():
        shift = max(0, bits - MORE_BITS)
        wanted = [r[0] >> bits for r in same]
        part = groups.filter(F.shiftright("hash", bits).isin(wanted)).groupBy(F.shiftright("hash", shift).alias("place"))
        for r in part.agg(F.sum("size"), F.max("size"), F.count("*"), F.min("hash")).collect():
            out.append((r[0] << shift, r[0] + 1 << shift, r[1], r[2], r[3], r[4]))
    return out


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, hash``: UTF-8 bytes plus 1; a null text counts as empty."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    return documents.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        hashed(F.col("text")).alias("hash"),
    )


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, hash, shard, slot`` of each row of ``documents``.

    Equal texts (null as empty) have one shard. Within a shard rows are in the order of hash,
    doc_id (null last) and size, and ``slot`` is the place from 0. With fewer groups than shards
    the last shards stay empty. Equal rows keep a slot each. An empty table gives no row.
    """
    rows = materialise(sized(documents), "sized")
    groups = materialise(rows.groupBy("hash").agg(F.sum("size").alias("size")), "groups")
    firsts = cuts(groups, shards)
    number = F.lit(0)
    for first in firsts:  # fewer than shards
        number = number + (F.col("hash") >= F.lit(first)).cast("int")
    order = [F.asc("hash"), F.asc_nulls_last("doc_id"), F.asc("size")]
    placed = with_position(rows, order).withColumn("shard", number)
    counts = rows.groupBy(number.alias("shard")).agg(F.count("*").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return placed.join(F.broadcast(begins), "shard").select(  # a row a shard
        "doc_id", "size", "text_crc32", "hash", "shard", (F.col("position") - F.col("begin")).alias("slot")
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all columns of ``documents`` to one folder a shard, ``shard=0`` and so on.

    A column ``shard`` (in any case) would meet the folders' names when they are read: that is refused.
    An empty table writes no folder of a shard. Null texts count as empty; repeated rows are all written.
    """
    if "shard" in [c.lower() for c in documents.columns]:
        raise ValueError("documents have a column named shard")
    groups = materialise(sized(documents).groupBy("hash").agg(F.sum("size").alias("size")), "groups")
    number = F.lit(0)
    for first in cuts(groups, shards):
        number = number + (hashed(F.col("text")) >= F.lit(first)).cast("int")
    documents.withColumn("shard", number).write.partitionBy("shard").parquet(path)
