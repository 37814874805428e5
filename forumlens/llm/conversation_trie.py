"""Prefix trie of conversations, with subtree totals by the Euler-tour technique.

Conversations that begin with the same turns share nodes. A node is named by the smallest
conversation that has it and its depth, so that equal prefixes meet by a fingerprint: sums, over
the turns, of hashes of place, role and text, from running sums within sorted ranges and one
offset for each range. No conversation, however long, is gathered.

Each node has an enter and an exit arc; the next arc of each makes the tour a linked list of all
arcs. The list is ranked by contraction: blocks of arcs join their chains into single items, as do
pairs by coin flips where blocks shrink little, until few items are left; offsets then return
level by level. A subtree's totals are the difference of the sums at its two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.llm.words import tidy
from forumlens.operators.lookup import lookup_join
from forumlens.session import materialise, small_side

LONGEST = 5  # turns that a conversation takes from its hundred's first one
BLOCK = 200_000  # list items that one task joins
IDS = 4_096  # conversation ids in one text of a node's ends
_PARTS = ["p0", "p1", "p2", "p3"]  # sums of 32-bit halves of two hashes, each below 2^32
_MODULUS = 1 << 32
_WEIGHTS = ["steps", "leaves", "saved"]


# -- rebuilt conversations -------------------------------------------------------------------


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from its hundred's first one."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("long")


def _turn_parts(place: Column) -> list[Column]:
    """Four 32-bit numbers of a turn at a place."""
    one, two = (F.xxhash64(F.lit(seed), place, "t1", "t2") for seed in (1, 2))
    low = F.lit(_MODULUS - 1)
    halves = (one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32))
    return [x.alias(name) for x, name in zip(halves, _PARTS, strict=True)]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, i, t1, t2, chars, range``: the turns of each conversation from 1, written.

    Turns are sorted by range over all conversations; the place within a range plus one offset
    for each range and conversation gives the number, so that a long conversation is many ranges.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    both = F.sha2(F.concat_ws("\x00", F.length(role).cast("string"), role, text), 256)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.conv(F.substring(both, 1, 15), 16, 10).cast("long").alias("t1"),
        F.conv(F.substring(both, 16, 15), 16, 10).cast("long").alias("t2"),
        F.length(text).cast("long").alias("chars"),
        both.alias("digest"),
    )
    ranged = turns.orderBy("conv_id", F.asc_nulls_first("turn"), "digest")
    ranged = ranged.drop("digest", "turn").withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    ranged = materialise(ranged, "turns")
    inside = Window.partitionBy("range", "conv_id").orderBy("at")
    local = ranged.withColumn("local", F.row_number().over(inside).cast("long"))
    return materialise(_offset(local, ["local"]).select("conv_id", F.col("local").alias("i"), "t1", "t2", "chars", "range"), "numbered")


def _offset(local: DataFrame, columns: list[str]) -> DataFrame:
    """Running values within a range and conversation, continued over the ranges before.

    Only conversations in several ranges have an offset, at most two of them in a range.
    """
    last = local.groupBy("conv_id", "range").agg(*[F.max(c).alias(c) for c in columns])
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = last.select("conv_id", "range", *[F.sum(c).over(before).alias(f"_{c}") for c in columns]).filter(f"_{columns[0]} IS NOT NULL")
    joined = local.join(small_side(materialise(ahead, "ahead")), ["conv_id", "range"], "left")
    return joined.withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in columns}).drop(*[f"_{c}" for c in columns])


def members(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, p0..p3, q0..q3, chars, is_end``: every prefix of every rebuilt conversation.

    The ``p`` are the fingerprint of the prefix, the ``q`` that of the prefix one turn shorter.
    ``chars`` are the code points of the last text. The textless prefix of each is a row too.
    """
    turns = numbered_turns(conversations)
    sizes = turns.groupBy("conv_id").agg(F.max("i").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % 100
    sizes = sizes.select("conv_id", "n", borrowed(F.col("conv_id")).alias("h"), base.alias("base"))
    of_base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    known = sizes.join(of_base, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    known = materialise(
        known.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("end")), "sizes"
    )

    # first turns of the hundred's first conversation: at most five rows each, no long sums
    heads = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("i") <= LONGEST))
    heads = heads.select(F.col("conv_id").alias("base"), F.col("i").alias("depth"), "chars", *_turn_parts(F.col("i")))
    taken = known.filter("m > 0").join(heads, "base").filter(F.col("depth") <= F.col("m"))
    run = Window.partitionBy("conv_id").orderBy("depth")
    given = taken.select(
        "conv_id", "depth", "chars", "end", *[(F.sum(p).over(run) % _MODULUS).alias(p) for p in _PARTS], *[F.col(p).alias(f"own_{p}") for p in _PARTS]
    )
    given = materialise(given, "given")
    starts = given.groupBy("conv_id").agg(*[F.max_by(p, "depth").alias(f"s_{p}") for p in _PARTS])
    whose = known.join(starts, "conv_id", "left").drop("base")

    # own turns after those: weights say how many turns a conversation has, as one may have most
    weighted = materialise(whose.withColumn("weight", F.col("end") - F.col("m") + 1).withColumnRenamed("conv_id", "whose"), "whose")
    own = lookup_join(turns, weighted, "conv_id", "whose", "weight").filter(F.col("i") > F.col("h"))
    own = own.withColumn("depth", F.col("i") - F.col("h") + F.col("m"))
    own = own.select("conv_id", "range", "depth", "chars", "end", *[f"s_{p}" for p in _PARTS], *_turn_parts(F.col("depth")))
    inside = Window.partitionBy("range", "conv_id").orderBy("depth")
    own = own.withColumns({f"own_{p}": F.col(p) for p in _PARTS} | {p: F.sum(p).over(inside) for p in _PARTS})
    own = _offset(materialise(own, "own"), _PARTS)
    own = own.withColumns({p: (F.col(p) + F.coalesce(f"s_{p}", F.lit(0))) % _MODULUS for p in _PARTS})

    both = own.select(given.columns).unionByName(given)
    before = [F.pmod(F.col(p) - F.col(f"own_{p}"), F.lit(_MODULUS)).alias(p.replace("p", "q")) for p in _PARTS]
    zero = [F.lit(0).cast("long").alias(x) for x in ("depth", "chars", *_PARTS)]
    none = [F.lit(None).cast("long").alias(p.replace("p", "q")) for p in _PARTS]
    roots = known.select("conv_id", *zero, *none, (F.col("end") == 0).alias("is_end"))
    deeper = both.select("conv_id", "depth", "chars", *_PARTS, *before, (F.col("depth") == F.col("end")).alias("is_end"))
    return materialise(roots.unionByName(deeper), "members")


# -- nodes -----------------------------------------------------------------------------------


def nodes(found: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, chars, p0..p3``, written."""
    parts = [F.first(q).alias(q) for q in ("q0", "q1", "q2", "q3")]
    alike = found.groupBy("depth", *_PARTS).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"), *parts
    )
    alike = materialise(alike, "alike")
    key = F.struct("depth", *_PARTS)
    above = F.struct((F.col("depth") - 1).alias("depth"), *[F.col(p.replace("p", "q")).alias(p) for p in _PARTS])
    born = alike.filter("depth > 0").groupBy(above.alias("above")).agg(F.count("*").alias("n_children"))
    parents = alike.select(key.alias("key"), F.col("conv_id").alias("parent_conv_id")).join(
        born.withColumnRenamed("above", "key"), "key"
    )
    parents = materialise(parents, "parents")
    counted = parents.select("key", "n_children")
    # a parent may have most nodes below it: its children find it by a join that knows its weight
    named = lookup_join(alike.withColumn("above", above), parents, "above", "key", "n_children").drop("above")
    named = named.withColumn("key", key).join(counted, "key", "left")
    return materialise(
        named.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "chars", *_PARTS), "nodes"
    )


def ends(found: DataFrame, named: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of the nodes at which conversations end.

    A node's ids are sorted by range, joined to texts of at most ``IDS`` ids, and hashed text by
    text as they come in order, so that no node's ids are ever held at once.
    """
    node = ["depth", *_PARTS]
    ids = found.filter("is_end").select(*node, "conv_id").orderBy(*node, "conv_id")
    ids = materialise(ids.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ends")
    # bounds of the chunks are places in a range, so that a chunk is in one range
    chunks = ids.groupBy(*node, "range", F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / IDS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")
    )
    keys = named.select("conv_id", *node)
    chunks = chunks.repartition(*node).sortWithinPartitions(*node, "range", "chunk")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*node, "ends_sha256"]
        schema = pa.schema([*[(c, pa.int64()) for c in node], ("ends_sha256", pa.string())])
        last, so_far = None, None
        for batch in batches:
            done = []
            keys_of = list(zip(*(batch.column(c).to_pylist() for c in node), strict=True))
            for key, text in zip(keys_of, batch.column("ids").to_pylist(), strict=True):
                if key == last:
                    so_far.update(b",")
                else:
                    if last is not None:
                        done.append((*last, so_far.hexdigest()))
                    last, so_far = key, hashlib.sha256()
                so_far.update(text.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in done], schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*last, so_far.hexdigest()), strict=True))], schema)

    hashed = chunks.select(*node, "ids").mapInArrow(tidy(digest), "depth long, p0 long, p1 long, p2 long, p3 long, ends_sha256 string")
    return keys.join(hashed, node).select("conv_id", "depth", "ends_sha256")


# -- the tour --------------------------------------------------------------------------------


# An arc is named by two numbers: its node's conversation, and twice its depth, plus 1 for the exit.
_ITEM, _NEXT, _HEAD = ["c", "e"], ["next_c", "next_e"], ["head_c", "head_e"]


def _arc(conv_id: Column, depth: Column, leaving: int) -> Column:
    return F.struct(conv_id.alias("c"), (2 * depth + leaving).alias("e"))


def tour(named: DataFrame) -> DataFrame:
    """``c, e, next_c, next_e, steps, leaves, saved``: all arcs as a linked list; the last has no next.

    Children follow each other by conv_id: all nodes are sorted by range under their parents, and
    the first node of the next range is the sibling of the last of a range.
    """
    below = named.filter("depth > 0").select("parent_conv_id", "depth", "conv_id")
    ranged = below.orderBy("parent_conv_id", "depth", "conv_id").withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged, "siblings")
    row = F.struct("parent_conv_id", "depth", "conv_id")
    firsts = ranged.groupBy("range").agg(F.min(row).alias("first"))
    firsts = firsts.select("range", F.lead("first").over(Window.orderBy("range")).alias("first"))  # a row a range
    inside = Window.partitionBy("range").orderBy("parent_conv_id", "depth", "conv_id")
    follows = ranged.join(F.broadcast(firsts), "range").withColumn("after", F.coalesce(F.lead(row).over(inside), "first"))
    is_sibling = (F.col("after.parent_conv_id") == F.col("parent_conv_id")) & (F.col("after.depth") == F.col("depth"))
    sibling = follows.select(
        "conv_id", "depth", F.when(is_sibling, F.col("after.conv_id")).alias("sibling")
    )
    eldest = below.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.min("conv_id").alias("child"))
    all_ = named.join(sibling, ["conv_id", "depth"], "left").join(eldest, ["conv_id", "depth"], "left")
    c, d = F.col("conv_id"), F.col("depth")
    after_enter = F.when(F.col("child").isNotNull(), _arc(F.col("child"), d + 1, 0)).otherwise(_arc(c, d, 1))
    after_exit = F.when(F.col("sibling").isNotNull(), _arc(F.col("sibling"), d, 0)).when(d > 0, _arc(F.col("parent_conv_id"), d - 1, 1))
    nothing = F.lit(0).cast("long")
    totals = [(F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("chars")]

    def arcs(leaving: int, after: Column, leaves: Column, saved: Column) -> DataFrame:
        made = all_.select(_arc(c, d, leaving).alias("item"), after.alias("next"), leaves.alias("leaves"), saved.alias("saved"))
        return made.select(
            "item.c", "item.e", F.col("next.c").alias("next_c"), F.col("next.e").alias("next_e"), F.lit(1).cast("long").alias("steps"), "leaves", "saved"
        )

    return materialise(arcs(0, after_enter, *totals).union(arcs(1, after_exit, nothing, nothing)), "tour")


def _chains(following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of chains given by each item's next one (-1 for none): the head of each, and the sums ahead
    of it in its chain, by pointer jumping towards the heads."""
    n = len(following)
    head, ahead = np.arange(n), np.zeros_like(weights)
    inner = following >= 0
    head[following[inner]] = np.flatnonzero(inner)
    ahead[following[inner]] = weights[inner]
    while True:
        above = head[head]
        if (above == head).all():
            return head, ahead
        ahead = ahead + np.where((above != head)[:, None], ahead[head], 0)
        head = above


_AHEAD = [f"ahead_{w}" for w in _WEIGHTS]
_LINKED = ", ".join(f"{x} long" for x in (*_ITEM, *_NEXT, *_WEIGHTS, *_HEAD, *_AHEAD))


def _by_blocks(items: DataFrame, blocks: int) -> DataFrame:
    """Each item with the head of its chain within its block, and the sums ahead of it there."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        here = pd.MultiIndex.from_frame(pdf[_ITEM])
        target = pdf[_NEXT].fillna(-1).astype(np.int64)  # no arc has -1 as its second number
        following = here.get_indexer(pd.MultiIndex.from_frame(target))
        head, ahead = _chains(following, pdf[_WEIGHTS].to_numpy(np.int64))
        made = pdf.drop(columns="block").reset_index(drop=True)
        made[_HEAD] = pdf[_ITEM].to_numpy()[head]
        made[_AHEAD] = ahead
        return made

    if blocks == 1:
        return items.withColumn("block", F.lit(0)).groupBy("block").applyInPandas(run, _LINKED)
    ranged = items.repartitionByRange(blocks, *_ITEM).withColumn("block", F.spark_partition_id())
    return materialise(ranged, "blocks").groupBy("block").applyInPandas(run, _LINKED)


def _by_coins(items: DataFrame, level: int) -> DataFrame:
    """Each item with a head: an item whose coin shows 1 hangs on the one before it, if that shows 0."""
    coin = F.pmod(F.xxhash64(*_ITEM, F.lit(level)), F.lit(2)) == 1
    tossed = items.withColumn("coin", coin)
    names = dict(zip([*_ITEM, *_NEXT, *_WEIGHTS], [*_HEAD, "to_c", "to_e", *_AHEAD], strict=True))
    heads = tossed.filter("NOT coin").select(*[F.col(a).alias(b) for a, b in names.items()])
    same = F.col("coin") & (F.col("c") == F.col("to_c")) & (F.col("e") == F.col("to_e"))
    hung = tossed.join(heads, same, "left")
    own = dict(zip([*_HEAD, *_AHEAD], [*map(F.col, _ITEM), *[F.lit(0)] * len(_AHEAD)], strict=True))
    return hung.select(*_ITEM, *_NEXT, *_WEIGHTS, *[F.coalesce(F.col(a), b).alias(a) for a, b in own.items()])


def ranked(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """``c, e, steps, leaves, saved`` of a linked list: the sums over all items ahead of each.

    ``items`` is a written table as ``tour`` makes it, and must be one list: every item but the first
    is one item's next. Each level contracts chains to their heads. In one block all of the
    list is one chain; while there are more blocks, a level that does not leave fewer than half
    as many items is followed by one of coin flips, which takes off a quarter on average.
    """
    levels, n, coins = [], items.count(), False
    while True:
        blocks = max(1, -(-n // block))
        linked = materialise(_by_coins(items, len(levels)) if coins and blocks > 1 else _by_blocks(items, blocks), "linked")
        levels.append(linked.select(*_ITEM, *_HEAD, *_AHEAD))
        if blocks == 1:
            break
        # a chain goes on where its last item does
        last = F.struct(*_NEXT, *[(F.col(w) + F.col(a)).alias(w) for w, a in zip(_WEIGHTS, _AHEAD, strict=True)])
        chains = linked.groupBy(*_HEAD).agg(F.max_by(last, "ahead_steps").alias("last"))
        items = chains.select(F.col("head_c").alias("c"), F.col("head_e").alias("e"), "last.*")
        items = materialise(items, "items")
        left = items.count()
        coins, n = not coins and 2 * left > n, left
    placed = levels.pop().select(*_ITEM, *[F.col(a).alias(w) for w, a in zip(_WEIGHTS, _AHEAD, strict=True)])
    for level in reversed(levels):
        heads = placed.withColumnsRenamed(dict(zip(_ITEM, _HEAD, strict=True)))
        sums = [(F.col(w) + F.col(a)).alias(w) for w, a in zip(_WEIGHTS, _AHEAD, strict=True)]
        placed = materialise(level.join(heads, _HEAD).select(*_ITEM, *sums), "placed")
    return placed


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are not used. Turns are in the
    order of ``turn``, null first, and of a hash of role and text where that is equal; null roles and
    texts are empty. A conversation is its hundred's first ones' turns, as many as ``borrowed``
    says, then its own turns after as many. There is a row for each distinct prefix, the textless one
    included, named by its smallest conversation and depth. Rows with a null conv_id belong to no
    conversation; repeated rows are turns each. Without any conversation there is no row.
    """
    found = members(conversations)
    named = nodes(found)
    arcs = ranked(tour(named), block)
    first, last = (F.max(F.when(F.col("e") % 2 == x, F.struct(*_WEIGHTS))) for x in (0, 1))
    sums = arcs.groupBy(F.col("c").alias("conv_id"), F.shiftright("e", 1).alias("depth")).agg(first.alias("enter"), last.alias("exit"))
    sums = sums.select(
        "conv_id",
        "depth",
        (F.col("exit.leaves") - F.col("enter.leaves")).alias("n_leaves"),
        (F.col("exit.saved") - F.col("enter.saved")).alias("saved_tokens"),
    )
    whole = named.join(sums, ["conv_id", "depth"]).join(ends(found, named), ["conv_id", "depth"], "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
