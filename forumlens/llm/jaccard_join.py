"""Exact Jaccard self-join of documents by the sets of their five-word shingles.

Two documents link when ``100 * |A and B| >= 75 * |A or B|``. The method is a partition of the
universe: level ``k`` hashes every shingle into ``segment_count(k)`` segments, and documents of
``2**k`` to ``2**(k+1) - 1`` shingles, as well as smaller ones that can still link with these,
index the subset of their shingles in each segment. Linked sets of ``l`` and ``L`` shingles
differ in ``(l + L) // 7`` at most, so that they agree on all segments but so many.

The allocation follows the measured cost of the keys. Empty segments and keys that more than
``BUCKET`` different sets share cost too much and count nothing. A document that has enough
other segments (more than it can differ in) is complete. The rest, called poor, can only miss
links among themselves: their segments with two or more shingles also index all subsets with
one shingle less, which makes each count two. Those for which even that is not enough take each
shingle as a segment, and compare the rarest ones, except inside a component already found.
In a key that many poor sets share each is compared to the least one, so that a group of near
copies becomes one component without its pairs. A pair of complete sets is a candidate only if it
shares as many keys as linked sets must. Every candidate is verified on whole sets.

Equal sets are one class from the start; links are found between classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from forumlens.llm.components import components
from forumlens.llm.words import mix, row_shingles, small_batches, tidy
from forumlens.operators.lookup import lookup_join
from forumlens.session import materialise

BUCKET = 16  # sets with one key of which all pairs are candidates
SLACK = 1.1  # segments per difference to tell apart
GROUP = 1 << 20  # keys that one group is meant to hold
FLUSH = 1 << 20  # keys that a task gathers before it hands them on
MASK_BITS = 24  # of the mask of wanted documents, 2 MB whatever the input
_ID_BITS, _KEY_BITS = 39, 40
_U = np.uint64


def segment_count(level: int) -> int:
    most = (2 * ((2 << level) - 1)) // 7
    return ceil(SLACK * (most + 1))


def levels_of(n: int) -> list[tuple[int, int]]:
    """``(level, most differences)`` at which a set of ``n`` shingles may link with others."""
    own, largest = n.bit_length() - 1, 4 * n // 3
    found = [(own, (n + min(largest, (2 << own) - 1)) // 7)]
    return found + [(own + 1, (n + largest) // 7)] if largest >= 2 << own else found


def segments(tokens: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filled segments, where each begins among the ascending tokens, and the sums of tokens."""
    segment = ((tokens >> _U(32)) * _U(segment_count(level))) >> _U(32)
    begins = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    return segment[begins], begins, np.add.reduceat(tokens, begins)


def _keys(segment: np.ndarray, sums: np.ndarray, level: int) -> np.ndarray:
    return mix(sums + mix(segment * _U(128) + _U(level)))


def subset_keys(tokens: np.ndarray, level: int) -> np.ndarray:
    """A key for the subset in each filled segment."""
    segment, _, sums = segments(tokens, level)
    return _keys(segment, sums, level)


def neighbour_keys(tokens: np.ndarray, level: int) -> np.ndarray:
    """``subset_keys``, and those of the subsets with one shingle less where two remain or one."""
    segment, begins, sums = segments(tokens, level)
    size = np.diff(np.append(begins, len(tokens)))
    at = np.repeat(np.arange(len(begins)), size)
    several = size[at] > 1
    less = _keys(segment[at[several]], sums[at[several]] - tokens[several], level)
    return np.concatenate([_keys(segment, sums, level), less])


def class_hashes(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        return int(tokens.sum().view(np.int64)), int(mix(tokens ^ _U(0x5BF03635)).sum().view(np.int64))


def _short(h1: np.ndarray) -> np.ndarray:
    return mix(h1.astype(np.int64).view(_U)) >> _U(64 - _ID_BITS)


def short_id(h1: int) -> int:
    return int(_short(np.array([h1]))[0])


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return row_shingles(batch.column("text"))


def document_sets(documents: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, n, id`` of each document, and by role how many of its segments are filled
    and the ``most`` differences it may have. Role 0 is its own level, 1 the next one (null if it
    cannot link there). ``n`` is 0 for an empty set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_summary(t) for t in _sets(batch)]
            columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    names = ["doc_id", *_CLASS]
    return documents.select("doc_id", "text").mapInArrow(tidy(run), ", ".join(f"{x} long" for x in names))


def _summary(tokens: np.ndarray) -> tuple:
    if not len(tokens):
        return None, None, 0, *[None] * 5
    h1, h2 = class_hashes(tokens)
    levels = levels_of(len(tokens))
    filled = [len(segments(tokens, level)[0]) for level, _ in levels]
    most = [m for _, m in levels]
    return h1, h2, len(tokens), short_id(h1), *(filled + [None])[:2], *(most + [None])[:2]


_CLASS = ["h1", "h2", "n", "id", "filled0", "filled1", "most0", "most1"]


class _Sender:
    """Gathers keys and hands them on as packed bytes, one row a group."""

    def __init__(self, groups: int):
        self.groups, self.keys, self.ids, self.held = groups, [], [], 0

    def add(self, keys: np.ndarray, id_: int) -> None:
        self.keys.append(keys)
        self.ids.append(np.full(len(keys), id_, _U))
        self.held += len(keys)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        keys, ids = np.concatenate(self.keys), np.concatenate(self.ids)
        self.keys, self.ids, self.held = [], [], 0
        group = (((keys >> _U(32)) * _U(self.groups)) >> _U(32)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, packed = group[order], _packed(keys[order], ids[order])
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        ends = np.append(begins[1:], len(group))
        for a in range(0, len(begins), 4096):
            some = slice(a, a + 4096)
            parts = [packed[x:y].tobytes() for x, y in zip(begins[some], ends[some], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[begins[some]]), pa.array(parts, pa.binary())], ["group", "packed"]
            )


def _packed(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Five bytes of the key and five of the id with its role."""
    both = np.empty((len(keys), 10), np.uint8)
    both[:, :5] = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    both[:, 5:] = ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return both


def _unpacked(parts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 10)
    wide = np.zeros((2, len(both), 8), np.uint8)
    wide[0, :, :5], wide[1, :, :5] = both[:, :5], both[:, 5:]
    return wide[0].reshape(-1).view("<u8"), wide[1].reshape(-1).view("<u8")


def _send(groups: int, keys_of: Callable[[np.ndarray, int], np.ndarray], sets_of) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, seen = _Sender(groups), set()
        for batch in batches:
            for tokens in sets_of(batch):
                if not len(tokens) or (known := class_hashes(tokens)) in seen:
                    continue
                seen.add(known)
                id_ = short_id(known[0])
                for role, (level, _) in enumerate(levels_of(len(tokens))):
                    sender.add(keys_of(tokens, level), id_ << 1 | role)
                if sender.held >= FLUSH:
                    yield from sender.flush()
        yield from sender.flush()

    return run


def _shared(parts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and ids, without repeats, of keys that several ids have, and where each key begins."""
    keys, ids = _unpacked(parts)
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    same = keys[1:] == keys[:-1]
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    keys, ids = keys[several], ids[several]
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])])[: len(keys)]
    keys, ids = keys[fresh], ids[fresh]
    return keys, ids, np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])


_FOUND = "a long, b long, roles int, n long"


def _candidates(pdf: pd.DataFrame, hubs: bool) -> pd.DataFrame:
    """Pairs ``a, b`` of ids with their roles and the number of keys they share; and, with ``b`` =
    -1, for each id and role the number of its keys that too many ids have.

    Two ids in role 1 share no pair: they are of one size band, and meet in role 0 as well.
    """
    keys, ids, begins = _shared(pdf["packed"])
    size = np.diff(np.append(begins, len(keys)))
    pairs = [np.zeros((0, 2), _U)]
    for n in np.unique(size[(size > 1) & (size <= BUCKET)]):
        rows = ids[begins[size == n][:, None] + np.arange(n)]
        x, y = np.triu_indices(n, 1)
        pairs.append(np.stack([rows[:, x].ravel(), rows[:, y].ravel()], 1))
    member = np.repeat(size > BUCKET, size)
    if hubs:
        least = np.repeat(ids[begins], size)[member]
        pairs.append(np.stack([least, ids[member]], 1))
    a, b = np.sort(np.concatenate(pairs), 1).T
    kept = ((a & b & _U(1)) == 0) & (a >> _U(1) != b >> _U(1))
    a, b = a[kept], b[kept]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)])
    count, a, b = np.diff(np.append(begin, len(a))), a[begin], b[begin]
    held, heavy = np.unique(ids[member], return_counts=True)
    return pd.DataFrame(
        {
            "a": np.concatenate([a >> _U(1), held >> _U(1)]).astype(np.int64),
            "b": np.concatenate([(b >> _U(1)).astype(np.int64), np.full(len(held), -1)]),
            "roles": np.concatenate([(a & _U(1)) | (b & _U(1)) << _U(1), held & _U(1)]).astype(np.int32),
            "n": np.concatenate([count, heavy]).astype(np.int64),
        }
    )


def _groups(keys: float) -> int:
    return max(16, ceil(keys / GROUP))


def _mask(ids: DataFrame, column: str) -> np.ndarray:
    """A bit for each hash that one of the ids has: of fixed size, whatever their number."""
    h = F.pmod(F.xxhash64(column), F.lit(1 << MASK_BITS))
    words = ids.select((F.shiftright(h, 5)).alias("word"), h.bitwiseAND(F.lit(31)).alias("bit")).distinct()
    words = words.groupBy("word").agg(F.sum(F.expr("shiftleft(1L, int(bit))")).alias("bits"))
    found = words.toPandas()  # at most 2 ** MASK_BITS / 32 rows
    mask = np.zeros(1 << (MASK_BITS - 5), np.uint32)
    mask[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return mask


def wanted_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, h1, h2, n, tokens`` of the classes ``wanted`` (with ``doc_id`` of a member each).

    The mask keeps most other documents from being cut into shingles and moved.
    """
    spark = documents.sparkSession
    mask = spark.sparkContext.broadcast(_mask(wanted, "doc_id"))
    hashed = documents.select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << MASK_BITS)).alias("h")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            kept = batch.filter(pa.array((mask.value[h >> 5] >> (h & 31).astype(np.uint32)) & 1 == 1))
            for first in range(0, kept.num_rows, 200):
                some = kept.slice(first, 200)
                sets = list(_sets(some))
                hashes = [class_hashes(t) if len(t) else (0, 0) for t in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        pa.array([x for x, _ in hashes], pa.int64()),
                        pa.array([y for _, y in hashes], pa.int64()),
                        pa.array([t.tobytes() for t in sets], pa.binary()),
                    ],
                    ["doc_id", "h1", "h2", "tokens"],
                )

    made = hashed.mapInArrow(tidy(run), "doc_id long, h1 long, h2 long, tokens binary").alias("m")
    asked = wanted.select("id", "n", *[F.col(c).alias(f"w_{c}") for c in ("doc_id", "h1", "h2")])
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"w_{c}")) for c in ("doc_id", "h1", "h2")]
    # one row a class also where a document id is repeated
    return made.join(asked, same).groupBy("id", "h1", "h2", "n").agg(
        F.first("tokens").alias("tokens")
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links ``a, b`` (``h1`` of two classes) among candidate pairs of short ids."""
    columns = ["id", "h1", "n", "tokens"]
    left = sets.select(*[F.col(c).alias(f"{c}_a") for c in columns])
    right = sets.select(*[F.col(c).alias(f"{c}_b") for c in columns])
    near = 3 * F.greatest("n_a", "n_b") <= 4 * F.least("n_a", "n_b")
    both = pairs.join(left.withColumnRenamed("id_a", "a"), "a").join(
        right.withColumnRenamed("id_b", "b"), "b"
    ).filter(near & (F.col("h1_a") != F.col("h1_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b"), strict=True):
                s, t = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                shared = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * shared >= 75 * (len(s) + len(t) - shared))
            yield batch.select(["h1_a", "h1_b"]).filter(pa.array(keep, pa.bool_()))

    linked = both.select("h1_a", "h1_b", "tokens_a", "tokens_b").mapInArrow(
        tidy(run), "h1_a long, h1_b long"
    )
    return linked.select(
        F.least("h1_a", "h1_b").alias("a"), F.greatest("h1_a", "h1_b").alias("b")
    ).distinct()


def _packed_sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return (np.frombuffer(x.as_buffer(), _U) for x in batch.column("tokens"))


def _twice_filled(sets: DataFrame) -> DataFrame:
    """``id, filled0, filled1``: what segments count for that also index one shingle less."""

    def weight(tokens: np.ndarray, level: int) -> int:
        size = np.diff(np.append(segments(tokens, level)[1], len(tokens)))
        return int(np.minimum(size, 2).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[weight(t, level) for level, _ in levels_of(len(t))] for t in _packed_sets(batch)]
            columns = [pa.array([(x + [None])[k] for x in counts], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "filled0", "filled1"])

    return sets.select("id", "tokens").mapInArrow(tidy(run), "id long, filled0 long, filled1 long")


def _collisions(sent: DataFrame, hubs: bool) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _candidates(pdf, hubs)

    return materialise(sent.groupBy("group").applyInPandas(run, _FOUND), "candidates")


def _light(classes: DataFrame, found: DataFrame, cost: int) -> DataFrame:
    """``id, n, most0, most1, light0, light1``: filled segments without ``cost`` a heavy key."""
    heavy = found.filter("b < 0").groupBy(F.col("a").alias("id")).agg(
        *[F.sum(F.when(F.col("roles") == k, F.col("n"))).alias(f"heavy{k}") for k in (0, 1)]
    )
    light = [
        (F.col(f"filled{k}") - cost * F.coalesce(f"heavy{k}", F.lit(0))).alias(f"light{k}") for k in (0, 1)
    ]
    return classes.join(heavy, "id", "left").select("id", "n", "most0", "most1", *light)


def _incomplete(light: DataFrame) -> DataFrame:
    """Ids whose segments count for too little to be sure of a match."""
    return light.filter("light0 <= most0 OR light1 <= most1").select("id").distinct()


def _with_end(pairs: DataFrame, light: DataFrame, end: str) -> DataFrame:
    role = F.col("roles").bitwiseAND(F.lit(1)) if end == "a" else F.shiftright("roles", 1)
    weight = F.when(role == 0, F.col("light0")).otherwise(F.col("light1")).alias(f"light_{end}")
    own = light.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), "light0", "light1")
    return pairs.join(own, end).select(*pairs.columns, f"n_{end}", weight)


def _pairs(found: DataFrame, light: DataFrame, counted: bool) -> DataFrame:
    """Pairs of fitting sizes with a complete end; if ``counted``, that share the keys which linked sets must.

    Sets that differ in ``d`` shingles at most agree on all light segments of each but ``d``.
    Pairs without a complete end are found by what is done with the incomplete sets later.
    """
    shared = found.filter("b >= 0").groupBy("a", "b", "roles").agg(F.sum("n").alias("shared"))
    complete = light.join(_incomplete(light), "id", "left_anti")
    pairs = _with_end(_with_end(shared, complete, "a"), light, "b").unionByName(
        _with_end(_with_end(shared, complete, "b"), light, "a")
    )
    near = 3 * F.greatest("n_a", "n_b") <= 4 * F.least("n_a", "n_b")
    apart = F.floor((F.col("n_a") + F.col("n_b")) / 7)
    needed = F.greatest("light_a", "light_b") - apart if counted else F.lit(1)
    return pairs.filter(near & (F.col("shared") >= needed)).select("a", "b").distinct()


def _rarest(sets: DataFrame) -> DataFrame:
    """``key, h1, id, n, rank``: each shingle a segment by itself, and of a set of ``n`` the rarest.

    Linked sets share ``ceil(0.75 * n)`` shingles of each at least; so they share one of the first
    ``n - ceil(0.75 * n) + 1`` of both in any order that is the same for all, as from rare to frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, ids = batch.column("h1").to_pylist(), batch.column("id").to_pylist()
            for tokens, id_, h in zip(_packed_sets(batch), ids, h1, strict=True):
                same = (np.full(len(tokens), x) for x in (h, id_, len(tokens)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (tokens.view(np.int64), *same)], ["key", "h1", "id", "n"]
                )

    made = sets.select("h1", "id", "tokens").mapInArrow(tidy(run), "key long, h1 long, id long, n long")
    tokens = materialise(made, "tokens")
    cost = tokens.groupBy("key").agg(F.count("*").alias("cost"))
    rank = F.row_number().over(Window.partitionBy("id", "h1").orderBy("cost", "key"))
    first = tokens.join(cost, "key").withColumn("rank", rank)
    return materialise(first.filter("rank <= n - ceil(0.75 * n) + 1 AND cost > 1").drop("cost"), "keys")


def _across(keys: DataFrame, sets: DataFrame, links: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``links`` and all others between sets that share a key, but for links within components,
    and the ``roots`` of them all, from those of ``links``.

    First one set in each key, one that has it early, is compared to the sets of other
    components there: near copies choose the same few sets, and mostly are one component then.
    All pairs that are left are compared.
    """
    if keys.isEmpty():
        return links, roots
    for hubs in (True, False):
        rooted = keys.join(roots.withColumnRenamed("node", "h1"), "h1", "left")
        rooted = materialise(rooted.withColumn("root", F.coalesce("root", "h1")).drop("h1"), "rooted")
        hub = F.min_by(F.struct("id", "n", "root", "rank"), F.struct(F.col("rank") / F.col("n"), F.xxhash64("id")))
        ends = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), hub.alias("hub"))
        open_ = ends.filter("lo < hi").select("key", "hub.*") if hubs else rooted.join(ends.filter("lo < hi"), "key", "left_semi")
        one = open_.select("key", F.col("id").alias("a"), F.col("root").alias("own"), F.col("n").alias("n_a"), F.col("rank").alias("rank_a"))
        left = 1 + F.least(F.col("n_a") - F.col("rank_a"), F.col("n") - F.col("rank"))
        fits = (F.col("own") != F.col("root")) & (175 * left >= 75 * (F.col("n_a") + F.col("n")))
        pairs = one.join(rooted.withColumnRenamed("id", "b"), "key").filter(fits)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        fresh = materialise(_verified(pairs, sets), "links")
        links, roots = links.union(fresh).distinct(), components(fresh, roots)
    return links, roots


def jaccard_components(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of each row of ``documents`` (doc_id, text).

    ``component_id`` is the least doc_id reachable by links, the document's own included.
    ``n_links`` counts the links found from its class to other classes; inside groups of near
    copies they span the component and need not be all. Documents without a word (null and
    empty texts too) have no shingle and are linked with nothing. Equal rows stay as they are,
    each a document. A null doc_id stays null and is no candidate for the least. Columns other
    than doc_id and text are not used. An empty table gives an empty result.
    """
    small_batches(documents.sparkSession)
    docs = materialise(document_sets(documents), "document_sets")
    classes = docs.filter("n > 0").groupBy(*_CLASS).agg(F.min("doc_id").alias("doc_id"))
    classes = materialise(classes, "classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sent = documents.select("text").mapInArrow(tidy(_send(_groups(0.7 * total), subset_keys, _sets)), _SENT)
    found = _collisions(sent, hubs=False)
    light = materialise(_light(classes, found, 1), "light")
    poor = materialise(_incomplete(light), "poor")
    pairs = materialise(_pairs(found, light, counted=True), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(poor).distinct()
    sets = materialise(wanted_sets(documents, classes.join(wanted, "id", "left_semi")), "sets")
    links = materialise(_verified(pairs, sets), "links")
    if poor.isEmpty():
        roots = components(links)
    else:
        poor_sets = sets.join(poor, "id", "left_semi")
        moved = poor_sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        sent = poor_sets.select("tokens").mapInArrow(
            tidy(_send(_groups(2 * moved), neighbour_keys, _packed_sets)), _SENT
        )
        found = _collisions(sent, hubs=True)
        twice = _twice_filled(poor_sets).join(classes.drop("filled0", "filled1"), "id")
        light = materialise(_light(twice, found, 2), "light")
        fresh = _pairs(found, light, counted=False).join(pairs, ["a", "b"], "left_anti")
        links = materialise(links.union(_verified(fresh, sets)).distinct(), "links")
        rest = _incomplete(light)
        links, roots = _across(_rarest(sets.join(rest, "id", "left_semi")), sets, links, components(links))
    return _joined(docs, classes, links, roots)


def _joined(docs: DataFrame, classes: DataFrame, links: DataFrame, roots: DataFrame) -> DataFrame:
    """Each row of ``docs`` with its class's component; classes of many copies and components of
    many classes are looked up by their weight, so that none of them is brought together."""
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count("*").alias("n_links")
    )
    copies = docs.filter("n > 0").groupBy(F.col("h1").alias("node")).agg(F.count("*").alias("copies"))
    # a class is one value of h1 but for rows whose other hash differs
    ids = classes.groupBy(F.col("h1").alias("node")).agg(F.min("doc_id").alias("doc_id"))
    named = ids.join(copies, "node").join(degree, "node", "left").join(roots, "node", "left")
    named = materialise(named.withColumn("root", F.coalesce("root", "node")), "named")
    least = named.groupBy(F.col("root").alias("_root")).agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("_classes")
    )
    known = lookup_join(named.drop("doc_id"), materialise(least, "least"), "root", "_root", "_classes")
    known = materialise(known.drop("root").withColumnRenamed("node", "_node"), "known")
    worded = lookup_join(docs.filter("n > 0"), known, "h1", "_node", "copies")
    found = worded.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    alone = docs.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return found.unionByName(alone)


_SENT = "group long, packed binary"
