"""Document fingerprints: a quartile digest over buckets of hashed byte triplets.

All overlapping triplets of a text's UTF-8 bytes are hashed into ``BUCKETS`` buckets and
counted. Each bucket is written as two bits: the number of quartiles of the counts that its
count exceeds. A last byte holds the length on a logarithmic scale. Digests compare by a
difference score: differences between bucket codes, with an extra for opposite ones, and
between lengths, at most ``WORST``; likeness is one less its share of that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from forumlens.llm.words import small_batches

BUCKETS = 1024
LENGTH_STEP = 1.05  # a step of the length byte
LENGTH_WORST = 32  # length steps that count at most
OPPOSITE = 6  # difference of codes 0 and 3
WORST = BUCKETS * OPPOSITE + LENGTH_WORST * 8
RANGE_ROWS = 4096  # documents that a range of neighbours is meant to hold
MAX_RANGES = 20_000

_HASH = np.uint32(0x9E3779B1)
_COST = np.array([0, 1, 2, OPPOSITE], np.int64)


def digest(data: bytes) -> bytes:
    """The fingerprint of a text's bytes. A text of fewer than three bytes has no triplet."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    if len(b) > 2:
        triplets = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        bucket = (triplets * _HASH) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        counts = np.bincount(bucket, minlength=BUCKETS)
    quarter = BUCKETS // 4
    q = np.sort(counts)[[quarter - 1, 2 * quarter - 1, 3 * quarter - 1]]
    code = (counts[:, None] > q).sum(1).astype(np.uint8).reshape(-1, 4)
    packed = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    length = min(255, round(np.log1p(len(data)) / np.log(LENGTH_STEP) / 2))
    return packed.tobytes() + bytes([length])


def difference(x: bytes, y: bytes) -> int:
    """From 0 (equal digests) to ``WORST``."""
    a, b = (np.frombuffer(v[:-1], np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3 for v in (x, y))
    buckets = _COST[np.abs(a.astype(np.int64) - b)].sum()
    return int(buckets) + 8 * min(LENGTH_WORST, abs(x[-1] - y[-1]))


def likeness(x: bytes, y: bytes) -> float:
    return 1.0 - difference(x, y) / WORST


def digests(texts: Column) -> Column:
    """The fingerprints of a column of texts in hexadecimal; a null text counts as empty."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([digest((v.as_py() or "").encode()).hex() for v in values])

    return run(texts)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    Next is by ascending doc_id (null ids first; equal ids by text, null texts as empty ones),
    and after the last comes the first; a single document is its own next. One row per row of
    ``documents``; columns other than doc_id and text are not used; an empty table gives none.

    Texts move once: documents are dealt to ranges of doc_id, and the rows with the least id
    of each range go to the range before as well, as the next of its last row. Ranges are cut
    at approximate quantiles of doc_id; a task streams through its sorted rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = docs.select("doc_id").count()
    cuts = _cuts(docs, n)
    place = F.lit(0)
    if cuts:
        array = F.array(*[F.lit(c) for c in cuts])
        place = F.coalesce(_at_or_below(array, F.col("doc_id")), F.lit(0))
    ranged = docs.withColumn("place", place)
    least = ranged.groupBy("place").agg(
        F.when(F.count("*") > F.count("doc_id"), F.lit(None)).otherwise(F.min("doc_id")).alias("least")
    )
    firsts = [(r["place"], r["least"]) for r in least.orderBy("place").collect()]  # one row a range
    rows = ranged.select("place", F.lit(0).alias("after"), "doc_id", "text")
    if firsts:
        before = spark.createDataFrame(
            [(firsts[k - 1][0], firsts[k][0], firsts[k][1]) for k in range(len(firsts))],
            "back int, place int, least long",
        )
        heads = ranged.join(F.broadcast(before), "place").filter(F.col("doc_id").eqNullSafe(F.col("least")))
        rows = rows.union(heads.select("back", F.lit(1), "doc_id", "text"))
    dealt = rows.repartitionById(len(cuts) + 1, F.col("place")).sortWithinPartitions(  # a range is a task
        "place", "after", F.asc_nulls_first("doc_id"), "text"
    )
    return dealt.mapInArrow(_compared, _SCHEMA)


def _cuts(docs: DataFrame, n: int) -> list[int]:
    ranges = min(MAX_RANGES, n // RANGE_ROWS + 1)
    if ranges < 2:
        return []
    shares = [k / ranges for k in range(1, ranges)]
    return sorted({int(c) for c in docs.approxQuantile("doc_id", shares, 0.2 / ranges)})


def _at_or_below(cuts: Column, value: Column) -> Column:
    """The number of cuts that are at most the value, by halving."""
    steps = F.sequence(F.lit(20), F.lit(0), F.lit(-1))

    def step(low: Column, power: Column) -> Column:
        probe = low + F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), power).cast("int")
        return F.when((probe <= F.size(cuts)) & (F.get(cuts, probe - 1) <= value), probe).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, out = None, []

    def row(doc_id: int | None, text: str, mark: bytes, following: str, next_mark: bytes) -> tuple:
        changed = edited(text, following).encode()
        own = digest(changed)
        return (
            doc_id, len(text), hashlib.sha256(changed).hexdigest(), mark.hex(), own.hex(),
            likeness(mark, own), likeness(mark, next_mark),
        )

    for batch in batches:
        columns = [batch.column(c) for c in ("place", "after", "doc_id", "text")]
        for values in zip(*columns, strict=True):
            place, after, doc_id, text = (v.as_py() for v in values)
            if after and (held is None or held[0] != place):
                continue  # a further row with the next range's least id
            mark = digest(text.encode())
            if held is not None:
                out.append(row(*held[1:], text, mark))
            held = None if after else (place, doc_id, text, mark)
        if out:
            yield _table(out)
            out = []


def _table(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCHEMA.split(", ")])
