"""Toxic documents and their offending sentences, by multiple-instance learning.

Only documents have labels. Every sentence gets a score from its words by a logistic model
over hashed words, and a document's score is the noisy-or of them: one less the product of
``1 - score`` over its sentences. The weights are trained on the documents' labels through
that noisy-or, so that the model itself finds which sentences made a document toxic. A word
counts by itself and by its beginnings and its end, as inflected and compound forms vary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.llm.words import give_back, mix, slices, small_batches, spans, tidy, word_hashes

HASH_BITS = 20
TRAIN_ROWS = 2000  # of each label at most: those whose ids have the smallest hashes
TRAIN_CHARS = 12_000_000  # of each label's sampled texts together at most; the first text always counts
STEPS = 120
GAIN = 16.0  # likelihood ratio from which a feature is looked at
DECAY = 1e-4
TOXIC_SHARE = 0.25  # weight of all toxic training documents together
THRESHOLD = 0.3

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
_EDGE = np.zeros(256, bool)  # bytes taken off both ends of a word
_EDGE[[ord(c) for c in ".,;:!?'\"()[]{}|#$%&*-_"]] = True


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def sentence_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the words of consecutive rows: features (one row a kind), sentence, first words.

    Sentences end at ``. ! ? `` and line ends. Marks around a word are no part of it.
    """
    starts, ends, firsts = spans(data, offsets)
    stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
    begins = np.zeros(len(starts) + 1, bool)
    begins[0] = True
    begins[1:-1] = stops[starts[1:]] > stops[starts[:-1]]
    begins[firsts] = True  # a row begins a sentence
    while (edge := (starts < ends) & _EDGE[data[np.minimum(starts, len(data) - 1)]]).any():
        starts = starts + edge
    while (edge := (starts < ends) & _EDGE[data[np.maximum(ends - 1, 0)]]).any():
        ends = ends - edge
    parts = [
        (starts, ends),
        (starts, np.minimum(starts + 4, ends)),
        (starts, np.minimum(starts + 6, ends)),
        (np.maximum(ends - 5, starts), ends),
    ]
    hashed = [word_hashes(data, *part) + np.uint64(k) for k, part in enumerate(parts)]
    features = (mix(np.stack(hashed)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    return features, np.cumsum(begins[:-1]) - 1, firsts


def noisy_or(logits: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One less the product of each owner's ``1 - sigmoid(logit)``; 0 for no sentence."""
    return -np.expm1(-np.bincount(owner, np.logaddexp(0, logits), n))


class Model:
    """Weights of the hashed words, and the bias of a sentence."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def sentences(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sentence logits, their rows, and their first words."""
        feature, sentence, firsts = sentence_words(data, offsets)
        n = int(sentence[-1]) + 1 if len(sentence) else 0
        logits = self.bias + np.bincount(sentence, self.weights[feature].sum(0), n)
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        return logits, np.searchsorted(firsts, first, "right") - 1, first

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = [np.zeros(0)]
        for _, offsets, data in slices(texts):
            logits, owner, _ = self.sentences(data, offsets)
            found.append(noisy_or(logits, owner, len(offsets) - 1))
        return np.concatenate(found)


def fit(texts: pa.ChunkedArray, toxic: np.ndarray) -> Model:
    """Full-batch training by Adam on the log loss of the noisy-or, over all sentences.

    Texts are read twice, slice by slice, so that only telling features are kept of them.
    """
    n = len(texts)
    used = _telling(texts, toxic)
    place = np.zeros(1 << HASH_BITS, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    plain = np.zeros(n)  # sentences without a telling feature, which all score the same
    features, sentences, owners, m = [], [], [], 0
    for first, offsets, data in slices(texts):
        feature, sentence, firsts = sentence_words(data, offsets)
        feature = place[feature]
        owner = _rows(firsts)[np.flatnonzero(np.diff(sentence, prepend=-1))] + first
        says = feature.any(0)  # words without such a feature change nothing
        told, sentence = np.unique(sentence[says], return_inverse=True)
        plain += np.bincount(owner, minlength=n) - np.bincount(owner[told], minlength=n)
        features.append(feature[:, says])
        sentences.append(sentence.astype(np.int32) + m)
        owners.append(owner[told])
        m += len(told)
    feature, sentence, owner = (np.concatenate(x, axis=-1) for x in (features, sentences, owners))
    share = np.where(toxic, TOXIC_SHARE / max(1, toxic.sum()), (1 - TOXIC_SHARE) / max(1, (1 - toxic).sum()))
    w, g1, g2 = (np.zeros(len(used) + 2) for _ in range(3))
    w[-1] = -4.0
    for step in range(1, STEPS + 1):
        logits = w[-1] + np.bincount(sentence, sum(w[kind] for kind in feature), m)
        p = 1 / (1 + np.exp(-logits))
        none = np.exp(-np.bincount(owner, np.logaddexp(0, logits), n) - plain * np.logaddexp(0, w[-1]))
        # d loss / d sum(log(1 - p)) is 1 - y / (1 - none), with the product as none
        outer = share * (1 - toxic / np.maximum(1 - none, 1e-9))
        inner = outer[owner] * p
        grad = sum(np.bincount(kind, inner[sentence], len(used) + 1) for kind in feature)
        grad = np.append(grad, inner.sum() + (outer * plain).sum() / (1 + np.exp(-w[-1])))
        grad[0] = 0  # all other features
        grad[:-1] += DECAY * w[:-1]
        g1, g2 = 0.9 * g1 + 0.1 * grad, 0.99 * g2 + 0.01 * grad**2
        w -= 0.1 * (g1 / (1 - 0.9**step)) / (np.sqrt(g2 / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << HASH_BITS, np.float32)
    weights[used] = w[1:-1]
    return Model(weights, float(w[-1]))


def _rows(firsts: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def _telling(texts: pa.Array, toxic: np.ndarray) -> np.ndarray:
    """Features that tell labels apart by the likelihood ratio of their documents' counts."""
    yes, no = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    for first, offsets, data in slices(texts):
        feature, _, firsts = sentence_words(data, offsets)
        pairs = np.unique(_rows(firsts) << HASH_BITS | feature)  # a row is in one slice
        found, doc = pairs & ((1 << HASH_BITS) - 1), (pairs >> HASH_BITS) + first
        yes += np.bincount(found, toxic[doc], 1 << HASH_BITS)
        no += np.bincount(found, 1 - toxic[doc], 1 << HASH_BITS)
    a, b = max(1, toxic.sum()), max(1, (1 - toxic).sum())
    gain = _ratio(yes, no, a, b) + _ratio(a - yes, b - no, a, b)
    return np.flatnonzero(gain >= GAIN)


def _ratio(yes: np.ndarray, no: np.ndarray, a: int, b: int) -> np.ndarray:
    expected = (yes + no) / (a + b)
    pairs = ((yes, a * expected), (no, b * expected))
    return sum(2 * x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)) for x, e in pairs)


def train(documents: DataFrame, labels: DataFrame) -> Model | None:
    """A model from labelled documents outside the held-out quarter; None if a label is missing.

    At most ``TRAIN_ROWS`` documents of each label, and at most ``TRAIN_CHARS`` characters of them,
    go to one task, those whose doc_id has the smallest hash: a bounded sample, of which all
    sentences count. Scores are for all documents. Of labels with several rows for a document the
    largest counts, of documents with several rows the least text; null labels are left out.
    """
    small_batches(documents.sparkSession)
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic")
    )
    known = documents.select("doc_id", "text").filter(~held_out(F.col("doc_id")) & (F.length("text") > 0))
    chosen = marks.filter(~held_out(F.col("doc_id"))).withColumn("at", F.xxhash64("doc_id"))
    few = None
    for label in (0, 1):
        some = chosen.filter(F.col("toxic") == label).orderBy("at", "doc_id").limit(TRAIN_ROWS)
        few = some if few is None else few.union(some)
    # a repeated id is one row before anything is brought together
    rows = known.join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic", "at").agg(F.min("text").alias("text"))
    so_far = Window.partitionBy("toxic").orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(F.length("text")).over(so_far), F.lit(0)))
    fits = (F.col("before") == 0) | (F.col("before") + F.length("text") <= TRAIN_CHARS)
    rows = rows.filter(fits).select("text", "toxic").coalesce(1).sortWithinPartitions("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("text", pa.string()), ("toxic", pa.int32())]))
        toxic = table.column("toxic").to_numpy()
        if len(np.unique(toxic)) < 2:
            return
        model = fit(table.column("text"), toxic.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([model.bias]), pa.array([model.weights.tobytes()])], ["bias", "weights"])

    found = rows.mapInArrow(tidy(run), "bias double, weights binary").collect()
    if not found:
        return None
    return Model(np.frombuffer(found[0]["weights"], np.float32), found[0]["bias"])


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``documents`` with ``score`` from 0 to 1; only ``text`` is looked at.

    A text without a word scores 0, and every text does without a model. A column ``score``
    that is there already is replaced. Rows stay as they are, repeated ones too.
    """
    small_batches(documents.sparkSession)
    if model is None:
        return documents.withColumn("score", F.lit(0.0))
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Model(*shared.value)
        try:
            for texts in batches:
                yield pa.array(known.scores(texts))
        finally:
            give_back()

    return documents.withColumn("score", run("text"))


def offending_sentences(documents: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """``doc_id, start, end, score`` of sentences that score ``threshold`` or more.

    ``start`` and ``end`` are places in the text's UTF-8 bytes, from the sentence's first word
    to before the next sentence's. Null texts and texts without words have no sentence, a repeated
    row has its sentences again, and a null doc_id stays null.
    """
    small_batches(documents.sparkSession)
    schema = "doc_id long, start long, end long, score double"
    if model is None:
        return documents.sparkSession.createDataFrame([], schema)
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            ids = batch.column("doc_id")
            for row, offsets, data in slices(batch.column("text")):
                logits, owner, first = known.sentences(data, offsets)
                starts, _, _ = spans(data, offsets)
                begin = starts[first]
                end = np.minimum(np.append(begin[1:], len(data)), offsets[owner + 1])
                p = 1 / (1 + np.exp(-logits))
                hit = p >= threshold
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(owner[hit] + row)),
                        pa.array((begin - offsets[owner])[hit]),
                        pa.array((end - offsets[owner])[hit]),
                        pa.array(p[hit]),
                    ],
                    ["doc_id", "start", "end", "score"],
                )

    return documents.select("doc_id", "text").mapInArrow(tidy(run), schema)


def judge(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
