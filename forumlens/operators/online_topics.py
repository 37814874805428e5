"""Spark's topic models with their weights as a table by term: nothing as large as the vocabulary
passes through the driver, and no task holds a matrix of it.

The online fit is Spark's: in each iteration a share of the documents is drawn, topics of these are found,
and the weights of all terms move towards what the draw gives. The weights of the first terms, a fixed number
of them, are sent to the tasks; other entries of drawn documents meet the weights of their terms by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.clustering import LDAModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.functions.variational import STEP_ENTRIES, digamma_of, document_topics, trigamma_of
from forumlens.operators.topic_tables import digamma, fit_topic_tables
from forumlens.session import materialise, small_batches

DRAWN = 0.05  # Spark's defaults, as are the next two
OFFSET = 1024
DECAY = 0.51
SHARED_TERMS = 100_000  # terms, the most frequent ones of a vocabulary, whose weights go to all tasks: 4 MB


def _numbered(df: DataFrame) -> DataFrame:
    """With ``_row``; written, as that number is of this run."""
    return materialise(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")


def _places(features: str) -> tuple[Column, Column]:
    """Indices, which ascend, and values of a vector."""
    raw = F.unwrap_udt(features)
    dense = F.transform(raw["values"], lambda _, i: i)
    return F.when(raw["type"] == 0, raw["indices"]).otherwise(dense), raw["values"]


def _entries(rows: DataFrame, features: str, since: int = 0) -> DataFrame:
    """``_row, idx, n`` of the terms from ``since`` on."""
    places, values = _places(features)
    if since:
        skipped = F.size(F.filter(places, lambda i: i < since))
        places, values = (F.slice(x, skipped + 1, F.greatest(F.size(x), F.lit(1))) for x in (places, values))
    pairs = F.explode(F.arrays_zip(places.alias("idx"), values.alias("n")))
    return rows.select("_row", pairs.alias("e")).select("_row", "e.idx", "e.n").filter("n > 0")


def _by_document(
    rows: DataFrame, features: str, shares: DataFrame, size: int, prior: np.ndarray, learning: bool
) -> DataFrame:
    """Topics of whole documents: ``_row, g``, or for learning ``idx, s``, the counts dealt to topics.

    With the latter a row of index -1 has the documents' logarithms of topics and their number.
    ``shares`` has ``b`` of each of the ``size`` terms. Those of the first terms, the frequent ones, go to
    all tasks, and a document's entries of these are one row; only the other entries are joined.
    """
    small_batches(rows.sparkSession)
    places, values = _places(features)
    places = F.filter(places, lambda i: i < SHARED_TERMS)
    none = F.array().cast("array<float>")
    known = rows.select("_row", places.alias("idx"), F.slice(values, 1, F.size(places)).alias("n"), none.alias("b"))
    if size > SHARED_TERMS:
        rest = _entries(rows, features, SHARED_TERMS).join(shares.filter(F.col("idx") >= SHARED_TERMS).hint("merge"), "idx")
        known = known.unionByName(rest.select("_row", F.array("idx").alias("idx"), F.array("n").alias("n"), "b"))
    together = known.repartition("_row").sortWithinPartitions("_row")
    schema = "idx int, s array<double>" if learning else "_row long, g array<double>"
    return together.mapInArrow(_steps(prior, learning, _first_shares(shares, len(prior))), schema)


def _first_shares(shares: DataFrame, k: int) -> np.ndarray:
    """``b`` of the terms that go to all tasks, by index: a few MB, however large the vocabulary."""
    first = shares.filter(F.col("idx") < SHARED_TERMS).toArrow()
    idx = first["idx"].to_numpy()
    held = np.zeros((int(idx.max(initial=-1)) + 1, k), np.float32)
    held[idx] = first["b"].combine_chunks().flatten().to_numpy().reshape(-1, k)
    return held


def _flat(batch: pa.RecordBatch, k: int, shared: np.ndarray | None) -> list[np.ndarray]:
    """Rows, indices, counts and shares of a batch's entries, of which a row may hold many."""
    row, idx, n, b = batch.columns
    given = b.flatten().to_numpy().reshape(-1, k)
    if not pa.types.is_list(idx.type):
        return [row.to_numpy(), idx.to_numpy(), n.to_numpy(), given]
    number = idx.value_lengths().to_numpy()
    own = np.repeat(b.value_lengths().to_numpy() > 0, number)
    idx, n = idx.flatten().to_numpy(), n.flatten().to_numpy()
    share = np.empty((len(idx), k), np.float32)
    share[own] = given
    share[~own] = shared[idx[~own]]
    some = n > 0
    return [x[some] for x in (np.repeat(row.to_numpy(), number), idx, n, share)]


def _steps(
    prior: np.ndarray, learning: bool, shared: np.ndarray | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k = len(prior)

    def lists(values: np.ndarray) -> pa.Array:
        width = values.shape[1]
        return pa.ListArray.from_arrays(np.arange(0, values.size + 1, width, dtype=np.int32), values.ravel())

    def found(row: np.ndarray, idx: np.ndarray, n: np.ndarray, b: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
        begun = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        topics, dealt = document_topics(n, b, np.diff(np.r_[begun, len(row)]), prior)
        if not learning:
            return pa.RecordBatch.from_arrays([pa.array(row[begun]), lists(topics)], ["_row", "g"])
        logs[:k] += (digamma_of(topics) - digamma_of(topics.sum(1, keepdims=True))).sum(0)
        logs[k] += len(begun)
        used, back = np.unique(idx, return_inverse=True)
        sums = np.column_stack([np.bincount(back, dealt[:, i], len(used)) for i in range(k)])
        return pa.RecordBatch.from_arrays([pa.array(used), lists(sums)], ["idx", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, enough, logs = [], 0, STEP_ENTRIES, np.zeros(k + 1)

        def joined() -> list[np.ndarray]:
            return [np.concatenate(parts) for parts in zip(*waiting, strict=True)]

        for batch in batches:
            columns = _flat(batch, k, shared)
            if not len(columns[0]):
                continue
            waiting.append(columns)
            size += len(columns[0])
            if size >= enough:
                columns = joined()
                last = int(np.searchsorted(columns[0], columns[0][-1]))  # this document may go on
                if last:
                    yield found(*[x[:last] for x in columns], logs)
                waiting = [tuple(x[last:] for x in columns)]
                size -= last
                enough = max(STEP_ENTRIES, 2 * size)
        if waiting:
            yield found(*joined(), logs)
        if learning and logs[k]:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), lists(logs[None])], ["idx", "s"])

    return run


class TermTopicsModel(LDAModel):
    """A topic model over ``terms``, a written table ``idx, l`` of the weight of every term in each topic."""

    def __init__(self, terms: DataFrame, size: int, totals: list[float], prior: np.ndarray, features: str, em: bool):
        super().__init__()
        self.terms, self.size, self.totals, self.prior = terms, size, totals, prior
        self.features, self.em = features, em

    def vocabSize(self) -> int:
        return self.size

    def isDistributed(self) -> bool:
        return self.em

    def term_weights(self) -> DataFrame:
        """``topic, idx, weight`` of all terms; a topic's weights sum to 1."""
        shares = F.array(*[F.col("l")[i] / total for i, total in enumerate(self.totals)])
        return self.terms.select("idx", F.posexplode(shares).alias("topic", "weight")).select("topic", "idx", "weight")

    def top_terms(self, n: int) -> DataFrame:
        """``topic, position, idx, weight``; every task hands on ``n`` terms a topic."""
        order = Window.partitionBy("topic").orderBy(F.desc("weight"), "idx")
        ranked = self.term_weights().withColumn("position", F.row_number().over(order) - 1)
        return ranked.filter(F.col("position") < n)

    def describeTopics(self, maxTermsPerTopic: int = 10) -> DataFrame:
        entries = F.sort_array(F.collect_list(F.struct("position", "idx", "weight")))
        grouped = self.top_terms(maxTermsPerTopic).groupBy("topic").agg(entries.alias("e"))
        return grouped.select("topic", F.col("e.idx").alias("termIndices"), F.col("e.weight").alias("termWeights"))

    def topicsMatrix(self) -> DenseMatrix:
        """All weights on the driver, for small vocabularies."""
        rows = self.terms.orderBy("idx").collect()
        return DenseMatrix(self.size, len(self.totals), np.array([r["l"] for r in rows]).T.ravel())

    def shares(self) -> DataFrame:
        """``idx, b``: what documents take of a term's weights."""
        return _shares(self.terms, self.totals)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = _numbered(dataset)
        scored = _by_document(rows, self.features, self.shares(), self.size, self.prior, False)
        whole = F.aggregate("g", F.lit(0.0), lambda a, b: a + b)
        none = F.array(*[F.lit(0.0)] * len(self.totals))
        found = scored.select("_row", F.transform("g", lambda g: g / whole).alias("_found"))
        shown = array_to_vector(F.coalesce("_found", none)).alias("topicDistribution")
        return rows.join(found.hint("merge"), "_row", "left").select(*dataset.columns, shown)


def _shares(terms: DataFrame, totals: list[float]) -> DataFrame:
    wholes = F.array(*[F.lit(float(x)) for x in digamma_of(totals)])
    share = F.zip_with("l", wholes, lambda l, whole: F.exp(digamma(F.greatest(l, F.lit(1e-30))) - whole).cast("float"))
    return terms.select("idx", share.alias("b"))


def _start(size: int, k: int, seed: int, spark) -> DataFrame:
    """Weights near 1, as Spark draws them: of a gamma law of shape 100, here from hashes."""

    def uniform(i: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "idx"), F.lit(1_000_003)) + 1) / F.lit(1_000_004.0)

    def draw(i: int) -> Column:
        normal = F.sqrt(-2 * F.log(uniform(2 * i))) * F.cos(uniform(2 * i + 1) * (2 * np.pi))
        return F.pow(normal / 30 + (1 - 1 / 900), F.lit(3.0))

    return spark.range(size).select(F.col("id").cast("int").alias("idx")).select("idx", F.array(*[draw(i) for i in range(k)]).alias("l"))


def _totals(terms: DataFrame, k: int) -> list[float]:
    return [x or 0.0 for x in terms.agg(*[F.sum(F.col("l")[i]) for i in range(k)]).first()]


def _moved_prior(prior: np.ndarray, logs: np.ndarray, documents: float, rate: float) -> np.ndarray:
    """A Newton step of the documents' prior, as Spark takes it."""
    gradient = documents * (logs / documents - (digamma_of(prior) - digamma_of(prior.sum())))
    curve = documents * trigamma_of(prior.sum())
    q = -documents * trigamma_of(prior)
    common = (gradient / q).sum() / (1 / curve + (1 / q).sum())
    moved = prior - rate * (gradient - common) / q
    return moved if (moved > 0).all() else prior


class TopicEstimator(Estimator):
    """Fits on a column of count vectors, which are written once, whatever makes them."""

    def __init__(self, k: int, iterations: int, seed: int, optimizer: str, features: str):
        super().__init__()
        self.k, self.iterations, self.seed, self.optimizer, self.features = k, iterations, seed, optimizer, features

    def _fit(self, dataset: DataFrame) -> TermTopicsModel:
        rows = _numbered(dataset.select(self.features))
        size = rows.agg(F.max(self._size())).first()[0] or 0
        return self._fit_em(rows, size) if self.optimizer == "em" else self._fit_online(rows, size)

    def _size(self) -> Column:
        raw = F.unwrap_udt(self.features)
        return F.coalesce(raw["size"], F.size(raw["values"]))

    def _fit_em(self, rows: DataFrame, size: int) -> TermTopicsModel:
        """Terms without any entry weigh nothing."""
        counts = _entries(rows, self.features).select(F.col("_row").alias("id"), F.col("idx").alias("term"), "n")
        model = fit_topic_tables(counts, self.k, self.iterations, self.seed, em=True)
        none = F.array(*[F.lit(0.0)] * self.k)
        every = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("idx"))
        terms = every.join(model.terms.withColumnRenamed("term", "idx"), "idx", "left").select("idx", F.coalesce("l", none).alias("l"))
        prior = np.full(self.k, 50 / self.k + 1)
        return TermTopicsModel(materialise(terms, "topic-terms"), size, model.totals, prior, self.features, True)

    def _fit_online(self, rows: DataFrame, size: int) -> TermTopicsModel:
        k, corpus = self.k, rows.count()
        terms = materialise(_start(size, k, self.seed, rows.sparkSession), "topic-terms")
        totals, prior = _totals(terms, k), np.full(k, 1 / k)
        for step in range(1, self.iterations + 1):
            chance = F.pmod(F.xxhash64(F.lit(self.seed), F.lit(step), "_row"), F.lit(1_000_003))
            drawn = rows.filter(chance < int(DRAWN * 1_000_003))
            sums = F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(k + 1)])
            found = _by_document(drawn, self.features, _shares(terms, totals), size, prior, True)
            dealt = materialise(found.groupBy("idx").agg(sums.alias("s")), "dealt")
            logs = dealt.filter("idx = -1").first()
            if logs is None:  # no document with terms was drawn
                continue
            *logs, documents = logs["s"]
            rate = float((OFFSET + step) ** -DECAY)
            moved = terms.join(dealt.filter("idx >= 0").hint("merge"), "idx", "left").select("idx", self._moved(rate, corpus / documents).alias("l"))
            terms = materialise(moved, "topic-terms")
            totals = _totals(terms, k)
            prior = _moved_prior(prior, np.array(logs), documents, rate)
        return TermTopicsModel(terms, size, totals, prior, self.features, False)

    def _moved(self, rate: float, scale: float) -> Column:
        """The weights after an iteration; terms that were not drawn move towards their prior."""
        given = [F.coalesce(F.col("s")[i], F.lit(0.0)) * scale + 1 / self.k for i in range(self.k)]
        return F.array(*[F.col("l")[i] * (1 - rate) + x * rate for i, x in enumerate(given)])
