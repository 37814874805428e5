"""Topic models whose state is a table by term: no vocabulary and no matrix on the driver.

Variational steps as joins: counts ``id, term, n`` meet the state of their term and of their
community, each entry's count is dealt to the topics, and one aggregation by grouping sets gives
the next state of both. Only ``k`` totals come back to the driver, whatever the vocabulary.

Where the communities are few enough to be sent to every task, a term's entries and weights are one
row, which a round rewrites in place: nothing is shuffled but the communities' sums of each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.functions.variational import dealt_sums, digamma_of
from forumlens.operators.lookup import lookup_join
from forumlens.operators.ranking import with_position
from forumlens.session import BROADCAST_ROWS, materialise

TOPICS = 10
ROUNDS = 15
SCORE_ROUNDS = 10
SEED = 42
TOP_TERMS = 10


def digamma(x: Column) -> Column:
    """By its series at ``x + 6``, and the recurrence down from there; for positive numbers."""
    y = x + 6
    square = y * y
    series = F.log(y) - 0.5 / y - (1 / 12 - (1 / 120 - 1 / (252 * square)) / square) / square
    return series - sum((1 / (x + i) for i in range(1, 6)), 1 / x)


@dataclass(frozen=True)
class TopicTables:
    """``terms`` is a written table ``term, l``: its weight in each topic, as an array."""

    terms: DataFrame
    totals: list[float]  # of each topic over all terms
    prior: float  # of a topic in a community
    em: bool = False  # by expectation maximisation, whose weights are plain counts
    smoothing: float = 0.0  # added to each of these counts

    @property
    def k(self) -> int:
        return len(self.totals)

    def matrix(self) -> DataFrame:
        """``topic, term, weight`` of all terms; a topic's weights sum to 1."""
        shares = F.array(*[F.col("l")[i] / total for i, total in enumerate(self.totals)])
        return self.terms.select("term", F.posexplode(shares).alias("topic", "weight")).select("topic", "term", "weight")

    def words(self, n: int = TOP_TERMS) -> DataFrame:
        """``topic, term_words, term_weight``: each topic's ``n`` heaviest terms, ties by term.

        Every task hands on ``n`` terms a topic, as the limit goes below the exchange.
        """
        order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
        top = self.matrix().withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)
        entries = F.sort_array(F.collect_list(F.struct("position", "term", "weight")))
        return top.groupBy("topic").agg(entries.alias("e")).select(
            "topic", F.col("e.term").alias("term_words"), F.col("e.weight").alias("term_weight")
        )

    def scores(self, counts: DataFrame, rounds: int = SCORE_ROUNDS) -> DataFrame:
        """``id, topicDistribution``; all zero for a community without any term of the model.

        Entries meet the state of their term once; the rounds then move only the communities'.
        """
        known = _entries(counts).join(self._shares(), "term").drop("term")
        known = materialise(known, "known-entries")
        places = None
        for _ in range(rounds):
            dealt = _dealt(_with_places(known, places, self.k), self.k)
            sums = dealt.groupBy("id").agg(*_sums(self.k), F.count("*").alias("weight"))
            places = _places(sums, self.k, self.prior)
        seen = places.select(F.col("id").alias("of"), "g")
        whole = F.aggregate("g", F.lit(0.0), lambda a, b: a + b)
        named = counts.select("id").distinct().join(seen, F.col("id").eqNullSafe(F.col("of")), "left")
        none = F.array(*[F.lit(0.0)] * self.k)
        return named.select("id", F.coalesce(F.transform("g", lambda g: g / whole), none).alias("topicDistribution"))

    def perplexity(self, counts: DataFrame) -> float:
        """Of the counts of terms that the model has, under each community's own distribution."""
        entries = _entries(counts).join(self.terms, "term")
        scored = self.scores(counts).select(F.col("id").alias("of"), "topicDistribution")
        both = entries.join(scored, F.col("id").eqNullSafe(F.col("of")))
        share = sum((F.col("topicDistribution")[i] * F.col("l")[i] / total for i, total in enumerate(self.totals)), F.lit(0.0))
        return both.agg(F.exp(-F.sum(F.col("n") * F.log(share)) / F.sum("n"))).first()[0]

    def _shares(self) -> DataFrame:
        """``term, b``: what a round takes of a term's weights."""
        if self.em:
            size = self.terms.count()
            wholes = F.array(*[F.lit(total + size * self.smoothing) for total in self.totals])
            return self.terms.select("term", F.zip_with("l", wholes, lambda l, whole: (l + self.smoothing) / whole).alias("b"))
        totals = F.transform(F.array(*map(F.lit, self.totals)), digamma)
        return self.terms.select("term", F.zip_with("l", totals, lambda l, total: F.exp(digamma(l) - total)).alias("b"))


def _entries(counts: DataFrame) -> DataFrame:
    return counts.filter("term IS NOT NULL AND n > 0").select("id", "term", F.col("n").cast("double").alias("n"))


def _sums(k: int) -> list[Column]:
    return [F.sum(f"r{i}").alias(f"s{i}") for i in range(k)]


def _with_places(entries: DataFrame, places: DataFrame | None, k: int) -> DataFrame:
    """Entries with their community's state, which is all alike at first.

    One community may have a third of all entries; the join knows what each of them weighs.
    """
    if places is None:
        return entries.withColumn("t", F.array(*[F.lit(1.0)] * k))
    return lookup_join(entries, places.select(F.col("id").alias("of"), "t", "weight"), "id", "of", "weight")


def _dealt(entries: DataFrame, k: int) -> DataFrame:
    """The count of each entry dealt to the topics, as ``r0, r1, ...``."""
    shares = [F.col("t")[i] * F.col("b")[i] for i in range(k)]
    dealt = entries.select("id", *(["term"] if "term" in entries.columns else []), "n", *[x.alias(f"r{i}") for i, x in enumerate(shares)])
    norm = F.col("n") / sum((F.col(f"r{i}") for i in range(1, k)), F.col("r0"))
    return dealt.withColumns({f"r{i}": F.col(f"r{i}") * norm for i in range(k)})


def _plus(k: int, prior: float) -> Column:
    return F.array(*[F.col(f"s{i}") + prior for i in range(k)])


def _places(sums: DataFrame, k: int, prior: float, em: bool = False) -> DataFrame:
    """``id, g, t, weight`` of communities from the counts dealt to their topics, written."""
    state = sums.select("id", "weight", _plus(k, prior).alias("g"))
    if em:
        return materialise(state.withColumn("t", F.col("g")), "places")
    whole = F.transform(F.array(F.aggregate("g", F.lit(0.0), lambda a, b: a + b)), digamma)[0]
    state = state.withColumn("whole", whole)
    return materialise(state.withColumn("t", F.transform("g", lambda g: F.exp(digamma(g) - F.col("whole")))).drop("whole"), "places")


def _totals(terms: DataFrame, k: int) -> list[float]:
    return [x or 0.0 for x in terms.agg(*[F.sum(F.col("l")[i]) for i in range(k)]).first()]


def fit_topic_tables(
    counts: DataFrame,
    k: int = TOPICS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    prior: float | None = None,
    term_prior: float | None = None,
    em: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> TopicTables:
    """A model from ``id, term, n``, one row for each community and term.

    Null terms and counts of 0 are left out; the null community is one. Terms begin with a seeded
    random share of their count for each topic, so that reruns begin alike. Priors are ``1 / k``.
    With ``em`` the rounds are those of expectation maximisation, with the priors of Spark's:
    ``50 / k`` and 0.1 above one. Up to ``max_rows`` communities are sent to every task.
    """
    usual = (50 / k, 0.1) if em else (1 / k, 1 / k)
    prior, term_prior = (least if x is None else x for x, least in zip((prior, term_prior), usual, strict=True))
    entries = materialise(_entries(counts), "entries")
    uniform = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "term"), F.lit(1_000_003)) + 1) / F.lit(1_000_004.0) for i in range(k)]
    least = 0.0 if em else term_prior
    begin = F.array(*[least - F.col("n") / k * F.log(u) for u in uniform])
    communities = materialise(entries.select("id").distinct(), "communities")
    if communities.count() <= max_rows:
        return _fit_by_term(entries, communities, begin, k, rounds, prior, term_prior, em)
    terms = materialise(entries.groupBy("term").agg(F.sum("n").alias("n")).select("term", begin.alias("l")), "topic-terms")
    model, places = TopicTables(terms, _totals(terms, k), prior, em, term_prior), None
    for _ in range(rounds):
        dealt = _dealt(_with_places(entries.join(model._shares(), "term"), places, k), k)
        both = dealt.groupingSets([[F.col("id")], [F.col("term")]], "id", "term").agg(
            *_sums(k), F.count("*").alias("weight"), F.grouping("id").alias("by_term")
        )
        both = materialise(both, "topic-sums")
        places = _places(both.filter("by_term = 0").drop("term", "by_term"), k, prior, em)
        terms = both.filter("by_term = 1").select("term", _plus(k, least).alias("l"))
        model = TopicTables(terms, _totals(terms, k), prior, em, term_prior)
    return model


def _fit_by_term(
    entries: DataFrame, communities: DataFrame, begin: Column, k: int, rounds: int, prior: float, term_prior: float, em: bool
) -> TopicTables:
    """The same rounds with a row for each term: its communities, its counts there, and its weights.

    A row has one entry for each community at most. Tasks get all communities' states, and give
    back their own sums for communities (as rows without a term) and for topics (place -1).
    """
    numbered = with_position(communities, [F.asc_nulls_first("id")], "place").select(F.col("id").alias("of"), F.col("place").cast("int").alias("place"))
    numbered = materialise(numbered, "numbered")
    number = numbered.count()
    placed = entries.join(F.broadcast(numbered), F.col("id").eqNullSafe(F.col("of")))
    grouped = placed.groupBy("term").agg(F.sum("n").alias("n"), F.collect_list(F.struct("place", "n")).alias("e"))
    none = F.lit(None)
    rows = grouped.select(
        "term", F.col("e.place").alias("places"), F.col("e.n").alias("ns"), begin.cast("array<float>").alias("l"),
        none.cast("int").alias("place"), none.cast("array<double>").alias("sums"),
    )
    rows = materialise(rows, "term-rows")
    known = rows.filter("place IS NULL")
    totals, size = np.array(_totals(known, k)), known.count() if em else 0
    state = np.ones((number, k))
    for _ in range(rounds):
        rows = materialise(known.mapInArrow(_round_by_term(state, totals, size, term_prior, em), rows.schema), "term-rows")
        known = rows.filter("place IS NULL")
        given = rows.filter("place IS NOT NULL").groupBy("place")
        found = given.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(k)]).toArrow()
        sums = np.zeros((number + 1, k))
        sums[found["place"].to_numpy()] = np.column_stack([found[f"s{i}"].to_numpy() for i in range(k)])
        totals, state = sums[-1], sums[:-1] + prior
        if not em:
            state = np.exp(digamma_of(state) - digamma_of(state.sum(1, keepdims=True)))
    terms = known.select("term", F.col("l").cast("array<double>").alias("l"))
    return TopicTables(terms, totals.tolist(), prior, em, term_prior)


def _round_by_term(
    state: np.ndarray, totals: np.ndarray, size: int, term_prior: float, em: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    sent, k = state, len(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, names = np.zeros((len(sent) + 1, k)), None
        for batch in batches:
            names = batch.schema
            where, n = batch.column("places"), batch.column("ns").flatten().to_numpy()
            counts = where.value_lengths().to_numpy()
            weights = batch.column("l").flatten().to_numpy().reshape(-1, k).astype(float)
            if em:
                share = (weights + term_prior) / (totals + size * term_prior)
            else:
                share = np.exp(digamma_of(weights) - digamma_of(totals))
            new = dealt_sums(sent, where.flatten().to_numpy(), n, share, counts, sums)
            new = (new if em else new + term_prior).astype(np.float32)
            sums[-1] += new.sum(0, dtype=float)
            made = pa.ListArray.from_arrays(np.arange(0, new.size + 1, k, dtype=np.int32), new.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("term"), where, batch.column("ns"), made, batch.column("place"), batch.column("sums")], ["term", "places", "ns", "l", "place", "sums"]
            )
        if names is None:
            return
        used = np.flatnonzero(sums.any(1))
        own = pa.ListArray.from_arrays(np.arange(0, k * len(used) + 1, k, dtype=np.int32), sums[used].ravel())
        at = np.where(used == len(sent), -1, used).astype(np.int32)
        columns = {"place": pa.array(at), "sums": own}
        yield pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(len(used), f.type)) for f in names], ["term", "places", "ns", "l", "place", "sums"]
        )

    return run
