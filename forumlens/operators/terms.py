"""Bags of words without community rows: term counts, vocabularies and vectors.

Tokens are counted per community and term before anything is brought together, so
that a community never costs more than one entry per distinct term.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from forumlens.operators.lookup import lookup_join
from forumlens.operators.ranking import with_position
from forumlens.session import materialise, small_side

HASH_BUCKETS = 1 << 18
COUNT_BUCKETS = 1 << 18  # counters that terms share; a table of so many rows may be broadcast


def term_counts(df: DataFrame, tokens: Column, community: str = "id") -> DataFrame:
    """``id, term, n``. A community without any token keeps one row with a null term."""
    exploded = df.select(F.col(community).alias("id"), F.explode_outer(tokens).alias("term"))
    return exploded.groupBy("id", "term").agg(F.count("term").alias("n"))


def word_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """``word, n`` over all rows."""
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(
    counts: DataFrame, size: int | None = None, min_documents: int = 1
) -> DataFrame:
    """``idx, term, n, documents``: all terms, or the ``size`` most frequent ones, by frequency;
    ties in alphabetical order. With a ``size``, ``counts`` is read three times and should be written."""
    known = counts.filter(F.col("term").isNotNull())
    if size is None:
        totals = _totals(known, min_documents)
    else:
        totals = _frequent(known, size, min_documents)
    ranked = with_position(totals, [F.desc("n"), F.asc("term")], "idx")
    if size is not None:
        ranked = ranked.filter(F.col("idx") < size)
    return ranked.select(F.col("idx").cast("int").alias("idx"), "term", "n", "documents")


def _totals(known: DataFrame, min_documents: int) -> DataFrame:
    totals = known.groupBy("term").agg(F.sum("n").alias("n"), F.count("*").alias("documents"))
    return totals.filter(F.col("documents") >= min_documents)


def _frequent(
    known: DataFrame, size: int, min_documents: int, buckets: int = COUNT_BUCKETS
) -> DataFrame:
    """Exact totals of all terms that may be among the ``size`` most frequent, and few others.

    Terms share counters by their hash. These add up within tasks, and there is a fixed number of
    them. A counter is at least the count of each of its terms. Terms of the ``size`` largest are
    counted by themselves; the ``size``-th count of these is one that every wanted term
    reaches, so that only terms of counters that reach it are counted again. Rare terms of low
    counters are never shuffled. If no such count is known, all terms are counted.
    """
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    marked = known.withColumn("_bucket", bucket)
    sums = materialise(marked.groupBy("_bucket").agg(F.sum("n").alias("_most")), "counters")

    def counted(chosen: DataFrame) -> DataFrame:
        few = F.broadcast(chosen.select("_bucket"))  # ``buckets`` rows at most
        return _totals(marked.join(few, "_bucket", "left_semi"), min_documents)

    largest = with_position(sums, [F.desc("_most"), F.asc("_bucket")], "_place").filter(F.col("_place") < size)
    ranked = with_position(counted(largest), [F.desc("n"), F.asc("term")], "_place")
    reached = ranked.filter(F.col("_place") == size - 1).select("n").first()
    return counted(sums.filter(F.col("_most") >= (reached["n"] if reached else 0)))


def _vectors(entries: DataFrame, size: int) -> DataFrame:
    """``id, idx, n`` to ``id, features``; a null index adds no entry.

    An array has no built-in way to a sparse vector, but a JSON reader makes one from
    the vector's own layout.
    """
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", F.col("n").cast("double").alias("n")))
    packed = entries.groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    layout = F.struct(
        F.lit(0).alias("type"),
        F.lit(size).alias("size"),
        F.col("_entries.idx").alias("indices"),
        F.col("_entries.n").alias("values"),
    )
    holder = T.StructType([T.StructField("features", VectorUDT())])
    parsed = F.from_json(F.to_json(F.struct(layout.alias("features"))), holder)
    return packed.select("id", parsed["features"].alias("features"))


def count_vectors(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Term counts over a vocabulary, whose number of terms is the vector size.

    Terms of very many communities are joined apart from the others, and null terms not at all.
    """
    known = vocab.select(F.col("term").alias("_term"), "idx", "documents")
    entries = lookup_join(counts.filter(F.col("term").isNotNull()), known, "term", "_term", "documents")
    empty = counts.filter(F.col("term").isNull()).select("id", F.lit(None).cast("int").alias("idx"), "n")
    return _vectors(entries.select("id", "idx", "n").unionByName(empty), vocab.count())


def term_buckets(term: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """Add ``idx``, the hash bucket of ``term``."""
    hashing = HashingTF(inputCol="_terms", outputCol="_hashed", numFeatures=buckets)
    single = F.when(F.col("term").isNotNull(), F.array("term")).otherwise(
        F.array().cast("array<string>")
    )
    hashed = hashing.transform(term.withColumn("_terms", single))
    return hashed.withColumn("idx", F.get(F.unwrap_udt("_hashed")["indices"], 0)).drop(
        "_terms", "_hashed"
    )


def hashed_vectors(counts: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """Term counts over hash buckets; terms that share a bucket are added up."""
    bucketed = term_buckets(counts, buckets).groupBy("id", "idx").agg(F.sum("n").alias("n"))
    return _vectors(bucketed, buckets)


def terms_of(indices: DataFrame, vocab: DataFrame, index: str = "idx") -> DataFrame:
    """Add ``term`` for a term index."""
    lookup = small_side(vocab.select(F.col("idx").alias(index), "term"))
    return indices.join(lookup, index, "left")
