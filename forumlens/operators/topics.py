"""Topic models over communities, and the tables made from them."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import (
    PCA,
    HashingTF,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from forumlens.functions.numbers import dominant_topic, four_decimals, largest, topic_number
from forumlens.operators.communities import with_parts
from forumlens.operators.online_topics import TermTopicsModel, TopicEstimator
from forumlens.operators.terms import HASH_BUCKETS, terms_of
from forumlens.operators.vectoriser import TermTableModel, TermVectoriser

TOPICS = 10
WHOLE_VOCABULARY = (1 << 31) - 1  # a vectoriser's largest size, which no vocabulary reaches
ITERATIONS = 10
SEED = 42
DOMINANCE = 0.7
TOP_TERMS = 10
PART_POINTS = 100_000


# -- models ----------------------------------------------------------------------------------


def topic_estimator(
    k: int = TOPICS,
    iterations: int = ITERATIONS,
    seed: int = SEED,
    optimizer: str = "online",
    features: str = "features",
) -> TopicEstimator:
    return TopicEstimator(k, iterations, seed, optimizer, features)


def fit_topics(vectors: DataFrame, **settings) -> TermTopicsModel:
    """Fit on ``id, features``; the weights of the model are a written table by term."""
    return topic_estimator(**settings).fit(vectors)


def distributions(model: LDAModel | PipelineModel, df: DataFrame) -> DataFrame:
    """``id, topicDistribution`` as an array; all zero for a community without terms."""
    if isinstance(model, PipelineModel):
        *before, model = model.stages
        for stage in before:
            df = stage.transform(df).select("id", stage.getOutputCol())
    scored = model.transform(df.select("id", "features"))  # of the columns only what is needed is written
    return scored.select("id", vector_to_array("topicDistribution").alias("topicDistribution"))


class TopicPipeline(Pipeline):
    """A pipeline whose stages are given the column they read and no other: some of them write it."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        *before, last = self.getStages()
        fitted = []
        for stage in before:
            fitted.append(stage.fit(dataset) if isinstance(stage, Estimator) else stage)
            dataset = fitted[-1].transform(dataset).select(stage.getOutputCol())
        return PipelineModel([*fitted, last.fit(dataset)])


def hashing_pipeline(buckets: int = HASH_BUCKETS, **settings) -> Pipeline:
    """Whitespace tokens, hashed counts, topics; over ``id, comments STRING`` rows."""
    return TopicPipeline(
        stages=[
            Tokenizer(inputCol="comments", outputCol="words"),
            HashingTF(inputCol="words", outputCol="features", numFeatures=buckets),
            topic_estimator(**settings),
        ]
    )


def counting_pipeline(size: int = WHOLE_VOCABULARY, **settings) -> Pipeline:
    """Counts over a learnt vocabulary, topics; over ``id, comments ARRAY<STRING>`` rows."""
    return TopicPipeline(
        stages=[
            TermVectoriser("comments", "features", size),
            topic_estimator(**settings),
        ]
    )


def regex_pipeline(size: int = WHOLE_VOCABULARY, min_length: int = 4, **settings) -> Pipeline:
    """Regex tokens, default stop words, counts, topics; over ``id, comments STRING`` rows."""
    return TopicPipeline(
        stages=[
            RegexTokenizer(
                inputCol="comments", outputCol="words", pattern=r"[\W_]+", minTokenLength=min_length
            ),
            StopWordsRemover(inputCol="words", outputCol="filtered"),
            TermVectoriser("filtered", "features", size),
            topic_estimator(**settings),
        ]
    )


def fitted_stage(model: PipelineModel, kind: type):
    """The stage of a given type, wherever it is in the pipeline."""
    return next(stage for stage in model.stages if isinstance(stage, kind))


def topics_of(model: PipelineModel) -> LDAModel:
    return fitted_stage(model, LDAModel)


def vocabulary_of(model: PipelineModel) -> DataFrame:
    """``idx, term`` of a fitted pipeline: the written table of its vectoriser."""
    return fitted_stage(model, TermTableModel).terms.select("idx", "term")


# -- topic terms -----------------------------------------------------------------------------


def topic_terms(model: TermTopicsModel, vocab: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """``topic, position, term, weight``: the heaviest terms of every topic."""
    return terms_of(model.top_terms(n), vocab).select("topic", "position", "term", "weight")


def topic_words(model: TermTopicsModel, vocab: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """``topic, term_words, term_weight`` as arrays of up to ``n`` entries."""
    entries = F.sort_array(F.collect_list(F.struct("position", "term", "weight")))
    grouped = topic_terms(model, vocab, n).groupBy("topic").agg(entries.alias("_entries"))
    return grouped.select(
        "topic",
        F.col("_entries.term").alias("term_words"),
        F.col("_entries.weight").alias("term_weight"),
    )


def topic_term_matrix(model: TermTopicsModel, vocab: DataFrame) -> DataFrame:
    """``topic, term, weight`` for all terms, which need no order for it."""
    return terms_of(model.term_weights(), vocab).select("topic", "term", "weight")


def leading_pairs(words: DataFrame, n: int = 3) -> DataFrame:
    """``topic_num, dists``: the first ``n`` (word, probability) pairs, with four decimals."""
    probabilities = F.transform("term_weight", four_decimals)
    pairs = F.arrays_zip(F.col("term_words").alias("word"), probabilities.alias("prob"))
    return words.select(
        topic_number(F.col("topic")).alias("topic_num"), F.slice(pairs, 1, n).alias("dists")
    )


# -- communities under topics ----------------------------------------------------------------


def dominated(
    df: DataFrame, threshold: float = DOMINANCE, distribution: str = "topicDistribution"
) -> DataFrame:
    """Communities whose largest topic probability is above the threshold, as numbers."""
    return df.filter(largest(F.col(distribution)) > threshold)


def assigned(df: DataFrame, distribution: str = "topicDistribution") -> DataFrame:
    """Add ``assignment``: the 1-based dominant topic, 0 for none."""
    return df.withColumn("assignment", dominant_topic(F.col(distribution)))


def layout(df: DataFrame, distribution: str = "topicDistribution") -> DataFrame:
    """``id, assignment, x, y``: communities on a plane, by principal components."""
    vectors = assigned(df, distribution).withColumn("_vector", array_to_vector(F.col(distribution)))
    model = PCA(k=2, inputCol="_vector", outputCol="_plane").fit(vectors)
    plane: Column = vector_to_array(F.col("_plane"))
    return model.transform(vectors).select(
        "id", "assignment", plane[0].alias("x"), plane[1].alias("y")
    )


def topic_spine(df: DataFrame, topics: int) -> DataFrame:
    return df.sparkSession.range(1, topics + 1).select(F.col("id").alias("assignment"))


def _labelled(df: DataFrame) -> DataFrame:
    label = F.concat(F.lit("Topic "), F.col("assignment").cast("string"))
    return df.withColumn("meta_label", label)


def _without_points(points: DataFrame, topics: int) -> DataFrame:
    used = points.select("assignment").distinct()
    return topic_spine(points, topics).join(used, "assignment", "left_anti")


def points_with_topics(points: DataFrame, topics: int) -> DataFrame:
    """Points joined to their topic group; topics without points stay, topic 0 is left out.

    The groups are a handful of rows and go to the points, so that a topic with most
    of the points is not brought together; an outer join would have to do that.
    """
    joined = points.join(F.broadcast(topic_spine(points, topics)), "assignment")
    return _labelled(
        joined.unionByName(_without_points(points, topics), allowMissingColumns=True)
    )


def nested_layout(points: DataFrame, topics: int, part_points: int = PART_POINTS) -> DataFrame:
    """``assignment, part, meta_label, data``: the points of every topic as nested arrays.

    A row holds up to ``part_points`` points, in the order of their ids.
    """
    kept = points.filter(F.col("assignment").between(1, topics))
    parted = with_parts(kept, "assignment", ["id"], F.lit(1), part_points)
    nested = parted.groupBy("assignment", "part").agg(
        F.sort_array(F.collect_list(F.struct("id", "x", "y"))).alias("data")
    )
    empty = _without_points(points, topics).select(
        "assignment",
        F.lit(0).cast("long").alias("part"),
        F.array().cast(nested.schema["data"].dataType).alias("data"),
    )
    return _labelled(nested.unionByName(empty)).select("assignment", "part", "meta_label", "data")
