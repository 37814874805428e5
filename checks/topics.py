"""Bags of words, and topic models by those of their properties that SQL can state."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDAModel
from pyspark.sql import DataFrame, functions as F

from checks import tables as t
from checks.registry import query
from forumlens.functions import text
from forumlens.operators import lemmas, terms, topic_tables, topics
from forumlens.session import materialise

COUNTS_SQL = (
    "(SELECT id, term, count(*) AS n FROM (SELECT id, unnest("
    + t.single_tokens_sql("comments", t.ASCII_TEST)
    + f") AS term FROM {t.COMMENTS_LANG_SQL}) GROUP BY id, term)"
)
VOCABULARY_SQL = (
    "(SELECT CAST(row_number() OVER (ORDER BY n DESC, term) - 1 AS INTEGER) AS idx, term, n, documents FROM "
    f"(SELECT term, CAST(sum(n) AS BIGINT) AS n, count(*) AS documents FROM {COUNTS_SQL} "
    "GROUP BY term))"
)

_fitted: dict[tuple, object] = {}


def _once(spark, sf: str, name: str, make):
    """Fitted models and written tables are shared by the queries of one session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _fitted:
        _fitted[key] = make()
    return _fitted[key]


def _tokens():
    return text.ascii_tokens(F.col("comments"), split_compound=True)


def _counts(spark, sf) -> DataFrame:
    return _once(
        spark,
        sf,
        "counts",
        lambda: materialise(terms.term_counts(t.comment_texts(spark, sf, True), _tokens()), "counts"),
    )


def _vocabulary(spark, sf) -> DataFrame:
    return _once(spark, sf, "vocabulary", lambda: terms.vocabulary(_counts(spark, sf)))


def _vectors(spark, sf) -> DataFrame:
    def make():
        return materialise(
            terms.count_vectors(_counts(spark, sf), _vocabulary(spark, sf)), "vectors"
        )

    return _once(spark, sf, "vectors", make)


def _model(spark, sf) -> LDAModel:
    return _once(spark, sf, "online", lambda: topics.fit_topics(_vectors(spark, sf)))


def _distributions(spark, sf) -> DataFrame:
    return topics.distributions(_model(spark, sf), _vectors(spark, sf))


@query(f"SELECT id, term, n FROM {COUNTS_SQL}")
def term_counts(spark, sf) -> DataFrame:
    counts = terms.term_counts(t.comment_texts(spark, sf, True), _tokens())
    return counts.filter(F.col("term").isNotNull())


@query(f"SELECT idx, term, n, documents FROM {VOCABULARY_SQL}")
def vocabulary(spark, sf) -> DataFrame:
    return terms.vocabulary(terms.term_counts(t.comment_texts(spark, sf, True), _tokens()))


@query(f"SELECT idx, term, n, documents FROM {VOCABULARY_SQL} WHERE idx < 1000")
def vocabulary_of_1000(spark, sf) -> DataFrame:
    """The most frequent terms by shared counters first, a top-k report."""
    return terms.vocabulary(_counts(spark, sf), 1000)


@query(
    f"SELECT c.id, v.idx, CAST(c.n AS DOUBLE) AS n FROM {COUNTS_SQL} c "
    f"JOIN {VOCABULARY_SQL} v ON v.term = c.term"
)
def count_vectors(spark, sf) -> DataFrame:
    """The entries of the vectors."""
    raw = F.unwrap_udt("features")
    entries = F.explode(F.arrays_zip(raw["indices"].alias("idx"), raw["values"].alias("n")))
    return _vectors(spark, sf).select("id", entries.alias("e")).select("id", "e.idx", "e.n")


@query(f"SELECT id, CAST(sum(n) AS DOUBLE) AS total FROM {COUNTS_SQL} GROUP BY id")
def hashed_totals(spark, sf) -> DataFrame:
    raw = F.unwrap_udt("features")["values"]
    total = F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)
    hashed = terms.hashed_vectors(_counts(spark, sf))
    return hashed.select("id", total.alias("total")).filter(F.col("total") > 0)


@query(
    "SELECT id, CAST(sum(n) AS DOUBLE) AS total, true AS distinct_buckets, true AS fits "
    f"FROM {COUNTS_SQL} GROUP BY id"
)
def hashed_vectors(spark, sf) -> DataFrame:
    """Counts add up, buckets ascend within their range, and terms share buckets or have their own."""
    counts = _counts(spark, sf)
    raw = F.unwrap_udt("features")
    total = F.aggregate(raw["values"], F.lit(0.0), lambda a, b: a + b)
    own = counts.groupBy("id").agg(F.count("term").alias("terms"))
    rows = terms.hashed_vectors(counts).select("id", total.alias("total"), raw["indices"].alias("buckets"))
    rows = rows.join(own, rows["id"].eqNullSafe(own["id"])).drop(own["id"]).filter("total > 0")
    return rows.select(
        "id",
        "total",
        (F.array_sort(F.array_distinct("buckets")) == F.col("buckets")).alias("distinct_buckets"),
        (
            (F.size("buckets") <= F.col("terms")) & (F.array_max("buckets") < terms.HASH_BUCKETS)
        ).alias("fits"),
    )


@query(
    f"SELECT e.vec_id, v.term FROM embeddings e LEFT JOIN {VOCABULARY_SQL} v ON v.idx = e.vec_id"
)
def term_lookup(spark, sf) -> DataFrame:
    """Words for term indices."""
    indices = t.table(spark, sf, "embeddings").select("vec_id", F.col("vec_id").alias("idx"))
    return terms.terms_of(indices, _vocabulary(spark, sf)).select("vec_id", "term")


_ENDINGS_SQL = "\n UNION ALL ".join(
    f"SELECT word, {i}, left(word, length(word) - {len(old)}) || '{new}' "
    f"FROM words WHERE ends_with(word, '{old}')"
    for i, (old, new) in enumerate(
        (
            ("s", ""),
            ("ses", "s"),
            ("ves", "f"),
            ("xes", "x"),
            ("zes", "z"),
            ("ches", "ch"),
            ("shes", "sh"),
            ("men", "man"),
            ("ies", "y"),
        ),
        1,
    )
)


@query(
    f"""WITH counts AS (SELECT * FROM {COUNTS_SQL}),
 words AS (SELECT term AS word, sum(n) AS n FROM counts GROUP BY term),
 forms(word, pos, form) AS (SELECT word, 0, word FROM words UNION ALL {_ENDINGS_SQL}),
 lemmas AS (SELECT word, first(form ORDER BY length(form), pos) AS lemma FROM forms
   WHERE form IN (SELECT word FROM words) GROUP BY word)
 SELECT c.id, l.lemma AS term, CAST(sum(c.n) AS BIGINT) AS n
 FROM counts c JOIN lemmas l ON l.word = c.term GROUP BY c.id, l.lemma"""
)
def lemma_counts(spark, sf) -> DataFrame:
    """Lemmas on counted terms, with no text put together again."""
    counts = _counts(spark, sf).filter(F.col("term").isNotNull())
    words = counts.groupBy(F.col("term").alias("word")).agg(F.sum("n").alias("n"))
    return lemmas.lemmatise_counts(counts, lemmas.lemma_table(words))


# -- models ----------------------------------------------------------------------------------


def _valid(distribution: str = "topicDistribution"):
    """Ten probabilities that sum to 1, or all zero."""
    total = F.aggregate(distribution, F.lit(0.0), lambda a, b: a + b)
    inside = F.forall(distribution, lambda p: (p >= 0) & (p <= 1))
    return (F.size(distribution) == 10) & inside & ((F.abs(total - 1) < 1e-6) | (total == 0))


@query(f"SELECT DISTINCT id, true AS valid FROM {t.COMMENTS_LANG_SQL}")
def topic_distributions(spark, sf) -> DataFrame:
    """Online variational topics over communities."""
    return _distributions(spark, sf).select("id", _valid().alias("valid"))


@query(f"SELECT DISTINCT id, CAST(1 AS DOUBLE) AS total, 10 AS topics FROM {COUNTS_SQL}")
def topic_distribution_sums(spark, sf) -> DataFrame:
    """Each distribution sums to 1, or to 0 without terms, which is left out here."""
    total = F.aggregate("topicDistribution", F.lit(0.0), lambda a, b: a + b)
    sums = _distributions(spark, sf).select(
        "id", F.round(total, 6).alias("total"), F.size("topicDistribution").alias("topics")
    )
    return sums.filter(F.col("total") > 0)


@query(f"SELECT DISTINCT id, true AS right FROM {t.COMMENTS_LANG_SQL}")
def dominated_communities(spark, sf) -> DataFrame:
    """Kept exactly where a topic has more than 0.7, under the number of that topic."""
    scored = _distributions(spark, sf)
    kept = topics.assigned(topics.dominated(scored)).select(F.col("id").alias("kept"), "assignment")
    both = scored.join(kept, F.col("id").eqNullSafe(F.col("kept")), "left")
    above = F.array_max("topicDistribution") > 0.7
    topic = F.array_position("topicDistribution", F.array_max("topicDistribution"))
    right = F.when(above, F.col("assignment") == topic).otherwise(F.col("assignment").isNull())
    return both.select("id", F.coalesce(right, F.lit(False)).alias("right"))


TOPIC_WORDS_SQL = (
    "SELECT topic, CAST(10 AS BIGINT) AS terms, CAST(10 AS BIGINT) AS known, true AS falling "
    "FROM (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS topic)"
)


def _words_shape(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Of each topic the number of different terms, of those in the vocabulary, and their order."""
    falling = F.sort_array("term_weight", asc=False) == F.col("term_weight")
    exploded = words.select("topic", falling.alias("falling"), F.explode("term_words").alias("term"))
    known = vocab.select("term", F.lit(1).alias("known"))
    return (
        exploded.distinct()
        .join(known, "term", "left")
        .groupBy("topic")
        .agg(
            F.count("*").alias("terms"),
            F.count("known").alias("known"),
            F.bool_and("falling").alias("falling"),
        )
    )


@query(TOPIC_WORDS_SQL)
def topic_words(spark, sf) -> DataFrame:
    vocab = _vocabulary(spark, sf)
    return _words_shape(topics.topic_words(_model(spark, sf), vocab), vocab)


@query(
    "SELECT topic, CAST(3 AS BIGINT) AS pairs, true AS falling "
    "FROM (SELECT CAST(unnest(range(1, 11)) AS BIGINT) AS topic)"
)
def top_term_pairs(spark, sf) -> DataFrame:
    words = topics.topic_words(_model(spark, sf), _vocabulary(spark, sf))
    falling = F.sort_array("dists.prob", asc=False) == F.col("dists.prob")
    return topics.leading_pairs(words).select(
        F.col("topic_num").cast("long").alias("topic"),
        F.size("dists").cast("long").alias("pairs"),
        falling.alias("falling"),
    )


@query(
    f"SELECT topic, (SELECT count(*) FROM {VOCABULARY_SQL}) AS terms, CAST(1 AS DOUBLE) AS total "
    "FROM (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS topic)"
)
def topic_term_matrix(spark, sf) -> DataFrame:
    matrix = topics.topic_term_matrix(_model(spark, sf), _vocabulary(spark, sf))
    return matrix.groupBy("topic").agg(
        F.count_distinct("term").alias("terms"), F.round(F.sum("weight"), 6).alias("total")
    )


@query(
    "SELECT count(DISTINCT id) AS communities, true AS valid, true AS widest_first "
    f"FROM {t.COMMENTS_LANG_SQL}"
)
def layout(spark, sf) -> DataFrame:
    """Every community once, on a topic, at a finite place, and spread out along x most."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e300) for c in "xy"]
    placed = F.col("assignment").between(0, 10) & finite[0] & finite[1]
    return topics.layout(_distributions(spark, sf)).agg(
        F.count_distinct("id").alias("communities"),
        F.bool_and(placed).alias("valid"),
        (F.var_samp("x") >= F.var_samp("y")).alias("widest_first"),
    )


@query(TOPIC_WORDS_SQL)
def topics_em(spark, sf) -> DataFrame:
    """Expectation-maximisation topics."""
    model = topics.fit_topics(_vectors(spark, sf), optimizer="em", iterations=20)
    vocab = _vocabulary(spark, sf)
    return _words_shape(topics.topic_words(model, vocab), vocab)


# -- models whose state is a table by term ---------------------------------------------------


def _tables(spark, sf) -> topic_tables.TopicTables:
    return _once(spark, sf, "tables", lambda: topic_tables.fit_topic_tables(_counts(spark, sf), rounds=5))


@query(TOPIC_WORDS_SQL)
def table_topic_words(spark, sf) -> DataFrame:
    return _words_shape(_tables(spark, sf).words(), _vocabulary(spark, sf))


@query(
    f"SELECT topic, (SELECT count(*) FROM {VOCABULARY_SQL}) AS terms, CAST(1 AS DOUBLE) AS total "
    "FROM (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS topic)"
)
def table_topic_matrix(spark, sf) -> DataFrame:
    """Every topic's weights over the whole vocabulary, which never passes through the driver."""
    return _tables(spark, sf).matrix().groupBy("topic").agg(
        F.count("term").alias("terms"), F.round(F.sum("weight"), 6).alias("total")
    )


@query(f"SELECT DISTINCT id, true AS valid FROM {t.COMMENTS_LANG_SQL}")
def table_topic_distributions(spark, sf) -> DataFrame:
    return _tables(spark, sf).scores(_counts(spark, sf), rounds=3).select("id", _valid().alias("valid"))


@query(
    "SELECT lang, true AS pure FROM documents WHERE regexp_matches(text, '[a-z]') AND lang IS NOT NULL GROUP BY lang"
)
def planted_topics(spark, sf) -> DataFrame:
    """Languages as planted topics: words carry their language, so that no two languages share one.

    Each language has a topic whose ten heaviest terms are all its own.
    """
    words = F.regexp_extract_all("text", F.lit("[a-z]{1,3}"), F.lit(0))
    marked = F.transform(words, lambda w: F.concat("lang", F.lit("/"), F.substring(w, F.lit(1), F.lit(2))))
    rows = t.table(spark, sf, "documents").filter("lang IS NOT NULL").select("doc_id", "lang", marked.alias("words"))
    community = F.concat("lang", F.lit("/"), (F.col("doc_id") % 10).cast("string"))
    counts = terms.term_counts(rows.withColumn("community", community), F.col("words"), "community")
    model = topic_tables.fit_topic_tables(counts, k=8, rounds=12)
    top = model.words(10).select("topic", F.explode("term_words").alias("term"))
    langs = F.array_distinct(F.collect_list(F.substring_index("term", "/", 1)))
    pure = top.groupBy("topic").agg(langs.alias("langs")).filter(F.size("langs") == 1)
    return pure.select(F.col("langs")[0].alias("lang"), F.lit(True).alias("pure")).distinct()


PIPELINE_SQL = "SELECT doc_id AS id, true AS valid, true AS assigned FROM documents"


def _assignments(make, df: DataFrame) -> DataFrame:
    model: PipelineModel = make.fit(df)
    rows = topics.assigned(topics.distributions(model, df))
    return rows.select(
        "id", _valid().alias("valid"), F.col("assignment").between(0, 10).alias("assigned")
    )


def _texts(spark, sf) -> DataFrame:
    documents = t.texts(spark, sf)
    return documents.select(F.col("doc_id").alias("id"), F.col("text").alias("comments"))


@query(PIPELINE_SQL)
def hashed_topics(spark, sf) -> DataFrame:
    return _assignments(topics.hashing_pipeline(), _texts(spark, sf))


@query(PIPELINE_SQL)
def counted_topics(spark, sf) -> DataFrame:
    texts = _texts(spark, sf).withColumn("comments", _tokens())
    return _assignments(topics.counting_pipeline(), texts)


@query(PIPELINE_SQL)
def regex_topics(spark, sf) -> DataFrame:
    return _assignments(topics.regex_pipeline(), _texts(spark, sf))


@query(TOPIC_WORDS_SQL)
def regex_topic_words(spark, sf) -> DataFrame:
    """Stages are taken from the fitted pipeline by their type."""
    model = topics.regex_pipeline().fit(_texts(spark, sf))
    vocab = topics.vocabulary_of(model)
    return _words_shape(topics.topic_words(topics.topics_of(model), vocab), vocab)
