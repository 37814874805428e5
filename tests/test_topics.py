from __future__ import annotations

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, HashingTF
from pyspark.sql import functions as F

from checks import tables as t
from forumlens.functions import text
from forumlens.functions.wordlists import NOUN_ENDINGS
from forumlens.operators import cleaning, lemmas, terms, topics
from forumlens.session import materialise

ROWS = [
    ("a", ["x", "y", "x", "z"], 1),
    ("a", ["x", "w"], 2),
    ("b", ["y"], 3),
    ("b", [], 4),
    ("c", [], 5),
    ("d", None, 6),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id string, comments array<string>, key long")


@pytest.fixture(scope="module")
def counts(rows):
    return materialise(terms.term_counts(rows, F.col("comments")), "counts")


def test_term_counts_keep_communities_without_terms(counts):
    found = {(r["id"], r["term"]): r["n"] for r in counts.collect()}
    assert found[("a", "x")] == 3
    assert found[("c", None)] == found[("d", None)] == 0
    assert {k for k in found if k[1]} == {("a", c) for c in "xyzw"} | {("b", "y")}


def test_vocabulary_order_size_and_minimum(counts):
    def listed(**kw):
        return [(r["idx"], r["term"]) for r in terms.vocabulary(counts, **kw).orderBy("idx").collect()]

    assert listed() == [(0, "x"), (1, "y"), (2, "w"), (3, "z")]
    assert listed(size=2) == [(0, "x"), (1, "y")]
    assert listed(min_documents=2) == [(0, "y")]


@pytest.mark.parametrize("buckets", [1, 7, 64, terms.COUNT_BUCKETS])
def test_frequent_terms_are_those_of_the_full_count(spark, buckets):
    """Shared counters leave out no term, ties, few terms and a minimum of documents included."""
    rng = np.random.default_rng(8)
    rows = [(f"c{rng.integers(9)}", f"t{int(x)}", int(rng.integers(1, 4))) for x in rng.zipf(1.3, 1500) % 400]
    table = spark.createDataFrame([*rows, ("c0", None, 0)], "id string, term string, n long")
    table = materialise(table.groupBy("id", "term").agg(F.sum("n").alias("n")), "counts")
    known = table.filter("term IS NOT NULL")
    for size, least in ((1, 1), (10, 1), (10, 5), (60, 2), (1000, 1)):
        full = [tuple(r) for r in terms.vocabulary(table, min_documents=least).orderBy("idx").limit(size).collect()]
        found = terms._frequent(known, size, least, buckets)
        best = found.orderBy(F.desc("n"), "term").limit(size).collect()
        assert [(k, r["term"], r["n"], r["documents"]) for k, r in enumerate(best)] == full
        if buckets > 64 and size == 1:
            assert found.count() < 10
    assert [tuple(r) for r in terms.vocabulary(table, 10, 5).orderBy("idx").collect()] == [
        tuple(r) for r in terms.vocabulary(table, min_documents=5).orderBy("idx").limit(10).collect()
    ]


def grouped(rows):
    """One array per community, as a vectoriser wants it; small fixtures only."""
    whole = F.flatten(F.collect_list(F.coalesce("comments", F.array().cast("array<string>"))))
    return rows.groupBy("id").agg(whole.alias("comments"))


def as_dict(vector):
    return dict(zip(vector.indices.tolist(), vector.values.tolist()))


def test_count_vectors_agree_with_the_ml_stage(rows, counts):
    vocab = materialise(terms.vocabulary(counts), "vocab")
    names = {r["idx"]: r["term"] for r in vocab.collect()}
    own = {
        r["id"]: {names[i]: n for i, n in as_dict(r["features"]).items()}
        for r in terms.count_vectors(counts, vocab).collect()
    }
    model = CountVectorizer(inputCol="comments", outputCol="f").fit(grouped(rows))
    ml = {
        r["id"]: {model.vocabulary[i]: n for i, n in as_dict(r["f"]).items()}
        for r in model.transform(grouped(rows)).collect()
    }
    assert own == ml
    assert own["c"] == {}
    assert all(r["features"].size == 4 for r in terms.count_vectors(counts, vocab).collect())


@pytest.mark.parametrize("buckets", [terms.HASH_BUCKETS, 3])
def test_hashed_vectors_agree_with_the_ml_stage(rows, counts, buckets):
    own = {r["id"]: r["features"] for r in terms.hashed_vectors(counts, buckets).collect()}
    stage = HashingTF(inputCol="comments", outputCol="f", numFeatures=buckets)
    ml = {r["id"]: r["f"] for r in stage.transform(grouped(rows)).collect()}
    assert own == ml


# -- lemmas ----------------------------------------------------------------------------------


def lemma_reference(word, known, exceptions=None):
    """The rules as published, one round after another."""

    def shorter(forms):
        return [
            f[: len(f) - len(old)] + new
            for f in forms
            for old, new in NOUN_ENDINGS
            if f.endswith(old)
        ]

    if exceptions and word in exceptions:
        found = [f for f in [word, *exceptions[word]] if f in known]
        return min(found, key=len) if found else word
    forms = shorter([word])
    found = [f for f in [word, *forms] if f in known]
    while not found and forms:
        forms = shorter(forms)
        found = [f for f in forms if f in known]
    return min(found, key=len) if found else word


WORDS = (
    "cats cat dogs boxes box wolves wolf churches church wishes wish men man women woman ladies "
    "lady glasses glass us bus buses as classs classss zzzs quizzes buzzes feet foot children s ss "
    "sss mens asses omens abcses leaves leaf leave sssssssssssss possesses zeses"
).split()


# All words of these letters up to a length have every chain of endings among them.
CHAINS = ["".join(w) for n in range(1, 7) for w in product("esxvin", repeat=n) if w[-1] in "sn"]
CHAINS += [f"{w}{end}" for w in ("ch", "sh", "me", "h", "men", "c") for n in range(5) for end in map("".join, product("es", repeat=n))]


def words_table(spark, words=WORDS):
    counted = Counter(words)
    return spark.createDataFrame([(w, n) for w, n in counted.items()], "word string, n long")


DICTIONARIES = {
    "own words": None,
    "nouns": "cat dog box wolf church wish man woman lady glass bus class quiz leaf".split(),
    "stems": "clas z qui abc mensch".split(),
}


@pytest.mark.parametrize("name", DICTIONARIES)
@pytest.mark.parametrize("irregular", [False, True])
def test_lemma_table_follows_the_rules(spark, name, irregular):
    known = DICTIONARIES[name]
    dictionary = spark.createDataFrame([(w,) for w in known], "word string") if known else None
    pairs = [("feet", "foot"), ("children", "child"), ("men", "man"), ("cats", "wolf")]
    exceptions = spark.createDataFrame(pairs, "word string, lemma string") if irregular else None
    table = lemmas.lemma_table(words_table(spark), dictionary, exceptions)
    found = {r["word"]: r["lemma"] for r in table.collect()}
    by_word = {w: [l] for w, l in pairs} if irregular else None
    assert found == {w: lemma_reference(w, set(known or WORDS), by_word) for w in set(WORDS)}


def test_a_word_in_the_dictionary_needs_no_further_round(spark):
    """Its forms are not made, however long its run of letters that the rules take off."""
    long = "s" * 300_000
    table = lemmas.lemma_table(words_table(spark, [long, "cats", "cat"]))
    found = {r["word"]: r["lemma"] for r in table.collect()}
    assert found == {long: long, "cats": "cat", "cat": "cat"}


TOKEN_ROWS = [
    (1, ["cats", "boxes,men", "dog", "zebra"]),
    (2, []),
    (3, ["ladies"] * 30 + ["wolves,cats,x"]),
    (4, ["unchanged", "words"]),
    (5, None),
]


@pytest.mark.parametrize("seed", range(3))
def test_lemmas_of_all_chains(spark, seed):
    rng = random.Random(seed)
    short = {"".join(w) for n in range(0, 5) for w in product("esxvinfy", repeat=n)}
    known = sorted(rng.sample(sorted(short), 400)) + ["ch", "shs", "man", "mane", "mans", "he", "c"]
    dictionary = spark.createDataFrame([(w,) for w in known], "word string")
    table = lemmas.lemma_table(words_table(spark, CHAINS), dictionary)
    found = {r["word"]: r["lemma"] for r in table.collect()}
    assert found == {w: lemma_reference(w, set(known)) for w in set(CHAINS)}


def test_long_words_with_a_dictionary(spark):
    """The work is linear in a word's length."""
    words = ["b" + "s" * 300_000, "x" + "es" * 150_000, "lad" + "ies" + "s" * 300_000, "cats"]
    dictionary = spark.createDataFrame([("b",), ("x",), ("lady",), ("cat",), ("bsss",)], "word string")
    found = {r["word"]: r["lemma"] for r in lemmas.lemma_table(words_table(spark, words), dictionary).collect()}
    assert [found[w] for w in words] == ["bsss", "x", "lady", "cat"]


@pytest.mark.parametrize("max_rows", [1000, 3, 1])
def test_lemmatised_tokens_by_function_and_by_join(spark, max_rows):
    nouns = spark.createDataFrame([(w,) for w in DICTIONARIES["nouns"]], "word string")
    table = lemmas.lemma_table(words_table(spark, WORDS + ["cats"] * 50), nouns)
    known = {r["word"]: r["lemma"] for r in table.collect()}
    df = spark.createDataFrame(TOKEN_ROWS, "key long, comments array<string>")
    done = lemmas.lemmatise_tokens(df, "comments", table, max_rows=max_rows)
    assert done.columns == df.columns
    found = {r["key"]: r["comments"] for r in done.collect()}

    def lemma(token):
        return ",".join(known.get(w, w) for w in token.split(","))

    for key, tokens in TOKEN_ROWS:
        assert found[key] == (None if tokens is None else [lemma(token) for token in tokens])


@pytest.mark.parametrize("max_rows", [1000, 1])
def test_lemmas_do_not_need_a_key(spark, max_rows):
    table = lemmas.lemma_table(words_table(spark, ["cats", "dogs", "cat", "dog"]))
    rows = [(None, ["cats"]), (1, ["dogs"]), (1, ["cats,dogs"]), (None, None)]
    df = spark.createDataFrame(rows, "key long, comments array<string>")
    done = lemmas.lemmatise_tokens(df, "comments", table, max_rows=max_rows).collect()
    assert sorted(map(str, (r["comments"] for r in done))) == ["None", "['cat']", "['cat,dog']", "['dog']"]


@pytest.mark.parametrize("max_rows", [1000, 2])
def test_lemma_counts_add_up(spark, max_rows):
    counts = spark.createDataFrame(
        [("a", "cats", 2), ("a", "cat", 1), ("b", "cats", 5), ("b", "box", 1), ("c", None, 0)],
        "id string, term string, n long",
    )
    table = lemmas.lemma_table(words_table(spark))
    rows = lemmas.lemmatise_counts(counts, table, max_rows).collect()
    assert {(r["id"], r["term"]): r["n"] for r in rows} == {
        ("a", "cat"): 3,
        ("b", "cat"): 5,
        ("b", "box"): 1,
        ("c", None): 0,
    }


def test_clean_text_without_any_change(spark):
    df = spark.createDataFrame([(1, "Alpha beta"), (2, None)], "key long, comments string")
    rows = {r["key"]: r["comments"] for r in cleaning.clean_text(df).collect()}
    assert rows == {1: "alpha beta", 2: ""}


# -- models ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def fitted(spark, small):
    tokens = text.ascii_tokens(F.col("comments"), split_compound=True)
    comments = t.comment_texts(spark, small).unionByName(
        spark.createDataFrame([("silent", "", 0, -1)], "id string, comments string, ups long, key long")
    )
    counts = materialise(terms.term_counts(comments, tokens), "counts")
    vocab = materialise(terms.vocabulary(counts, 5000), "vocab")
    vectors = materialise(terms.count_vectors(counts, vocab), "vectors")
    return topics.fit_topics(vectors, k=4, iterations=3), vocab, vectors


def test_distributions_sum_to_one_or_are_zero(fitted):
    model, _, vectors = fitted
    rows = topics.assigned(topics.distributions(model, vectors)).collect()
    assert len(rows) == 21
    for row in rows:
        total = sum(row["topicDistribution"])
        if row["id"] == "silent":
            assert total == 0 and row["assignment"] == 0
        else:
            assert total == pytest.approx(1) and 1 <= row["assignment"] <= 4


def test_same_seed_gives_the_same_topics(fitted):
    model, _, vectors = fitted
    again = topics.fit_topics(vectors, k=4, iterations=3)
    first, second = (
        {r["id"]: [round(p, 4) for p in r["topicDistribution"]] for r in topics.distributions(m, vectors).collect()}
        for m in (model, again)
    )
    assert first == second


def test_topic_words_and_matrix(fitted):
    model, vocab, _ = fitted
    terms_in = {r["term"] for r in vocab.collect()}
    words = topics.topic_words(model, vocab, 7).collect()
    assert [r["topic"] for r in sorted(words, key=lambda r: r["topic"])] == [0, 1, 2, 3]
    for row in words:
        assert len(row["term_words"]) == len(row["term_weight"]) == 7
        assert set(row["term_words"]) <= terms_in
        assert row["term_weight"] == sorted(row["term_weight"], reverse=True)
    matrix = topics.topic_term_matrix(model, vocab)
    assert matrix.count() == 4 * vocab.count()
    sums = matrix.groupBy("topic").agg(F.sum("weight").alias("w")).collect()
    assert all(r["w"] == pytest.approx(1) for r in sums)


def test_layout_and_nesting(fitted):
    model, _, vectors = fitted
    points = materialise(topics.layout(topics.distributions(model, vectors)), "points")
    assert points.columns == ["id", "assignment", "x", "y"]
    assert points.count() == 21
    nested = topics.nested_layout(points, 4).collect()
    assert sorted({r["assignment"] for r in nested}) == [1, 2, 3, 4]
    assert sum(len(r["data"]) for r in nested) == 20  # the silent community is in no topic
    split = topics.nested_layout(points, 4, part_points=3).collect()
    assert len(split) > len(nested)
    assert sorted(p["id"] for r in split for p in r["data"]) == sorted(
        p["id"] for r in nested for p in r["data"]
    )
    joined = topics.points_with_topics(points, 4)
    assert joined.filter(F.col("id").isNotNull()).count() == 20


def test_em_topics(fitted):
    _, vocab, vectors = fitted
    model = topics.fit_topics(vectors, k=3, iterations=2, optimizer="em")
    assert model.isDistributed()
    assert topics.topic_words(model, vocab).count() == 3


@pytest.mark.parametrize("name", ["hashing", "counting", "regex"])
def test_pipelines(spark, small, name):
    texts = t.table(spark, small, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("comments")
    )
    if name == "counting":
        texts = texts.withColumn("comments", text.ascii_tokens(F.col("comments")))
    size = {"buckets": 1000} if name == "hashing" else {"size": 500}
    pipeline = getattr(topics, f"{name}_pipeline")(k=3, iterations=1, **size)
    model = pipeline.fit(texts)
    assert isinstance(topics.topics_of(model), LDAModel)
    assert topics.distributions(model, texts).count() == texts.count()
    if name != "hashing":
        assert topics.fitted_stage(model, CountVectorizerModel)
        words = topics.topic_words(topics.topics_of(model), topics.vocabulary_of(model))
        assert all(None not in r["term_words"] for r in words.collect())


def test_lemmas_beyond_the_byte_bound(spark):
    rows = [(1, ["cats", None, "cats,dog", "", "x"]), (2, []), (3, None), (4, ["cats"] * 3), (5, [None]), (6, ["x", "dog,cats"])]
    df = spark.createDataFrame(rows, "id int, comments array<string>")
    table = spark.createDataFrame([("cats", 9, "cat"), ("x", 2, "x")], "word string, n long, lemma string")
    want = [(1, ["cat", None, "cat,dog", "", "x"]), (2, []), (3, None), (4, ["cat"] * 3), (5, [None]), (6, ["x", "dog,cat"])]
    joined = lemmas.lemmatise_tokens(df, "comments", table, max_bytes=6)  # cats and cat have 7
    assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, joined.collect())) == want


def test_lemmas_of_a_row_of_a_million_words(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(1_000_000)), lambda i: F.concat(F.lit("w"), i.cast("string"), F.lit("s")))
    df = spark.range(1).select("id", words.alias("comments"))
    word = F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("s"))
    lemma = F.when(F.col("id") % 2 == 0, F.concat(F.lit("w"), F.col("id").cast("string"))).otherwise(word)
    table = spark.range(1, 1_000_001).select(word.alias("word"), F.lit(1).cast("long").alias("n"), lemma.alias("lemma"))
    done = lemmas.lemmatise_tokens(df, "comments", table).select(F.size("comments"), F.slice("comments", 999_997, 4)).first()
    assert list(done) == [1_000_000, ["w999997s", "w999998", "w999999s", "w1000000"]]


@pytest.mark.parametrize("max_rows", [1000, 1])
def test_lemmas_by_small_batches(spark, max_rows):
    """A Python worker holds some copies of a batch: it gets a thousand rows at most, whatever was set before."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 30))
    table = lemmas.lemma_table(words_table(spark, ["cats", "dogs", "cat", "dog"]))
    df = spark.range(3000).select("id", F.array(F.lit("cats"), F.lit("x,dogs")).alias("comments"))
    done = lemmas.lemmatise_tokens(df, "comments", table, max_rows=max_rows)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    assert [tuple(r["comments"]) for r in done.collect()] == [("cat", "x,dog")] * 3000
