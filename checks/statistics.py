"""Projections, groupings, statistics, order, limits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import tables as t
from checks.registry import query
from checks.text import CLEAN_TEXT_SQL
from forumlens.functions import text
from forumlens.operators import cleaning, communities as com, ranking
from forumlens.operators.leaderboards import totals_text

ASCII_LISTS = (
    "(SELECT id, part, key, ups, "
    + t.compound_tokens_sql("comments", t.ASCII_TEST)
    + f" AS tokens FROM {t.PARTS_SQL})"
)


def _raw(spark, sf) -> DataFrame:
    return t.table(spark, sf, "documents")


@query(f"SELECT id, comments, ups, key FROM {t.COMMENTS_SQL}")
def comments_selected(spark, sf) -> DataFrame:
    raw = t.comments(spark, sf).toDF("subreddit", "body", "ups", "name")
    return com.select_comments(raw)


@query(
    "SELECT doc_id, n_chars, CAST(length(text) AS INTEGER) AS chars, "
    "length(text) - n_chars AS diff FROM documents"
)
def derived_columns(spark, sf) -> DataFrame:
    chars = _raw(spark, sf).select("doc_id", "n_chars", F.length("text").alias("chars"))
    return chars.withColumn("diff", F.col("chars") - F.col("n_chars"))


@query(f"SELECT id, key, ups FROM {t.COMMENTS_LANG_SQL} WHERE id = 'src0_en'")
def one_community(spark, sf) -> DataFrame:
    return com.only_community(t.comments(spark, sf, True), "src0_en").select("id", "key", "ups")


@query("SELECT doc_id, lang FROM documents")
def repartitioned(spark, sf) -> DataFrame:
    return _raw(spark, sf).select("doc_id", "lang").repartition(16)


@query("SELECT lang, source FROM documents")
def columns_dropped(spark, sf) -> DataFrame:
    return _raw(spark, sf).drop("doc_id", "text", "n_chars")


# -- community documents ---------------------------------------------------------------------


def _concat_sql(separator: str) -> str:
    return (
        f"SELECT id, part, string_agg(comments, '{separator}' ORDER BY key) AS comments "
        f"FROM {t.PARTS_SQL} GROUP BY id, part"
    )


@query(_concat_sql(" "))
def community_text(spark, sf) -> DataFrame:
    return com.community_text(t.comment_texts(spark, sf))


@query(_concat_sql(", "))
def community_text_comma_space(spark, sf) -> DataFrame:
    return com.community_text(t.comment_texts(spark, sf), ", ")


@query(_concat_sql(","))
def community_text_comma(spark, sf) -> DataFrame:
    return com.community_text(t.comment_texts(spark, sf), ",")


_PARTED_SQL = f"""WITH rows AS (SELECT * FROM {t.COMMENTS_SQL}),
 parted AS (SELECT * FROM {t.parted_sql("rows", 20_000)})
"""


@query(
    _PARTED_SQL
    + " SELECT id, part, string_agg(comments, ' ' ORDER BY key) AS comments "
    "FROM parted GROUP BY id, part"
)
def community_text_in_parts(spark, sf) -> DataFrame:
    """The same text with a part size that makes all communities large."""
    return com.community_text(t.comment_texts(spark, sf), part_chars=20_000)


@query(
    f"SELECT c.id, c.part, string_agg(v.value, ' ' ORDER BY v.key) AS comments FROM "
    f"({CLEAN_TEXT_SQL}) v JOIN {t.PARTS_SQL} c ON c.key = v.key "
    "WHERE v.value <> '' GROUP BY c.id, c.part"
)
def community_clean_text(spark, sf) -> DataFrame:
    """Cleaned with lemmas, empties dropped, one text per community."""
    parted = com.assign_parts(t.comment_texts(spark, sf))
    return com.community_text(cleaning.clean_text(parted), drop_empty=True)


@query(
    "SELECT id, part, "
    "array_to_string(flatten(list(tokens ORDER BY key)), '|') AS comments, "
    f"CAST(len(flatten(list(tokens ORDER BY key))) AS INTEGER) AS size FROM {ASCII_LISTS} GROUP BY id, part"
)
def community_tokens(spark, sf) -> DataFrame:
    parted = com.assign_parts(t.comment_texts(spark, sf))
    tokens = com.community_tokens(cleaning.clean_tokens(parted))
    return tokens.select(
        "id",
        "part",
        F.array_join("comments", "|").alias("comments"),
        F.size("comments").alias("size"),
    )


@query(
    "SELECT id, part, array_to_string(list_transform(list(tokens ORDER BY key), "
    "lambda l: coalesce(array_to_string(l, '|'), '')), '#') AS comments, CAST(count(*) AS INTEGER) AS size "
    f"FROM {ASCII_LISTS} GROUP BY id, part"
)
def community_token_lists(spark, sf) -> DataFrame:
    parted = com.assign_parts(t.comment_texts(spark, sf))
    lists = com.community_token_lists(cleaning.clean_tokens(parted))
    joined = F.transform("comments", lambda tokens: F.array_join(tokens, "|"))
    return lists.select(
        "id", "part", F.array_join(joined, "#").alias("comments"), F.size("comments").alias("size")
    )


@query(
    "SELECT id, "
    + t.joined("arg_min(tokens, key)")
    + " AS comments FROM (SELECT id, key, string_split(comments, ' ') AS tokens "
    f"FROM {t.COMMENTS_SQL}) GROUP BY id"
)
def first_comment_tokens(spark, sf) -> DataFrame:
    first = com.first_comment(t.comments(spark, sf))
    tokens = text.split_single_space(F.col("comments"))
    return first.select("id", F.array_join(tokens, "|").alias("comments"))


@query("SELECT key, array_to_string(flatten(l), '|') AS value FROM (SELECT doc_id AS key, "
       f"list_transform({t.words_sql('text')}, lambda w: string_split(w, '-')) AS l FROM documents)")
def lists_flattened(spark, sf) -> DataFrame:
    nested = F.transform(text.split_whitespace(F.col("text")), lambda w: F.split(w, "-"))
    return _raw(spark, sf).select(
        F.col("doc_id").alias("key"), F.array_join(F.flatten(nested), "|").alias("value")
    )


@query(
    "SELECT id, part, "
    "array_to_string(flatten(list(tokens ORDER BY key)), '|') AS comments, "
    f"CAST(sum(ups) AS BIGINT) AS ups, count(id) AS comm_count FROM {ASCII_LISTS} GROUP BY id, part"
)
def community_documents(spark, sf) -> DataFrame:
    documents = com.community_documents(
        t.comment_texts(spark, sf), text.ascii_tokens(F.col("comments"))
    )
    return documents.withColumn("comments", F.array_join("comments", "|"))


@query(
    _PARTED_SQL
    + ", totals AS (SELECT id, CAST(sum(ups) AS BIGINT) AS ups, count(id) AS comm_count "
    "FROM rows GROUP BY id), lists AS (SELECT id, part, key, "
    + t.compound_tokens_sql("comments", t.ASCII_TEST)
    + " AS tokens FROM parted) SELECT l.id, l.part, "
    "array_to_string(flatten(list(l.tokens ORDER BY l.key)), '|') AS comments, "
    "any_value(o.ups) AS ups, any_value(o.comm_count) AS comm_count "
    "FROM lists l JOIN totals o ON o.id = l.id GROUP BY l.id, l.part"
)
def community_documents_in_parts(spark, sf) -> DataFrame:
    documents = com.community_documents(
        t.comment_texts(spark, sf), text.ascii_tokens(F.col("comments")), part_chars=20_000
    )
    return documents.withColumn("comments", F.array_join("comments", "|"))


# -- statistics ------------------------------------------------------------------------------


@query(f"SELECT id, ups FROM {t.stats_sql(t.COMMENTS_SQL)}")
def ups_per_community(spark, sf) -> DataFrame:
    return com.ups_per_community(t.comments(spark, sf))


@query(f"SELECT id, comm_count FROM {t.stats_sql(t.COMMENTS_SQL)}")
def count_per_community(spark, sf) -> DataFrame:
    return com.count_per_community(t.comments(spark, sf))


@query(f"SELECT * FROM {t.stats_sql()}")
def community_stats(spark, sf) -> DataFrame:
    return com.community_stats(t.comments(spark, sf, True))


@query(
    "SELECT role AS id, CAST(sum(turn) AS BIGINT) AS ups, count(role) AS comm_count "
    "FROM conversations GROUP BY role"
)
def role_stats(spark, sf) -> DataFrame:
    """Three very large communities."""
    turns = t.table(spark, sf, "conversations")
    return com.community_stats(turns.select(F.col("role").alias("id"), F.col("turn").alias("ups")))


@query(
    "SELECT id, part, string_agg(comments, ' ' ORDER BY conv_id, turn) AS comments FROM "
    + t.parted_sql(
        "(SELECT role AS id, text AS comments, conv_id, turn FROM conversations)", order="conv_id, turn"
    )
    + " GROUP BY id, part"
)
def role_text(spark, sf) -> DataFrame:
    turns = t.table(spark, sf, "conversations").select(
        F.col("role").alias("id"), F.col("text").alias("comments"), "conv_id", "turn"
    )
    return com.community_text(turns, keys=["conv_id", "turn"])


@query(f"SELECT id, ups, comm_count, comm_ups_ratio FROM {t.ratio_sql()}")
def comments_per_up(spark, sf) -> DataFrame:
    return com.with_ratio(com.community_stats(t.comments(spark, sf, True)))


@query(
    "SELECT CAST(sum(comm_count) AS BIGINT) AS total_comments, count(*) AS total_communities "
    f"FROM {t.stats_sql()}"
)
def grand_totals(spark, sf) -> DataFrame:
    return com.grand_totals(com.community_stats(t.comments(spark, sf, True)))


@query(
    "SELECT format('{:,}', CAST(sum(comm_count) AS BIGINT)) AS total_comments, "
    f"format('{{:,}}', count(*)) AS total_communities FROM {t.stats_sql()}"
)
def totals_as_text(spark, sf) -> DataFrame:
    return totals_text(com.community_stats(t.comments(spark, sf, True)))


@query("SELECT l_orderkey, format('{:,}', sum(CAST(l_quantity * 1000 AS BIGINT))::BIGINT) AS quantity "
       "FROM lineitem GROUP BY l_orderkey")
def thousands_separated(spark, sf) -> DataFrame:
    from forumlens.functions.numbers import thousands

    totals = t.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum((F.col("l_quantity") * 1000).cast("long")).alias("q")
    )
    return totals.select("l_orderkey", thousands(F.col("q")).alias("quantity"))


# -- limits and samples ----------------------------------------------------------------------


@query(f"SELECT id, key FROM {t.COMMENTS_SQL} ORDER BY key LIMIT 50")
def first_comments(spark, sf) -> DataFrame:
    return ranking.top_rows(t.comments(spark, sf).select("id", "key"), [F.asc("key")], 50)


@query("SELECT page_id, url FROM pages ORDER BY md5('10|' || page_id) LIMIT 100")
def seeded_sample(spark, sf) -> DataFrame:
    pages = t.table(spark, sf, "pages").select("page_id", "url")
    return ranking.seeded_sample(pages, ["page_id"], 100)


@query("SELECT event_id, event_type FROM events ORDER BY md5('10|' || event_id) LIMIT 10000")
def seeded_sample_of_10000(spark, sf) -> DataFrame:
    events = t.table(spark, sf, "events").select("event_id", "event_type")
    return ranking.seeded_sample(events, ["event_id"], 10_000)


@query(
    "SELECT id, n, row_number() OVER (ORDER BY n DESC, id) - 1 AS index FROM "
    f"(SELECT id, count(*) AS n FROM {t.COMMENTS_LANG_SQL} GROUP BY id)"
)
def index_by_frequency(spark, sf) -> DataFrame:
    """Numeric community index, as a long."""
    return ranking.index_by_frequency(t.comments(spark, sf, True))


_CONTENT_SQL = "md5(coalesce(md5(source), '-') || '|' || coalesce(md5(lang), '-'))"


@query(
    "SELECT source, lang FROM (SELECT *, row_number() OVER (PARTITION BY content) AS occurrence FROM "
    f"(SELECT source, lang, {_CONTENT_SQL} AS content FROM documents)) "
    "ORDER BY md5('10|' || content || '|' || occurrence), content, occurrence LIMIT 500"
)
def content_sample(spark, sf) -> DataFrame:
    """A sample of rows that are repeated very often and have no key."""
    return ranking.content_sample(t.table(spark, sf, "documents").select("source", "lang"), 500)
