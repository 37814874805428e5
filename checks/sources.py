"""Round trips: the given tables written in each input format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import tables as t
from checks.registry import query
from forumlens import schemas
from forumlens.operators import cleaning, communities as com, leaderboards as boards
from forumlens.session import scratch_path
from forumlens.sources import readers, writers

_JSON_SQL = """SELECT 't1_' || key AS name, id AS subreddit, comments AS body, ups,
 CAST(1451606400 + key AS VARCHAR) AS created_utc, true AS gilded_absent FROM """ + t.COMMENTS_SQL


def _comment_records(spark, sf) -> DataFrame:
    return t.comments(spark, sf).select(
        F.concat(F.lit("t1_"), F.col("key").cast("string")).alias("name"),
        F.col("id").alias("subreddit"),
        F.col("comments").alias("body"),
        "ups",
        (F.lit(1451606400) + F.col("key")).cast("string").alias("created_utc"),
    )


def _json(spark: SparkSession, records: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    records.write.option("compression", "gzip").json(path)
    return path


@query(_JSON_SQL)
def comments_from_json(spark, sf) -> DataFrame:
    path = _json(spark, _comment_records(spark, sf), "comments-json")
    read = readers.read_comments(spark, path, partitions=8)
    return read.select(
        "name", "subreddit", "body", "ups", "created_utc", F.col("gilded").isNull().alias("gilded_absent")
    )


@query(
    "SELECT 't3_' || conv_id || '_' || turn AS name, role AS subreddit, text AS selftext, "
    "turn AS num_comments, turn = 0 AS is_self, true AS edited_absent FROM conversations"
)
def submissions_from_json(spark, sf) -> DataFrame:
    records = t.table(spark, sf, "conversations").select(
        F.concat(F.lit("t3_"), F.col("conv_id"), F.lit("_"), F.col("turn")).alias("name"),
        F.col("role").alias("subreddit"),
        F.col("text").alias("selftext"),
        F.col("turn").alias("num_comments"),
        (F.col("turn") == 0).alias("is_self"),
    )
    read = readers.read_submissions(spark, _json(spark, records, "submissions-json"))
    return read.select(
        "name",
        "subreddit",
        "selftext",
        "num_comments",
        "is_self",
        F.col("edited").isNull().alias("edited_absent"),
    )


@query(
    "SELECT id, string_agg(comments, ' ' ORDER BY key) AS comments, part FROM "
    f"(SELECT id, part, key, {t.joined(t.plain_tokens_sql('comments'), ' ')} AS comments "
    f"FROM {t.PARTS_SQL}) WHERE comments <> '' GROUP BY id, part"
)
def documents_from_csv(spark, sf) -> DataFrame:
    """Cleaned community texts, written without a header and read back."""
    from forumlens.functions.text import plain_text

    parted = com.assign_parts(t.comment_texts(spark, sf))
    cleaned = parted.withColumn("comments", plain_text(F.col("comments")))
    path = scratch_path(spark, "documents-csv")
    texts = com.community_text(cleaned, drop_empty=True)
    writers.write_csv(texts.select("id", "comments", "part"), path)
    return readers.read_documents(spark, path, schema=schemas.DOCUMENT_PARTS)


@query("SELECT doc_id, text FROM documents")
def raw_texts_from_csv(spark, sf) -> DataFrame:
    """Texts with quotes, commas and line breaks survive the round trip."""
    path = scratch_path(spark, "texts-csv")
    texts = t.table(spark, sf, "documents").select("doc_id", "text")
    writers.write_csv(texts, path)
    return readers.read_documents(spark, path, multiline=True, schema=texts.schema)


@query("SELECT page_id, html AS comment_message FROM pages")
def page_union_from_csv(spark, sf) -> DataFrame:
    """One headered CSV folder per page host, with differing columns, read as one table."""
    pages = t.table(spark, sf, "pages")
    host = F.substring_index(F.split_part("url", F.lit("/"), F.lit(3)), ".", -1)
    message = F.col("html").alias("comment_message")
    layouts = {
        "com": ["url", "page_id", message],
        "net": [message, "page_id"],
        "org": ["page_id", message, "url"],
    }
    paths = []
    for name, columns in layouts.items():
        own = host == name if name != "org" else ~host.isin("com", "net")
        path = scratch_path(spark, f"page-{name}")
        pages.filter(own).select(*columns).write.option("escape", '"').csv(path, header=True)
        paths.append(path)
    read = readers.read_pages(spark, paths, ["page_id", "comment_message"])
    return read.withColumn("page_id", F.col("page_id").cast("long"))


@query(
    "SELECT id, part, "
    + "array_to_string(flatten(list(tokens ORDER BY key)), '|') AS comments, "
    "CAST(sum(ups) AS BIGINT) AS ups, count(id) AS comm_count FROM (SELECT id, part, key, ups, "
    + t.compound_tokens_sql("comments", t.LETTER_TEST)
    + f" AS tokens FROM {t.PARTS_SQL}) GROUP BY id, part"
)
def communities_from_parquet(spark, sf) -> DataFrame:
    from forumlens.functions.text import letter_tokens

    documents = com.community_documents(t.comment_texts(spark, sf), letter_tokens(F.col("comments")))
    path = scratch_path(spark, "communities")
    writers.write_parquet(documents, path)
    read = readers.read_communities(spark, path)
    return read.withColumn("comments", F.array_join("comments", "|"))


_CUT_LINE_SQL = "'{\"name\":\"t1_' || key || '\",\"ups\":'"


@query(
    f"SELECT CASE WHEN ups < 0 THEN {_CUT_LINE_SQL} ELSE 't1_' || key END AS record, "
    "CASE WHEN ups < 0 THEN NULL ELSE ups END AS ups, ups < 0 AS malformed FROM " + t.COMMENTS_SQL
)
def malformed_lines_apart(spark, sf) -> DataFrame:
    """Comments with a negative sum of upvotes are lines that break off."""
    comments = t.comments(spark, sf)
    whole = F.to_json(
        F.struct(
            F.concat(F.lit("t1_"), F.col("key").cast("string")).alias("name"),
            F.col("id").alias("subreddit"),
            F.col("comments").alias("body"),
            "ups",
        )
    )
    cut = F.concat(F.lit('{"name":"t1_'), F.col("key").cast("string"), F.lit('","ups":'))
    path = scratch_path(spark, "lines")
    comments.select(F.when(F.col("ups") < 0, cut).otherwise(whole).alias("value")).write.text(path)
    records, malformed = readers.read_lines_apart(spark, path)
    good = records.select(F.col("name").alias("record"), "ups", F.lit(False).alias("malformed"))
    bad = malformed.select("line", F.lit(None).cast("long"), F.lit(True))
    return good.union(bad)


@query(f"SELECT id, ups, comm_count FROM {t.stats_sql()}")
def published_statistics(spark, sf) -> DataFrame:
    """The second of two published versions is read, whole."""
    directory = scratch_path(spark, "published")
    stats = com.community_stats(t.comments(spark, sf, True))
    writers.publish_tables({"stats": stats.limit(0)}, directory)
    writers.publish_tables({"stats": stats}, directory)
    return writers.published_tables(spark, directory)["stats"].select("id", "ups", "comm_count")


@query(f"SELECT id, comm_ups_ratio FROM {t.ratio_sql()}")
def ratio_board_from_result(spark, sf) -> DataFrame:
    """A result directory of CSV parts, read by its fixed layout."""
    stats = com.with_ratio(com.community_stats(t.comments(spark, sf, True)))
    path = scratch_path(spark, "ratio-board")
    writers.write_csv(boards.by_ratio(stats), path, overwrite=False)
    return readers.read_result(spark, path, schemas.RATIO_BOARD)


@query(
    "SELECT doc_id, "
    + t.joined(t.compound_tokens_sql("text", t.ASCII_TEST))
    + " AS tokens FROM documents"
)
def clean_tokens_from_json(spark, sf) -> DataFrame:
    """Only the body and the key are read from 21 fields."""
    path = _json(spark, _comment_records(spark, sf), "comments-json")
    rows = com.select_comments(readers.read_comments(spark, path), ups=None)
    cleaned = cleaning.clean_tokens(rows)
    return cleaned.select(
        F.substring("key", 4, 20).cast("long").alias("doc_id"),
        F.array_join("comments", "|").alias("tokens"),
    )
