"""The given tables under the names the operators expect, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens.functions.wordlists import ENGLISH_STOP_WORDS, SPACES
from forumlens.sources.readers import spread

STOP = list(ENGLISH_STOP_WORDS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    """A table for text work, spread over all cores as it may come in one split."""
    return spread(table(spark, sf, name))


def comments(spark: SparkSession, sf: str, by_language: bool = False) -> DataFrame:
    """``id, comments, ups, key``; by language there are zero and negative sums of ups."""
    return _comments(spark, sf, table(spark, sf, "documents"), by_language)


def comment_texts(spark: SparkSession, sf: str, by_language: bool = False) -> DataFrame:
    return _comments(spark, sf, texts(spark, sf), by_language)


def _comments(spark, sf: str, documents: DataFrame, by_language: bool) -> DataFrame:
    labels = table(spark, sf, "labels")
    community = F.concat_ws("_", "source", "lang") if by_language else F.col("source")
    ups = F.coalesce("quality", F.lit(0)) - 2 * F.coalesce("toxic", F.lit(0))
    return documents.join(labels, "doc_id", "left").select(
        community.alias("id"),
        F.col("text").alias("comments"),
        ups.cast("long").alias("ups"),
        F.col("doc_id").alias("key"),
    )


def fixed_distributions(spark: SparkSession, sf: str) -> DataFrame:
    """``id, topicDistribution``: embeddings as a table of doubles that SQL has too."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("topicDistribution")
    )


# -- SQL -------------------------------------------------------------------------------------


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


SPACES_SQL = quoted(SPACES)
WS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
STOP_SQL = in_list(STOP)

COMMENTS_SQL = """(SELECT d.source AS id, d.text AS comments, d.doc_id AS key,
  CAST(coalesce(l.quality, 0) - 2 * coalesce(l.toxic, 0) AS BIGINT) AS ups
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
COMMENTS_LANG_SQL = COMMENTS_SQL.replace("d.source AS id", "d.source || '_' || d.lang AS id")


PART_CHARS = 8_000_000


def parted_sql(source: str, chars: int = PART_CHARS, order: str = "key") -> str:
    """The rows with their part: characters before them in their community, over ``chars``."""
    size = "coalesce(length(comments), 0)"
    return (
        f"(SELECT *, CAST((sum({size}) OVER (PARTITION BY id ORDER BY {order} "
        f"ROWS UNBOUNDED PRECEDING) - {size}) // {chars} AS BIGINT) AS part FROM {source})"
    )


PARTS_SQL = parted_sql(COMMENTS_SQL)


def stats_sql(source: str = COMMENTS_LANG_SQL) -> str:
    return (
        "(SELECT id, CAST(sum(ups) AS BIGINT) AS ups, count(id) AS comm_count "
        f"FROM {source} GROUP BY id)"
    )


def ratio_sql(source: str = COMMENTS_LANG_SQL) -> str:
    """Rounded to three decimals by the exact value of the quotient, as Python rounds."""
    return f"""(WITH quotients AS (SELECT *, CAST(comm_count AS DOUBLE) / nullif(ups, 0) AS x
   FROM {stats_sql(source)}),
  halves AS (SELECT *, x * 134217729 - (x * 134217729 - x) AS high, x * 1000 AS y FROM quotients),
  errors AS (SELECT *, (high * 1000 - y) + (x - high) * 1000 AS error FROM halves)
  SELECT id, ups, comm_count, coalesce(CASE WHEN y - floor(y) = 0.5 AND error > 0 THEN ceil(y)
    WHEN y - floor(y) = 0.5 AND error < 0 THEN floor(y) ELSE round_even(y, 0) END / 1000, 0.0)
    AS comm_ups_ratio FROM errors)"""


def words_sql(text: str) -> str:
    """Whitespace-separated words."""
    return f"list_filter(string_split_regex({text}, '[{WS}]+'), lambda w: w <> '')"


def plain_tokens_sql(text: str) -> str:
    cleaned = rf"regexp_replace(lower(trim({text}, {SPACES_SQL})), '[!-/:-@\[-`{{-~]+', '', 'g')"
    return (
        f"list_filter(string_split_regex({cleaned}, '[{WS}]+'), "
        rf"lambda w: regexp_matches(w, '^\p{{L}}+$') AND NOT list_contains({STOP_SQL}, w))"
    )


ASCII_TEST = f"regexp_matches(t, '^[a-z]+$') AND length(t) > 2 AND NOT list_contains({STOP_SQL}, t)"
LETTER_TEST = rf"regexp_matches(t, '^\p{{L}}+$') AND NOT list_contains({STOP_SQL}, t)"
WORD_TEST = f"NOT list_contains({STOP_SQL}, t)"


def compound_tokens_sql(text: str, test: str) -> str:
    """Word by word, as the profile is defined."""
    tokens = (
        r"list_filter(regexp_extract_all(lower(w), '[\p{L}\p{N}_]+'), " + f"lambda t: {test})"
    )
    return (
        f"list_filter(list_transform(string_split_regex({text}, '[{WS}]+'), "
        f"lambda w: array_to_string({tokens}, ',')), lambda j: j <> '')"
    )


def single_tokens_sql(text: str, test: str) -> str:
    return (
        rf"list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]+'), lambda t: {test})"
    )


def joined(tokens: str, separator: str = "|") -> str:
    return f"coalesce(array_to_string({tokens}, '{separator}'), '')"
