"""Lines that many documents share, kept in one document only; column functions alone.

A line's key is its text without white space at both ends and with A-Z in lower case. Keys become
hashes, which are range-partitioned and sorted by document and place within each range, so that
the rows of a key are one run: its first document is the first occurrence, and stays, and the run
tells whether enough documents follow it. Only bitmaps return to the documents, of the 64-line
words that lose a line; texts are cut with them afterwards.

A key may be on a third of all lines, so frequent keys never enter a range: a sketch of bounded
size names them, their documents are counted by partial aggregation, and that table, of
``FREQUENT`` rows at most, is broadcast to their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlens.session import materialise

MIN_CHARS = 20
MIN_DOCUMENTS = 3
FREQUENT = 2_000  # keys with at least this part of all lines, one of so many, are frequent
SKETCH = 40_000  # keys that the sketch follows

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DOCUMENT = ["doc_id", "text_hash"]
_KEY = ["h", "g"]


def lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Without white space at both ends, A-Z in lower case; other letters keep their case."""
    bare = F.trim(line, F.lit(_SPACE))
    ascii_only = F.length(bare) == F.octet_length(bare)  # then the fast function does the same
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def long_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h, g, doc_id, text_hash, place`` of each line whose key has ``min_chars`` code points."""
    named = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines(F.col("text"))).alias("place", "line"))
    keys = named.select(*_DOCUMENT, "place", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keys.select(F.xxhash64("key").alias("h"), F.hash("key").alias("g"), *_DOCUMENT, "place")


def frequent_hashes(found: DataFrame) -> list[int]:
    """Hashes with about ``1 / FREQUENT`` of the rows or more: at most ``FREQUENT`` numbers."""
    row = found.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {FREQUENT}, {SKETCH})").alias("top")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] * FREQUENT >= row["n"]]


def dropped_lines(found: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``doc_id, text_hash, place`` of the lines that go, from a written table of ``long_lines``."""
    spark = found.sparkSession
    often = spark.createDataFrame([(h,) for h in frequent_hashes(found)], "h long")
    # first the last document: null ids are one document before all others
    order = [F.desc_nulls_last("doc_id"), F.asc("place")]
    run = Window.partitionBy(*_KEY)
    ranged = found.join(F.broadcast(often), "h", "left_anti").repartitionByRange(*_KEY)
    ranked = ranged.withColumn("document", F.dense_rank().over(run.orderBy(order[0])))
    ranked = ranked.withColumn("documents", F.max("document").over(run))
    rare = ranked.filter((F.col("document") > 1) & (F.col("documents") >= min_documents))

    hot = found.join(F.broadcast(often), "h")
    holders = hot.select(*_KEY, "doc_id").distinct().groupBy(*_KEY).agg(
        F.count("*").alias("documents"), F.max("doc_id").alias("last")
    )
    many = holders.filter(F.col("documents") >= min_documents).select(*_KEY, "last")
    kept = F.broadcast(many)  # not more than the frequent hashes, but for collisions
    common = hot.join(kept, _KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return rare.select(*_DOCUMENT, "place").unionByName(common.select(*_DOCUMENT, "place"))


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``doc_id, text_hash, n_dropped, words`` of each document that loses a line.

    ``documents`` has ``doc_id, text``; other columns are not used. ``words`` is the compressed
    bitmap: ``word`` and ``keep`` of the 64 lines from line ``64 * word`` on, in order, where a bit
    of ``keep`` is 1 for a line that stays; of words that are not there all lines stay.

    A key of at least ``min_chars`` code points that at least ``min_documents`` documents hold loses
    all its lines except in the largest doc_id holding it. Rows with one doc_id are one document
    in this, and null ids are one before all others. Equal rows have one bitmap. A null text is
    one empty line. An empty table gives no row. Keys are compared by 96 bits of hashes.
    """
    found = materialise(long_lines(documents, min_chars), "long_lines")
    gone = dropped_lines(found, min_documents)
    bit = F.expr("shiftleft(1L, cast(place % 64 AS int))")
    words = gone.groupBy(*_DOCUMENT, F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("gone"))
    word = F.struct("word", F.bitwise_not("gone").alias("keep"))
    return words.groupBy(*_DOCUMENT).agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"), F.sort_array(F.collect_list(word)).alias("words")
    )


def kept_text(text: Column, words: Column) -> Column:
    """The lines that a bitmap keeps, joined by line breaks; a null bitmap keeps all."""
    numbers = F.transform(words, lambda w: w["word"])

    def stays(line: Column, place: Column) -> Column:
        at = F.array_position(numbers, F.shiftright(place, 6))
        keep = F.get(words, (at - 1).cast("int"))["keep"]
        return (at == 0) | (F.expr("1L").bitwiseAND(F.call_function("shiftright", keep, place % 64)) == 1)

    cut = F.array_join(F.filter(lines(text), stays), "\n")
    return F.when(words.isNull(), F.coalesce(text, F.lit(""))).otherwise(cut)


def deduplicated(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``documents`` with the kept text, ``n_lines`` (before) and ``n_dropped``.

    Columns of these names are replaced, all others stay; a null text becomes empty. Repeated rows
    stay as they are. What is kept, and how odd rows count, is as ``keep_bitmaps`` says.
    """
    maps = keep_bitmaps(documents, min_chars, min_documents).select(
        F.col("doc_id").alias("_dedup_id"), F.col("text_hash").alias("_dedup_hash"), F.col("n_dropped").alias("_dedup_n"), "words"
    ).withColumnRenamed("words", "_dedup_words")
    same = F.col("doc_id").eqNullSafe(F.col("_dedup_id")) & (F.xxhash64("text") == F.col("_dedup_hash"))
    both = documents.join(maps, same, "left")
    return both.withColumns(
        {
            "n_lines": F.size(lines(F.col("text"))).cast("long"),
            "n_dropped": F.coalesce("_dedup_n", F.lit(0)).cast("long"),
            "text": kept_text(F.col("text"), F.col("_dedup_words")),
        }
    ).drop("_dedup_id", "_dedup_hash", "_dedup_n", "_dedup_words")
