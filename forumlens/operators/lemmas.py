"""Noun lemmas as a table job.

Each word has forms by the published noun-ending rules, round after round; of those found in a
dictionary table in the earliest round, the shortest wins. The dictionary is a parameter and by
default the words of the corpus itself, as no lexical database is at hand: with
another dictionary the lemmas change, the rules do not.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from forumlens.functions.text import COMPOUND_MARK
from forumlens.operators.lookup import lookup_join
from forumlens.session import BROADCAST_BYTES, BROADCAST_ROWS, materialise, small_batches


# All endings but three leave a word's own beginning: its final run of e and s gets shorter.
_RUN = "es"
# These three end a chain, as no ending fits what they make: letters of the known form that are
# replaced, letters that the longer word has there, and letters that it has beyond the form.
_LAST = (("f", "v", "es"), ("y", "i", "es"), ("an", "en", ""))


def can_change(word: Column) -> Column:
    """True for words that some ending rule applies to."""
    return F.endswith(word, F.lit("s")) | F.endswith(word, F.lit("men"))


def stem(word: Column) -> Column:
    """The word without its final run of ``e`` and ``s``, which all forms of a word share."""
    return F.rtrim(word, F.lit(_RUN))


def _origins(form: Column) -> Column:
    """``array<struct<key, start, more>>``: what words with the form begin with, and their stem.

    A word has the form if its stem is ``key``, it begins with ``start``, and what follows are
    steps (see ``_steps``); ``more`` is the number of endings besides these.
    """
    own = F.struct(stem(form).alias("key"), form.alias("start"), F.lit(0).alias("more"))
    others = []
    for end, old, rest in _LAST:
        key = F.concat(F.substring(form, F.lit(1), F.length(form) - len(end)), F.lit(old))
        made = F.struct(key.alias("key"), F.concat(key, F.lit(rest)).alias("start"), F.lit(1).alias("more"))
        others.append(F.when(F.endswith(form, F.lit(end)), made))
    return F.array_compact(F.array(own, *others))


def _steps(word: Column, start: Column) -> Column:
    """How many endings lead from ``word`` back to its beginning ``start``; null if none do.

    Each ending takes ``s`` off, or ``es`` after s, x, z, ch or sh. So the letters between are
    ``s`` and ``es`` one after the other: no two ``e`` meet, and the last is an ``s``. Inside the
    run an ``es`` always follows an ``s``; the first one must follow a letter that allows it.
    """
    run = F.substring(word, F.length(start) + 1, F.length(word))
    allows = F.lit(False)
    for end in ("s", "x", "z", "ch", "sh"):
        allows = allows | F.endswith(start, F.lit(end))
    fits = (run == "") | (F.endswith(run, F.lit("s")) & ~F.contains(run, F.lit("ee")) & (~F.startswith(run, F.lit("e")) | allows))
    return F.when(fits, F.length(run) - F.length(F.replace(run, F.lit("s"), F.lit(""))))


def lemma_table(
    words: DataFrame, dictionary: DataFrame | None = None, exceptions: DataFrame | None = None
) -> DataFrame:
    """``word, n, lemma`` for every row of ``words(word, n)``, written once.

    ``dictionary(word)`` holds the known nouns, ``exceptions(word, lemma)`` the
    irregular ones, whose rows replace the rules for their words.
    """
    words = materialise(words, "words")
    known = (words if dictionary is None else dictionary).select(F.col("word").alias("form")).distinct()
    regular = words.filter(can_change(F.col("word"))).select("word")
    if exceptions is not None:
        regular = regular.join(exceptions, "word", "left_anti")
    candidates = _known_forms(regular, known)
    if exceptions is not None:
        own = words.select("word").join(exceptions.select("word").distinct(), "word")
        irregular = own.select("word", F.lit(0).alias("steps"), F.col("word").alias("form")).union(
            words.select("word").join(exceptions, "word").select("word", F.lit(1), "lemma")
        )
        candidates = candidates.unionByName(irregular.join(known, "form", "left_semi"))
    # the first round is the word itself and one ending; a later one counts if no earlier form is known
    order = F.struct(F.greatest(F.col("steps"), F.lit(1)), F.length("form"), "steps", "form")
    best = candidates.groupBy("word").agg(F.min_by("form", order).alias("lemma"))
    table = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("lemma", "word").alias("lemma")
    )
    return materialise(table, "lemmas")


def _known_forms(words: DataFrame, known: DataFrame) -> DataFrame:
    """``word, steps, form``: every known form of every word, by whatever number of endings.

    Words and known forms meet by stem, so that a word's forms are never listed: the work is
    linear in the length of a word and in the known forms of its stem.
    """
    origins = known.select("form", F.explode(_origins(F.col("form"))).alias("o")).select("form", "o.*")
    pairs = words.withColumn("key", stem(F.col("word"))).join(origins, "key")
    pairs = pairs.filter(F.startswith("word", "start"))
    return pairs.select("word", (_steps(F.col("word"), F.col("start")) + F.col("more")).alias("steps"), "form").filter(
        F.col("steps").isNotNull()
    )


def map_words(
    rows: DataFrame, column: str, table: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``lemma`` for the word in ``column``; a word without one is its own lemma."""
    joined = lookup_join(rows, table, column, "word", "n", _is_changed(), max_rows)
    return joined.withColumn("lemma", F.coalesce("lemma", column))


def _is_changed() -> Column:
    return F.col("lemma") != F.col("word")


def lemmatise_counts(
    counts: DataFrame, table: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``id, term, n`` with terms replaced by their lemmas and added up."""
    return (
        map_words(counts, "term", table, max_rows)
        .groupBy("id", F.col("lemma").alias("term"))
        .agg(F.sum("n").alias("n"))
    )


def lemmatise_tokens(
    df: DataFrame,
    column: str,
    table: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace the tokens of every row by their lemmas, also inside compound tokens. Null stays null.

    If the words that have another lemma are at most ``max_rows`` and, with their lemmas, at most
    ``max_bytes``, every task gets them and no row moves. Beyond that they are looked up by join.
    Either way Python works on batches of some 8 MB, or one longer row.
    """
    small_batches(df.sparkSession)
    changed = table.filter(_is_changed()).select("word", "lemma")
    size = F.sum(F.octet_length("word") + F.octet_length("lemma"))
    rows, total = changed.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    if rows <= max_rows and total <= max_bytes:
        done = _lemma_function(changed)(F.col(column))
        return df.withColumn(column, F.when(F.col(column).isNotNull(), done))
    return _lemmatise_by_join(df, column, table, max_rows)


def _lemma_function(changed: DataFrame) -> Callable[[Column], Column]:
    """A whole-batch function over token arrays, for a table that has been counted."""
    lemmas = changed.toArrow()
    shared = changed.sparkSession.sparkContext.broadcast(
        (lemmas["word"].combine_chunks(), lemmas["lemma"].combine_chunks())
    )

    @arrow_udf("array<string>")
    def replace(tokens: pa.Array) -> pa.Array:
        words, lemmas = shared.value
        parts = pc.split_pattern(tokens.flatten(), COMPOUND_MARK)
        single = parts.flatten()
        found = pc.take(lemmas, pc.index_in(single, value_set=words))
        mapped = pa.ListArray.from_arrays(parts.offsets, pc.coalesce(found, single))
        sizes = pc.fill_null(pc.list_value_length(tokens), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes)])
        pa.default_memory_pool().release_unused()  # workers outlive tasks, and share their memory
        return pa.ListArray.from_arrays(offsets, pc.binary_join(mapped, COMPOUND_MARK))

    return replace


def _lemmatise_by_join(
    df: DataFrame, column: str, table: DataFrame, max_rows: int
) -> DataFrame:
    """Rows are written with a number each. Words leave them with their place; those with another
    lemma come back as lists of places and lemmas, and are put there in time linear in the row."""
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    single = F.split(F.array_join(column, COMPOUND_MARK, ""), COMPOUND_MARK)
    words = rows.select("_row", F.posexplode(single).alias("_place", "word_"))
    changed = map_words(words, "word_", table, max_rows).filter(F.col("lemma") != F.col("word_"))
    found = changed.groupBy("_row").agg(F.collect_list(F.struct("_place", "lemma")).alias("_found"))
    done = _put_lemmas(F.col(column), F.col("_found._place"), F.col("_found.lemma"))
    replaced = F.when(F.col("_found").isNull(), F.col(column)).otherwise(done)
    return rows.join(found, "_row", "left").withColumn(column, replaced).select(*df.columns)


@arrow_udf(T.ArrayType(T.StringType()))  # a type by name would need a session at import
def _put_lemmas(tokens: pa.Array, places: pa.Array, lemmas: pa.Array) -> pa.Array:
    """Token lists with lemmas at the given places of their single words."""
    flat = tokens.flatten()
    parts = pc.split_pattern(pc.fill_null(flat, ""), COMPOUND_MARK)
    single, part_offsets = parts.flatten(), np.asarray(parts.offsets)
    offsets = np.cumsum([0, *pc.fill_null(pc.list_value_length(tokens), 0).to_pylist()])
    firsts = part_offsets[offsets[:-1]]
    at = np.repeat(firsts, pc.fill_null(pc.list_value_length(places), 0)) + np.asarray(places.flatten())
    source = np.arange(len(single))
    source[at] = len(single) + np.arange(len(at))
    words = pa.concat_arrays([single, lemmas.flatten().cast(single.type)]).take(pa.array(source))
    joined = pc.binary_join(pa.ListArray.from_arrays(parts.offsets, words), COMPOUND_MARK)
    joined = pc.if_else(flat.is_null(), pa.scalar(None, joined.type), joined)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), joined)
