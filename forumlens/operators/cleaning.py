"""Cleaning profiles over whole tables, with lemmas where the profile has them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from forumlens.functions import text
from forumlens.functions.wordlists import ENGLISH_STOP_WORDS
from forumlens.operators.lemmas import lemma_table, lemmatise_tokens
from forumlens.operators.terms import word_counts
from forumlens.session import materialise


def corpus_lemmas(
    df: DataFrame,
    tokens: Column,
    dictionary: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """``word, n, lemma`` for the words that a profile leaves; compounds count as their tokens."""
    single = F.split(F.array_join(tokens, text.COMPOUND_MARK), text.COMPOUND_MARK)
    words = word_counts(df, single).filter(F.col("word") != "")
    return lemma_table(words, dictionary, exceptions)


def _lemmatised(
    df: DataFrame,
    column: str,
    tokens: Column,
    dictionary: DataFrame | None,
    exceptions: DataFrame | None,
) -> DataFrame:
    """Tokens are made once and written, as both the lemmas and the rows need them."""
    rows = materialise(df.withColumn(column, tokens), "tokens")
    return lemmatise_tokens(rows, column, corpus_lemmas(rows, F.col(column), dictionary, exceptions))


def clean_text(
    df: DataFrame,
    column: str = "comments",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    dictionary: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Alphabetic lemmas joined by spaces; rows may come out empty."""
    tokens = text.plain_tokens(F.col(column), stop_words)
    cleaned = _lemmatised(df, column, tokens, dictionary, exceptions)
    return cleaned.withColumn(column, text.join_tokens(F.col(column)))


def clean_tokens(
    df: DataFrame,
    column: str = "comments",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    split_compound: bool = False,
) -> DataFrame:
    """Arrays of a-z tokens of three letters or more, not lemmatised."""
    return df.withColumn(column, text.ascii_tokens(F.col(column), stop_words, split_compound))


def clean_tokens_lemma(
    df: DataFrame,
    column: str = "comments",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    alpha: bool = True,
    dictionary: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Arrays of lemmas of any script; ``alpha=False`` keeps digits and underscores."""
    tokens = text.letter_tokens(F.col(column), stop_words, alpha)
    return _lemmatised(df, column, tokens, dictionary, exceptions)


def clean_page(
    df: DataFrame,
    column: str = "comment_message",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    dictionary: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Page comments: marks, contractions, signs, digits and URLs handled, then lemmas."""
    tokens = text.page_tokens(F.col(column), stop_words)
    cleaned = _lemmatised(df, column, tokens, dictionary, exceptions)
    return cleaned.withColumn(column, text.join_tokens(F.col(column)))
