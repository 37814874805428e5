"""Text functions, column in and column out, with no Python evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

from forumlens.functions.wordlists import (
    CONTRACTIONS,
    ENGLISH_STOP_WORDS,
    PAGE_SIGNS,
    SPACE_CLASS,
    SPACES,
)

WORD_CLASS = r"\p{L}\p{N}_"  # Unicode word characters; Java's bare \w is ASCII only
COMPOUND_MARK = ","


# -- whole strings ---------------------------------------------------------------------------


def strip_lower(c: Column) -> Column:
    return F.lower(F.btrim(c, F.lit(SPACES)))


def delete_punctuation(c: Column) -> Column:
    """Delete ASCII punctuation without leaving a space: ``don't`` becomes ``dont``."""
    return F.regexp_replace(c, r"[!-/:-@\[-`{-~]+", "")


def strip_byte_literal(c: Column) -> Column:
    """Strip the characters of ``b'`` and then of ``b"`` from both ends."""
    return F.btrim(F.btrim(c, F.lit("b'")), F.lit('b"'))


def drop_media_marks(c: Column) -> Column:
    """Delete ``[[...]]`` marks, each as short as possible and within one line."""
    return F.regexp_replace(c, r"\[\[[^\n]*?\]\]", "")


def drop_escape_runs(c: Column) -> Column:
    r"""Delete written-out escapes such as ``\xf0\x9f`` up to the next whitespace."""
    return F.regexp_replace(c, rf"\\x[^{SPACE_CLASS}]+", "")


def expand_contractions(c: Column) -> Column:
    for short, long in CONTRACTIONS:
        c = F.replace(c, F.lit(short), F.lit(long))
    return c


def dots_to_spaces(c: Column) -> Column:
    return F.replace(c, F.lit("."), F.lit(" "))


def drop_signs(c: Column) -> Column:
    return F.translate(c, PAGE_SIGNS, "")


def drop_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[0-9]+", "")


def drop_urls(c: Column) -> Column:
    return F.regexp_replace(c, rf"http[^{SPACE_CLASS}]+", "")


# -- splitting and joining -------------------------------------------------------------------


def split_whitespace(c: Column) -> Column:
    return F.array_remove(F.split(c, f"[{SPACE_CLASS}]+"), "")


def split_single_space(c: Column) -> Column:
    """Split at each space; neighbouring spaces give empty tokens."""
    return F.split(c, " ")


def word_tokens(word: Column) -> Column:
    return F.regexp_extract_all(word, F.lit(f"([{WORD_CLASS}]+)"), 1)


def regex_tokens(c: Column, pattern: str = r"[\W_]+", min_length: int = 4) -> Column:
    r"""Lower-cased pieces between matches; ``\W`` is ASCII, so accented letters split."""
    return F.filter(F.split(F.lower(c), pattern), lambda w: F.length(w) >= min_length)


def lower_tokens(c: Column) -> Column:
    """Lower-case and split at each whitespace character; empty tokens stay, except at the end."""
    kept = F.rtrim(F.lower(c), F.lit(" \t\n\x0b\f\r"))
    return F.when((kept == "") & (c != ""), F.array().cast("array<string>")).otherwise(
        F.split(kept, r"\s")
    )


def join_tokens(tokens: Column, separator: str = " ") -> Column:
    return F.array_join(tokens, separator)


# -- tests on one token ----------------------------------------------------------------------


def is_alpha(word: Column) -> Column:
    return word.rlike(r"^\p{L}+$")


def is_ascii(word: Column) -> Column:
    return word.rlike(r"^[\x00-\x7F]*$")


def longer_than(word: Column, length: int) -> Column:
    return F.length(word) > length


def is_stop_word(word: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    return word.isin(*stop_words) if stop_words else F.lit(False)


def default_stop_words() -> list[str]:
    """The stop words of Spark's own stop-word stage."""
    return StopWordsRemover.loadDefaultStopWords("english")


def drop_stop_words(
    tokens: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, any_case: bool = False
) -> Column:
    """Remove stop words and keep everything else, repeats included."""
    if any_case:
        lowered = [w.lower() for w in stop_words]
        return F.filter(tokens, lambda w: ~is_stop_word(F.lower(w), lowered))
    return F.filter(tokens, lambda w: ~is_stop_word(w, stop_words))


@dataclass(frozen=True)
class TokenRule:
    """Which lower-case word tokens to keep: a pattern for the whole token, and stop words."""

    pattern: str
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS

    def keeps(self, word: Column) -> Column:
        return word.rlike(f"^{self.pattern}$") & ~is_stop_word(word, self.stop_words)

    def tokens(self, c: Column) -> Column:
        """All kept tokens of a lower-case text, found in one pass over it."""
        whole = f"(?<![{WORD_CLASS}])({self.pattern})(?![{WORD_CLASS}])"
        return drop_stop_words(F.regexp_extract_all(c, F.lit(whole), 1), self.stop_words)


def token_rule(
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    alpha: bool = True,
    ascii_only: bool = False,
    min_length: int = 1,
) -> TokenRule:
    """The separate tests put together; in lower case, ASCII letters are a to z."""
    if ascii_only:
        characters = "[a-z]" if alpha else "[a-z0-9_]"
    else:
        characters = r"\p{L}" if alpha else f"[{WORD_CLASS}]"
    return TokenRule(f"{characters}{{{min_length},}}+", stop_words)


# -- profiles --------------------------------------------------------------------------------


def plain_tokens(c: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Punctuation deleted, split at whitespace, stop words and non-alphabetic tokens dropped."""
    # The test for letters also drops the empty tokens that outer whitespace leaves.
    words = F.split(delete_punctuation(F.lower(c)), f"[{SPACE_CLASS}]+")
    kept = F.filter(words, lambda w: is_alpha(w) & ~is_stop_word(w, stop_words))
    return F.coalesce(kept, F.array().cast("array<string>"))


def plain_text(c: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    return join_tokens(plain_tokens(c, stop_words))


def compound_tokens(c: Column, rule: TokenRule, split_compound: bool = False) -> Column:
    """Kept word tokens of every whitespace-separated word.

    The tokens of one word stay together, joined by a comma (``foo-bar`` gives
    ``foo,bar``); ``split_compound`` gives them singly. A null text has no tokens.

    A unit runs from the first to the last word character of a word. Almost every
    unit is a single token, so that only true compounds pay for a second split. The
    pattern never gives back what it took (``++``): a unit may be a whole long line.
    """
    lowered = F.lower(c)
    if split_compound:
        tokens = rule.tokens(lowered)
    else:
        inner = f"[^{WORD_CLASS}{SPACE_CLASS}]++"
        unit = f"([{WORD_CLASS}]++(?:{inner}[{WORD_CLASS}]++)*+)"
        units = F.regexp_extract_all(lowered, F.lit(unit), 1)

        def is_compound(word: Column) -> Column:
            return word.rlike(f"[^{WORD_CLASS}]")

        def rejoin(word: Column) -> Column:
            kept = F.filter(F.split(word, f"[^{WORD_CLASS}]+"), rule.keeps)
            return F.array_join(kept, COMPOUND_MARK)

        candidates = F.filter(units, lambda w: rule.keeps(w) | is_compound(w))
        tokens = F.array_remove(
            F.transform(candidates, lambda w: F.when(is_compound(w), rejoin(w)).otherwise(w)), ""
        )
    return F.coalesce(tokens, F.array().cast("array<string>"))


def ascii_tokens(
    c: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS, split_compound: bool = False
) -> Column:
    """Tokens of at least three letters a to z."""
    rule = token_rule(stop_words, ascii_only=True, min_length=3)
    return compound_tokens(c, rule, split_compound)


def letter_tokens(
    c: Column,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    alpha: bool = True,
    split_compound: bool = False,
) -> Column:
    """Tokens of letters of any script; ``alpha=False`` also keeps digits and underscores."""
    return compound_tokens(c, token_rule(stop_words, alpha=alpha), split_compound)


def page_tokens(c: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Page-comment cleaning. URLs go last, after dots and digits: the order is part of it."""
    c = strip_byte_literal(F.lower(c))
    c = dots_to_spaces(expand_contractions(drop_escape_runs(drop_media_marks(c))))
    c = drop_urls(drop_digits(drop_signs(c)))
    tokens = drop_stop_words(split_whitespace(c), stop_words)
    return F.coalesce(tokens, F.array().cast("array<string>"))


def page_text(c: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    return join_tokens(page_tokens(c, stop_words))
