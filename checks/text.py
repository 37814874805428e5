"""Text functions over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, functions as F

from checks import tables as t
from checks.registry import add, query
from forumlens.functions import text
from forumlens.functions.wordlists import NOUN_ENDINGS
from forumlens.operators import cleaning, communities
from forumlens.operators.lemmas import lemma_table
from forumlens.operators.terms import word_counts

# The default English list of the stop-word stage, for its SQL.
ML_STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did
    doing a an the and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in out on off over
    under again further then once here there when where why how all any both each few more
    most other some such no nor not only own same so than too very s t can will just don
    should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
    you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
    haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
    couldn't cannot could here's how's let's ought that's there's what's when's where's who's
    why's would
""".split()


def _documents(function: Callable[[Column], Column]):
    def run(spark, sf):
        value = function(F.col("text"))
        return t.texts(spark, sf).select("doc_id", value.alias("value"))

    return run


def _pages(function: Callable[[Column], Column]):
    def run(spark, sf):
        value = function(F.col("html"))
        return t.texts(spark, sf, "pages").select("page_id", value.alias("value"))

    return run


def on_documents(name: str, function: Callable[[Column], Column], sql: str) -> None:
    add(name, _documents(function), f"SELECT doc_id, {sql} AS value FROM documents")


def on_pages(name: str, function: Callable[[Column], Column], sql: str) -> None:
    add(name, _pages(function), f"SELECT page_id, {sql} AS value FROM pages")


def listed(function: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Show an array as text, so that both engines give the same value."""
    return lambda c: F.array_join(function(c), "|")


on_documents("strip_lower", text.strip_lower, f"lower(trim(text, {t.SPACES_SQL}))")
on_documents(
    "delete_punctuation",
    text.delete_punctuation,
    r"regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g')",
)
on_documents("split_whitespace", listed(text.split_whitespace), t.joined(t.words_sql("text")))
on_documents(
    "split_single_space",
    listed(text.split_single_space),
    "array_to_string(string_split(text, ' '), '|')",
)
on_documents(
    "word_tokens",
    listed(
        lambda c: F.flatten(F.transform(text.split_whitespace(F.lower(c)), text.word_tokens))
    ),
    t.joined(r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"),
)
on_documents(
    "alpha_tokens",
    listed(lambda c: F.filter(text.split_whitespace(c), text.is_alpha)),
    t.joined(rf"list_filter({t.words_sql('text')}, lambda a: regexp_matches(a, '^\p{{L}}+$'))"),
)
on_documents(
    "ascii_only_tokens",
    listed(lambda c: F.filter(text.split_whitespace(c), text.is_ascii)),
    t.joined(
        rf"list_filter({t.words_sql('text')}, lambda a: regexp_matches(a, '^[\x00-\x7F]*$'))"
    ),
)
on_documents(
    "longer_tokens",
    listed(lambda c: F.filter(text.split_whitespace(c), lambda w: text.longer_than(w, 2))),
    t.joined(f"list_filter({t.words_sql('text')}, lambda a: length(a) > 2)"),
)
on_documents(
    "stop_words_dropped",
    listed(lambda c: text.drop_stop_words(text.split_whitespace(F.lower(c)))),
    t.joined(
        f"list_filter({t.words_sql('lower(text)')}, lambda a: NOT list_contains({t.STOP_SQL}, a))"
    ),
)
on_documents(
    "compound_tokens",
    listed(text.ascii_tokens),
    t.joined(t.compound_tokens_sql("text", t.ASCII_TEST)),
)
on_documents(
    "compound_tokens_split",
    listed(lambda c: text.ascii_tokens(c, split_compound=True)),
    t.joined(t.single_tokens_sql("text", t.ASCII_TEST)),
)
on_documents(
    "letter_tokens",
    listed(text.letter_tokens),
    t.joined(t.compound_tokens_sql("text", t.LETTER_TEST)),
)
on_documents(
    "letter_tokens_with_digits",
    listed(lambda c: text.letter_tokens(c, alpha=False)),
    t.joined(t.compound_tokens_sql("text", t.WORD_TEST)),
)
on_documents(
    "tokens_rejoined",
    lambda c: text.join_tokens(text.split_whitespace(c)),
    t.joined(t.words_sql("text"), " "),
)
on_documents(
    "plain_text_no_lemmas", text.plain_text, t.joined(t.plain_tokens_sql("text"), " ")
)
on_documents(
    "regex_tokens",
    listed(text.regex_tokens),
    t.joined(
        r"list_filter(string_split_regex(lower(text), '[\W_]+'), lambda w: length(w) >= 4)"
    ),
)
on_documents(
    "lower_tokens",
    listed(text.lower_tokens),
    r"array_to_string(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s'), '|')",
)
on_pages(
    "byte_literals_stripped",
    text.strip_byte_literal,
    "trim(trim(html, 'b'''), 'b\"')",
)
on_pages(
    "media_marks_dropped",
    text.drop_media_marks,
    r"regexp_replace(html, '\[\[[^\n]*?\]\]', '', 'g')",
)
on_pages(
    "escape_runs_dropped",
    text.drop_escape_runs,
    rf"regexp_replace(html, '\\x[^{t.WS}]+', '', 'g')",
)
_EXPANDED = "html"
for _short, _long in (
    ("'s", " is"),
    ("'re", " are"),
    ("'t", " not"),
    ("'m", " am"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
):
    _EXPANDED = f"replace({_EXPANDED}, {t.quoted(_short)}, {t.quoted(_long)})"
on_pages("contractions_expanded", text.expand_contractions, _EXPANDED)
on_pages("dots_to_spaces", text.dots_to_spaces, "replace(html, '.', ' ')")
on_pages("signs_dropped", text.drop_signs, "translate(html, '!?.\\\",-$%''', '')")
on_pages("digits_dropped", text.drop_digits, "regexp_replace(html, '[0-9]', '', 'g')")
on_pages("urls_dropped", text.drop_urls, rf"regexp_replace(html, 'http[^{t.WS}]+', '', 'g')")


def _page_chain(column: str) -> str:
    c = f"trim(trim(lower({column}), 'b'''), 'b\"')"
    c = rf"regexp_replace({c}, '\[\[[^\n]*?\]\]', '', 'g')"
    c = rf"regexp_replace({c}, '\\x[^{t.WS}]+', '', 'g')"
    c = _EXPANDED.replace("html", c)
    c = f"translate(replace({c}, '.', ' '), '!?.\\\",-$%''', '')"
    c = f"regexp_replace(regexp_replace({c}, '[0-9]', '', 'g'), 'http[^{t.WS}]+', '', 'g')"
    return f"list_filter({t.words_sql(c)}, lambda a: NOT list_contains({t.STOP_SQL}, a))"


on_pages("page_text_no_lemmas", text.page_text, t.joined(_page_chain("html"), " "))


@query(
    "SELECT doc_id, "
    + t.joined(
        f"list_filter({t.words_sql('text')}, "
        f"lambda a: NOT list_contains({t.in_list(ML_STOP_WORDS)}, lower(a)))"
    )
    + " AS value FROM documents"
)
def default_stop_words_removed(spark, sf) -> DataFrame:
    remover = StopWordsRemover(inputCol="words", outputCol="kept")
    words = t.texts(spark, sf).select(
        "doc_id", text.split_whitespace(F.col("text")).alias("words")
    )
    return remover.transform(words).select("doc_id", F.array_join("kept", "|").alias("value"))


# -- lemmas ----------------------------------------------------------------------------------

def lemmas_sql(table: str, key: str, tokens: str) -> str:
    """CTEs ``toks(key, pos, sub, word)`` and ``lemmas(word, n, lemma)`` of a token list."""
    forms = "\n UNION ALL ".join(
        f"SELECT word, {i}, left(word, length(word) - {len(old)}) || '{new}' "
        f"FROM words WHERE ends_with(word, '{old}')"
        for i, (old, new) in enumerate(NOUN_ENDINGS, 1)
    )
    return f"""WITH lists AS (SELECT {key} AS key, {tokens} AS toks FROM {table}),
 elems AS (SELECT key, unnest(toks) AS elem, generate_subscripts(toks, 1) AS pos FROM lists),
 subs AS (SELECT key, pos, string_split(elem, ',') AS parts FROM elems),
 toks AS (SELECT key, pos, unnest(parts) AS word, generate_subscripts(parts, 1) AS sub FROM subs),
 words AS (SELECT word, count(*) AS n FROM toks GROUP BY word),
 forms(word, pos, form) AS (SELECT word, 0, word FROM words
 UNION ALL {forms}),
 lemmas AS (SELECT f.word, any_value(w.n) AS n,
   first(f.form ORDER BY length(f.form), f.pos) AS lemma
   FROM forms f JOIN words w ON w.word = f.word
   WHERE f.form IN (SELECT word FROM words) GROUP BY f.word),
 parts AS (SELECT t.key, t.pos, string_agg(l.lemma, ',' ORDER BY t.sub) AS elem
   FROM toks t JOIN lemmas l ON l.word = t.word GROUP BY t.key, t.pos)"""


@query(
    lemmas_sql("documents", "doc_id", t.plain_tokens_sql("text"))
    + " SELECT word, n, lemma FROM lemmas"
)
def noun_lemmas(spark, sf) -> DataFrame:
    tokens = text.plain_tokens(F.col("text"))
    return lemma_table(word_counts(t.texts(spark, sf), tokens))


def _lemmatised_sql(table: str, key: str, tokens: str, separator: str) -> str:
    return (
        lemmas_sql(table, key, tokens)
        + f" SELECT s.key, coalesce(string_agg(p.elem, '{separator}' ORDER BY p.pos), '') AS value"
        + " FROM lists s LEFT JOIN parts p ON p.key = s.key GROUP BY s.key"
    )


CLEAN_TEXT_SQL = _lemmatised_sql("documents", "doc_id", t.plain_tokens_sql("text"), " ")


@query(CLEAN_TEXT_SQL)
def clean_text(spark, sf) -> DataFrame:
    cleaned = cleaning.clean_text(t.comment_texts(spark, sf))
    return cleaned.select("key", F.col("comments").alias("value"))


@query(f"SELECT key, value FROM ({CLEAN_TEXT_SQL}) WHERE value <> ''")
def empty_texts_dropped(spark, sf) -> DataFrame:
    cleaned = communities.drop_empty(cleaning.clean_text(t.comment_texts(spark, sf)))
    return cleaned.select("key", F.col("comments").alias("value"))


@query(
    f"SELECT doc_id AS key, {t.joined(t.compound_tokens_sql('text', t.ASCII_TEST))} AS value "
    "FROM documents"
)
def clean_tokens(spark, sf) -> DataFrame:
    cleaned = cleaning.clean_tokens(t.comment_texts(spark, sf))
    return cleaned.select("key", F.array_join("comments", "|").alias("value"))


@query(
    _lemmatised_sql("documents", "doc_id", t.compound_tokens_sql("text", t.LETTER_TEST), "|")
)
def clean_tokens_lemma(spark, sf) -> DataFrame:
    cleaned = cleaning.clean_tokens_lemma(t.comment_texts(spark, sf))
    return cleaned.select("key", F.array_join("comments", "|").alias("value"))


@query(_lemmatised_sql("pages", "page_id", _page_chain("html"), " "))
def clean_page(spark, sf) -> DataFrame:
    pages = t.texts(spark, sf, "pages").select(F.col("page_id").alias("key"), "html")
    cleaned = cleaning.clean_page(pages, "html")
    return cleaned.select("key", F.col("html").alias("value"))
