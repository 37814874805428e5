from __future__ import annotations

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from forumlens.functions import text
from forumlens.functions.wordlists import ENGLISH_STOP_WORDS, PUNCTUATION

C = F.col("c")
STOP = set(ENGLISH_STOP_WORDS)

EDGES = [
    "",
    "   ",
    "the and of",
    "don't",
    "foo-bar and/or cats,dogs!",
    "_x_ a1 b_c",
    "Élan naïve ÉTÉ straße",
    "one\u00a0two\u2003three\x1cfour\x85five",
    "tabs\tand\r\nlines\n",
    "½ x² 三十 Привет мир",
    "b'It\\'s [[gif]] http://www.foo.com/a1 \\xf0\\x9f ok!'",
    "cafe\u0301 combining",
    "...---...",
    "a.b.c xyz.abc;def",
    "you're we'll I'd",
]


def one(spark, column, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, c string").select("i", column.alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


# The tokens of EDGES that each profile should give, in the same order.
PROFILES = {
    "plain": (
        text.plain_tokens,
        [
            [], [], [], ["dont"], ["foobar", "andor", "catsdogs"], ["x", "bc"],
            ["élan", "naïve", "été", "straße"], ["one", "two", "three", "four", "five"],
            ["tabs", "lines"], ["三十", "привет", "мир"], ["bits", "gif", "ok"], ["combining"], [],
            ["abc", "xyzabcdef"], ["youre", "well", "id"],
        ],
    ),
    "ascii": (
        text.ascii_tokens,
        [
            [], [], [], [], ["foo,bar", "cats,dogs"], [], [],
            ["one", "two", "three", "four", "five"], ["tabs", "lines"], [],
            ["gif", "http,www,foo,com"], ["cafe", "combining"], [], ["xyz,abc,def"], [],
        ],
    ),
    "letters": (
        text.letter_tokens,
        [
            [], [], [], [], ["foo,bar", "cats,dogs"], [], ["élan", "naïve", "été", "straße"],
            ["one", "two", "three", "four", "five"], ["tabs", "lines"], ["三十", "привет", "мир"],
            ["b", "gif", "http,www,foo,com", "ok"], ["cafe", "combining"], [],
            ["b,c", "xyz,abc,def"], [],
        ],
    ),
    "words": (
        lambda c: text.letter_tokens(c, alpha=False),
        [
            [], [], [], [], ["foo,bar", "cats,dogs"], ["_x_", "a1", "b_c"],
            ["élan", "naïve", "été", "straße"], ["one", "two", "three", "four", "five"],
            ["tabs", "lines"], ["½", "x²", "三十", "привет", "мир"],
            ["b", "gif", "http,www,foo,com,a1", "xf0,x9f", "ok"], ["cafe", "combining"], [],
            ["b,c", "xyz,abc,def"], [],
        ],
    ),
}

PAGES = [
    "", "", "", "", "foobar and/or catsdogs", "_x_ b_c", "élan naïve été straße",
    "one two three four five", "tabs lines", "½ x² 三十 привет мир", "foo com/a ok", "cafe\u0301 combining",
    "", "b c xyz abc;def", "would",
]


@pytest.mark.parametrize("name", PROFILES)
def test_profiles_on_edges(spark, name):
    column, expected = PROFILES[name]
    assert one(spark, column(C), EDGES) == expected


@pytest.mark.parametrize("name", PROFILES)
def test_null_text_has_no_tokens(spark, name):
    assert one(spark, PROFILES[name][0](C), [None]) == [[]]


LETTERS = st.sampled_from("abcstheéÄß'-.,_ \t\n\u00a019½!?\"/[]ñ三")


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(LETTERS, max_size=40), min_size=20, max_size=60))
def test_profiles_on_random_text(spark, values):
    """What holds for the tokens of any text."""
    for name, (column, _) in PROFILES.items():
        for value, tokens in zip(values, one(spark, column(C), values), strict=True):
            words = [w for token in tokens for w in token.split(",")]
            assert STOP.isdisjoint(words)
            if name != "words":
                assert all(w.isalpha() for w in words)
            if name == "ascii":
                assert all(w.isascii() and len(w) > 2 for w in words)
            rest = iter("".join(ch for ch in value.lower() if ch not in PUNCTUATION.replace("_", "")))
            assert all(ch in rest for ch in "".join(words))  # nothing new, in the text's order


@pytest.mark.parametrize("value", EDGES)
def test_split_gives_the_same_tokens_singly(spark, value):
    joined, single = (
        one(spark, text.ascii_tokens(C, split_compound=flag), [value])[0] for flag in (False, True)
    )
    assert [t for token in joined for t in token.split(",")] == single


def test_plain_text_twice_is_the_same(spark):
    once = one(spark, text.plain_text(C), EDGES)
    assert one(spark, text.plain_text(C), once) == once


def test_single_steps(spark):
    assert one(spark, text.strip_lower(C), ["\u00a0 ÀB \n", None]) == ["àb", None]
    assert one(spark, text.delete_punctuation(C), [PUNCTUATION + "a", "don't"]) == ["a", "dont"]
    assert one(spark, text.split_whitespace(C), [" a  b\u2003c "]) == [["a", "b", "c"]]
    assert one(spark, text.split_single_space(C), [" a  b"]) == [["", "a", "", "b"]]
    assert one(spark, text.word_tokens(C), ["foo-bar_1 é½"]) == [["foo", "bar_1", "é½"]]
    assert one(spark, text.is_alpha(C), ["été", "a1", "", "a_"]) == [True, False, False, False]
    assert one(spark, text.is_ascii(C), ["abc", "é", ""]) == [True, False, True]
    assert one(spark, text.longer_than(C, 2), ["ab", "abc"]) == [False, True]
    tokens = F.split(C, " ")
    assert one(spark, text.drop_stop_words(tokens), ["the cat the cat"]) == [["cat", "cat"]]
    assert one(spark, text.drop_stop_words(tokens, []), ["the cat"]) == [["the", "cat"]]
    assert one(spark, text.join_tokens(tokens), ["a b"]) == ["a b"]


def test_page_steps(spark):
    assert one(spark, text.strip_byte_literal(C), ["b'bob's'", 'b"x\'y"']) == ["ob's", "x'y"]
    assert one(spark, text.drop_media_marks(C), ["a[[x]]b[[y]]c", "[[a\nb]]"]) == ["abc", "[[a\nb]]"]
    assert one(spark, text.drop_escape_runs(C), ["a \\xf0\\x9f b", "c\\x"]) == ["a  b", "c\\x"]
    expanded = one(spark, text.expand_contractions(C), ["he's we're don't i'm i'd i'll i've"])
    assert expanded == ["he is we are don not i am i would i will i have"]
    assert one(spark, text.dots_to_spaces(C), ["a.b"]) == ["a b"]
    assert one(spark, text.drop_signs(C), ["a!?.\\\",-$%'b"]) == ["ab"]
    assert one(spark, text.drop_digits(C), ["a1b22"]) == ["ab"]
    assert one(spark, text.drop_urls(C), ["see https://a.b/c now", "http"]) == ["see  now", "http"]


def test_page_profile_keeps_the_order_of_steps(spark):
    value = "b'It\\'s [[gif]] http://www.foo.com/a1 \\xf0\\x9f ok!'"
    # Dots and digits go first, so that only the host name's first part is a URL.
    assert one(spark, text.page_text(C), [value]) == ["foo com/a ok"]


def test_page_profile(spark):
    assert one(spark, text.page_text(C), EDGES) == PAGES
    value = "b\"She's here's\\x00 [[a]] [[b]]. it'd\" b"
    assert one(spark, text.page_text(C), [value]) == ["would"]


def test_very_long_words(spark):
    chain = "-".join(["abc", "the", "x9"] * 60_000)
    letters = "z" * 300_000
    values = [chain, letters, letters + "1", "." * 300_000 + "abc", "abc" + " " * 300_000 + "abc"]
    joined = one(spark, text.ascii_tokens(C), values)
    assert joined[0] == [",".join(["abc"] * 60_000)]
    assert joined[1:] == [[letters], [], ["abc"], ["abc", "abc"]]
    single = one(spark, text.ascii_tokens(C, split_compound=True), values)
    assert single == [["abc"] * 60_000, [letters], [], ["abc"], ["abc", "abc"]]
    assert one(spark, text.plain_tokens(C), values)[1:] == [[letters], [], ["abc"], ["abc", "abc"]]
    assert one(spark, text.lower_tokens(C), ["a" + " " * 300_000]) == [["a"]]


def test_ml_tokenisers_agree(spark):
    values = [v for v in EDGES if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    regex = RegexTokenizer(inputCol="c", outputCol="r", pattern=r"[\W_]+", minTokenLength=4)
    plain = Tokenizer(inputCol="c", outputCol="p")
    rows = regex.transform(plain.transform(df)).select(
        "r", "p", text.regex_tokens(C).alias("r2"), text.lower_tokens(C).alias("p2")
    )
    for row in rows.collect():
        assert row["r"] == row["r2"]
        assert row["p"] == row["p2"]


def test_default_stop_words_agree(spark):
    df = spark.createDataFrame([(["The", "cat", "IS", "I'd", "here"],)], "w array<string>")
    words = text.default_stop_words()
    row = (
        StopWordsRemover(inputCol="w", outputCol="ml")
        .transform(df)
        .select("ml", text.drop_stop_words(F.col("w"), words, any_case=True).alias("own"))
        .first()
    )
    assert row["ml"] == row["own"] == ["cat"]


def test_fixed_lists():
    assert len(ENGLISH_STOP_WORDS) == len(STOP) == 179
    assert len(set(PUNCTUATION)) == 32
    assert all(unicodedata.category(ch)[0] in "PS" for ch in PUNCTUATION)


def test_whitespace_is_what_python_splits_at(spark):
    spaces = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    others = ["​", "᠎", "⁠", "ᚁ", "⿿", "‐"]
    values = [f"ab{ch}cd" for ch in spaces + others]
    assert one(spark, text.split_whitespace(C), values) == [v.split() for v in values]
    assert one(spark, text.plain_tokens(C), [f"ab{ch}cd" for ch in spaces]) == [["ab", "cd"]] * len(spaces)
    assert one(spark, text.letter_tokens(C), [f"ab{ch}cd" for ch in spaces]) == [["ab", "cd"]] * len(spaces)
    assert one(spark, text.strip_lower(C), [ch + "a" + ch for ch in spaces]) == ["a"] * len(spaces)
