"""Word and character lists that the results depend on."""

from __future__ import annotations

# The English stop words of the public NLTK corpus.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how all any
    both each few more most other some such no nor not only own same so than too very s t can will
    just don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn
    didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn
    mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
    wouldn't
    """.split()
)

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Characters that a Unicode whitespace split breaks at, for a Java regex class.
# The rare ones stand behind one coarse range, so that a letter is ruled out at once.
SPACE_CLASS = (
    r"\t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
# The same characters spelt out, for trimming.
SPACES = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Contractions and their long forms, in the order they are applied.
CONTRACTIONS = (
    ("'s", " is"),
    ("'re", " are"),
    ("'t", " not"),
    ("'m", " am"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
)

# Signs deleted from page comments.
PAGE_SIGNS = "!?.\\\",-$%'"

# Noun endings and what replaces them, in the order they are tried.
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)
