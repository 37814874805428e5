"""Conversation tries, line dedup and alignment against slow versions, and on awkward rows."""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import alignment, conversation_trie as trie, line_dedup
from forumlens.llm.queries import tokenizer
from forumlens.session import materialise

FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")

# -- line dedup ------------------------------------------------------------------------------


def slow_dedup(rows, least=20, most=3):
    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    out = []
    for i, text in rows:
        some = (text or "").split("\n")
        keep = [
            x for x in some
            if len(key(x)) < least or len(holders[key(x)]) < most or max(holders[key(x)]) == (-1 if i is None else i)
        ]
        out.append((i, len(some), len(some) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


LINES = ["A line that many documents share", "  a LINE that many documents share\t", "short", "Ünïcode Line of twenty", "ünïcode line of twenty", "\x1fnot space, stays a key of its own"]


@pytest.mark.parametrize("frequent", [2_000, 5])
def test_line_dedup(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)  # few: nearly every shared key is a frequent one
    rng = np.random.default_rng(3)
    rows = [(i, "\n".join(LINES[k] for k in rng.integers(0, len(LINES), rng.integers(0, 9)))) for i in range(60)]
    rows += [(7, LINES[0]), (7, LINES[0]), (None, LINES[0] + "\n" + LINES[3]), (None, LINES[3]), (-5, None), (90, ""), (91, "\n\n")]
    rows += [(100 + i, "\n".join(f"line number {k} of a long text" for k in range(150 - i))) for i in range(4)]
    data = [(i, t, "en", 7, "w") for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, n_dropped int, words string")
    made = line_dedup.deduplicated(docs)
    assert made.columns == ["doc_id", "text", "lang", "n_dropped", "words", "n_lines"]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in made.collect()]
    assert sorted(got, key=str) == slow_dedup(rows)


def test_line_bitmaps(spark):
    shared = [f"line number {k} of a long text" for k in range(130)]
    texts = ["\n".join(shared), "\n".join(shared[:1] + shared[129:]), "\n".join(shared[::129]), "\n".join(f"own line number {k} of one text" for k in range(99))]
    found = line_dedup.keep_bitmaps(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    maps = {r["doc_id"]: (r["n_dropped"], [(w["word"], w["keep"]) for w in r["words"]]) for r in found}
    assert maps == {0: (2, [(0, -2), (2, -3)]), 1: (2, [(0, -4)])}
    plan = line_dedup.deduplicated(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_line_dedup_of_nothing(spark):
    assert not line_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect()


# -- conversations ---------------------------------------------------------------------------


def slow_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}\0{role}\0{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in nodes:
        kids[p[:-1]] += bool(p)
    for p, who in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, who in nodes.items():
        last = ",".join(map(str, sorted(c for c in who if len(rebuilt[c]) == len(p))))
        out.append((min(who), len(p), min(nodes[p[:-1]]) if p else None, len(who), kids[p], leaves[p], saved[p], hashlib.sha256(last.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string"


def some_conversations():
    rng = np.random.default_rng(4)
    rows = []
    for c in [*range(0, 12), *range(100, 130), *range(203, 260), 300, 301, -7, -100]:
        for t in range(rng.integers(1, 9)):
            rows.append((c, t, ["user", None, "bot"][t % 3], f"text {rng.integers(0, 2)}"))
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(401, t, "user", f"long {t}") for t in range(250)]
    rows += [(500, None, None, None), (500, None, "x", "y"), (500, 1, "a", "tie b"), (500, 1, "a", "tie a"), (500, 1, "a", "tie a"), (500, 2, "", "")]
    return [*rows, (None, 1, "user", "nobody"), (601, 0, "user", "x")]


@pytest.mark.parametrize("block", [200_000, 300])
def test_trie(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "IDS", 3)
    data = [(*r, "x", 1) for r in some_conversations()]
    df = spark.createDataFrame(data, TURNS + ", depth string, e int").repartition(7)
    got = trie.prefix_trie(df, block)
    assert sorted(map(tuple, got.collect()), key=str) == slow_trie(some_conversations())


def test_trie_of_nothing(spark):
    assert not trie.prefix_trie(spark.createDataFrame([], TURNS)).collect()
    assert not trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect()


def test_list_ranking(spark):
    order = np.random.default_rng(1).permutation(3000)  # neighbours in the list are far apart: coins are needed
    rows = [(int(a), 0, int(b), 0, 1, int(a) % 2, int(a)) for a, b in zip(order, order[1:], strict=False)]
    rows.append((int(order[-1]), 0, None, None, 1, 1, 5))
    items = spark.createDataFrame(rows, "c long, e long, next_c long, next_e long, steps long, leaves long, saved long")
    got = {r["c"]: (r["steps"], r["leaves"], r["saved"]) for r in trie.ranked(materialise(items, "items"), 400).collect()}
    leaves, saved = np.cumsum([0, *(order % 2)]), np.cumsum([0, *order])
    assert got == {int(c): (k, int(leaves[k]), int(saved[k])) for k, c in enumerate(order)}


# -- alignment -------------------------------------------------------------------------------


def slow_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(tokenizer(FILES[0]))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=tokenizer(FILES[1]))
    letters, out, counts = alignment.byte_level_alphabet(), [], Counter()
    for i, text in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        parts_a = [bytes(letters[c] for c in one.id_to_token(k)) for k in a]
        names = [two.id_to_piece(k) for k in b]
        parts_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in names]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            out.append((i, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]).tolist(), np.cumsum([len(p) for p in parts_b]).tolist()
        both, groups, links, low = sorted(set(ends_a) & set(ends_b)), [], [], 0
        for end in both:
            cut = [x[bisect.bisect_right(e, low) : bisect.bisect_right(e, end)] for x, e in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(",".join(map(str, ids)) for ids in cut))
            links.append((cut[0][-1], cut[1][-1]))
            low = end
        counts.update(links)
        out.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((i, x, y, g, len(p), sum(counts[q] == best[q[1]] for q in p), sum(counts[q] for q in p), s) for i, x, y, g, p, s in out), key=str)


ODD = [
    "", None, " ", "  two  spaces  ", "tab\tand\nline \n end", "it's we'll I'D", "<|endoftext|> and <s> <unk> <0x41>", "日本語 テキスト",
    "é è ü ﬁ ² ½ x² y", "a▁b", " nbsp  em  x", "emoji 🙂 👩‍👩‍👧 end", "x" * 3000, "ab " * 2000, "1 2 3 a1 b2", "a -b _c (d) e", "\x1cx \x1f y", "same text", "same text",
]


def test_alignment(spark, small):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (3, "  two  spaces  ")]
    rows += [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, n_a int, row string").repartition(5)
    got = alignment.align(docs, *map(tokenizer, FILES))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == slow_alignment(rows)


@pytest.mark.parametrize("chars", [1, 20])
def test_pieces_change_nothing(monkeypatch, chars):
    aligner = alignment.Aligner(*map(tokenizer, FILES))
    whole = [tuple(map(str, aligner.document(t))) for t in ODD]
    cut = aligner.pieces
    monkeypatch.setattr(aligner, "pieces", lambda text: cut(text, chars))
    assert [tuple(map(str, aligner.document(t))) for t in ODD] == whole
    assert max(len(list(cut(t, chars))) for t in ODD if t) > 50


def test_kept_words_change_nothing(monkeypatch):
    aligner = alignment.Aligner(*map(tokenizer, FILES))
    whole = [tuple(map(str, aligner.document(t))) for t in ODD]
    assert aligner.known and [tuple(map(str, aligner.document(t))) for t in ODD] == whole
    monkeypatch.setattr(alignment, "KEPT_WORDS", 2)
    monkeypatch.setattr(alignment, "KEPT_CHARS", 3)
    aligner.known.clear()
    assert [tuple(map(str, aligner.document(t))) for t in ODD] == whole
    assert max(map(len, aligner.known), default=0) <= 3


def test_texts_together_are_as_alone(monkeypatch, small):
    import pyarrow.parquet as pq

    aligner = alignment.Aligner(*map(tokenizer, FILES))
    texts = [*ODD, *pq.read_table(f"{small}/documents.parquet").column("text").to_pylist()[:200], *ODD[:7], "Ünï ßt x 三 y", "a" * 50 + " b"]
    whole = [tuple(map(str, aligner.document(t))) for t in texts]
    for slice_chars, chunk, mark in ((1 << 22, 1 << 13, "▁"), (700, 40, "▁"), (1 << 22, 9, "no mark")):
        monkeypatch.setattr(alignment, "SLICE_CHARS", slice_chars)
        monkeypatch.setattr(alignment, "CHUNK_CHARS", chunk)
        monkeypatch.setattr(alignment, "_SPACE", mark)  # the last: a text whose bytes differ is among others
        assert [tuple(map(str, found)) for found in aligner.documents(texts)] == whole
    assert aligner.documents([]) == []


def test_a_word_of_many_texts_is_encoded_once():
    aligner = alignment.Aligner(*map(tokenizer, FILES))
    encode, seen = aligner.encode_a, []
    aligner.encode_a = lambda text: seen.append(text) or encode(text)
    aligner.documents([f"some words that many texts share and one own{chr(97 + k)}" for k in range(20)])
    assert " ".join(seen).split().count("share") == 1 and len(seen) == 1
    assert not aligner.known  # not one text after the other


def test_alignment_of_nothing(spark):
    assert not alignment.align(spark.createDataFrame([], "doc_id long, text string"), *map(tokenizer, FILES)).collect()


def test_both_libraries_give_the_same_ids(small):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer(FILES[0]))
    slow.encode_special_tokens = True
    encode = alignment.Aligner(*map(tokenizer, FILES)).encode_a
    assert all(encode(" " + t) == slow.encode(" " + t, add_special_tokens=False).ids for t in filter(None, ODD))


def test_place_of_long_lines(spark):
    df = spark.createDataFrame([(1, "\n".join(["x", " " * 30, "y" * 20]))], "doc_id long, text string")
    assert [r["place"] for r in line_dedup.long_lines(df).collect()] == [2]
    assert df.select(F.size(line_dedup.lines(F.lit(None)))).first()[0] == 1
