"""Packing token sequences into windows by best fit, longest first.

Documents are cut into full windows and one shorter rest. The rests of a shard are placed in
order of descending length, each into the open window with the least room that is enough,
found in a segment tree indexed by remaining capacity. Shards are random subsets of some ten
thousand rests; the last windows of a shard are the only ones with notable padding.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from forumlens.llm.alignment import byte_level_alphabet
from forumlens.llm.words import small_batches, tidy

WINDOW = 4096
SHARD_ROWS = 20_000  # rests that one shard is meant to hold
SLICE_CHARS = 1 << 20  # of text that a task encodes at once

# Fixed value: how vocabularies of this kind prepare a text and cut it into parts.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False}
# Characters whose kind and small letter all versions of Unicode agree on, and that stand for themselves
# beside each other: ASCII, Latin, Greek, Cyrillic, punctuation, currencies, kana, Han, Hangul, full width.
_COMMON = (
    (0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0x24F), (0x386, 0x386), (0x388, 0x3CE), (0x400, 0x481), (0x48A, 0x52F), (0x2010, 0x2027),
    (0x2030, 0x205E), (0x20A0, 0x20BD), (0x3001, 0x3003), (0x3008, 0x3011), (0x3041, 0x3096), (0x30A1, 0x30FE), (0x4E00, 0x9FA5),
    (0xAC00, 0xD7A3), (0xFF01, 0xFF5E),
)
_SPACE, _LETTER, _NUMBER, _MARK, _ODD = range(5)
_BLANK = re.compile("[ \t\n\r]")
_SHORT, _LONG = np.frombuffer(b"stmd", "u1"), [tuple(x) for x in (b"re", b"ve", b"ll")]  # after an apostrophe


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kind and small letter of each character."""
    kinds, small = np.full(0x110000, _ODD, np.uint8), np.arange(0x110000, dtype="<u4")
    kinds[[9, 10, 13, 32]] = _SPACE
    for first, last in _COMMON:
        for code in range(first, last + 1):
            one = chr(code)
            kind, lower = unicodedata.category(one), one.lower()
            if kind[0] not in "MCZ" and len(lower) == 1 and all(unicodedata.is_normalized("NFC", x) for x in (one, lower)):
                kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(kind[0], _MARK)
                small[code] = ord(lower)
    return kinds, small


class _Encoder:
    """Ids of texts, part by part: the tokenizer drops white space and never looks across it.

    The parts of a slice of texts are found by arrays of its characters, and only distinct ones are
    encoded. Where each id is its merge's number, as is usual, parts are ranked byte pairs that end
    with a space. Words with a character that is not common go to the tokenizer as they are, and
    with vocabularies of another kind all words do.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)")  # found in texts as they are
        self.kinds, self.small = _kinds()
        self.pairs, self.last = self._ranked(path)
        if self.pairs is None:
            self.kinds[self.kinds != _SPACE] = _ODD

    @staticmethod
    def _ranked(path: str) -> tuple:
        """A faster encoder of common parts, and the ids that end one; None if the vocabulary is of another kind."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        cuts = before.get("pretokenizers") or [{}]
        known = (
            (file["normalizer"] or {}).get("normalizers") == _STEPS
            and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
            and (cuts[0].get("pattern"), cuts[0].get("behavior"), cuts[0].get("invert")) == ({"Regex": _CUTS}, "Removed", True)
            and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
            and all(model.get(k) == v for k, v in _MODEL.items())
            and not any(t["normalized"] for t in file["added_tokens"])
        )
        vocab = model["vocab"]
        merges = [pair if isinstance(pair, str) else " ".join(pair) for pair in model["merges"]]
        letters = byte_level_alphabet()
        if not known or any(vocab.get(c + end) != i + first for first, end in ((0, ""), (256, "</w>")) for i, c in enumerate(letters)):
            return None, None
        if len(vocab) < 512 + len(merges) or any(vocab.get(pair.replace(" ", "")) != 512 + k for k, pair in enumerate(merges)):
            return None, None
        spelt = {i: token for token, i in vocab.items() if i < 512 + len(merges)}
        ends = np.array([spelt[i].endswith("</w>") for i in range(len(spelt))])
        ranks = {bytes(map(letters.__getitem__, t.removesuffix("</w>"))) + b" " * t.endswith("</w>"): i for i, t in spelt.items()}
        return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}), ends

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """The ids of each text with ``end`` after them, as unsigned 32-bit integers."""
        made, some, size = [[] for _ in texts], [], 0
        for i, text in enumerate(texts):
            first = 0
            while True:
                cut = _BLANK.search(text, first + SLICE_CHARS)
                piece = text[first : cut.start() if cut else len(text)]
                if some and size + len(piece) > SLICE_CHARS:
                    self._add(made, some)
                    some, size = [], 0
                some.append((i, piece))
                size += len(piece) + 1
                if not cut:
                    break
                first = cut.end()
        self._add(made, some)
        last = np.array([end], "<u4").tobytes()
        return [b"".join([*ids, last]) for ids in made]

    def _add(self, made: list[list[bytes]], pieces: list[tuple[int, str]]) -> None:
        places, ids = self._slice([piece for _, piece in pieces])
        data, places = ids.tobytes(), (4 * places).tolist()
        for (i, _), a, b in zip(pieces, places, places[1:], strict=False):
            made[i].append(data[a:b])

    def _slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, and where each text's begin and end."""
        text = " ".join([*texts, ""])
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
        kinds = self.kinds[chars]
        kinds[[m.start() for m in self.added.finditer(text)]] = _ODD
        small, starts, odd = self._parts(chars, kinds)
        at = np.flatnonzero(kinds)  # all but white space
        begins = np.flatnonzero(starts[at])
        # the parts with a space after each
        spaced = np.full(len(at) + len(begins), 32, "<u4")
        spaced[np.arange(len(at)) + np.cumsum(starts[at]) - 1] = small[at]
        offsets = 4 * np.append(begins + np.arange(len(begins)), len(spaced)).astype(np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(spaced)])
        found = parts.dictionary_encode()
        which = found.indices.to_numpy()
        others = np.zeros(len(found.dictionary), bool)
        others[which[odd[at[begins]]]] = True  # no common part is like a word that is not
        lengths, sources, ids = self._distinct(found.dictionary, others)
        n = lengths[which]
        done = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.repeat(sources[which] - done[:-1], n) + np.arange(done[-1])]
        bounds = np.cumsum([0, *(len(text) + 1 for text in texts)])
        return done[np.searchsorted(at[begins], bounds)], out

    def _parts(self, chars: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The characters in small letters, where a part starts, and what is of words that are not common.

        The last character is a space.
        """
        before = np.concatenate([[np.uint8(_SPACE)], kinds[:-1]])
        starts = (kinds != before) | (kinds == _NUMBER)
        small = self.small[chars]
        short = np.flatnonzero((small == ord("'")) & starts)
        if len(short):  # an apostrophe at the start of a part takes some letters along
            padded = np.append(small, [32, 32])
            one, two = padded[short + 1], padded[short + 2]
            long = np.logical_or.reduce([(one == a) & (two == b) for a, b in _LONG])
            for taken, letters in ((np.isin(one, _SHORT), 1), (long, 2)):
                starts[short[taken] + 1] = False
                starts[short[taken] + 1 + letters] = True
        odd = kinds == _ODD
        if odd.any():  # the whole word is a part, as it is
            words = np.cumsum((kinds != _SPACE) & (before == _SPACE))
            inside = np.zeros(words[-1] + 1, bool)
            inside[words[odd]] = True
            odd = inside[words] & (kinds != _SPACE)
            small[odd] = chars[odd]
            starts[odd] = before[odd] == _SPACE
        starts &= kinds != _SPACE
        return small, starts, odd

    def _distinct(self, parts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many ids each part has, where they begin, and all ids."""
        if not len(parts):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, "<u4"),)
        ends = np.frombuffer(parts.buffers()[1], np.int64)[: len(parts) + 1]
        chars = np.frombuffer(parts.buffers()[2], "<u4", ends[-1] // 4)
        lengths, ids = np.zeros(len(parts), np.int64), []
        for some, encode in ((~odd, self._common), (odd, self._others)):
            if some.any():
                lengths[some], found = encode(chars[np.repeat(some, np.diff(ends) // 4)].tobytes().decode("utf-32-le"))
                ids.append(found)
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        sources = np.empty(len(parts), np.int64)
        sources[order] = np.cumsum(lengths[order]) - lengths[order]
        return lengths, sources, np.concatenate(ids)

    def _common(self, parts: str) -> tuple[np.ndarray, np.ndarray]:
        ids = self.pairs.encode_to_numpy(parts)
        return np.diff(np.flatnonzero(self.last[ids]), prepend=-1), ids

    def _others(self, words: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(words[:-1].split(" "), add_special_tokens=False)
        found = [np.array(e.ids, "<u4") for e in found]
        return np.array(list(map(len, found))), np.concatenate(found)


def cut(documents: DataFrame, tokenizer: str, end: int = 2, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens`` of full windows and the rest of each document.

    ``ids`` are unsigned 32-bit integers, little-endian; each document ends with ``end``. A null
    text counts as empty and is a piece with that id alone. ``tokenizer`` is a file that every
    executor has, of a word-by-word tokenizer that drops white space.
    """
    small_batches(documents.sparkSession)
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(tokenizer)  # of one task: workers outlive tasks, and would keep it
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts, end), strict=True):
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, piece, n))
            columns = zip(*rows, strict=True)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return documents.select("doc_id", "text").mapInArrow(
        tidy(run), "doc_id long, start long, length long, ids binary, doc_tokens long"
    )


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree over the capacities."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)  # windows below each node
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def _count(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, window: int, capacity: int) -> None:
        self.at[capacity].append(window)
        self._count(capacity, 1)

    def tightest(self, least: int) -> tuple[int, int] | None:
        """Takes out the window with the smallest capacity from ``least`` on."""
        node = least + self.size
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not self.tree[2 * node])
        capacity = node - self.size
        self._count(capacity, -1)
        return self.at[capacity].pop(), capacity


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and place of each length; the lengths must not ascend."""
    open_, places, used = OpenWindows(window), [], 0
    for n in lengths.tolist():
        found = open_.tightest(n)
        if found is None:
            found, used = (used, window), used + 1
        number, room = found
        places.append((number, window - room))
        if room > n:
            open_.put(number, room - n)
    both = np.array(places, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def pack(pieces: DataFrame, window: int = WINDOW, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """All columns of ``pieces`` (doc_id, start, length from 1 to ``window``) with
    ``sequence_id`` and ``offset`` there, gapless from 0.

    Columns named ``sequence_id`` or ``offset`` before are replaced. Equal rows are packed each.
    Equal lengths are placed by doc_id (null last) and start. An empty table gives no row. Shards
    are dealt by all columns and the row's number, so that null or repeated ids are spread too;
    ``pieces`` should be a written table, whose rows a lost task finds in the same order again.
    """
    pieces = pieces.drop("sequence_id", "offset", "_shard")
    n = pieces.count()
    shards = -(-n // shard_rows) or 1
    shard = F.pmod(F.xxhash64(*pieces.columns, F.monotonically_increasing_id()), F.lit(shards))
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        number, offset = best_fit(order["length"].to_numpy(), window)
        order = order.drop(columns="_shard")
        return order.assign(sequence_id=key[0] * (1 << 32) + number, offset=offset)

    return pieces.withColumn("_shard", shard).groupBy("_shard").applyInPandas(run, schema)
