"""Alignment of two tokenizers' ids over the same bytes, and how often ids are linked.

Both tokenizers cut a text's bytes into tokens. A dictionary from the byte at which a token ends
to the token's number is made for each; the keys in both, sorted, cut the two id lists into groups
of the same bytes, and each group gives the links of its tokens that end together. Ids that are
linked are counted over all documents.

Long texts are aligned piece by piece. A piece begins at a space that follows a non-space and is
followed by a letter: there both tokenizers begin a token, whatever comes before (byte-level words
take one space at their front; no piece of the other vocabulary has a space behind anything else,
which is checked). So memory is bounded by the longest text without such a place. For the same reason a
word between two such places is aligned once, and found again by its text: among some thousand
texts by arrays over their characters, in longer and rarer ones by a dictionary.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from forumlens.llm.words import give_back, small_batches
from forumlens.operators.lookup import lookup_join
from forumlens.session import materialise

PIECE_CHARS = 1 << 16  # from which a text is cut
PAIR_BITS = 24  # of a pair's number that hold the second id
NUMBER_BITS = 32  # of a word's two numbers of ids that hold the second
KEPT_WORDS = 200_000  # aligned words that a task keeps; beyond that it begins anew
KEPT_CHARS = 32  # longer words are aligned wherever they are met
SLICE_CHARS = 1 << 22  # of texts that a task aligns at once; longer texts are aligned alone
CHUNK_CHARS = 1 << 13  # of distinct words that are encoded as one text

_CUT = re.compile(r"(?<=\S) (?=[^\W\d_])")
_INNER = re.compile(r"[^\W\d_](?:.*\S)?", re.DOTALL)  # what may stand between two cuts
# Fixed value: how byte-level vocabularies of this kind cut a text into words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE = "▁"  # stands for a space in the second vocabulary's pieces
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_ROWS = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def byte_level_alphabet() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable Latin-1 ones stand
    for themselves, the others for the characters from 256 on, in their order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level(file: str) -> tuple[list[bytes], Callable[[str], list[int]]]:
    """The bytes of each id of a byte-level vocabulary, and a function from a text to its ids.

    Where ids follow the merges, as is usual, they are all that the faster of two libraries needs.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(file, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_level_alphabet()
    known = {i: bytes(letters[c] for c in entry) for entry, i in model["vocab"].items() if all(c in letters for c in entry)}
    merges = [pair if isinstance(pair, str) else " ".join(pair) for pair in model["merges"]]
    follows = all(model["vocab"].get(pair.replace(" ", "")) == 256 + k for k, pair in enumerate(merges))
    slow = Tokenizer.from_file(file)
    slow.encode_special_tokens = True  # their strings in texts are plain text
    all_bytes = [known.get(i) if i in known else (slow.id_to_token(i) or "").encode() for i in range(slow.get_vocab_size())]
    if follows:
        ranks = {all_bytes[i]: i for i in range(256 + len(merges))}
        return all_bytes, tiktoken.Encoding("byte level", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return all_bytes, lambda text: slow.encode(text, add_special_tokens=False).ids


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Which characters are white space, and which are letters: some are left out, so that there are fewer cuts."""
    spaces, letters = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    spaces[:0x3100], letters[:0x3100] = zip(*((c.isspace(), c.isalpha()) for c in map(chr, range(0x3100))), strict=True)
    letters[0x4E00:0x9FA6] = letters[0xAC00:0xD7A4] = True
    return spaces, letters


def _binary(offsets: np.ndarray, data: bytes | np.ndarray | pa.Buffer) -> pa.Array:
    offsets = pa.py_buffer(offsets.astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), offsets.size // 8 - 1, [None, offsets, data if isinstance(data, pa.Buffer) else pa.py_buffer(data)])


def _offsets(binary: pa.Array) -> np.ndarray:
    return np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]


def _before(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


Entry = tuple[int, str, bytes]  # of a word: how many ids of each side, its groups, its linked pairs


class Aligner:
    """Two tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece

        self.bytes_a, self.encode_a = byte_level(byte_file)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = []
        for piece in pieces:
            one = _BYTE.fullmatch(piece)
            self.bytes_b.append(bytes.fromhex(one[1]) if one else piece.replace(_SPACE, " ").encode())
        self.cuts = not any(_SPACE in piece.lstrip(_SPACE) for piece in pieces)
        self.long_a, self.long_b = (np.array([len(x) for x in some]) for some in (self.bytes_a, self.bytes_b))
        self.known: dict[str, Entry] = {}
        # an id with what follows it: another id of its group, the other side, or the next group
        self.written = [f"{i}{mark}" for some, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for i in range(len(some)) for mark in marks]
        self.long_written = np.array([len(x) for x in self.written])
        self.spaces, self.letters = _kinds()
        self.data_a, self.data_b, self.data_written = (
            pa.array(x, pa.large_binary()) for x in (self.bytes_a, self.bytes_b, [w.encode() for w in self.written])
        )

    def pieces(self, text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
        """Parts between places at which both begin a token; each is encoded with one space ahead."""
        first = 0
        while self.cuts and (cut := _CUT.search(text, first + chars)):
            yield text[first : cut.start()]
            first = cut.end()
        yield text[first:]

    def aligned(self, words: list[str]) -> list[Entry] | None:
        """What each of the words gives that a text is made of; None if a byte differs.

        The words are encoded as one text with a space ahead of each, and must all end a group.
        """
        piece = " ".join(words)
        a, b = self.encode_a(" " + piece), self.b.encode(piece)
        whole = b" " + piece.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        a, b = np.array(a), np.array(b)
        at_a = dict(zip(np.cumsum(self.long_a[a]).tolist(), range(len(a)), strict=True))
        at_b = dict(zip(np.cumsum(self.long_b[b]).tolist(), range(len(b)), strict=True))
        ends = sorted(at_a.keys() & at_b.keys())
        # the last tokens of each group, which alone of it end together
        last_a = np.fromiter(map(at_a.__getitem__, ends), np.int64, len(ends))
        last_b = np.fromiter(map(at_b.__getitem__, ends), np.int64, len(ends))
        codes = self.groups(a, b, last_a, last_b)
        word_ends = np.cumsum([len(word.encode()) + 1 for word in words])
        last = np.minimum(np.searchsorted(ends, word_ends), len(ends) - 1)  # each word's last group
        if not np.array_equal(np.array(ends)[last], word_ends):
            return None
        n_a, n_b = last_a[last] + 1, last_b[last] + 1
        text = "".join(map(self.written.__getitem__, codes.tolist()))
        text_ends = np.cumsum(self.long_written[codes])[n_a + n_b - 1].tolist()
        pairs = (a[last_a] << PAIR_BITS | b[last_b]).tobytes()
        pair_ends = (8 * (last + 1)).tolist()
        numbers = (np.diff(n_a, prepend=0) << NUMBER_BITS | np.diff(n_b, prepend=0)).tolist()
        texts = map(text.__getitem__, map(slice, [0, *text_ends], text_ends))
        linked = map(pairs.__getitem__, map(slice, [0, *pair_ends], pair_ends))
        return list(zip(numbers, texts, linked, strict=False))

    def groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
        """What is written of each group's ids of one side, then of the other."""
        many_a, many_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        code_a, code_b = 2 * a, 2 * b + 2 * len(self.bytes_a)
        code_a[last_a] += 1
        code_b[last_b] += 1
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(last_b + 1 - many_b, many_a)] = code_a
        codes[np.arange(len(b)) + np.repeat(last_a + 1, many_b)] = code_b
        return codes

    def words_of(self, piece: str) -> list[Entry] | None:
        """The entries of a piece's words, in order; new words are aligned together and kept."""
        words = _CUT.split(piece) if self.cuts else [piece]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = set(words).difference(self.known)
        # the first and the last word of a piece may begin or end with anything
        alone = {word for word in (words[0], words[-1]) if word in new and not _INNER.fullmatch(word)}
        together = list(new - alone)
        entries = self.aligned(together) if together else []
        if entries is None:
            alone, together, entries = new, [], []
        fresh = dict(zip(together, entries, strict=True))
        for word in alone:
            one = self.aligned([word])
            if one is None:
                return None
            fresh[word] = one[0]
        self.known.update(fresh)
        found = list(map(self.known.__getitem__, words))
        for word in new:
            if len(word) > KEPT_CHARS:
                del self.known[word]
        return found

    def documents(self, texts: list[str | None]) -> list[tuple]:
        """What ``document`` gives for each text, found for many at once where each has its tokens."""
        made: list = [None] * len(texts)
        some: list[int] = []
        size = 0
        for i, text in [*enumerate(texts), (None, None)]:
            if some and (i is None or size + len(text or "") > SLICE_CHARS):
                for k, found in zip(some, self.halved([texts[k] for k in some]), strict=True):
                    made[k] = found
                some, size = [], 0
            if text and self.cuts and _SPACE not in text and len(text) <= SLICE_CHARS:
                some.append(i)
                size += len(text)
        return [found or self.document(text) for found, text in zip(made, texts, strict=True)]

    def halved(self, texts: list[str]) -> list[tuple]:
        """``together``, with texts whose bytes differ found by halves."""
        found = self.together(texts)
        if found is not None:
            return found
        half = len(texts) // 2
        return [*self.halved(texts[:half]), *self.halved(texts[half:])] if half else [self.document(texts[0])]

    def together(self, texts: list[str]) -> list[tuple] | None:
        """``document`` of texts with a character at least; None if a byte of one of them differs."""
        chars = np.frombuffer(" ".join(["", *texts]).encode("utf-32-le"), "<u4")
        bounds = _before(np.array([len(text) + 1 for text in texts]))
        spaces, letters = self.spaces[chars], self.letters[chars]
        starts = np.zeros(len(chars), bool)
        starts[1:-1] = (chars[1:-1] == 32) & ~spaces[:-2] & letters[2:]
        starts[bounds[:-1]] = True
        starts = np.flatnonzero(starts)
        # words with the space ahead of each; a text's first and last may begin or end with anything
        words = _binary(4 * np.append(starts, len(chars)), chars).dictionary_encode()
        which, firsts = words.indices.to_numpy(), np.searchsorted(starts, bounds)
        alone = np.zeros(len(words.dictionary), bool)
        alone[which[firsts[:-1][~letters[bounds[:-1] + 1]]]] = True
        alone[which[firsts[1:][spaces[bounds[1:] - 1]] - 1]] = True
        entries = self.distinct(words.dictionary, alone)
        if entries is None:
            return None
        n_a, n_b, n, pairs, written = entries
        many = n[which]
        done = _before(many)
        linked = pairs[np.repeat(_before(n)[which] - done[:-1], many) + np.arange(done[-1])]
        bits = PAIR_BITS + len(self.bytes_a).bit_length()
        rows = np.repeat(np.arange(len(texts)), np.diff(done[firsts]))
        linked, times = np.unique(rows << bits | linked, return_counts=True)
        ends = np.searchsorted(linked, np.arange(len(texts) + 1) << bits)
        linked &= (1 << bits) - 1
        written = written.take(pa.array(which))
        marks, data = _offsets(written)[firsts].tolist(), memoryview(written.buffers()[2])
        all_a, all_b = (np.diff(_before(x[which])[firsts]).tolist() for x in (n_a, n_b))
        return [
            (a, b, c, c, hashlib.sha256(data[x : y - 1]).hexdigest(), linked[p:q], times[p:q])
            for a, b, c, x, y, p, q in zip(
                all_a, all_b, np.diff(done[firsts]).tolist(), marks[:-1], marks[1:], ends[:-1], ends[1:], strict=True
            )
        ]

    def distinct(self, words: pa.Array, alone: np.ndarray) -> tuple | None:
        """How many ids of each side and groups each word has, the linked pairs and the groups of all.

        The words have a space ahead, and their characters have four bytes each. None if a byte differs.
        """
        places = _offsets(words) // 4
        chars = np.frombuffer(words.buffers()[2], "<u4", int(places[-1]))
        text = chars.tobytes().decode("utf-32-le")
        cut = np.diff(places[:-1] // CHUNK_CHARS, prepend=-1) > 0
        cut |= alone
        cut[1:] |= alone[:-1]
        chunks = [*places[:-1][cut].tolist(), len(text)]
        chunks = [text[x:y] for x, y in zip(chunks, chunks[1:], strict=False)]
        a = np.fromiter(chain.from_iterable(map(self.encode_a, chunks)), np.int64)
        b = np.fromiter(chain.from_iterable(self.b.encode([x[1:] for x in chunks], num_threads=1)), np.int64)
        whole = text.encode()
        if any(x.take(pa.array(ids)).buffers()[2].to_pybytes() != whole for x, ids in ((self.data_a, a), (self.data_b, b))):
            return None
        at_a, at_b = np.full(len(whole) + 1, -1), np.full(len(whole) + 1, -1)
        at_a[np.cumsum(self.long_a[a])] = np.arange(len(a))
        at_b[np.cumsum(self.long_b[b])] = np.arange(len(b))
        ends = np.flatnonzero((at_a >= 0) & (at_b >= 0))
        last_a, last_b = at_a[ends], at_b[ends]
        codes = self.groups(a, b, last_a, last_b)
        sizes = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        word_ends = np.cumsum(np.add.reduceat(sizes, places[:-1]))
        last = np.minimum(np.searchsorted(ends, word_ends), len(ends) - 1)
        if not np.array_equal(ends[last], word_ends):
            return None
        n_a, n_b = last_a[last] + 1, last_b[last] + 1
        text_ends = _before(self.long_written[codes])[_before(np.diff(n_a + n_b, prepend=0))]
        written = _binary(text_ends, self.data_written.take(pa.array(codes)).buffers()[2])
        counts = (np.diff(x, prepend=0) for x in (n_a, n_b, last + 1))
        return *counts, a[last_a] << PAIR_BITS | b[last_b], written

    def document(self, text: str | None) -> tuple:
        """``n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of a text."""
        nothing = (0, 0, 0, 0, "", [], [])
        if not text:
            return nothing
        digest, links, numbers, mark = hashlib.sha256(), [], 0, ""
        for piece in self.pieces(text):
            found = self.words_of(piece)
            if found is None:
                return nothing
            some, written, pairs = zip(*found, strict=True)
            digest.update((mark + "".join(written)[:-1]).encode())
            mark = ";"
            numbers += sum(some)
            links.append(np.frombuffer(b"".join(pairs), np.int64))
        pairs, times = np.unique(np.concatenate(links), return_counts=True)
        n = int(times.sum())  # a group has one link
        return numbers >> NUMBER_BITS, numbers & (1 << NUMBER_BITS) - 1, n, n, digest.hexdigest(), pairs, times


def aligned_documents(documents: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """``doc_id, row, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of each row.

    ``pairs`` are the distinct linked ids, the first times ``2 ** PAIR_BITS`` plus the second, with
    how often each is linked in the document. Texts that are null, empty, or whose tokens' bytes
    differ from a space and the text have no tokens. ``row`` numbers the rows of a written result.
    """
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_file, piece_file)
        types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        for batch in batches:
            if batch.num_rows:
                columns = zip(*aligner.documents(batch.column("text").to_pylist()), strict=True)
                arrays = [batch.column("doc_id"), *columns]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(arrays, types, strict=True)], names)
        del aligner
        give_back()

    names = [c.split()[0] for c in _ROWS.split(", ") if not c.startswith("row ")]
    schema = ", ".join(c for c in _ROWS.split(", ") if not c.startswith("row "))
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, schema).select(*names, F.monotonically_increasing_id().alias("row"))


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, rows, n, is_best``: documents with each pair, its links, whether they are the most of its second id."""
    pairs = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.count("*").alias("rows"), F.sum("p.times").alias("n"))
    counts = materialise(counts, "pair_counts")
    second = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
    most = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))  # a row an id, of a vocabulary
    return counts.join(F.broadcast(most), second == F.col("second")).select(
        "pair", "rows", "n", (F.col("n") == F.col("most")).alias("is_best")
    )


def align(documents: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row.

    ``documents`` has ``doc_id, text``; other columns are not used. ``byte_file`` is a byte-level
    vocabulary, ``piece_file`` one of pieces with a space in front; every executor has both.
    ``n_best`` are the links whose pair is linked most often of all pairs with its second id, over
    all rows, ties included; ``count_sum`` adds up the pairs' counts over the links. Rows without
    tokens (null, empty, bytes that differ) have zeros and an empty digest. Equal rows are rows
    each, and a null doc_id stays null. An empty table gives no row.
    """
    found = materialise(aligned_documents(documents, byte_file, piece_file), "aligned")
    counts = materialise(pair_counts(found), "counts")
    linked = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    linked = linked.select("row", F.col("p.pairs").alias("linked"), F.col("p.times").alias("times"))
    # common pairs are in most documents: the join knows the weight of each
    known = lookup_join(linked, counts, "linked", "pair", "rows")
    sums = known.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
