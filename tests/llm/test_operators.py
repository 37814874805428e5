"""The operators against brute force on small tables, and on awkward rows."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forumlens.llm import (
    components,
    graph_search,
    jaccard_join,
    licences,
    mixing,
    packing,
    pseudonyms,
    quartile_digest,
    sharding,
    toxicity,
    url_aliases,
    words,
)
from forumlens.llm.alignment import byte_level_alphabet
from forumlens.llm.queries import tokenizer
from forumlens.operators import lookup
from forumlens.session import materialise

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _row string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PROSE = [f"word{i % 7} alpha{i} beta{i * 3} gamma" for i in range(40)]
BASE = " ".join(PROSE)


def rows():
    """Nulls, empty and very long texts, copies, near copies, repeated rows, clashing columns."""
    texts = [
        (1, BASE), (2, BASE + " tail"), (3, BASE), (3, BASE), (4, None), (5, ""), (6, " \t\n"), (7, "one two"),
        (8, "One  TWO"), (9, LONG), (10, LONG + " end"), (None, "no id here at all"), (11, "é ü 三十 日本"),
        (12, "a b c d e"), (13, "a b c d e f"), (14, "x. idiot! y"), (None, None),
    ]
    return [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", 0, 0.0, "r") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def linked(texts):
    sets, top = [shingles(t) for t in texts], list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and 100 * shared >= 75 * len(sets[a] | sets[b]):
            x, y = top[a], top[b]
            top = [min(x, y) if t in (x, y) else t for t in top]
    return sets, top


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
    assert not components.components(spark.createDataFrame([], "a long, b long")).collect()


def test_words_are_hashed_alike_wherever_they_are():
    import pyarrow as pa

    sets = list(words.row_shingles(pa.array([BASE, None, "x " + BASE, BASE.upper(), "a" * 100_000])))
    assert len(sets[0]) == len(shingles(BASE)) and not len(sets[1])
    assert set(sets[0]) < set(sets[2]) and set(sets[0]) == set(sets[3]) and len(sets[4]) == 1


def test_jaccard_join_on_awkward_rows(docs, none):
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in jaccard_join.jaccard_components(docs).collect())
    data = [r[:2] for r in rows()]
    sets, top = linked([t for _, t in data])
    least = {t: min((data[k][0] for k in range(len(data)) if top[k] == t and data[k][0] is not None), default=0) for t in top}
    want = sorted((i or 0, len(s), least[t] if s else i or 0) for (i, _), s, t in zip(data, sets, top, strict=True))
    assert got == want
    assert not jaccard_join.jaccard_components(none).collect()


def test_jaccard_join_on_many_near_copies_and_a_common_passage(spark):
    rng = np.random.default_rng(5)
    common = [f"c{i}" for i in range(40)]
    texts = []
    for i in range(150):
        if i % 3 == 0:
            base = [f"b{j}" for j in range(60 + i % 7)]
            base[rng.integers(len(base))] = f"z{i}"
            texts.append(base)
        elif i % 3 == 1:
            texts.append(common + [f"o{i}_{j}" for j in range(rng.integers(1, 30))])
        else:
            texts.append([f"q{rng.integers(12)}" for _ in range(rng.integers(1, 9))])
    texts = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, top = linked(texts)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(df).collect()} == dict(enumerate(top))


def test_partition_finds_every_link():
    """At any size, two linked sets agree on more segments than they may differ in shingles."""
    rng = np.random.default_rng(3)
    for n in [*range(3, 40), 100, 333]:
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        m = 4 * len(a) // 3
        b = np.unique(np.concatenate([a, rng.integers(0, 1 << 63, m - len(a)).astype(np.uint64)]))
        shared = [x for x in jaccard_join.levels_of(len(a)) if x[0] == jaccard_join.levels_of(len(b))[0][0]]
        (level, most), apart = shared[0], len(b) - len(a)
        assert apart <= most < jaccard_join.segment_count(level)
        ka, kb = (set(jaccard_join.subset_keys(x, level)) for x in (a, b))
        assert len(ka & kb) >= len(ka) - apart


def slow_digest(data):
    counts = [0] * quartile_digest.BUCKETS
    for i in range(len(data) - 2):
        triplet = data[i] | data[i + 1] << 8 | data[i + 2] << 16
        counts[(triplet * 0x9E3779B1 % (1 << 32)) >> 22] += 1
    ordered, n = sorted(counts), len(counts)
    q = [ordered[k * n // 4 - 1] for k in (1, 2, 3)]
    bits = 0
    for k, c in enumerate(counts):
        bits |= sum(c > x for x in q) << 2 * k
    return bits.to_bytes(n // 4, "little")


def test_quartile_digest(docs, none):
    got = quartile_digest.compare_with_next(docs).collect()
    data = sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, text), (_, after) in zip(data, data[1:] + data[:1], strict=True):
        half = len(text) // 2
        changed = (text[: len(text) - half] + after[:half]).encode()
        want.append((i, len(text), hashlib.sha256(changed).hexdigest(), slow_digest(text.encode()).hex(), slow_digest(changed).hex()))
    seen = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"][:-2], r["edited_fingerprint"][:-2]) for r in got]
    assert sorted(map(str, seen)) == sorted(map(str, want))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert quartile_digest.likeness(*[quartile_digest.digest(b"same text")] * 2) == 1
    assert not quartile_digest.compare_with_next(none).collect()


def test_quartile_digest_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(quartile_digest, "RANGE_ROWS", 10)
    data = [(i * 3 % 101, f"text {i * i}" * (i % 9)) for i in range(101)]
    got = quartile_digest.compare_with_next(spark.createDataFrame(data, "doc_id long, text string")).collect()
    texts = [t for _, t in sorted(data)]
    want = [quartile_digest.edited(t, texts[(k + 1) % 101]).encode() for k, t in enumerate(texts)]
    assert [r["edited_sha256"] for r in sorted(got, key=lambda r: r["doc_id"])] == [hashlib.sha256(w).hexdigest() for w in want]


def test_packing(docs, none):
    from tokenizers import Tokenizer

    pieces = packing.cut(docs, tokenizer())
    got = packing.pack(pieces).collect()
    encode = Tokenizer.from_file(tokenizer()).encode
    want = []
    for i, text, *_ in rows():
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want += [(str(i), s, zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096)]
    assert sorted((str(r["doc_id"]), r["start"], zlib.crc32(r["ids"]), r["doc_tokens"]) for r in got) == sorted(want)
    used: dict = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 4096
    assert not packing.pack(packing.cut(none, tokenizer())).collect()


ODD_PARTS = [
    *"aabeéÉsStTmMdDrReEvVlL''''’ \n\t\r.,;!12½²ΣσİßñÑſかっー가中😀\xa0\x85\x0b\x1c\u200b\u3000\u0301\u0331\u3099\u1100\u1161\u11a8\u2126\ufb01Ａ９",
    "<|endoftext|>", "<|EndOfText|>", "don't", "I'LL", "''re", "the", "ing",
]


def test_packing_ids_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "SLICE_CHARS", 500)
    encoder = packing._Encoder(tokenizer())
    common = map(chr, np.flatnonzero(encoder.kinds != packing._ODD).tolist())
    texts = [f"a{c}b1{c}{c} {c}'s {c}" for c in common]  # all kinds of neighbours of each
    rng = np.random.default_rng(7)
    texts += ["".join(ODD_PARTS[k] for k in rng.integers(0, len(ODD_PARTS), rng.integers(0, 30))) for _ in range(3000)]
    texts += ["", " \n", "a" * 3000, " ".join(texts[-200:])]
    encode = encoder.tokenizer.encode_batch
    want = [np.array([*e.ids, 2], "<u4").tobytes() for e in encode(texts, add_special_tokens=False)]
    assert encoder.encode(texts, 2) == want
    assert encoder.encode(["", ""], 2) == [want[texts.index("")]] * 2 and encoder.encode([], 2) == []
    encoder.tokenizer = None  # common words do without it
    some = ["Thé cat's  20 mats, (really)!", "", "Σίσυφος — “Иван”, 三十"]
    assert encoder.encode(some, 2) == [np.array([*e.ids, 2], "<u4").tobytes() for e in encode(some, add_special_tokens=False)]


def test_packing_ranks_give_each_entry_its_id():
    # with ids that follow the merges, all texts' ids then are those of the merges
    encoder = packing._Encoder(tokenizer())
    model = json.loads(encoder.tokenizer.to_str())["model"]
    assert all(max(model["vocab"][x] for x in pair) < 512 + k for k, pair in enumerate(model["merges"]))
    letters, n = byte_level_alphabet(), 0
    for entry, i in model["vocab"].items():
        if entry.endswith("</w>") and not entry.startswith("<|") and i != model["vocab"]["Ġ</w>"]:
            try:
                text = bytes(map(letters.__getitem__, entry.removesuffix("</w>"))).decode()
            except UnicodeDecodeError:
                continue
            assert encoder.pairs.encode(text + " ") == [i]
            n += 1
    assert n > 30_000


def test_packing_of_a_vocabulary_of_another_kind(tmp_path):
    with open(tokenizer(), encoding="utf-8") as f:
        file = json.load(f)
    file["normalizer"]["normalizers"].pop()  # keeps capitals
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file), encoding="utf-8")
    encoder = packing._Encoder(str(other))
    assert encoder.pairs is None
    ids = encoder.tokenizer.encode("The Cat's 20 mats", add_special_tokens=False).ids
    assert encoder.encode(["The Cat's 20 mats"], 2) == [np.array([*ids, 2], "<u4").tobytes()]


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 101, 300))[::-1]
    window, offset = packing.best_fit(lengths, 100)
    room: list[int] = []
    for n, w, o in zip(lengths, window, offset, strict=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if fits:
            assert room[w] == min(fits)[0]
        else:
            assert w == len(room)
            room.append(100)
        assert o == 100 - room[w]
        room[w] -= n


def test_pseudonyms():
    f = pseudonyms.Feistel(b"k")
    text = (
        "card 4111 1111 1111 1111, 4111-1111-1111-1112; tel +1 (743) 555-3824 or 212-555-0123; ip 152.143.123.131 "
        "and 999.1.1.1; born 1984-02-29 or 29.02.1985, 3/14/2001; ssn 123-45-6789, 000-12-3456; "
        "iban GB82 WEST 1234 5698 7654 32; mail Bob.19@mail5.example.com; key 24be64439e3e49cf46b2d7c90f3602a3; 12345"
    )
    new, spans = pseudonyms.replaced(text, f)
    assert [s["kind"] for s in spans] == ["card", "phone", "phone", "ip", "date", "date", "ssn", "iban", "email", "secret"]
    assert "4111-1111-1111-1112" in new and "29.02.1985" in new and "000-12-3456" in new
    found = dict(zip(["card", "phone"], (new[s["start"] : s["end"]] for s in spans[:2]), strict=False))
    assert found["card"] != "4111 1111 1111 1111" and not pseudonyms._luhn(re.sub(r"\D", "", found["card"]))
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", found["phone"])
    assert pseudonyms.replaced(new, f, back=True)[0] == text
    assert pseudonyms.replaced("clean text 12 3.5 v1.2.3", f) == ("clean text 12 3.5 v1.2.3", [])
    assert sorted(f.permute(x, 97, b"t") for x in range(97)) == list(range(97))
    assert [f.permute(f.permute(x, 1000, b"t"), 1000, b"t", True) for x in range(50)] == list(range(50))
    dates = " ".join(f"{m}/{d}/2001 {d:02d}.{m:02d}.1999" for m in range(1, 13) for d in range(1, 29))
    assert pseudonyms.replaced(pseudonyms.replaced(dates, f)[0], f, back=True)[0] == dates


def test_phones_with_any_area():
    f = pseudonyms.Feistel(b"k")
    rng = np.random.default_rng(3)
    some = [f"+1 ({a:03d}) {e:03d}-{n:04d}" for a, e, n in zip(*rng.integers(0, [[250], [250], [10_000]], (3, 200)), strict=True)]
    for text in ("+1 (017) 555-7713", "(743) 199-0000", "+1 000 000 0000", "100-555-7713", *some):
        new, spans = pseudonyms.replaced(f"call {text} now", f)
        assert [s["kind"] for s in spans] == ["phone"] and new != f"call {text} now"
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", f"call {text} now")
        assert pseudonyms.replaced(new, f, back=True)[0] == f"call {text} now"
    same = {re.sub(r"\D", "", pseudonyms.replaced(t, f)[0])[-10:] for t in ("+1 (017) 555-7713", "(017) 555-7713", "017-555-7713")}
    assert len(same) == 1


def test_values_followed_by_more():
    f = pseudonyms.Feistel(b"k")
    cases = [
        ("card", "4111111111111111", " 123"), ("card", "4111 1111 1111 1111", " 12/25"), ("card", "4111111111111111", " 08"),
        ("card", "4111-1111-1111-1111", "-7"), ("iban", "BE68 5390 0754 7034", " BANK"), ("iban", "BE68539007547034", " EUR"),
        ("iban", "GB82 WEST 1234 5698 7654 32", " BANK"), ("date", "2020-01-31", "T12:00:00Z"), ("date", "2020-01-31", "T12:00"),
    ]
    cases += [("card", "4111111111111111", f" {n:0{w}d}") for w in (1, 2, 3) for n in range(10**w)]
    cases += [("iban", "BE68 5390 0754 7034", f" {n:04d}") for n in range(0, 10_000, 71)]
    found = {}
    for kind, value, behind in cases:
        text = f"see {value}{behind} end"
        new, spans = pseudonyms.replaced(text, f)
        assert [s["kind"] for s in spans] == [kind] and value not in new
        assert pseudonyms.replaced(new, f, back=True)[0] == text
        if spans[0]["end"] == 4 + len(value):
            found.setdefault(re.sub(r"\W", "", value), set()).add(re.sub(r"\W", "", new[4 : spans[0]["end"]]))
    assert all(len(x) == 1 for x in found.values()) and len(found) == 4
    for text in ("2020-01-31Tx", "2020-01-31x", "4111111111111112 123", "BE68 5390 0754 7035 BANK"):
        assert pseudonyms.replaced(text, f) == (text, [])


def test_pseudonyms_of_a_table(spark, docs, none):
    mail = spark.createDataFrame([(1, "to a1@b.org"), (2, "see a1@b.org"), (3, None)], "doc_id long, text string")
    got = pseudonyms.pseudonymise(mail.withColumns({"spans": F.lit("old"), "_made": F.lit("kept")}), b"k").orderBy("doc_id").collect()
    assert {r["_made"] for r in got} == {"kept"}
    assert got[0]["text"][3:] == got[1]["text"][4:] != "a1@b.org" and got[2]["text"] is None and got[2]["spans"] == []
    same = pseudonyms.pseudonymise(docs, b"k").collect()
    assert sorted(str(r["text"]) for r in same) == sorted(str(r[1]) for r in rows())
    assert pseudonyms.reveal(pseudonyms.pseudonymise(mail, b"k"), b"k").select("text").collect() == mail.select("text").collect()
    assert not pseudonyms.pseudonymise(none, b"k").collect()


def test_key_from_a_setting(spark):
    mail = spark.createDataFrame([(1, "to a1@b.org")], "doc_id long, text string")
    with pytest.raises(ValueError, match="not set"):
        pseudonyms.pseudonymise(mail)
    with pytest.warns(UserWarning, match="public key"):
        assert pseudonyms.key_of(spark, pseudonyms.TRIAL_KEY) == pseudonyms.TRIAL_KEY
    spark.conf.set(pseudonyms.KEY_SETTING, "k")
    try:
        assert pseudonyms.key_of(spark, pseudonyms.TRIAL_KEY) == b"k"
        assert pseudonyms.pseudonymise(mail).collect() == pseudonyms.pseudonymise(mail, b"k").collect()
    finally:
        spark.conf.unset(pseudonyms.KEY_SETTING)


def test_licences(spark, docs, none):
    texts = [
        "Code.\nLicensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.",
        "This work is licensed under the GNU General Public License, version 3. Or, at your option, any later version!\nx",
        "Released under the MIT License. All rights reserved.", "MIT", None, "or at your option any later version",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [(r["licences"], r["unknown"]) for r in licences.recognise(df).orderBy("doc_id").collect()]
    assert got == [
        (["Apache-2.0"], []), (["GPL-3.0-or-later"], []), (["MIT", "Proprietary"], []), ([], []), ([], []), ([], ["OrLater"]),
    ]
    assert licences.recognise(docs).count() == len(rows()) and not licences.recognise(none).collect()


MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE.
"""
BSD = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
"""
APACHE = """   Copyright 2020 Some Body

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
"""
GPL = """This file is part of Some Tool.

Some Tool is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

Some Tool is distributed in the hope that it will be useful.
"""


def test_licences_of_standard_texts(spark):
    gpl2 = GPL.replace("software:", "software;").replace("Foundation,", "Foundation;").replace("version 3", "version 2")
    lesser = GPL.replace("GNU General", "GNU Lesser General")
    wanted = [
        (MIT, ["MIT"], ["MIT", "MitGrant", "MitAsIs"]), (BSD, ["BSD"], ["AllRights", "BsdGrant"]),
        (APACHE, ["Apache-2.0"], ["Apache2Ref", "ApacheUse", "ApacheCopy"]), (GPL, ["GPL-3.0-or-later"], ["Gpl3Ref", "OrLater"]),
        (gpl2, ["GPL-2.0-or-later"], ["Gpl2Ref", "OrLater"]), (GPL.replace("Some Tool is free", "This program is free"), ["GPL-3.0-or-later"], None),
        (gpl2.replace("either version 2 of the License, or\n(at your option) any later version", "version 2"), ["GPL-2.0-only"], None),
        (lesser, ["LGPL-3.0-or-later"], ["LGPL-3.0", "OrLater"]), ("x\nReleased under the MIT License\ny", ["MIT"], ["MitRef"]), ("not Released under the MIT License", [], []),
        ("Released\n\nunder the MIT License", [], []), (None, [], []), (" ;\n \n" * 9, [], []),
    ]
    changes = [
        lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "".join(f"# {x}\n" for x in t.split("\n")),
        lambda t: t if "\n\nunder" in t or "x\n" in t else "\n\n".join(" ".join(x.split()) for x in t.split("\n\n")),
    ]
    texts = [(k, n, t and change(t)) for n, change in enumerate(changes) for k, (t, _, _) in enumerate(wanted)]
    df = spark.createDataFrame([(n * 100 + k, t) for k, n, t in texts], "doc_id long, text string")
    for r in licences.recognise(df).collect():
        n, k = divmod(r["doc_id"], 100)
        if n == 3 and "All rights" in (wanted[k][0] or ""):  # no sentence of its own when on one line with the holder
            assert r["licences"] == ["BSD"]
            continue
        assert (r["licences"], r["unknown"]) == (wanted[k][1], []), (n, wanted[k][0])
        assert wanted[k][2] is None or r["identifiers"] == wanted[k][2]


def brute_capacity(sizes, shards):
    for capacity in range(max(sizes), sum(sizes) + 1):
        used, room = 0, 0
        for n in sizes:
            if n > room:
                used, room = used + 1, capacity
            room -= n
        if used <= shards:
            return capacity


def test_smallest_capacity():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = rng.integers(1, 30, 25).tolist()
        assert sharding.smallest_capacity(sizes, 4) == brute_capacity(sizes, 4)


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_sharding(spark, docs, none, monkeypatch, bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits)
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("repeat('t' || id % 120, int(id % 13))").alias("text"))
    for df in (many, docs):
        got = sharding.shard(df, 5).collect()
        sizes: dict = {}
        for r in got:
            sizes[r["hash"]] = sizes.get(r["hash"], 0) + r["size"]
        total = {k: sum(r["size"] for r in got if r["shard"] == k) for k in range(5)}
        assert max(total.values()) == brute_capacity([sizes[h] for h in sorted(sizes)], 5)
        assert len({(r["hash"], r["shard"]) for r in got}) == len(sizes)
        for k in range(5):
            assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
        assert len(got) == df.count()
    assert not sharding.shard(none, 5).collect()


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(4)
    data, marks = [], []
    for i in range(600):
        sentences = [" ".join(f"w{rng.integers(50)}" for _ in range(8)) for _ in range(6)]
        if i % 4 == 0:
            sentences[i % 6] += " vile" + "abcdef"[rng.integers(6)]
        data.append((i, ". ".join(sentences)))
        marks.append((i, int(i % 4 == 0)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.judge(df, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.95
    model = toxicity.train(df, labels)
    spans = toxicity.offending_sentences(df.filter("doc_id = 8"), model).collect()
    assert len(spans) == 1 and b"vile" in data[8][1].encode()[spans[0]["start"] : spans[0]["end"]]
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == len(rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert not toxicity.judge(none, labels).collect()
    assert {r["score"] for r in toxicity.judge(df, labels.limit(0)).collect()} == {0.0}


def test_toxicity_trains_on_all_sentences(monkeypatch):
    rng = np.random.default_rng(5)
    texts, toxic = [], np.arange(80) % 4 // 3
    for y in toxic:
        sentences = [" ".join(f"w{rng.integers(50)}" for _ in range(7)) for _ in range(300)]
        sentences[100] += " vile" * y  # the only toxic one of 2,100 words
        texts.append(". ".join(sentences))
    whole = toxicity.fit(pa.array(texts), toxic)
    scores = whole.scores(pa.array(texts))
    assert scores[toxic == 1].min() > 0.5 and scores[toxic == 0].max() < 0.1
    monkeypatch.setattr(words, "SLICE_BYTES", 40_000)
    cut = toxicity.fit(pa.array(texts), toxic)
    assert np.allclose(whole.weights, cut.weights, atol=1e-4) and abs(whole.bias - cut.bias) < 1e-6
    assert toxicity.fit(pa.array([" ", "\n"]), np.array([0, 1])).scores(pa.array([" "])) == [0]


def test_graph_search(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[100:160] = x[100]
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [1.0, None] * 8), (1080, [1.0] * 3), (None, [1.0] * 16), (7, x[7].tolist())]
    got = graph_search.nearest(spark.createDataFrame(data + odd, "vec_id long, embedding array<float>")).collect()
    exact = x.astype(float) @ x.T.astype(float)
    hits = []
    for q in range(0, 700, 20):
        order = sorted((i for i in range(700) if i != q), key=lambda i: (-exact[q, i], i))[:20]
        found = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert np.allclose([r["score"] for r in found], [exact[q, r["vec_id"]] for r in found], rtol=1e-12, atol=1e-12)
        hits.append(len({r["vec_id"] for r in found} & set(order)) / 20)
    assert np.mean(hits) >= 0.9 and not [r for r in got if r["query_id"] >= 1000]
    assert not graph_search.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect()


def test_every_usable_row_is_a_candidate(spark):
    """Rows that share an id, of which the least vector is not usable or not the nearest."""
    inf = float("-inf")
    data = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [5.0, 0.0]), (2, [inf, 0.0]), (2, [3.0, 0.0]), (3, [2.0, 0.0]), (20, [1.0, 0.0]), (20, [4.0, 4.0])]
    df = spark.createDataFrame([(*r, 1, "s") for r in data], "vec_id long, embedding array<double>, row int, shard string")
    got = sorted((r["query_id"], -r["score"], r["vec_id"], r["rank"]) for r in graph_search.nearest(df).collect())
    wanted = []
    usable = [(i, v) for i, v in data if v[0] != inf]
    for at, (q, v) in enumerate(usable):
        if q % 20 == 0:
            near = sorted((-(v[0] * w[0] + v[1] * w[1]), i) for k, (i, w) in enumerate(usable) if k != at)
            wanted += [(q, s, i, k) for k, (s, i) in enumerate(near, 1)]
    assert got == sorted(wanted)


def test_packing_shards_with_null_ids(spark):
    """Null and repeated ids are spread over the shards like any other."""
    rows_ = [(None if i % 2 else 7, 0, 1 + i % 5, 9) for i in range(4000)]
    pieces = materialise(spark.createDataFrame(rows_, "doc_id long, start long, length long, ids_crc32 long"), "pieces")
    packed = packing.pack(pieces, window=16, shard_rows=500).collect()
    shards = Counter(r["sequence_id"] >> 32 for r in packed)
    assert len(packed) == 4000 and len(shards) == 8 and max(shards.values()) < 650


def test_components_with_weights(spark, monkeypatch):
    monkeypatch.setattr(components, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(500, 540)] + [(900 + i, 900) for i in range(1, 20)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    wanted = {i: 0 for i in range(300)} | {i: 500 for i in range(500, 541)} | {i: 900 for i in range(900, 920)}
    assert {r["node"]: r["root"] for r in found} == wanted


def test_training_takes_texts_up_to_a_bound(spark, monkeypatch):
    """Repeated ids count once, and the first text even if it is longer than the bound."""
    texts = [(i, f"plain words number {i} here. " * 5 + ("vile slur here. " if i % 2 else "")) for i in range(400)]
    docs = spark.createDataFrame(texts + texts[:50], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 3000)
    few = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 2 == 1) for r in few]) > 0.9
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 1)
    assert toxicity.train(docs, labels) is not None


def test_mixing(spark, docs, none):
    many = spark.range(400).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w x ', int(id % 50))").alias("text"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 's' || id % 4 END").alias("source"),
    )
    got = mixing.taken(many).collect()
    sizes: dict = {}
    by = {r["doc_id"]: r["source"] for r in many.collect()}
    for r in got:
        sizes[by[r["doc_id"]]] = sizes.get(by[r["doc_id"]], 0) + r["size"]
        assert r["size"] == 2 * (r["doc_id"] % 50) and r["taken"] <= 2 * r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, total = {}, 1.5 * sum(sizes.values())
    while True:  # reshare until none is above twice its size
        free = [s for s in names if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 2 * sizes[s] for s in full}
    for s in names:
        rows_ = [r for r in got if by[r["doc_id"]] == s]
        assert rows_[0]["target"] == pytest.approx(target[s]) and rows_[0]["source_size"] == sizes[s]
        assert abs(sum(r["taken"] for r in rows_) - target[s]) <= 0.5
    assert sorted(mixing.taken(many).collect()) == sorted(got)
    assert mixing.taken(docs).count() == len(rows()) and not mixing.taken(none).collect()


def test_permutation(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("s")).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def test_mixed_documents(spark):
    df = spark.createDataFrame([(1, "a  b\nc", "s"), (2, " d e ", None), (3, None, "s"), (3, None, "s")], "doc_id long, text string, source string")
    got = mixing.mixed_documents(df).collect()
    words = {1: ["a", "b", "c"], 2: ["d", "e"]}
    assert all(r["text"].split() == words[r["doc_id"]][: len(r["text"].split())] for r in got) and set(got[0].asDict()) == set(df.columns)
    # of 7.5 words two sources of weights 5 and 2 take 5.36 and 2.14
    assert {i: sum(len(r["text"].split()) for r in got if r["doc_id"] == i) for i in words} == {1: 5, 2: 2}


@pytest.mark.parametrize("sizes", [(3, 10, 10), (10, 10, 10), (100, 150, 400), (64, 128, 65), (1, 1, 1)])
def test_mixing_to_the_word(spark, sizes):
    """Sources of any size get their rounded target, in the numbers and in the texts."""
    data = []
    for k, n in enumerate(sizes):  # documents of seven words, and a rest
        for at in range(0, n, 7):
            text = " ".join(f"s{k}w{i}" for i in range(at, min(n, at + 7)))
            data.append((len(data), text, f"s{k}", k, "h"))
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size int, _hash string")
    taken = mixing.taken(df.drop("size")).collect()
    mixed = mixing.mixed_documents(df).collect()
    source = {i: s for i, _, s, _, _ in data}
    for k, n in enumerate(sizes):
        rows_ = [r for r in taken if source[r["doc_id"]] == f"s{k}"]
        goal = int(rows_[0]["target"] + 0.5)
        assert sum(r["taken"] for r in rows_) == goal <= 2 * n and all(r["taken"] <= 2 * r["size"] for r in rows_)
        found = [w for r in mixed if r["source"] == f"s{k}" for w in r["text"].split()]
        assert len(found) == goal and set(found) <= {f"s{k}w{i}" for i in range(n)}
        assert all(r["size"] == k and r["_hash"] == "h" for r in mixed if r["source"] == f"s{k}")


def test_url_aliases(spark):
    rules = spark.createDataFrame([*url_aliases.RULES, (None, "/", "block")], "host string, path string, verdict string")
    canon = '<link rel="canonical" href="{}">'
    moved = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://A.example.org/es/x?q#f", None), (2, "https://a.example.org/en/12", ""), (3, "http://notcom/de/", "x"),
        (4, "http://b.com/fr/1", "x"), (5, "http://c.net/p", canon.format("http://a.example.org/es/1")),
        (6, "http://d.net/", moved.format("http://c.net/p")), (7, "http://e.net/", canon.format("http://b.com/fr/1")),
        (8, "http://f.net/", canon.format("http://e.net/")), (9, "http://f.net/", canon.format("http://b.com/de/9")),
        (10, None, None), (11, "no scheme", None), (12, "x://b.com", "x"), (12, "x://b.com", "x"),
    ]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, rule string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_aliases.judge(df, rules).collect()}
    assert got == {
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "a.example.org", "/en/12", "example.org/en/1", "block"),
        (3, "notcom", "/de/", None, "allow"), (4, "b.com", "/fr/1", "com/fr/", "allow"), (5, "c.net", "/p", None, "block"),
        (6, "d.net", "/", None, "block"), (7, "e.net", "/", None, "allow"), (8, "f.net", "/", None, "allow"),
        (9, "f.net", "/", None, "allow"), (10, "", "", None, "allow"), (11, "", "", None, "allow"), (12, "b.com", "", None, "allow"),
    }
    assert url_aliases.judge(df, rules).count() == len(pages)
    assert not url_aliases.judge(df.limit(0), rules).collect()


def test_components_of_more_edges(spark):
    def roots(edges, known=None):
        return components.components(spark.createDataFrame(edges, "a long, b long"), known)

    first = [(2, 9), (9, 7), (5, 6), (20, 21), (None, 5)]
    known = roots(first)
    for more in ([(7, 1), (6, 30), (40, 41), (41, 40), (8, 8)], [(9, 2), (21, 21)], [(None, 3)], []):
        assert sorted(roots(more, known).collect()) == sorted(roots(first + more).collect())
    none = roots([])
    assert sorted(roots(first, none).collect()) == sorted(known.collect()) and not roots([], none).collect()


def test_components_start_few_queries(spark, monkeypatch):
    """A chain takes rounds; each counts its nodes once, and asks only for what it needs to go on."""
    kind, asked = type(spark.range(1)), Counter()
    for name in ("count", "isEmpty"):
        old = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, name=name, old=old: (asked.update([name]), old(self))[1])
    monkeypatch.setattr(components, "materialise", lambda df, name: (asked.update([name]), materialise(df, name))[1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    found = components.components(chain)
    assert {r["root"] for r in found.collect()} == {0}
    assert asked["count"] == asked["parents"] == 1
    assert asked["isEmpty"] == asked["edges"] + asked["tops"]
    asked.clear()
    components.components(chain, found)
    assert asked == {"count": 1, "edges": 1, "isEmpty": 1}
