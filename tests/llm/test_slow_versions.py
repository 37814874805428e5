"""Finding personal data and learning toxicity, beside slow versions of both."""

from __future__ import annotations

from datetime import date

import numpy as np
import pyarrow as pa
import pytest

from forumlens.llm import jaccard_join, pseudonyms, toxicity
from forumlens.operators.lookup import lookup_join

WORD = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
PHONES = {f"+0{a}{area}{b}000{c}0000" for a in ("", " ", ".", "-") for area in ("000", "(000)") for b in ("", " ", ".", "-") for c in ("", " ", ".", "-")}
BARE_PHONES = {f"(000){a}000{b}0000" for a in ("", " ") for b in ".-"}
DASHED_PHONES = {f"000{a}000{b}0000" for a in ".-" for b in ".-"}
DATES = ["0000-00-00"] + [f"{a}{m}{b}{m}0000" for m in "./" for a in ("0", "00") for b in ("0", "00")]


def shape(text):
    return "".join("0" if c in "0123456789" else c for c in text)


def is_email(text):
    local, _, domain = text.partition("@")
    labels = domain.split(".")
    return (
        0 < len(local) <= 64 and local[0] in WORD and all(c in WORD + "._%+-" for c in local) and len(labels) > 1
        and all(0 < len(x) <= 63 and x[0] in WORD and all(c in WORD + "-" for c in x) for x in labels[:-1])
        and 2 <= len(labels[-1]) <= 24 and all(c in WORD[:52] for c in labels[-1])
    )


def is_iban(text):
    if not (text[:2].isalpha() and text[:2].isupper() and shape(text[2:4]) == "00"):
        return False
    at, groups = 4, 0
    while groups < 7 and at < len(text):
        begin = at + (text[at] == " ")
        if len(text) < begin + 4 or not all(c in WORD[26:] for c in text[begin : begin + 4]):
            break
        at, groups = begin + 4, groups + 1
    rest = text[at:].removeprefix(" ")
    return groups >= 2 and (at == len(text) or 0 < len(rest) <= 3 and all(c in WORD[26:] for c in rest))


def is_card(text):
    pairs = zip(text, text[1:], strict=False)
    return (
        text[0] in "23456" and text[-1] in "0123456789" and 13 <= sum(c in "0123456789" for c in text) <= 19
        and all(c in "0123456789 -" for c in text) and not any(a in " -" and b in " -" for a, b in pairs)
    )


def fits(kind, text, before, after):
    """Whether the text has the shape of the kind, and may stand between what is around it."""
    value = shape(text)
    wordy = before.isalnum() or before == "_"
    ends = not (after[:1].isalnum() or after[:1] == "_")
    dotted = after[:1] == "." and after[1:2].isdigit()
    if kind == "email":
        return is_email(text) and not wordy and before not in tuple(".%+-")
    if kind in ("iban", "secret"):
        if before and before in WORD or after[:1] and after[0] in WORD:
            return False
        hexes = any(all(c in x for c in text) for x in ("0123456789abcdef", "0123456789ABCDEF"))
        return is_iban(text) if kind == "iban" else 32 <= len(text) <= 64 and hexes
    if kind in ("date", "ssn", "ip"):
        if wordy or before == ".":
            return False
        stamp = kind == "date" and after[:1] == "T" and after[1:2].isdigit()
        if not stamp and (not ends or dotted):
            return False
        numbers = value.split(".")
        return {
            "date": value in DATES, "ssn": value == "000-00-0000",
            "ip": len(numbers) == 4 and all(x in ("0", "00", "000") for x in numbers),
        }[kind]
    if kind == "phone":
        if wordy or before == "+" or after[:1].isdigit():
            return False
        return value in PHONES and text[1] == "1" or value in BARE_PHONES or value in DASHED_PHONES and before not in (".", "-") and ends and after[:1] != "-"
    return is_card(text) and not wordy and before not in tuple(".+-") and ends


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def is_day(text):
    mark = next(c for c in text if not c.isdigit())
    a, b, c = (int(x) for x in text.split(mark))
    y, m, d = {"-": (a, b, c), ".": (c, b, a), "/": (c, a, b)}[mark]
    try:
        return 1800 <= date(y, m, d).year < 2200
    except ValueError:
        return False


def is_valid(kind, text):
    if kind == "card":
        return 13 <= sum(c.isdigit() for c in text) <= 19 and luhn(text)
    if kind == "iban":
        plain = text.replace(" ", "")
        return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    if kind == "date":
        return is_day(text)
    if kind == "ssn":
        return text[:3] not in ("000", "666") and text[0] != "9" and text[4:6] != "00" and text[7:] != "0000"
    if kind == "ip":
        return all(x == str(int(x)) and int(x) < 256 for x in text.split("."))
    return kind != "secret" or not text.isdigit() and not text.isalpha()


def slow_find(text):
    """Each start, each kind, each end from the farthest: no pattern and no skipping but after words."""
    found, at = [], 0
    while at < len(text):
        match = None
        for kind in pseudonyms.KINDS:
            for end in range(min(len(text), at + 150), at, -1):
                if fits(kind, text[at:end], text[at - 1 : at] if at else "", text[end : end + 2]):
                    match = kind, end
                    break
            if match:
                break
        if match is None:
            at += 1
            continue
        kind, end = match
        stops = [end]
        if kind in ("card", "iban"):
            stops += [i for i in range(end - 1, at + 12, -1) if text[i] in " -"]
        good = [i for i in stops if is_valid(kind, text[at:i])]
        if good:
            found.append((kind, at, good[0]))
            at = good[0]
        else:
            at += 1
            while at < len(text) and text[at - 1] in WORD and text[at] in WORD:
                at += 1
    return found


def some_texts(rng, n):
    values = [
        "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "5500 0000 0000 0004", "+1 (743) 555-3824", "212-555-0123",
        "(017) 555-7713", "152.143.123.131", "999.1.1.1", "1.2.3.4", "1984-02-29", "1985-02-29", "29.02.1984", "3/14/2001", "13/14/2001",
        "2020-01-31T12:00:00Z", "123-45-6789", "000-12-3456", "900-12-3456", "GB82 WEST 1234 5698 7654 32", "BE68539007547034",
        "BE68 5390 0754 7035", "Bob.19@mail5.example.com", "a@b", "x+y@z.org", "24be64439e3e49cf46b2d7c90f3602a3", "A" * 32, "7" * 33,
        "plain", "EUR", "BANK", "12", "0123", "v1.2.3", "é", "T1", "-", "+",
    ]
    for _ in range(n):
        parts = []
        for value in rng.choice(values, rng.integers(1, 9)):
            if rng.random() < 0.2:  # another character somewhere
                k = rng.integers(len(value))
                value = value[:k] + str(rng.choice(list("0123456789 .-aZ_"))) + value[k + 1 :]
            parts += [value, str(rng.choice([" ", " ", " ", ", ", ". ", "-", ".", "", "/", "\n"]))]
        yield "".join(parts)


def test_values_are_found_as_by_a_slow_search():
    f = pseudonyms.Feistel(b"k")
    kinds = set()
    for text in some_texts(np.random.default_rng(11), 400):
        new, spans = pseudonyms.replaced(text, f)
        found = slow_find(text)
        kinds.update(kind for kind, _, _ in found)
        assert [s["kind"] for s in spans] == [kind for kind, _, _ in found], text
        pieces, end, shift = [], 0, 0
        for s, (_, a, b) in zip(spans, found, strict=True):
            assert s["start"] == a + shift, text
            shift = s["end"] - b
            pieces += [text[end:a], new[s["start"] : s["end"]]]
            end = b
        assert "".join([*pieces, text[end:]]) == new
    assert kinds == set(pseudonyms.KINDS)


def slow_sentences(text):
    """Lists of words, bare of marks, in lower case."""
    out, word, stopped = [], "", True
    for c in text.lower() + " ":
        if c in " \t\n\v\f\r":
            if word:
                if stopped:
                    out.append([])
                out[-1].append(word.strip(".,;:!?'\"()[]{}|#$%&*-_"))
                stopped = any(x in ".!?" for x in word)
                word = ""
            stopped = stopped or c == "\n"
        else:
            word += c
    return out


def places(word):
    """The features of a word, found for it alone."""
    data = np.frombuffer(f"x{word}x".encode(), np.uint8)[1:-1] if word else np.frombuffer(b".", np.uint8)
    return toxicity.sentence_words(data, np.array([0, len(data)]))[0][:, 0]


def slow_score(text, weights, bias):
    none = 1.0
    for sentence in slow_sentences(text):
        logit = bias + sum(weights[places(word)].astype(float).sum() for word in sentence)
        none *= 1 - 1 / (1 + np.exp(-logit))
    return 1 - none


TEXTS = ["", " \n", "One two. Three! 'four' (five)\nsix, seven? eight", "a.b c", "no end", "...", "x\n\ny\n", "Vile. VILE vile-ish, \"vile\"."]


def test_scores_are_the_noisy_or_of_sentences():
    weights = np.random.default_rng(12).normal(size=1 << toxicity.HASH_BITS).astype(np.float32)
    got = toxicity.Model(weights, -1.5).scores(pa.array(TEXTS))
    assert got == pytest.approx([slow_score(t, weights, -1.5) for t in TEXTS], abs=1e-6)


def slow_fit(texts, toxic, used):
    """The same descent with derivatives by differences of the loss itself."""
    at = {place: k for k, place in enumerate(used)}
    bags = []
    for text in texts:
        bags.append([])
        for sentence in slow_sentences(text):
            row = np.zeros(len(used) + 1)
            row[-1] = 1
            for place in np.concatenate([places(word) for word in sentence]):
                if place in at:
                    row[at[place]] += 1
            bags[-1].append(row)
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    rows = np.array([row for bag in bags for row in bag])
    share = np.where(toxic, toxicity.TOXIC_SHARE / toxic.sum(), (1 - toxicity.TOXIC_SHARE) / (1 - toxic).sum())

    def losses(many):
        """Of each row of weights."""
        kept = np.log1p(-1 / (1 + np.exp(-rows @ many.T)))
        none = np.array([np.exp(kept[owner == k].sum(0)) for k in range(len(bags))])
        loss = -(share * toxic) @ np.log(1 - none) - (share * (1 - toxic)) @ np.log(none)
        return loss + toxicity.DECAY / 2 * (many[:, :-1] ** 2).sum(1)

    w = np.append(np.zeros(len(used)), -4.0)
    g1, g2, step_size = np.zeros(len(w)), np.zeros(len(w)), 1e-5 * np.eye(len(w))
    for step in range(1, toxicity.STEPS + 1):
        grad = (losses(w + step_size) - losses(w - step_size)) / 2e-5
        g1, g2 = 0.9 * g1 + 0.1 * grad, 0.99 * g2 + 0.01 * grad**2
        w = w - 0.1 * (g1 / (1 - 0.9**step)) / (np.sqrt(g2 / (1 - 0.99**step)) + 1e-8)
    return w


def test_weights_are_those_of_a_slow_descent():
    rng = np.random.default_rng(13)
    toxic = np.arange(60) % 3 // 2
    texts = []
    for k, y in enumerate(toxic):
        sentences = [" ".join(rng.choice(["red", "green", "blue", "grey"], 3)) for _ in range(4)]
        sentences[k % 4] += (" vile" if k % 2 else " slur") * y + " mild" * (k % 5 == 0 and y)
        texts.append(". ".join(sentences))
    model = toxicity.fit(pa.array(texts), toxic)
    used = toxicity._telling(pa.array(texts), toxic)
    assert 3 <= len(used) <= 40
    want = slow_fit(texts, toxic, used.tolist())
    assert model.bias == pytest.approx(want[-1], abs=0.02)
    assert model.weights[used] == pytest.approx(want[:-1], abs=0.02)
    scores = np.array([slow_score(t, model.weights, model.bias) for t in texts])
    assert scores[toxic == 1].min() > 0.5 > scores[toxic == 0].max()


@pytest.mark.parametrize("bound", [300_000, 5])
def test_copies_and_components_are_looked_up_by_weight(spark, monkeypatch, bound):
    """Most rows are copies of one text, most classes one component; null ids and empty rows too."""
    base = [f"word{k}" for k in range(60)]
    texts = [" ".join(base)] * 200 + [" ".join([*base, f"end{k}"]) for k in range(40)]
    texts += [" ".join(f"other{k}x{j}" for j in range(9)) for k in range(20)] + [None, "", " "] * 10
    rows = [(None if k % 7 == 0 else 5_000 - k, text) for k, text in enumerate(texts)]
    monkeypatch.setattr(lookup_join, "__defaults__", (None, bound))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near = min(i for i, _ in rows[:240] if i is not None)
    want = [(i, 60 - 4 + (k >= 200), near) for k, (i, _) in enumerate(rows[:240])]
    want += [(i, 5, i) for i, _ in rows[240:260]] + [(i, 0, i) for i, _ in rows[260:]]
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(str, want))
