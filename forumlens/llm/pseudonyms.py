"""Format-preserving pseudonyms for personal numbers and dates.

Values are found by their shape and kept only if valid. A value is written as a number within
the set of all valid values of its format, this number is permuted by a keyed Feistel network
(walked on while it falls outside the set), and the result is written in the same format. So
equal values have equal pseudonyms in all documents, different ones different, and the holder
of the key can go back. Separators, case and length stay.

| kind | valid | what is permuted |
|---|---|---|
| card | 13 to 19 digits, first one 2 to 6, Luhn sum | all digits but the first and the check digit, which is made anew; the Luhn sum one place on stays |
| phone | ten digits | all ten; area and exchange from 200 become such, all others others |
| ssn | ddd-dd-dddd; not 000, 666 or 9xx, 00, 0000 | the three groups |
| ip | four numbers up to 255 | all but the first number |
| iban | country, check digits by 97 | the digits and letters after these, each in its class; the check digits stay |
| date | a calendar day of 1800 to 2199, y-m-d, d.m.y or m/d/y | the day |
| email | local@domain | the letters and digits of the local part, each in its class |
| secret | 32 to 64 hexadecimal digits with a digit and a letter | all digits |

A card or IBAN may be found together with a number or word behind it. If the whole is not valid,
its shorter ends at a separator are tried, the longest first. What stays the same (see above) makes
a longer end as valid or not after the change as before, so that going back finds the same end;
only if what is behind is itself part of another value can going back find a different one.
"""

from __future__ import annotations

import hmac
import re
import warnings
from datetime import date, timedelta
from math import prod

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from forumlens.llm.words import small_batches

ROUNDS = 10
KEY_SETTING = "spark.forumlens.pseudonyms.key"
TRIAL_KEY = b"public key for trial runs"
KINDS = ("email", "iban", "secret", "date", "ssn", "ip", "phone", "card")

_DAY = date(1800, 1, 1)
_DAYS = (date(2200, 1, 1) - _DAY).days
_FINDER = re.compile(
    r"(?P<email>(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24})"
    r"|(?<![A-Za-z0-9])(?:(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?P<secret>(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}))(?![A-Za-z0-9]))"
    r"|(?<![\w.])(?:(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?=T[0-9]|(?![\w]|\.[0-9]))"
    r"|(?:(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})"
    r"|(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3}))(?![\w]|\.[0-9]))"
    r"|(?P<phone>(?<![\w+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![\w+])\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}(?![0-9])|(?<![\w+.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.+-])[2-6](?:[ -]?[0-9]){12,18}(?![\w]))"
)


def _luhn(digits: str) -> int:
    """What the Luhn sum is over a multiple of ten."""
    double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10


class Feistel:
    """Keyed permutations of 0 to ``n - 1``."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, turn: int, half: int, bits: int) -> int:
        text = tweak + turn.to_bytes(1, "big") + half.to_bytes((half.bit_length() + 7) // 8 + 1, "big")
        found, need = b"", (bits + 7) // 8
        while len(found) < need:
            found += hmac.digest(self.key, text + len(found).to_bytes(4, "big"), "sha256")
        return int.from_bytes(found[:need], "big") & ((1 << bits) - 1)

    def permute(self, x: int, n: int, tweak: bytes, back: bool = False) -> int:
        if n < 2:
            return x
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        low = (1 << bits) - 1
        while True:
            a, b = x >> bits, x & low
            for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    a, b = b ^ self._round(tweak, turn, a, bits), a
                else:
                    a, b = b, a ^ self._round(tweak, turn, b, bits)
            x = a << bits | b
            if x < n:
                return x

    def characters(self, text: str, tweak: bytes, back: bool) -> str:
        """Digits stay digits, small letters small, capitals capitals; all else stays."""
        bases = [10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 1 for c in text]
        x = 0
        for c, base in zip(text, bases, strict=True):
            x = x * base + (int(c) if base == 10 else ord(c.lower()) - 97 if base == 26 else 0)
        x = self.permute(x, prod(bases), tweak, back)
        out = []
        for c, base in zip(reversed(text), reversed(bases), strict=True):
            x, digit = divmod(x, base)
            letter = chr(97 + digit)
            out.append(str(digit) if base == 10 else c if base == 1 else letter.upper() if c.isupper() else letter)
        return "".join(reversed(out))

    def digits(self, text: str, tweak: bytes, back: bool) -> str:
        if not text:
            return text
        return f"{self.permute(int(text), 10 ** len(text), tweak, back):0{len(text)}d}"


def _filled(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in shape)


def _mixed(f: Feistel, values: list[int], bases: list[int], tweak: bytes, back: bool) -> list[int]:
    x = 0
    for value, base in zip(values, bases, strict=True):
        x = x * base + value
    x = f.permute(x, prod(bases), tweak, back)
    out = []
    for base in reversed(bases):
        x, value = divmod(x, base)
        out.append(value)
    return out[::-1]


def _iban_ok(plain: str) -> bool:
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _usual_phone(digits: str) -> bool:
    return digits[0] >= "2" and digits[3] >= "2"


def _date(text: str) -> tuple[date, str, list[int]] | None:
    mark = re.sub(r"[0-9]", "", text)[0]
    parts = [int(p) for p in text.split(mark)]
    y, m, d = {"-": (0, 1, 2), ".": (2, 1, 0), "/": (2, 0, 1)}[mark]
    try:
        day = date(parts[y], parts[m], parts[d])
    except ValueError:
        return None
    return (day, mark, [y, m, d]) if 0 <= (day - _DAY).days < _DAYS else None


def pseudonym(kind: str, text: str, f: Feistel, back: bool = False) -> str | None:
    """The pseudonym of a value found as ``kind``; None if the value is not valid."""
    only = re.sub(r"[^0-9]", "", text) if kind in ("card", "phone", "ssn") else ""
    if kind == "card":
        if not 13 <= len(only) <= 19 or _luhn(only):
            return None
        shifted = _luhn(only + "0")
        while True:
            body = only[0] + f.digits(only[1:-1], b"card", back)
            only = body + str(-_luhn(body + "0") % 10)
            if _luhn(only + "0") == shifted:
                return _filled(text, only)
    if kind == "phone":
        body = only[-10:]
        if _usual_phone(body):
            parts = [int(body[:3]) - 200, int(body[3:6]) - 200, int(body[6:])]
            a, e, line = _mixed(f, parts, [800, 800, 10000], b"phone", back)
            body = f"{a + 200}{e + 200}{line:04d}"
        else:
            while _usual_phone(body := f.digits(body, b"other phone", back)):
                pass
        return _filled(text, only[:-10] + body)
    if kind == "ssn":
        a, g, s = int(only[:3]), int(only[3:5]), int(only[5:])
        if a in (0, 666) or a >= 900 or not g or not s:
            return None
        a, g, s = _mixed(f, [a - 1 - (a > 666), g - 1, s - 1], [898, 99, 9999], b"ssn", back)
        a += 1 + (a + 1 >= 666)
        return f"{a:03d}-{g + 1:02d}-{s + 1:04d}"
    if kind == "ip":
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        tail = _mixed(f, parts[1:], [256] * 3, b"ip%d" % parts[0], back)
        return ".".join(map(str, [parts[0], *tail]))
    if kind == "iban":
        plain = text.replace(" ", "")
        if not _iban_ok(plain):
            return None
        body = f.characters(plain[4:], b"iban" + plain[:2].encode(), back)
        while not _iban_ok(plain[:4] + body):
            body = f.characters(body, b"iban" + plain[:2].encode(), back)
        left = iter(plain[:4] + body)
        return "".join(c if c == " " else next(left) for c in text)
    if kind == "date":
        found = _date(text)
        if found is None:
            return None
        places, texts = found[2], text.split(found[1])
        loose = min(len(texts[p]) for p in places[1:]) < 2  # without leading zeros
        day = found[0]
        while day is found[0] or loose and min(day.month, day.day) > 9:
            day = _DAY + timedelta(f.permute((day - _DAY).days, _DAYS, b"date", back))
        parts = [""] * 3
        for place, value in zip(places, (day.year, day.month, day.day), strict=True):
            parts[place] = str(value) if loose else f"{value:02d}"
        return found[1].join(parts)
    if kind == "email":
        local, _, domain = text.partition("@")
        return f"{f.characters(local, b'email' + domain.lower().encode(), back)}@{domain}"
    if kind == "secret":
        if text.isdigit() or text.isalpha():
            return None
        return f"{f.permute(int(text, 16), 16 ** len(text), b'secret', back):0{len(text)}{'x' if text == text.lower() else 'X'}}"
    raise ValueError(kind)


def _stops(kind: str, text: str) -> list[int]:
    """Where a value found as ``text`` may end: after all of it, or before a separator."""
    if kind not in ("card", "iban"):
        return [len(text)]
    return [len(text), *(i for i in range(len(text) - 1, 12, -1) if text[i] in " -")]


def replaced(text: str, f: Feistel, back: bool = False) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and where they are in it."""
    out, spans, end, length = [], [], 0, 0
    at = 0
    while (m := _FINDER.search(text, at)) is not None:
        kind = m.lastgroup
        new = None
        for stop in _stops(kind, m.group()):
            if (new := pseudonym(kind, m.group()[:stop], f, back)) is not None:
                break
        if new is None:  # what follows the first character may hold another value
            at = m.start() + max(1, re.match(r"[A-Za-z0-9]*", m.group()).end())
            continue
        out += [text[end : m.start()], new]
        length += m.start() - end
        spans.append({"kind": kind, "start": length, "end": length + len(new)})
        length += len(new)
        at = end = m.start() + stop
    return "".join([*out, text[end:]]), spans


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _column(key: bytes, back: bool, text: Column) -> Column:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(f"struct<text:string,spans:{SPANS}>")
    def run(texts: pa.Array) -> pa.Array:
        f = Feistel(key)
        rows = [(None, []) if t is None else replaced(t, f, back) for t in texts.to_pylist()]
        columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], kind)]
        return pa.StructArray.from_arrays(columns, ["text", "spans"])

    return run(text)


def key_of(spark: SparkSession, otherwise: bytes | None = None) -> bytes:
    """The key in ``spark.forumlens.pseudonyms.key``, or else the given one; neither is an error.

    Whoever knows the key can go back. With ``TRIAL_KEY``, which is in this file, that is everyone.
    """
    named = spark.conf.get(KEY_SETTING, None)
    if named:
        return named.encode()
    if otherwise is None:
        raise ValueError(f"{KEY_SETTING} is not set")
    if otherwise == TRIAL_KEY:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms by a public key can be undone", stacklevel=2)
    return otherwise


def pseudonymise(documents: DataFrame, key: bytes | None = None) -> DataFrame:
    """All columns of ``documents`` with pseudonyms in ``text``, and ``spans`` of these there.

    Without a ``key`` that of the session's setting is taken, and there must be one. Spans are in
    characters of the new text. Whole texts are searched; a null text stays null, with no spans. An
    earlier column ``spans`` is replaced. Repeated rows stay as they are; an empty table gives no row.
    """
    return _changed(documents, key, False)


def reveal(documents: DataFrame, key: bytes | None = None) -> DataFrame:
    """Undoes ``pseudonymise`` with the same key."""
    return _changed(documents, key, True)


def _changed(documents: DataFrame, key: bytes | None, back: bool) -> DataFrame:
    spark = documents.sparkSession
    small_batches(spark)
    made = "_made"
    while made in documents.columns:
        made += "_"
    kept = documents.drop("spans").withColumn(made, _column(key or key_of(spark), back, F.col("text")))
    return kept.withColumns({"text": F.col(f"{made}.text"), "spans": F.col(f"{made}.spans")}).drop(made)
