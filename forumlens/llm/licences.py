"""Licence recognition: known sentences first, then rules over their sequence.

Texts are normalised and known licence sentences are looked for in them, from a sentence's
or line's beginning to such an end; they may go on over single line breaks. A document's identifiers, in order, are matched to licence rules: from the first
rule on, each occurrence of a rule's sequence of consecutive identifiers is one recognition
and is taken out. What no rule explains stays as unknown identifiers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Known sentences, as normalised here, and their identifiers.
SENTENCES = [
    ("released under the mit license", "MitRef"),
    ("licensed under the mit license", "MitRef"),
    ("spdx license identifier mit", "MitRef"),
    ("licensed under the apache license version 2 0", "Apache2Ref"),
    ("spdx license identifier apache 2 0", "Apache2Ref"),
    ("you may not use this file except in compliance with the license", "ApacheUse"),
    ("you may obtain a copy of the license at", "ApacheCopy"),
    ("this work is licensed under the gnu general public license version 3", "Gpl3Ref"),
    ("this work is licensed under the gnu general public license version 2", "Gpl2Ref"),
    ("licensed under the gnu general public license version 3", "Gpl3Ref"),
    ("licensed under the gnu general public license version 2", "Gpl2Ref"),
    ("spdx license identifier gpl 3 0 only", "Gpl3Ref"),
    ("spdx license identifier gpl 2 0 only", "Gpl2Ref"),
    ("or at your option any later version", "OrLater"),
    ("licensed under cc by nc 4 0", "CcByNc4Ref"),
    ("licensed under cc by sa 4 0", "CcBySa4Ref"),
    ("licensed under cc by 4 0", "CcBy4Ref"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "CcBy4Ref"),
    ("all rights reserved", "AllRights"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "MitGrant"),
    ("the software is provided as is without warranty of any kind express or implied", "MitAsIs"),
    ("redistribution and use in source and binary forms are permitted", "BsdGrant"),
]

# Rules in the order in which they are tried; longer ones of a licence first.
RULES = [
    ("Apache-2.0", ["Apache2Ref", "ApacheUse", "ApacheCopy"]),
    ("Apache-2.0", ["Apache2Ref", "ApacheUse"]),
    ("Apache-2.0", ["Apache2Ref"]),
    ("GPL-3.0-or-later", ["Gpl3Ref", "OrLater"]),
    ("GPL-2.0-or-later", ["Gpl2Ref", "OrLater"]),
    ("GPL-3.0-only", ["Gpl3Ref"]),
    ("GPL-2.0-only", ["Gpl2Ref"]),
    ("MIT", ["MitGrant", "MitAsIs"]),
    ("MIT", ["MitGrant"]),
    ("MIT", ["MitRef"]),
    ("CC-BY-NC-4.0", ["CcByNc4Ref"]),
    ("CC-BY-SA-4.0", ["CcBySa4Ref"]),
    ("CC-BY-4.0", ["CcBy4Ref"]),
    ("BSD", ["BsdGrant"]),
    ("Proprietary", ["AllRights"]),
]

# SPDX identifiers and other names of the licences.
NAMES = {
    "MIT": ["mit license", "mit licence", "expat license", "mit"],
    "MIT-0": ["mit no attribution license"],
    "ISC": ["isc license"],
    "0BSD": ["zero clause bsd license", "bsd zero clause license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache software license version 2 0", "apache 2 0 license"],
    "MPL-1.1": ["mozilla public license version 1 1", "mozilla public license 1 1"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license v1 0", "eclipse public license 1 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v2 0", "eclipse public license v 2 0", "eclipse public license 2 0"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "CDDL-1.0": ["common development and distribution license version 1 0", "common development and distribution license 1 0"],
    "Artistic-2.0": ["artistic license 2 0"],
    "PSF-2.0": ["python software foundation license version 2"],
    "OFL-1.1": ["sil open font license version 1 1"],
    "Zlib": ["zlib license"],
    "Unlicense": ["unlicense", "the unlicense"],
    "WTFPL": ["do what the fuck you want to public license"],
    "CC0-1.0": ["cc0 1 0 universal", "creative commons zero v1 0 universal", "cc0"],
}

# Parts of the names of Creative Commons licences, their versions and their forms.
CREATIVE = {
    "CC-BY": "attribution",
    "CC-BY-SA": "attribution sharealike",
    "CC-BY-NC": "attribution noncommercial",
    "CC-BY-ND": "attribution noderivatives",
    "CC-BY-NC-SA": "attribution noncommercial sharealike",
    "CC-BY-NC-ND": "attribution noncommercial noderivatives",
}
CREATIVE_VERSIONS = {"3.0": ["unported", ""], "4.0": ["international", ""]}

# The GNU licences, their versions, and the date below a version's title.
GNU = {"GPL": "gnu general public license", "LGPL": "gnu lesser general public license", "AGPL": "gnu affero general public license"}
GNU_VERSIONS = {
    "GPL": {"2.0": "june 1991", "3.0": "29 june 2007"},
    "LGPL": {"2.1": "february 1999", "3.0": "29 june 2007"},
    "AGPL": {"3.0": "19 november 2007"},
}
GNU_REFS = {"GPL-2.0": "Gpl2Ref", "GPL-3.0": "Gpl3Ref"}  # as SENTENCES names them; the others by themselves

# SPDX exceptions, which stand after "with".
EXCEPTIONS = ["Classpath-exception-2.0", "LLVM-exception", "GCC-exception-3.1", "Linux-syscall-note", "Autoconf-exception-3.0"]

SUBJECTS = "project|work|program|software|library|file|package|code|repository|module|document|tool"
GIVEN = "licensed|released|distributed|available|made available|provided|published"

_FSF = "as published by the free software foundation"
_FREE = ["this program is free software you can", "this library is free software you can", "you can", "you may"]


def _spelled(name: str) -> str:
    return name.lower().replace("-", " ").replace(".", " ")


def _gnu() -> Iterator[tuple[str, str, str, str]]:
    """Short name, long name, version and the identifier of each GNU licence's version."""
    for short, long in GNU.items():
        for version in GNU_VERSIONS[short]:
            yield short, long, version, GNU_REFS.get(f"{short}-{version}", f"{short}-{version}")


def _gnu_sentences() -> Iterator[tuple[str, str]]:
    """The notices and titles of the GNU licences; both of a version's spellings, ``3`` and ``3 0``."""
    for short, long, version, ref in _gnu():
        yield f"{long} version {_spelled(version).removesuffix(' 0')} {GNU_VERSIONS[short][version]}", ref
        for v in {_spelled(version), _spelled(version).removesuffix(" 0")}:
            later = "or at your option any later version"
            for which, found in (
                (f"{_FSF}; either version {v} of the license {later}", f"{ref} OrLater"),
                (f"{_FSF}; either version {v}; {later}", f"{ref} OrLater"),
                (f"version {v} {later} {_FSF}", f"{ref} OrLater"),
                (f"{_FSF}; version {v} of the license", ref),
                (f"{_FSF}; version {v}", ref),
                (f"{_FSF} version {v} only", ref),
                (f"version {v} {_FSF}", ref),
                (f"version {v} only {_FSF}", ref),
            ):
                for free in _FREE:
                    yield f"{free} redistribute it and or modify it under the terms of the {long} {which}", found


# Sentences of the licences' own texts and notices. A ; is a sentence mark or none;
# several identifiers are in order. These are beside the short forms.
STANDARD = [
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
        "MitGrant",
    ),
    (
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement",
        "MitAsIs",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "IscGrant",
    ),
    *[
        (f"redistribution and use in source and binary forms with or without modification are permitted{end}", "BsdGrant")
        for end in ("", " provided that the following conditions are met")
    ],
    (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
        "BsdSource",
    ),
    (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
        "BsdBinary",
    ),
    *[
        (
            f"neither the name of {owner} nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission",
            "BsdNames",
        )
        for owner in ("the copyright holder", "the copyright holders", "the author", "the organization")
    ],
    ("licensed under the apache license version 2 0 the license", "Apache2Ref"),
    (
        "licensed under the apache license version 2 0 the license; you may not use this file except in compliance "
        "with the license",
        "Apache2Ref ApacheUse",
    ),
    *[(f"you may obtain a copy of the license at {http} www apache org licenses license 2 0", "ApacheCopy") for http in ("http", "https")],
    ("apache license version 2 0 january 2004", "Apache2Ref"),
    ("this source code form is subject to the terms of the mozilla public license v; 2 0", "MPL-2.0"),
    ("this is free and unencumbered software released into the public domain", "Unlicense"),
    *_gnu_sentences(),
]

# Tried before RULES.
STANDARD_RULES = [
    *[
        (name, [*before, "BsdGrant", "BsdSource", "BsdBinary", *last])
        for name, last in (("BSD-3-Clause", ["BsdNames"]), ("BSD-2-Clause", []))
        for before in (["AllRights"], [])
    ],
    ("BSD", ["AllRights", "BsdGrant"]),  # the notice that goes before the grant
    ("ISC", ["IscGrant", "MitAsIs"]),
    ("ISC", ["IscGrant"]),
    *[
        rule
        for short, _, version, ref in _gnu()
        for rule in ((f"{short}-{version}-or-later", [ref, "OrLater"]), (f"{short}-{version}-only", [ref]))
    ],
]


def named() -> dict[str, str]:
    """Names that stand in declarations, as normalised, and the identifiers of what they name.

    SPDX identifiers and the other names of ``NAMES``, of the Creative Commons and GNU licences with
    ``only`` and ``or later`` (a GNU licence's bare name and version mean that version), and the
    exceptions. An identifier is the SPDX one.
    """
    out = {_spelled(x): x for x in (*NAMES, *EXCEPTIONS)}
    out |= {name: x for x, names in NAMES.items() for name in names}
    for short, long in CREATIVE.items():
        for version, forms in CREATIVE_VERSIONS.items():
            v, spdx = _spelled(version), f"{short}-{version}"
            out[_spelled(spdx)] = spdx
            for form in forms:
                for end in ("", " license", " public license"):
                    out[" ".join(f"creative commons {long} {v} {form}".split()) + end] = spdx
    for short, long, version, ref in _gnu():
        v = _spelled(version)
        for spelled in {v, v.removesuffix(" 0")}:
            heads = [f"{head} {sign}{spelled}" for head in (long, f"gnu {short.lower()}", short.lower()) for sign in ("", "v", "version ")]
            for head in (*heads, f"{short.lower()}v{spelled}"):
                out[head] = out[f"{head} only"] = ref
                out[f"{head} or later"] = out[f"{head} or any later version"] = f"{short}-{version}-or-later"
    return out


NAMED = named()
NAMED_RULES = [(x, [x]) for x in dict.fromkeys(NAMED.values()) if x not in GNU_REFS.values()]
ALL_KNOWN = (*SENTENCES, *STANDARD)
ALL_RULES = (*STANDARD_RULES, *RULES, *NAMED_RULES)

# What may stand before a name in a declaration, and the words after one that are left out.
FRAME = (
    rf"spdx license identifier|licen[sc]e|(?:(?:(?:this|the) )?(?:{SUBJECTS}) is )?(?:also |dual )?(?:{GIVEN}) under"
    r"(?: the terms of)?(?: the| an?)?"
)
AFTER = r" see(?: [a-z0-9]+)+$"


def normalised(texts: Column) -> Column:
    """A-Z in lower case; runs of all but ASCII letters and digits as one space, ``\n`` or ``|``.

    ``\n`` is for a single line break, ``|`` for a blank line or for . ! ? ; before white
    space, as also for : after "software", since notices go on there.
    """
    low = F.translate(texts, "ABCDEFGHIJKLMNOPQRSTUVWXYZ|", "abcdefghijklmnopqrstuvwxyz ")
    plain = F.regexp_replace(F.regexp_replace(low, r"(?:[.!?;]|(?<=software):)[ \t\r\n]", "|\n"), r"[^a-z0-9|\n]+", " ")
    breaks = F.regexp_replace(plain, r"\n[ \n]*\n", "|")
    return F.regexp_replace(F.regexp_replace(breaks, r"[ \n|]*\|[ \n|]*", "|"), r" ?\n ?", "\n")


def pattern(known: Sequence[tuple[str, str]], names: Sequence[str], space: str = r"[ \n]", mark: str = r"[|]") -> str:
    """Known sentences and declarations, without the breaks around them; the longer one first.

    ``space`` and ``mark`` are what may stand between words, and for a ``;``.
    """
    either = rf"(?:{mark}|{space})"
    some = sorted({s for s, _ in known}, key=lambda s: (-len(s), s))
    some = [either.join(part.replace(" ", space) for part in s.split("; ")) for s in some]
    ordered = sorted(names, key=lambda s: (-len(s), s))
    name, title = "(?:" + "|".join(ordered) + ")", "|".join(s for s in ordered if "licen" in s)
    declared = rf"(?:{FRAME}) {name}(?: (?:or|and|with) (?:the )?{name})*(?: see(?: [a-z0-9]+){{1,12}})?|(?:the )?(?:{title})"
    return "|".join([*some, declared.replace(" ", space)])


def names_pattern(names: Sequence[str]) -> str:
    return r"\b(" + "|".join(sorted(names, key=lambda s: (-len(s), s))) + r")\b"


def _words(sequence: Sequence[str]) -> str:
    return "".join(f"<{x}>" for x in sequence)


def recognise(
    documents: DataFrame,
    known: Sequence[tuple[str, str]] = ALL_KNOWN,
    rules: Sequence[tuple[str, Sequence[str]]] = ALL_RULES,
    names: dict[str, str] = NAMED,
) -> DataFrame:
    """``doc_id, identifiers, licences, unknown`` of every document, as arrays in order.

    A known sentence, or a declaration (such as ``SPDX-License-Identifier: A OR B`` or ``Licensed under
    A``) of ``names``, counts from break to break, and so does a name that says licence by itself. ``licences`` has the recognised rules'
    licences without repeats, in the order of the rules; ``unknown`` the identifiers left over. A
    null or empty text has empty arrays. Repeated rows are rows each. Columns other than doc_id and
    text are not used.
    """
    rows = documents.select("doc_id", "text")
    breaks = "(?:^ ?|[\n|])(" + pattern(known, list(names)) + ")(?= ?$|[\n|])"
    sentences = F.create_map(*[F.lit(x) for s, ids in dict(known).items() for x in (s.replace(";", ""), F.split(F.lit(ids), " "))])
    by_name = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])

    def ids_of(sentence: Column) -> Column:
        found = F.regexp_extract_all(F.regexp_replace(sentence, AFTER, ""), F.lit(names_pattern(list(names))), F.lit(1))
        return F.coalesce(F.element_at(sentences, sentence), F.transform(found, lambda n: F.element_at(by_name, n)))

    array = F.regexp_extract_all(normalised(F.col("text")), F.lit(breaks), F.lit(1))
    found = F.flatten(F.transform(array, lambda s: ids_of(F.translate(s, "\n|", "  "))))
    ids = F.coalesce(found, F.array().cast("array<string>"))
    return _ruled(rows.select("doc_id", ids.alias("identifiers")), rules)


def _ruled(rows: DataFrame, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    some = rows.withColumn("_left", F.concat_ws("", F.transform("identifiers", lambda x: F.concat(F.lit("<"), x, F.lit(">")))))
    step = F.struct(F.col("_left").alias("left"), F.array().cast("array<string>").alias("found"))
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_words(seq)).alias("seq")) for name, seq in rules])

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["seq"])
        found = F.when(hit, F.array_union(state["found"], F.array(rule["name"]))).otherwise(state["found"])
        left = F.when(hit, F.replace(state["left"], rule["seq"], F.lit("|"))).otherwise(state["left"])
        return F.struct(left.alias("left"), found.alias("found"))

    done = F.when(F.size("identifiers") > 0, F.aggregate(steps, step, apply)).otherwise(step)
    out = some.withColumn("_done", done)
    return out.select(
        "doc_id",
        "identifiers",
        F.col("_done.found").alias("licences"),
        F.regexp_extract_all(F.col("_done.left"), F.lit("<([^>]*)>"), F.lit(1)).alias("unknown"),
    )
