"""License scan: ordered signature rules over whole texts.

A rule is a hand-written regex over the normalised text (words joined by one
blank), keywords of which a match holds one, a label, a priority and a
confidence. A keyword prefilter decides which rules run at all; detections are
then resolved by priority and interval containment: a detection whose words lie
inside those of one with an equal or better priority is suppressed.

Null and empty texts have no words and no detections (score 0); very long texts
are normalised by byte tables and scanned one at a time; repeated rows keep
their rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import words

#: phrase -> label of the base rules
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Families: label stem -> (keywords, names a text calls it by, versions it has). A name
# always holds one of the keywords. Names and
# versions are regexes over normalised words; "" stands for "no version named".
FAMILIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "gpl": (("general public license", "gpl",), r"(?:gnu )?(?:general public license|gpl)", ("1", "2", "3")),
    "lgpl": (("lesser general public", "library general public", "lgpl",), r"(?:gnu )?(?:(?:lesser|library) general public license|lgpl)", ("2", "2.1", "3")),
    "agpl": (("affero", "agpl",), r"(?:gnu )?(?:affero general public license|agpl)", ("1", "3")),
    "gfdl": (("free documentation license", "gfdl",), r"(?:gnu )?(?:free documentation license|gfdl)", ("1.1", "1.2", "1.3")),
    "apache": (("apache",), r"apache(?: software)?(?: license| licence)?", ("1.0", "1.1", "2.0")),
    "mpl": (("mozilla public", "mpl",), r"(?:mozilla public license|mpl)", ("1.0", "1.1", "2.0")),
    "epl": (("eclipse public", "epl",), r"(?:eclipse public license|epl)", ("1.0", "2.0")),
    "cddl": (("common development and distribution", "cddl",), r"(?:common development and distribution license|cddl)", ("1.0", "1.1")),
    "cpl": (("common public license", "cpl",), r"(?:common public license|cpl)", ("1.0",)),
    "eupl": (("european union public", "eupl",), r"(?:european union public licen[cs]e|eupl)", ("1.1", "1.2")),
    "osl": (("open software license", "osl",), r"(?:open software license|osl)", ("1.0", "2.0", "3.0")),
    "afl": (("academic free license", "afl",), r"(?:academic free license|afl)", ("2.1", "3.0")),
    "artistic": (("artistic license",), r"artistic license", ("1.0", "2.0")),
    "bsl": (("boost software", "bsl",), r"(?:boost software license|bsl)", ("1.0",)),
    "ofl": (("open font license", "ofl",), r"(?:sil )?(?:open font license|ofl)", ("1.0", "1.1")),
    "odc-by": (("open data commons", "odc by",), r"(?:open data commons attribution license|odc by)", ("1.0",)),
    "odbl": (("open database license", "odbl",), r"(?:open database license|odbl)", ("1.0",)),
    "pddl": (("public domain dedication and", "pddl",), r"(?:public domain dedication and license|pddl)", ("1.0",)),
    "cecill": (("cecill",), r"cecill(?: [bc])?(?: free software license)?", ("1.1", "2.0", "2.1")),
    "ms-pl": (("microsoft public", "ms pl",), r"(?:microsoft public license|ms pl)", ("",)),
    "ms-rl": (("microsoft reciprocal", "ms rl",), r"(?:microsoft reciprocal license|ms rl)", ("",)),
    "zpl": (("zope public", "zpl",), r"(?:zope public license|zpl)", ("1.1", "2.0", "2.1")),
    "php": (("php license",), r"php license", ("3.0", "3.01")),
    "python": (("python software foundation", "psf license",), r"(?:python software foundation|psf) license", ("2",)),
    "ruby": (("ruby license",), r"ruby license", ("",)),
    "postgresql": (("postgresql licen",), r"postgresql licen[cs]e", ("",)),
    "openssl": (("openssl license",), r"openssl license", ("",)),
    "upl": (("universal permissive",), r"universal permissive license", ("1.0",)),
    "ncsa": (("ncsa",), r"(?:university of illinois )?(?:ncsa )(?:open source )?license", ("",)),
    "isc": (("isc license",), r"isc license", ("",)),
    "zlib": (("zlib",), r"(?:zlib(?: libpng)?) license", ("",)),
    "mit": (("mit ", "expat ", "x11 ",), r"(?:mit|expat|x11)(?: open source)? licen[cs]e", ("",)),
    "unlicense": (("unlicense",), r"unlicense", ("",)),
    "wtfpl": (("wtfpl",), r"wtfpl", ("1", "2")),
    "openrail": (("openrail",), r"(?:creativeml )?openrail(?: m)?(?: license)?", ("",)),
    "llama": (("llama",), r"llama(?: [23])? community license", ("",)),
    "bsd-2-clause": (("bsd licen",), r"(?:simplified|freebsd|2 clause|two clause) bsd licen[cs]e", ("",)),
    "bsd-3-clause": (("bsd licen",), r"(?:new|modified|revised|3 clause|three clause) bsd licen[cs]e", ("",)),
    "bsd-4-clause": (("bsd licen",), r"(?:original|4 clause|four clause) bsd licen[cs]e", ("",)),
    "bsd": (("bsd licen",), r"bsd licen[cs]e", ("",)),
}
CC = {"by": "by", "by-sa": "by sa", "by-nd": "by nd", "by-nc": "by nc", "by-nc-sa": "by nc sa", "by-nc-nd": "by nc nd"}
CC_NAMES = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s",
            "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
            "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
VERSION = r"(?: (?:as published by the free software foundation )?(?:either )?(?:version|v|ver))? ?v?"
GRANT = r"(?:(?:re)?licen[cs]ed|released|distributed|available|published|provided|dual licen[cs]ed) " \
        r"(?:\S+ ){0,3}?(?:under|with|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"

# Wording of the licences themselves and of common notices (label, confidence, regex, keywords).
TEXTS: list[tuple[str, float, str, tuple[str, ...]]] = [
    ("mit", 1.0,
     r"permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby",)),
    ("isc", 1.0,
     r"permission to use copy modify and or distribute this software for any purpose with or without fee", ("permission to use copy",)),
    ("bsd", 0.95,
     r"redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source",)),
    ("bsd-3-clause", 0.95,
     r"neither the name of (?:\S+ ){1,12}?may be used to endorse or promote products", ("endorse or promote products",)),
    ("bsd-4-clause", 0.95,
     r"all advertising materials mentioning features or use of this software must display", ("all advertising materials",)),
    ("zlib", 1.0,
     r"this software is provided as is without any express or implied warranty in no event will the authors", ("this software is provided as is",)),
    ("gpl", 0.95,
     r"this program is free software you can redistribute it and or modify it", ("this program is free software",)),
    ("lgpl", 0.95,
     r"this library is free software you can redistribute it and or modify it", ("this library is free software",)),
    ("gpl", 0.95, r"you should have received a copy of the gnu general public license", ("gnu general public license",)),
    ("lgpl", 0.95, r"you should have received a copy of the gnu lesser general public license", ("gnu lesser general",)),
    ("agpl", 0.95, r"you should have received a copy of the gnu affero general public license", ("gnu affero",)),
    ("apache-2.0", 1.0,
     r"you may not use this file except in compliance with the license you may obtain a copy of the license", ("in compliance with the license",)),
    ("mpl-2.0", 1.0,
     r"this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", 1.0,
     r"this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("wtfpl", 1.0, r"do what the fuck you want to(?: public license)?", ("do what the",)),
    ("cc0-1.0", 1.0,
     r"(?:creative commons|cc) ?(?:zero|0)(?: 1 0)?(?: universal)?(?: public domain dedication)?", ("cc0", "cc 0", "cc zero", "creative commons",)),
    ("cc-pdm", 0.9, r"creative commons public domain mark(?: 1 0)?", ("public domain mark",)),
    ("public-domain", 0.7, r"(?:dedicated to|released into|placed in|in) the public domain", ("the public domain",)),
    ("public-domain", 0.5, r"no rights reserved", ("no rights reserved",)),
    ("reserved", 0.5, r"some rights reserved", ("some rights reserved",)),
    ("copyright", 0.4, r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*", ("copyright",)),
    ("copyright", 0.4, r"(?:c )?copyright(?: \S+){0,3}? all rights reserved", ("copyright",)),
    ("proprietary", 0.8, r"proprietary and confidential", ("proprietary and confidential",)),
    ("proprietary", 0.8,
     r"unauthori[sz]ed copying of this file (?:\S+ ){0,6}?is strictly prohibited", ("copying of this file",)),
    ("proprietary", 0.7,
     r"may not be (?:reproduced|redistributed|copied) (?:\S+ ){0,8}?without (?:\S+ ){0,4}?permission", ("may not be",)),
    ("commercial", 0.7, r"(?:commercial|enterprise) license(?: agreement)?", ("commercial license", "enterprise license",)),
    ("eula", 0.8, r"end user licen[cs]e agreement", ("end user licen",)),
    ("non-commercial", 0.6,
     r"for (?:personal and )?non ?commercial use only", ("commercial use only", "noncommercial use only",)),
    ("research-only", 0.6,
     r"for (?:academic |scientific )?research (?:purposes|use) only", ("research purposes only", "research use only",)),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]   # a match holds one of them
    pattern: re.Pattern
    priority: int               # smaller wins
    confidence: float
    base: bool = False


def _rule(label: str, keywords: tuple[str, ...], regex: str, priority: int, confidence: float, base: bool = False) -> Rule:
    return Rule(label, keywords, re.compile(rb"(?<![^ ])(?:" + regex.encode() + rb")(?![^ ])"), priority, confidence, base)


def _spaced(version: str) -> str:
    """"2.1" as normalised words; a trailing .0 may be left out."""
    major, _, minor = version.partition(".")
    return major + (f"(?: {minor})?" if minor == "0" else f" {minor}" if minor else "")


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order. Priorities: 0 SPDX tag, 1 licence wording, 2 grant with version,
    3 named version, 4 grant, 5 mere name, 6 base phrase."""
    out: list[Rule] = []
    for stem, (keys, names, versions) in FAMILIES.items():
        tag = rf"spdx licen[cs]e identifier {stem.replace('-', ' ')}"
        later = r"(?: only| or later| or any later version| or at your option any later version)?"
        for v in (x for x in versions if x):
            out += [_rule(f"{stem}-{v}", ("spdx",), f"{tag} {_spaced(v)}{later}", 0, 1.0),
                    _rule(f"{stem}-{v}", keys, GRANT + names + VERSION + _spaced(v) + later, 2, 0.98),
                    _rule(f"{stem}-{v}", keys, names + VERSION + _spaced(v) + later, 3, 0.9)]
        out += [_rule(stem, ("spdx",), tag, 0, 0.95), _rule(stem, keys, GRANT + names, 4, 0.9),
                _rule(stem, keys, names, 5, 0.6)]
    port, named = r"(?: (?:international|unported|generic))?", ("cc by", "creative commons by")
    for stem, short in CC.items():
        for v in CC_VERSIONS:
            label, cc = f"cc-{stem}-{v}", rf"(?:cc|creative commons) {short}"
            out += [_rule(label, ("spdx",), rf"spdx licen[cs]e identifier cc {short} {_spaced(v)}", 0, 1.0),
                    _rule(label, named, rf"{GRANT}(?:a )?{cc} {_spaced(v)}{port}", 2, 0.98),
                    _rule(label, ("creativecommons org",), rf"creativecommons org licenses {short} {_spaced(v)}", 2, 0.98),
                    _rule(label, named, rf"{cc} {_spaced(v)}{port}", 3, 0.9),
                    _rule(label, ("creative commons attribution",),
                          rf"creative commons {CC_NAMES[stem]} {_spaced(v)}{port}(?: licen[cs]e)?", 3, 0.9)]
        out += [_rule(f"cc-{stem}", named, rf"{GRANT}(?:a )?(?:cc|creative commons) {short}", 4, 0.9),
                _rule(f"cc-{stem}", named, rf"(?:cc|creative commons) {short}", 5, 0.6)]
    out += [_rule(label, keys, regex, 1, conf) for label, conf, regex, keys in TEXTS]
    out += [_rule(label, (phrase,), phrase, 6, 0.5, base=True) for phrase, label in BASE.items()]
    return tuple(out)


@lru_cache(maxsize=1)
def prefilter() -> ahocorasick.Automaton:
    """Automaton over every rule's keywords: one pass tells which of them a text holds."""
    a = ahocorasick.Automaton()
    for k in {k for r in rules() for k in r.keywords}:
        a.add_word(k, k)
    a.make_automaton()
    return a


@dataclass
class Detection:
    first: int
    last: int              # words, both included
    label: str
    priority: int
    confidence: float
    base: bool


def detect(text: bytes) -> list[Detection]:
    """Every detection in the normalised text, before suppression."""
    held = {k for _, k in prefilter().iter(text.decode("latin-1"))}
    out = []
    for r in rules() if held else ():
        if not held.isdisjoint(r.keywords):
            for m in r.pattern.finditer(text):
                first = text.count(b" ", 0, m.start())
                out.append(Detection(first, first + m[0].count(b" "), r.label, r.priority, r.confidence, r.base))
    return out


def resolve(found: list[Detection]) -> list[Detection]:
    """Suppress what lies inside a detection of better priority, or of the same one and longer
    (the same words and priority: the first rule stays)."""
    firsts = sorted({d.first for d in found})
    reach = [-1] * (len(firsts) + 1)  # Fenwick tree: furthest last word of a kept detection that starts no later
    kept = []
    for d in sorted(found, key=lambda d: (d.priority, d.first - d.last, d.first)):
        at = i = bisect_right(firsts, d.first)
        far = -1
        while i:
            far, i = max(far, reach[i]), i & (i - 1)
        if far < d.last:
            kept.append(d)
            while at < len(reach):
                reach[at] = max(reach[at], d.last)
                at += at & -at
    return sorted(kept, key=lambda d: (d.first, d.last))


DETAIL = "array<struct<first:long,last:long,label:string,priority:int,confidence:double,base:boolean,kept:boolean>>"


def scan(text: str | Column) -> Column:
    """Struct column: ``n_words`` and every detection, with ``kept`` false where suppressed."""
    kind = pa.struct([("n_words", pa.int64()), ("found", pa.list_(pa.struct(
        [("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("priority", pa.int32()),
         ("confidence", pa.float64()), ("base", pa.bool_()), ("kept", pa.bool_())])))])

    @F.arrow_udf(f"struct<n_words:long,found:{DETAIL}>")
    def run(col: pa.Array) -> pa.Array:
        out = []
        for t in col:
            ws = words(t.as_py())
            norm = b" ".join(ws)
            found = detect(norm)
            kept = {id(d) for d in resolve(found)}
            out.append({"n_words": len(ws), "found": [vars(d) | {"kept": id(d) in kept} for d in found]})
        return pa.array(out, kind)
    return run(text)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the digest of its detections and the detections themselves.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` come from the base
    rules' detections (all places, suppressed or not); ``labels`` from the base ones
    and the kept ones; ``score`` is the confidence that the text carries a licence
    statement: the kept detections' best one.
    """
    d = docs.select(F.col(id_col), scan(F.col(text_col)).alias("s")).select(
        id_col, F.col("s.n_words").alias("n_words"), F.col("s.found").alias("detections"))
    base, kept = F.filter("detections", lambda x: x.base), F.filter("detections", lambda x: x.kept)
    label = lambda a: F.array_sort(F.array_distinct(F.transform(a, lambda x: x.label)))
    starts = F.transform(base, lambda x: x.first)
    return d.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(label(base), ",").alias("base_labels"),
        F.array_join(label(F.concat(base, kept)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda x: x.confidence)), F.lit(0.0)).alias("score"), "detections")
