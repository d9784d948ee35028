"""License scans with ordered signature rules.

Rules are regular expressions over a text's words (lower-cased, joined by single
spaces).  They are written as sentences of licences and as names with versions, ordered by
priority: identifiers before notices, notices before names with versions, those
before plain names.  A rule runs only where its keyword, a literal part of
its pattern, occurs.  Detections that
lie inside one of a better or the same priority are dropped; the rest stays.

Rules for odd input: null counts as empty, texts without words have no places and
score 0.  The base phrases are counted on their own and their labels are never
dropped.  Ids and further columns pass through; columns named as a result are replaced.
Repeated rows each get their row, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby
from re import _parser as sre_parse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import small_batches

# Base phrases and their labels.
BASE = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Label, names (words), versions (words).
FAMILIES = [
    ("mit", [r"mit", r"mit expat", r"expat mit"], []),
    ("expat", [r"expat"], []),
    ("x11", [r"x11", r"mit x11"], []),
    ("isc", [r"isc", r"internet systems consortium"], []),
    ("apache", [r"apache", r"apache software", r"asl"], ["1 0", "1 1", "2 0", "2"]),
    ("gpl", [r"gpl", r"gnu gpl"], ["1", "2", "3", "1 0", "2 0", "3 0"]),
    ("gpl", [r"gnu general public", r"general public"], ["1", "2", "3", "2 0", "3 0"]),
    ("lgpl", [r"lgpl", r"gnu lgpl"], ["2", "2 0", "2 1", "3", "3 0"]),
    ("lgpl", [r"gnu lesser general public", r"lesser general public"], ["2 1", "3", "3 0"]),
    ("lgpl", [r"gnu library general public", r"library general public"], ["2", "2 0"]),
    ("agpl", [r"agpl", r"gnu agpl"], ["1", "3", "3 0"]),
    ("agpl", [r"gnu affero general public", r"affero general public"], ["1", "3", "3 0"]),
    ("gfdl", [r"gnu free documentation", r"free documentation"], ["1 1", "1 2", "1 3"]),
    ("bsd", [r"bsd", r"berkeley software distribution", r"modified bsd", r"simplified bsd", r"new bsd", r"freebsd"], []),
    ("bsd-2-clause", [r"bsd 2 clause", r"2 clause bsd", r"two clause bsd"], []),
    ("bsd-3-clause", [r"bsd 3 clause", r"3 clause bsd", r"three clause bsd"], []),
    ("bsd-4-clause", [r"bsd 4 clause", r"4 clause bsd", r"four clause bsd"], []),
    ("0bsd", [r"0bsd", r"zero clause bsd"], []),
    ("mpl", [r"mozilla public"], ["1 0", "1 1", "2 0"]),
    ("mpl", [r"mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", [r"eclipse public"], ["1 0", "2 0"]),
    ("epl", [r"epl"], ["1 0", "2 0"]),
    ("edl", [r"eclipse distribution"], ["1 0"]),
    ("cddl", [r"cddl"], ["1 0", "1 1"]),
    ("cddl", [r"common development and distribution"], ["1 0", "1 1"]),
    ("cpl", [r"common public"], ["1 0"]),
    ("eupl", [r"european union public"], ["1 0", "1 1", "1 2"]),
    ("eupl", [r"eupl"], ["1 0", "1 1", "1 2"]),
    ("artistic", [r"artistic", r"perl artistic"], ["1 0", "2 0"]),
    ("bsl", [r"boost software"], ["1 0"]),
    ("busl", [r"business source"], ["1 1"]),
    ("zlib", [r"zlib", r"zlib libpng"], []),
    ("unlicense", [r"unlicense", r"the unlicense"], []),
    ("wtfpl", [r"wtfpl"], ["1", "2"]),
    ("psf", [r"python software foundation", r"python"], ["2", "2 0"]),
    ("php", [r"php"], ["3 0", "3 01"]),
    ("openssl", [r"openssl"], []),
    ("ofl", [r"sil open font", r"sil ofl"], ["1 0", "1 1"]),
    ("ms-pl", [r"microsoft public"], []),
    ("ms-rl", [r"microsoft reciprocal"], []),
    ("osl", [r"open software"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", [r"academic free"], ["1 1", "2 0", "2 1", "3 0"]),
    ("qpl", [r"q public"], ["1 0"]),
    ("odbl", [r"open database", r"open data commons open database"], ["1 0"]),
    ("cc-by", [r"creative commons attribution", r"cc attribution"], ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", [r"creative commons attribution sharealike"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", [r"creative commons attribution noncommercial"], ["2 0", "3 0", "4 0"]),
    ("cc-by-nd", [r"creative commons attribution noderivatives"], ["2 0", "3 0", "4 0"]),
    ("cc-by", [r"cc by"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", [r"cc by sa"], ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", [r"cc by nc"], ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-sa", [r"cc by nc sa"], ["2 0", "3 0", "4 0"]),
    ("cc0", [r"cc0"], ["1 0"]),
    ("sspl", [r"sspl"], ["1", "1 0"]),
    ("sspl", [r"server side public"], ["1", "1 0"]),
    ("elastic", [r"elastic"], ["1 0", "2 0"]),
    ("polyform", [r"polyform noncommercial", r"polyform small business"], ["1 0 0"]),
]
# Label, pattern, confidence of sentences that stand in one licence or in notices of it.
NOTICES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    ("mit", r"to deal in the software without restriction including without limitation the rights", 0.95),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", 0.95),
    ("mit-0", r"mit no attribution", 0.9),
    ("x11", r"shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", 0.9),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 0.95),
    ("isc", r"the software is provided as is and the author disclaims all warranties", 0.8),
    ("bsd", r"redistributions? (?:and use )?in source and binary forms with or without modification", 0.9),
    ("bsd", r"redistributions of source code must retain the above copyright notice", 0.9),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice", 0.9),
    ("bsd-3-clause", r"neither the names? of (?:[a-z0-9]+ ){1,12}nor the names of (?:its|their|any) contributors may be used to endorse", 0.95),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", 0.95),
    ("0bsd", r"bsd zero clause", 0.9),
    ("bsd-3-clause-clear", r"no express or implied licenses to any party s patent rights are granted", 0.9),
    ("apache-2.0", r"you may not use this (?:file|work|software) except in compliance with the license", 0.85),
    ("apache-2.0", r"apache org licenses license 2 0", 0.95),
    ("apache-2.0", r"terms and conditions for use reproduction and distribution", 0.85),
    ("apache-1.1", r"this product includes software developed by the apache software foundation", 0.8),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu", 0.9),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty", 0.85),
    ("gpl", r"either version [123] of the license or at your option any later version", 0.85),
    ("gpl", r"you should have received a copy of the gnu general public", 0.9),
    ("gpl-2", r"free software foundation inc 51 franklin st", 0.6),
    ("gpl-3", r"the gnu general public license is a free copyleft license", 0.95),
    ("gpl-3", r"gnu org licenses gpl 3 0", 0.9),
    ("gpl-2", r"gnu org licenses (?:old licenses )?gpl 2 0", 0.9),
    ("gpl-classpath", r"as a special exception the copyright holders of this library give you permission to link", 0.9),
    ("gcc-exception", r"gcc runtime library exception", 0.9),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser", 0.95),
    ("lgpl", r"you should have received a copy of the gnu lesser general public", 0.9),
    ("lgpl-2", r"this library is free software you can redistribute it and or modify it under the terms of the gnu library", 0.95),
    ("agpl-3", r"if your software can interact with users remotely through a computer network", 0.9),
    ("agpl-3", r"you should have received a copy of the gnu affero general public", 0.9),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", 0.95),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", 0.9),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public", 0.95),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public", 0.9),
    ("mpl-2.0", r"mozilla org mpl 2 0", 0.9),
    ("npl", r"the contents of this file are subject to the netscape public", 0.95),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public", 0.95),
    ("epl-2.0", r"eclipse org legal epl (?:v20|2 0)", 0.9),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution", 0.95),
    ("cpl", r"the accompanying program is provided under the terms of this common public", 0.9),
    ("ipl", r"the accompanying program is provided under the terms of this ibm public", 0.9),
    ("eupl", r"you may not use this work except in compliance with the licence", 0.85),
    ("cecill", r"governed by the cecill(?: [bc])? license under french law", 0.95),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", 0.95),
    ("perl", r"under the same terms as perl(?: itself)?", 0.9),
    ("bsl-1.0", r"distributed under the boost software license", 0.95),
    ("bsl-1.0", r"free of charge to any person or organization obtaining a copy of the software and accompanying documentation", 0.9),
    ("busl-1.1", r"the licensor may make an additional use grant", 0.9),
    ("busl-1.1", r"change license (?:[a-z0-9]+ ){1,9}change date", 0.6),
    ("zlib", r"altered source versions must be plainly marked as such", 0.95),
    ("zlib", r"this software is provided as is without any express or implied warranty", 0.7),
    ("libpng", r"the png reference library is supplied as is", 0.9),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 0.95),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", 0.95),
    ("wtfpl", r"do what the fuck you want to", 0.95),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer", 0.95),
    ("beerware", r"beer ?ware license", 0.9),
    ("psf", r"psf is making python available to licensee on an as is basis", 0.95),
    ("psf", r"python software foundation all rights reserved", 0.7),
    ("php", r"this product includes php software freely available from", 0.9),
    ("openssl", r"this product includes software developed by the openssl project", 0.95),
    ("ssleay", r"this product includes cryptographic software written by eric young", 0.95),
    ("ofl-1.1", r"this font software is licensed under the sil open font", 0.95),
    ("ofl-1.1", r"the font software may not be sold by itself", 0.9),
    ("ubuntu-font", r"ubuntu font licen[sc]e", 0.9),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license", 0.8),
    ("osl", r"licensed under the open software license version", 0.9),
    ("afl", r"licensed under the academic free license version", 0.9),
    ("ncsa", r"university of illinois ncsa open source", 0.95),
    ("ncsa", r"to deal with the software without restriction", 0.9),
    ("w3c", r"w3c software notice and license", 0.95),
    ("w3c", r"by obtaining using and or copying this work you the licensee agree", 0.9),
    ("icu", r"icu license icu", 0.7),
    ("unicode", r"unicode inc license agreement data files and software", 0.95),
    ("unicode", r"unicode license v3", 0.9),
    ("curl", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", 0.85),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose", 0.85),
    ("postgresql", r"postgresql licen[sc]e", 0.9),
    ("postgresql", r"in no event shall the university of california be liable to any party for direct indirect", 0.9),
    ("sleepycat", r"information on how to obtain complete source code for the db software", 0.95),
    ("tcl", r"this software is copyrighted by the regents of the university of california sun microsystems", 0.9),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim", 0.95),
    ("ruby", r"you can redistribute it and or modify it under either the terms of the 2 clause bsdl", 0.95),
    ("ijg", r"this software is based in part on the work of the independent jpeg group", 0.9),
    ("ftl", r"portions of this software are copyright (?:[0-9]+ )?the freetype project", 0.9),
    ("odbl", r"this (?:[a-z0-9]+ ){1,6}is made available under the open database license", 0.95),
    ("odc-by", r"made available under the open data commons attribution license", 0.95),
    ("pddl", r"open data commons public domain dedication and license", 0.95),
    ("cc-by", r"creativecommons org licenses by [1-4] [05]", 0.95),
    ("cc-by-sa", r"creativecommons org licenses by sa [1-4] [05]", 0.95),
    ("cc-by-nc", r"creativecommons org licenses by nc [1-4] [05]", 0.95),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa [1-4] [05]", 0.95),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd [1-4] [05]", 0.95),
    ("cc-by-nd", r"creativecommons org licenses by nd [1-4] [05]", 0.95),
    ("cc0", r"creativecommons org publicdomain zero 1 0", 0.95),
    ("cc0", r"to the extent possible under law (?:[a-z0-9]+ ){1,12}has waived all copyright", 0.95),
    ("cc-mark", r"creativecommons org publicdomain mark 1 0", 0.9),
    ("sspl-1", r"if you make the functionality of the program or a modified version available to third parties as a service", 0.95),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", 0.95),
    ("commons-clause", r"commons clause license condition", 0.95),
    ("commons-clause", r"the license does not grant to you the right to sell the software", 0.95),
    ("polyform", r"polyform (?:noncommercial|small business|strict|shield|perimeter) license", 0.9),
    ("json", r"the software shall be used for good not evil", 0.95),
    ("hippocratic", r"hippocratic license", 0.9),
    ("openrail", r"open ?rail(?: [msd])? license", 0.85),
    ("llama", r"llama (?:2|3|3 1|3 2) community license", 0.95),
    ("gemma", r"gemma terms of use", 0.9),
    ("nasa", r"nasa open source agreement", 0.9),
    ("public-domain", r"(?:released|placed|dedicated|in)(?: in| into| to)? the public domain", 0.8),
    ("public-domain", r"no rights reserved", 0.6),
    ("proprietary", r"proprietary and confidential", 0.8),
    ("proprietary", r"unauthori[sz]ed copying of this file via any medium is strictly prohibited", 0.95),
    ("proprietary", r"may not be (?:reproduced|copied|distributed|disclosed) without (?:the )?(?:prior )?(?:express )?written (?:permission|consent)", 0.8),
    ("proprietary", r"this software is licensed not sold", 0.8),
    ("proprietary", r"end user licen[sc]e agreement", 0.7),
    ("non-commercial", r"for non ?commercial (?:use|purposes|research) only", 0.8),
    ("research-only", r"for (?:academic )?research (?:use|purposes) only", 0.8),
    ("no-redistribution", r"redistribution is (?:strictly )?prohibited", 0.8),
    ("proprietary", r"all rights reserved", 0.4),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", 0.3),
]
_DELIMITERS = bytes(c for c in range(128) if not (chr(c).isdigit() or "a" <= chr(c) <= "z"))
_TO_SPACE = bytes.maketrans(_DELIMITERS, b" " * len(_DELIMITERS))


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: bytes
    pattern: re.Pattern
    confidence: float


def _literal(body: str) -> str:
    """The longest literal that every match of a pattern contains."""
    runs = [""]
    for kind, value in sre_parse.parse(body):
        if kind is sre_parse.LITERAL:
            runs[-1] += chr(value)
        else:
            runs.append("")
    return max(runs, key=len)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """The families' phrases in order of priority; a few hundred patterns."""
    out: list[Rule] = []

    def add(priority, label, keyword, body, confidence):
        pattern = re.compile(b"(?<= )" + body.encode() + b"(?= )")
        out.append(Rule(priority, label, keyword.encode(), pattern, confidence))

    for label, names, versions in FAMILIES:
        under = r"(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?"
        for name in names:
            keyword = _literal(name)
            for v in versions:
                tagged = f"{label}-{v.replace(' ', '.')}"
                later = r"(?: or (?:any )?later| or newer)?"
                add(1, tagged, keyword, rf"spdx licen[sc]e identifier {name} {v}(?: only| or later)?", 1.0)
                add(2, tagged, keyword, rf"{under}{name}(?: licen[sc]e)?(?: version| v)? v?{v}{later}", 0.98)
                add(3, tagged, keyword, rf"{name}(?: licen[sc]e)?(?: version| v)? v?{v}{later}", 0.9)
            add(1, label, keyword, rf"spdx licen[sc]e identifier {name}", 1.0)
            add(2, label, keyword, rf"{under}{name} licen[sc]e", 0.95)
            add(4, label, keyword, rf"{name} licen[sc]e", 0.8)
    for label, body, confidence in NOTICES:
        add(2 if confidence >= 0.8 else 5, label, _literal(body), body, confidence)
    return tuple(sorted(out, key=lambda r: r.priority))


@dataclass(frozen=True)
class Detection:
    priority: int
    label: str
    start: int
    end: int
    confidence: float


def resolve(found: list[Detection]) -> list[Detection]:
    """Drops detections that lie inside one of a better or the same priority."""
    kept: list[Detection] = []
    starts: list[int] = []
    reach: list[int] = []
    for _, level in groupby(sorted(found, key=lambda d: (d.priority, d.start, -d.end, d.label)), key=lambda d: d.priority):
        end, fresh = -1, []
        for d in level:
            at = bisect_right(starts, d.start) - 1
            same = fresh and (fresh[-1].start, fresh[-1].end) == (d.start, d.end)
            if (at < 0 or reach[at] < d.end) and (d.end > end or same):
                fresh.append(d)
            end = max(end, d.end)
        kept = sorted(kept + fresh, key=lambda d: (d.start, d.end))
        starts, reach, top = [], [], 0
        for d in kept:
            starts.append(d.start)
            top = max(top, d.end)
            reach.append(top)
    return kept


def normalised(text: bytes | None) -> bytes:
    """Words of a text, each between single spaces."""
    words = (text or b"").lower().translate(_TO_SPACE).split()
    return b" " + b" ".join(words) + b" " if words else b""


def detect(line: bytes) -> list[Detection]:
    """Detections over a normalised text, in byte offsets."""
    found, present = [], {}
    for rule in rules():
        if rule.keyword not in present:
            present[rule.keyword] = rule.keyword in line
        if present[rule.keyword]:
            for m in rule.pattern.finditer(line):
                found.append(Detection(rule.priority, rule.label, m.start(), m.end(), rule.confidence))
    return resolve(found) if found else found


def _places(line: bytes) -> list[tuple[int, str]]:
    out = []
    if b"license" in line:
        for phrase, label in BASE:
            key = b" " + phrase.encode() + b" "
            at = line.find(key)
            while at >= 0:
                out.append((at, label))
                at = line.find(key, at + 1)
    return out


_RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, detections array<struct<label:string,first_word:long,n_words:long,confidence:double>>"
)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the results and all detections (word offsets)."""

    @F.pandas_udf(_RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                line = normalised(value)
                index = lambda at, line=line: line.count(b" ", 0, at + 1) - 1
                base, found = _places(line), detect(line)
                places = [index(f(at for at, _ in base)) for f in (min, max)] if base else [None, None]
                labels = {x for _, x in base}
                rows.append((
                    max(0, line.count(b" ") - 1), len(base), *places, ",".join(sorted(labels)),
                    ",".join(sorted(labels | {d.label for d in found})),
                    max([0.8] * bool(base) + [d.confidence for d in found], default=0.0),
                    [{"label": d.label, "first_word": index(d.start - 1),
                      "n_words": line.count(b" ", d.start, d.end) + 1, "confidence": d.confidence} for d in found],
                ))
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in _RESULT.split(", ")])
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    found = small_batches(docs).withColumn("__found", run(F.col(text).cast("binary")))
    results = [x.split()[0] for x in _RESULT.split(", ")]
    return found.drop(text, *results).select("*", "__found.*").drop("__found")
