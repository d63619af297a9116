"""License scans: ordered signature rules, gated by keywords, with priority and containment of intervals.

A text becomes its words (A-Z lower-cased; everything else in ASCII but digits and letters separates), joined by single
spaces. Rules are regular expressions over that line, so that punctuation and line breaks never matter. A rule runs only
in texts that hold its keyword. Of the matches, one that lies within the interval of another with a higher priority, or
within a longer one of the same priority, is suppressed; what remains gives the labels.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8

#: Phrases that are always counted, with their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

_WORDS = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 32 for c in range(256))


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int


# Families of licenses: label, keyword, pattern of the name, versions with their patterns. Fixed values, one line a family.
V = r"(?: v| version| ver)? ?"
FAMILIES = [
    ("apache", "apache", r"apache(?: software)? license", {"2.0": "2 0", "1.1": "1 1", "1.0": "1 0"}),
    ("apache", "apache", r"apache", {"2.0": "2 0 license", "1.1": "1 1 license"}),
    ("gpl", "gnu", r"gnu (?:gpl|general public licen[sc]e)", {"3.0": "3(?: 0)?", "2.0": "2(?: 0)?", "1.0": "1(?: 0)?"}),
    ("lgpl", "gnu", r"gnu (?:lgpl|(?:lesser|library) general public licen[sc]e)", {"3.0": "3(?: 0)?", "2.1": "2 1", "2.0": "2(?: 0)?"}),
    ("agpl", "gnu", r"gnu (?:agpl|affero general public licen[sc]e)", {"3.0": "3(?: 0)?", "1.0": "1(?: 0)?"}),
    ("fdl", "gnu", r"gnu (?:fdl|gfdl|free documentation licen[sc]e)", {"1.3": "1 3", "1.2": "1 2", "1.1": "1 1"}),
    ("gpl", "gpl", r"gpl(?:v| v| version)?", {"3.0": "3(?: 0)?", "2.0": "2(?: 0)?"}),
    ("lgpl", "lgpl", r"lgpl(?:v| v| version)?", {"3.0": "3(?: 0)?", "2.1": "2 1", "2.0": "2(?: 0)?"}),
    ("agpl", "agpl", r"agpl(?:v| v| version)?", {"3.0": "3(?: 0)?"}),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", {"2.0": "2 0", "1.1": "1 1", "1.0": "1 0"}),
    ("mpl", "mpl", r"mpl", {"2.0": "2 0", "1.1": "1 1"}),
    ("epl", "eclipse", r"eclipse public licen[sc]e", {"2.0": "2 0", "1.0": "1 0"}),
    ("edl", "eclipse", r"eclipse distribution licen[sc]e", {"1.0": "1 0"}),
    ("cddl", "common", r"common development and distribution licen[sc]e", {"1.1": "1 1", "1.0": "1 0"}),
    ("cpl", "common", r"common public licen[sc]e", {"1.0": "1 0"}),
    ("cpal", "common", r"common public attribution licen[sc]e", {"1.0": "1 0"}),
    ("eupl", "european", r"european union public licen[sc]e", {"1.2": "1 2", "1.1": "1 1", "1.0": "1 0"}),
    ("artistic", "artistic", r"artistic licen[sc]e", {"2.0": "2 0", "1.0": "1 0"}),
    ("bsl", "boost", r"boost software licen[sc]e", {"1.0": "1 0"}),
    ("busl", "business", r"business source licen[sc]e", {"1.1": "1 1"}),
    ("osl", "open software", r"open software licen[sc]e", {"3.0": "3 0", "2.1": "2 1", "1.0": "1 0"}),
    ("afl", "academic", r"academic free licen[sc]e", {"3.0": "3 0", "2.1": "2 1"}),
    ("ecl", "educational", r"educational community licen[sc]e", {"2.0": "2 0", "1.0": "1 0"}),
    ("psf", "python", r"(?:python software foundation|psf) licen[sc]e", {"2": "2"}),
    ("php", "php", r"php licen[sc]e", {"3.01": "3 01", "3.0": "3 0"}),
    ("zpl", "zope", r"zope public licen[sc]e", {"2.1": "2 1", "2.0": "2 0"}),
    ("apsl", "apple", r"apple public source licen[sc]e", {"2.0": "2 0"}),
    ("lppl", "latex", r"latex project public licen[sc]e", {"1.3": "1 3[abc]?", "1.2": "1 2"}),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", {"1.1": "1 1", "1.0": "1 0"}),
    ("odc-by", "open data", r"open data commons attribution licen[sc]e", {"1.0": "1 0"}),
    ("odbl", "open", r"open (?:data commons open )?database licen[sc]e", {"1.0": "1 0"}),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", {}),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", {}),
    ("cecill", "cecill", r"cecill(?: free software)?(?: licen[sc]e)?(?: agreement)?", {"2.1": "2 1", "2.0": "2 0"}),
    ("sspl", "server side", r"server side public licen[sc]e", {"1.0": "1(?: 0)?"}),
    ("elastic", "elastic", r"elastic licen[sc]e", {"2.0": "2(?: 0)?"}),
    ("openrail", "rail", r"(?:bigscience |creativeml )?open ?rail(?: m| licen[sc]e)?", {}),
    ("qpl", "q public", r"q public licen[sc]e", {"1.0": "1 0"}),
    ("ipl", "ibm", r"ibm public licen[sc]e", {"1.0": "1 0"}),
    ("wtfpl", "public", r"do what the f\w* you want to public licen[sc]e", {"2": "2"}),
]
# Single wordings: label, keyword, pattern. Fixed values.
WORDINGS = [
    ("mit", "mit", r"mit licen[sc]e"), ("mit", "mit", r"licen[sc]ed under (?:the )?mit"), ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "without restriction", r"to deal in the software without restriction"), ("isc", "isc", r"isc licen[sc]e"), ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause"), ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd licen[sc]e"), ("bsd-2-clause", "bsd", r"bsd 2 clause"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) (?:bsd )?licen[sc]e"), ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|original bsd licen[sc]e|4 clause bsd)"), ("bsd-0", "0bsd", r"0bsd"), ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"), ("bsd-3-clause", "endorse", r"neither the name of .{1,120}? may be used to endorse or promote products"),
    ("apache-2.0", "www apache", r"www apache org licenses license 2 0"), ("apache", "apache", r"licen[sc]ed to the apache software foundation"),
    ("gpl", "gpl", r"(?:gnu )?gpl licen[sc]e"), ("gpl", "free software", r"this (?:program|library) is free software you can redistribute it and or modify it"), ("gpl", "gnu org", r"www gnu org licenses gpl"),
    ("gpl-or-later", "any later", r"version [123](?: \d)? of the licen[sc]e or at your option any later version"), ("gpl-2.0", "gnu", r"gnu general public license as published by the free software foundation version 2"),
    ("lgpl", "gnu", r"gnu (?:lesser|library) general public licen[sc]e"), ("agpl", "affero", r"affero general public licen[sc]e"), ("fdl", "documentation", r"free documentation licen[sc]e"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"), ("unlicense", "unlicense", r"(?:the )?unlicense"), ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"is (?:in )?the public domain"), ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"), ("cc0-1.0", "creative", r"creative commons (?:cc )?zero"), ("cc-pdm", "public domain mark", r"public domain mark(?: 1 0)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"), ("zlib", "as is", r"provided as is without any express or implied warranty in no event"), ("openssl", "openssl", r"openssl licen[sc]e"), ("curl", "curl", r"curl licen[sc]e"),
    ("ijg", "jpeg", r"independent jpeg group"), ("beerware", "beer", r"beer ?ware licen[sc]e"), ("json", "evil", r"the software shall be used for good not evil"), ("vim", "vim", r"vim licen[sc]e"), ("ruby", "ruby", r"ruby licen[sc]e"),
    ("perl", "perl", r"same terms as perl itself"), ("unicode", "unicode", r"unicode (?:inc )?licen[sc]e agreement"), ("w3c", "w3c", r"w3c (?:software|document) (?:notice and )?licen[sc]e"), ("x11", "x11", r"x11 licen[sc]e"), ("ncsa", "ncsa", r"ncsa open source licen[sc]e"),
    ("hpnd", "permission to use", r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation"), ("upl-1.0", "universal", r"universal permissive licen[sc]e"), ("mulan", "mulan", r"mulan (?:psl|permissive software licen[sc]e)"),
    ("llama", "llama", r"llama \d? ?(?:\d )?community licen[sc]e"), ("gemma", "gemma", r"gemma terms of use"), ("reserved", "rights", r"all rights (?:are )?reserved"), ("reserved", "rights", r"(?:some|no) rights reserved"),
    ("reserved", "derechos", r"(?:todos los )?derechos reservados"), ("reserved", "droits", r"tous droits r\S+serv\S+s"), ("reserved", "rechte", r"alle rechte vorbehalten"), ("proprietary", "proprietary", r"(?:proprietary and confidential|proprietary licen[sc]e)"),
    ("proprietary", "confidential", r"confidential and proprietary"), ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d"), ("no-redistribution", "permission", r"(?:no part of this|may not be reproduced|reproduced) .{0,80}?without (?:the )?(?:prior |written |express )*permission"),
    ("noncommercial", "non", r"for non ?commercial (?:use|purposes) only"), ("licensed-under", "under", r"licen[sc]ed under (?:the )?(?:terms of )?(?:the )?\S+ licen[sc]e"), ("spdx", "spdx", r"spdx licen[sc]e identifier \S+"),
]


@lru_cache(1)
def rules() -> list[Rule]:
    """All rules in order: exact versions before families, families before single wordings. A few hundred; those of the
    Creative Commons follow from the list of its parts, versions and ways to write them."""
    out = []
    for label, key, name, versions in FAMILIES:
        for version, pattern in versions.items():
            out.append(Rule(f"{label}-{version}", key, rf"{name}{V}{pattern}", 3))
            out.append(Rule(f"{label}-{version}", key, rf"{name}{V}{pattern} or (?:any )?later", 4))
        out.append(Rule(label, key, name, 2))
    long = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:atives|ative works|s)"}
    for parts in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        label = "cc-" + parts.replace(" ", "-")
        full = r"(?: and)? ".join(long[p] for p in parts.split())
        last = r"(?! (?:nc|sa|nd)\b)"
        for version in ("4.0", "3.0", "2.5", "2.0", "1.0"):
            v = version.replace(".", " ")
            out.append(Rule(f"{label}-{version}", "cc", rf"cc {parts} {v}", 4))
            out.append(Rule(f"{label}-{version}", "creative", rf"creative commons {full} {v}(?: international| unported| generic)?", 4))
            out.append(Rule(f"{label}-{version}", "creativecommons", rf"creativecommons org licenses {parts} {v}", 4))
        out.append(Rule(label, "cc", rf"cc {parts}{last}", 2))
        out.append(Rule(label, "creative", rf"creative commons {full}(?: licen[sc]e)?", 2))
    out.append(Rule("cc", "creative", r"creative commons(?: licen[sc]e)?", 1))
    out += [Rule(label, key, pattern, 2) for label, key, pattern in WORDINGS]
    return out


@lru_cache(1)
def _machine() -> tuple[ahocorasick.Automaton, list[tuple[Rule, re.Pattern]]]:
    compiled = [(r, re.compile(rb" " + r.pattern.encode() + rb"(?= )")) for r in rules()]
    by_key: dict[str, list[int]] = {}
    for i, (r, _) in enumerate(compiled):
        by_key.setdefault(r.keyword, []).append(i)
    machine = ahocorasick.Automaton()
    for key, which in by_key.items():
        machine.add_word(key, which)
    machine.make_automaton()
    return machine, compiled


@dataclass
class Detection:
    label: str
    first: int
    n_words: int
    priority: int
    order: int


def detect(line: bytes) -> list[Detection]:
    """The detections in " word word ... word " that no other suppresses, by place."""
    machine, compiled = _machine()
    which = sorted({i for _, found in machine.iter(line.decode()) for i in found})
    found = []
    for i in which:
        rule, pattern = compiled[i]
        for m in pattern.finditer(line):
            found.append((m.start(), m.end(), rule.priority, i, rule.label))
    kept = []
    starts: list[int] = []  # of those kept that lie in no other, ascending; so are their ends
    ends: list[int] = []
    for x in sorted(found, key=lambda x: (-x[2], x[0] - x[1], x[3], x[0])):
        start, end = x[:2]
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        low, high = bisect_left(starts, start), bisect_right(ends, end)
        starts[low : max(low, high)], ends[low : max(low, high)] = [start], [end]
        kept.append(x)
    first, last = (words_before(line, [x[side] for x in kept]) for side in (0, 1))
    out = [Detection(label, a, b - a, priority, i) for (_, _, priority, i, label), a, b in zip(kept, first, last, strict=True)]
    return sorted(out, key=lambda d: (d.first, d.order))


def words_before(line: bytes, places: list[int]) -> list[int]:
    """The number of spaces before each place, in one pass over the line."""
    if not places:
        return []
    return np.searchsorted(np.flatnonzero(np.frombuffer(line, np.uint8) == 32), places).tolist()


def words_line(text: bytes) -> tuple[bytes, int]:
    """The words between single spaces, one before and one after them all, and their number."""
    words = text.translate(_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" ", len(words)


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(start in words, label) of every place of a base phrase, overlapping ones included."""
    out = []
    for phrase, label in BASE:
        wanted = f" {phrase} ".encode()
        at = line.find(wanted)
        while at >= 0:
            out.append((at, label))
            at = line.find(wanted, at + 1)
    return list(zip(words_before(line, [at for at, _ in out]), [label for _, label in out], strict=True))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score, detections`` of each row.

    Null text counts as empty: no words, null places, empty labels, score 0. ``detections`` has label, first word, words
    and priority of each. The score is 1 - 0.5 ** (sum of the priorities): 0 without a detection. Whole texts; rows
    are independent, so copies and hot sources don't matter; repeated rows repeat.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,first_word:long,n_words:long,priority:int>>"
    detection = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("priority", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                a, b, body = utf8(part.column(1))
                rows = []
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    line, n = words_line(body[i:j])
                    places = base_places(line)
                    found = detect(line)
                    base = {x for _, x in places}
                    score = 1 - 0.5 ** sum(d.priority for d in found) if found else 0.5 if base else 0.0
                    starts = [x for x, _ in places]
                    rows.append((n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {d.label for d in found})), score, [{"label": d.label, "first_word": d.first, "n_words": d.n_words, "priority": d.priority} for d in found]))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
                types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), detection]
                yield pa.RecordBatch.from_arrays([part.column(0)] + [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(run, schema)
