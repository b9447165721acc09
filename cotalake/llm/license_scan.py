"""License scans by ordered signature rules.

Texts are lower-cased (A-Z) and reduced to words of letters, digits and non-ASCII characters, joined by single blanks. A few
hundred regular expressions run over that form: each belongs to a license, has a priority, and is tried only on texts that
hold its keyword. Of overlapping detections the one of higher priority (then the longer, then the earlier rule) stands, and
those whose interval lies within it are suppressed. Fixed phrases (``BASE``) are found everywhere and never suppressed.

Defined results: null and empty texts have no words, no detections and score 0. Repeated rows are scanned each; a phrase found
several times counts every place. Texts of any length are scanned whole. Empty tables give an empty result. Other columns are
kept; equal detections are reported once.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.llm import text as T

#: Fixed phrases and labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label, keyword that a text must hold, and how the license is named (a pattern over words).
NAMES: list[tuple[str, str, str]] = [
    ("mit", "mit", r"mit"),
    ("mit-0", "mit", r"mit (?:0|no attribution)"),
    ("apache-1", "apache", r"apache(?: software)?(?: license)?(?: version)? 1(?: [01])?"),
    ("apache-2", "apache", r"apache(?: software)?(?: license)?(?: version)? 2(?: 0)?"),
    ("gpl-1", "gnu", r"gnu (?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v) ?1"),
    ("gpl-2", "gnu", r"gnu (?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v) ?2(?: 0)?"),
    ("gpl-3", "gnu", r"gnu (?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v) ?3(?: 0)?"),
    ("gpl-2", "gpl", r"gpl ?v? ?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gpl", r"gpl ?v? ?3(?: 0)?(?: only| or later)?"),
    ("lgpl-2", "lesser", r"(?:gnu )?(?:lesser|library) general public license(?: version| v) ?2(?: [01])?"),
    ("lgpl-3", "lesser", r"(?:gnu )?lesser general public license(?: version| v) ?3(?: 0)?"),
    ("lgpl-2", "lgpl", r"lgpl ?v? ?2(?: [01])?(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"lgpl ?v? ?3(?: 0)?(?: only| or later)?"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public license(?: version| v) ?3(?: 0)?"),
    ("agpl-3", "agpl", r"agpl ?v? ?3(?: 0)?(?: only| or later)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation license(?: version 1(?: [123])?)?"),
    ("bsd-0", "bsd", r"(?:0|zero) clause bsd"),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)"),
    ("bsd-3", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)"),
    ("bsd-4", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)"),
    ("mpl-1", "mozilla", r"mozilla public license(?: version)? 1(?: [01])?"),
    ("mpl-2", "mozilla", r"mozilla public license(?: version)? 2(?: 0)?"),
    ("mpl-2", "mpl", r"mpl ?v? ?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("cddl-1", "cddl", r"(?:common development and distribution license )?cddl(?: version)?(?: 1 [01])?"),
    ("eupl", "european union", r"european union public licen[cs]e(?: v ?1 [12])?"),
    ("artistic-2", "artistic", r"artistic license(?: version)? 2(?: 0)?"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("boost-1", "boost", r"boost software license(?: version 1(?: 0)?)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "do what the", r"do what the \w+ you want to public license"),
    ("postgresql", "postgresql", r"postgresql"),
    ("python-2", "python software", r"python software foundation(?: license)?(?: version)?(?: 2)?"),
    ("php-3", "php", r"php license(?: version)? 3(?: 0[1]?)?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("odbl-1", "open database", r"open database license(?: odbl)?(?: v ?1(?: 0)?)?"),
    ("pddl-1", "public domain dedication", r"(?:open data commons )?public domain dedication and licen[cs]e"),
    ("ofl-1", "open font", r"(?:sil )?open font license(?: version 1(?: 1)?)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons", r"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc", "cc by", r"cc by nc(?: [1234] [05])?"),
    ("cc-by-nd", "cc by", r"cc by nd(?: [1234] [05])?"),
    ("cc-by-sa", "cc by", r"cc by sa(?: [1234] [05])?"),
    ("cc-by", "cc by", r"cc by(?: [1234] [05])?"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative|ative work)?s?(?: [1234] [05])?"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike(?: [1234] [05])?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: [1234] [05])?"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative|ative work)?s?(?: [1234] [05])?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: [1234] [05])?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: [1234] [05])?"),
]

#: Ways to speak of a license named N: priority, a second keyword, and the pattern around the name.
FORMS: list[tuple[int, str, str]] = [
    (4, "spdx", r"spdx license identifier {n}"),
    (3, " under ", r"(?:licen[cs]ed|released|distributed|published|available|provided|redistributed|offered|shared) under (?:the |an? )?(?:terms (?:and conditions )?of )?(?:the )?{n}(?: licen[cs]e)?"),
    (3, "subject to", r"subject to (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{n}(?: licen[cs]e)?"),
    (3, "governed by", r"governed by (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{n}(?: licen[cs]e)?"),
    (3, "covered by", r"covered by (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{n}(?: licen[cs]e)?"),
    (2, "licen", r"licen[cs]e {n}"),
    (2, "licen", r"(?:the )?{n} licen[cs]e"),
]

#: Sentences of license texts: label, keyword, priority, pattern.
SIGNATURES: list[tuple[str, str, int, str]] = [
    ("mit", "permission is hereby granted", 5, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "above copyright notice", 3, r"the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", "permission to use", 5, r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd-3", "neither the name", 5, r"neither the name of .{1,120}? nor the names of its contributors may be used to endorse"),
    ("bsd-2", "redistribution and use", 4, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-4", "all advertising materials", 5, r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "you may not use this file", 5, r"you may not use this file except in compliance with the license"),
    ("apache-2", "apache", 3, r"apache org licenses license 2 0"),
    ("gpl-3", "gnu", 4, r"gnu org licenses gpl 3 0"),
    ("gpl-2", "gnu", 4, r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl", "free software", 3, r"this program is free software you can redistribute it and or modify it"),
    ("gpl", "gnu", 1, r"gnu general public license"),
    ("lgpl", "lesser", 1, r"(?:gnu )?lesser general public license"),
    ("agpl", "affero", 1, r"(?:gnu )?affero general public license"),
    ("gpl-or-later", "gnu", 4, r"gnu general public license .{0,80}?either version [123] .{0,40}?or at your option any later version"),
    ("mpl-2", "mozilla", 5, r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "eclipse", 1, r"eclipse public license"),
    ("apache", "apache", 1, r"apache (?:software )?license"),
    ("mit", "mit", 1, r"mit licen[cs]e"),
    ("bsd", "bsd", 1, r"bsd licen[cs]e"),
    ("unlicense", "public domain", 5, r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", 2, r"(?:released|placed|dedicated) (?:in)?to the public domain"),
    ("public-domain", "public domain", 1, r"(?:is|are) in the public domain"),
    ("zlib", "warranty", 5, r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("wtfpl", "do what the", 4, r"you just do what the \w+ you want to"),
    ("cc-by", "creativecommons", 4, r"creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", "creativecommons", 4, r"creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nd", "creativecommons", 4, r"creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-nc", "creativecommons", 4, r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nc-sa", "creativecommons", 4, r"creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "creativecommons", 4, r"creativecommons org licenses by nc nd [1234] [05]"),
    ("cc0", "creativecommons", 4, r"creativecommons org publicdomain zero 1 0"),
    ("all-rights-reserved", "all rights reserved", 2, r"(?:copyright (?:c )?(?:\d{4} )?(?:\w+ ){0,6}?)?all rights reserved"),
    ("proprietary", "proprietary", 2, r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "reproduced", 3, r"no part of this (?:publication|work|document) may be reproduced"),
    ("non-commercial", "commercial", 2, r"for (?:personal and )?non ?commercial (?:use|purposes) only"),
    ("no-ai-training", "train", 3, r"may not be used (?:for|to) (?:the )?train(?:ing)?(?: of)? (?:ai|machine learning|language)"),
]

#: How sure a detection of each priority makes of a license.
CERTAINTY = {1: 0.3, 2: 0.5, 3: 0.8, 4: 0.9, 5: 0.97}
BASE_CERTAINTY = 0.9

SCHEMA = (
    "n_words long, base array<struct<label string, first_word long>>, "
    "found array<struct<label string, rule int, priority int, first_word long, last_word long>>"
)
_FOUND = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
_BASE = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    priority: int
    pattern: re.Pattern


def rules() -> list[Rule]:
    """All rules: every name in every form, and the signatures."""
    listed = [(label, (keyword, second), priority, form.format(n=f"(?:{name})")) for label, keyword, name in NAMES for priority, second, form in FORMS]
    listed += [(label, (keyword,), priority, pattern) for label, keyword, priority, pattern in SIGNATURES]
    return [
        Rule(label, tuple(k.encode() for k in keywords), priority, re.compile(rb"(?<= )(?:" + pattern.encode() + rb")(?= )"))
        for label, keywords, priority, pattern in listed
    ]


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Scanner:
    def __init__(self) -> None:
        self.rules = rules()
        self.by_keyword: dict[bytes, list[int]] = {}
        for number, rule in enumerate(self.rules):
            self.by_keyword.setdefault(rule.keywords[0], []).append(number)
        self.seconds = sorted({k for rule in self.rules for k in rule.keywords[1:]})
        self.base = [(re.compile(rb"(?<= )(?=" + phrase.encode() + rb" )"), label) for phrase, label in BASE.items()]
        # The longest word of each keyword and phrase: a text with none of them holds nothing.
        self.gate = sorted({max(k.split(), key=len) for k in [*self.by_keyword, *[p.encode() for p in BASE]]}, key=len, reverse=True)

    def scan(self, raw: bytes) -> tuple[list[dict], list[dict]]:
        """Base places and standing detections of one lower-cased text."""
        if not any(word in raw for word in self.gate):
            return [], []
        text = b" " + b" ".join(_WORD.findall(raw)) + b" "
        blanks: list[int] = []

        def word_at(position: int) -> int:
            if not blanks:
                blanks.extend(np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist())
            return bisect.bisect_left(blanks, position) - 1

        base = [{"label": label, "first_word": word_at(m.start())} for pattern, label in self.base for m in pattern.finditer(text)]
        seconds = {k for k in self.seconds if k in text}
        hits = []
        for keyword, numbers in self.by_keyword.items():
            if keyword not in text:
                continue
            for number in numbers:
                rule = self.rules[number]
                if seconds.issuperset(rule.keywords[1:]):
                    hits.extend((-rule.priority, m.start() - m.end(), number, m.start(), m.end()) for m in rule.pattern.finditer(text))
        # Best first; what lies within an interval that stands is suppressed. Such an interval starts no further back than
        # the longest one is long.
        longest = max((h[4] - h[3] for h in hits), default=0)
        standing: list[tuple[int, int]] = []
        found = []
        for negative, _, number, start, end in sorted(hits):
            place = bisect.bisect_right(standing, (start, len(text) + 1))
            inside = False
            while place and not inside and standing[place - 1][0] >= start - longest:
                place -= 1
                inside = standing[place][1] >= end
            if not inside:
                bisect.insort(standing, (start, end))
                found.append({"label": self.rules[number].label, "rule": number, "priority": -negative, "first_word": word_at(start), "last_word": word_at(end) - 1})
        return sorted(base, key=lambda b: b["first_word"]), sorted(found, key=lambda f: (f["first_word"], f["last_word"]))


def _scan_column(column: pa.Array) -> pa.Array:
    global _scanner
    if _scanner is None:
        _scanner = Scanner()
    data, offsets = T.utf8(column)
    counted = np.zeros(len(column), np.int64)
    base, found = [], []
    for first, last in T.groups(offsets):
        part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts = T.spans(part, bounds, T.LETTERS)[0]
        counted[first:last] = np.diff(np.searchsorted(starts, bounds))
        raw = part.tobytes().lower()
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            places, hits = _scanner.scan(raw[lo:hi])
            base.append(places)
            found.append(hits)
    return pa.StructArray.from_arrays([pa.array(counted), pa.array(base, _BASE), pa.array(found, _FOUND)], names=["n_words", "base", "found"])


_scanner: Scanner | None = None


def scan(df: DataFrame, text: Column) -> DataFrame:
    """``df`` plus the struct column ``licenses``: n_words, base places, and the detections that stand."""
    run = F.arrow_udf(_scan_column, SCHEMA)
    return df.select(*[F.col(c) for c in df.columns if c != "licenses"], run(text).alias("licenses"))


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per document: counts of words and base places, first and last base place, labels, and a score.

    The score is one minus the product of the detections' doubts.
    """
    found = scan(docs.select("doc_id", "text"), F.col("text"))
    base = F.col("licenses.base")
    labels = F.col("licenses.found.label")
    certain = F.create_map(*[x for k, v in CERTAINTY.items() for x in (F.lit(k), F.lit(v))])
    doubt = F.aggregate(F.col("licenses.found.priority"), F.lit(1.0), lambda a, p: a * (1.0 - F.element_at(certain, p)))
    doubt = F.aggregate(base, doubt, lambda a, _: a * F.lit(1.0 - BASE_CERTAINTY))
    return found.select(
        "doc_id",
        "licenses.n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min("licenses.base.first_word").alias("first_word"),
        F.array_max("licenses.base.first_word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("licenses.base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.col("licenses.base.label"), labels))), ",").alias("labels"),
        (1.0 - doubt).alias("score"),
        F.size("licenses.found").cast("long").alias("n_found"),
    )
