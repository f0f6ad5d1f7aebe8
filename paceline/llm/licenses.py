"""License scans: ordered signature rules gated by keywords.

A text is reduced to lower-cased words joined by single spaces. Rules are regular expressions
over that line: signatures written by hand (``license_signatures``: notices, titles, addresses, names,
body sentences) and phrases made from license families, their versions and the ways licenses are granted or
named; each is tried only if the line holds one of its literals, of which every match has one (a
family's rules: its name words), and lines without any literal have no match. Detections are
taken in order of priority, then length; one that lies within an accepted detection is
suppressed, so "gpl" inside "lgpl 2.1" or an unversioned name inside a versioned one does not
count. Base phrases are found word by word and always stay.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows get
equal results; the score is 1 minus the product of the accepted detections' doubts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from paceline.llm import common
from paceline.llm.license_signatures import GROUPS

WORD_BYTES = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_TABLE = common.byte_table(word=WORD_BYTES)
_SPACED = bytes(int(b) or 0x20 for b in _TABLE)  # words lower-cased, the rest blank

#: The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, the words that name the license, its versions.
FAMILIES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("agpl", "gnu affero general public|gnu agpl|agpl|affero general public", ("1", "3")),
    ("lgpl", "gnu lesser general public|gnu library general public|lesser general public|gnu lgpl|lgpl", ("2", "2 1", "3")),
    ("gpl", "gnu general public|gnu gpl|gpl", ("1", "2", "3")),
    ("gfdl", "gnu free documentation|gfdl", ("1 1", "1 2", "1 3")),
    ("apache", "apache software|apache", ("1", "1 1", "2")),
    ("mit", "mit x11|mit expat|mit", ()),
    ("bsd", "bsd", ("1 clause", "2 clause", "3 clause", "4 clause")),
    ("mpl", "mozilla public|mpl", ("1", "1 1", "2")),
    ("epl", "eclipse public|epl", ("1", "2")),
    ("cddl", "common development and distribution|cddl", ("1", "1 1")),
    ("cpl", "common public|cpl", ("1",)),
    ("eupl", "european union public|eupl", ("1", "1 1", "1 2")),
    ("afl", "academic free|afl", ("1 1", "2", "2 1", "3")),
    ("osl", "open software|osl", ("1", "2", "2 1", "3")),
    ("artistic", "artistic", ("1", "2")),
    ("ofl", "sil open font|open font|ofl", ("1", "1 1")),
    ("odbl", "open database|odbl", ("1",)),
    ("bsl", "boost software|boost", ("1",)),
    ("ms-pl", "microsoft public|ms pl", ()),
    ("ms-rl", "microsoft reciprocal|ms rl", ()),
    ("python", "python software foundation|psf|python", ("2",)),
    ("zlib", "zlib libpng|zlib", ()),
    ("isc", "isc", ()),
    ("upl", "universal permissive|upl", ("1",)),
    ("ncsa", "university of illinois ncsa|ncsa", ()),
    ("postgresql", "postgresql", ()),
    ("openssl", "openssl", ()),
    ("wtfpl", "do what the fuck you want to public|wtfpl", ("1", "2")),
    ("cecill", "cecill", ("1", "2", "2 1")),
    ("qpl", "q public|qpl", ("1",)),
)
#: The parts of Creative Commons licenses and their spoken names.
CC_PARTS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
CC_KINDS = ("by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by")
CC_VERSIONS = ("1", "2", "2 5", "3", "4")
_GRANT = (r"(?:licen[sc]ed|released|distributed|published|provided|available|covered|made available|redistributed|"
          r"dual licen[sc]ed|redistribute it and or modify it) under (?:an? |the )?(?:terms (?:and conditions )?of (?:an? |the )?)?")


@dataclass(frozen=True)
class Rule:
    """``priority``: smaller wins. ``sure``: how much a detection alone tells, 0 to 1.

    ``literals``: every match lies in a line that has one of them.
    """

    label: str
    priority: int
    literals: tuple[bytes, ...]
    pattern: re.Pattern
    sure: float


def _rule(label: str, priority: int, literals: str, pattern: str, sure: float) -> Rule:
    """``literals``: whole words or phrases of the pattern, one of which is in every match."""
    return Rule(label, priority, tuple(f" {w} ".encode() for w in literals.split("|")), re.compile(rf"(?<= )(?:{pattern})(?= )".encode()), sure)


def _versioned(version: str) -> str:
    """Version words; "2" is also written "2 0", "v2" or with "only" or "or later"."""
    whole = version if " " in version else rf"{version}(?: 0)?(?! \d)"
    return rf"(?:version |v |v|ver )?{whole}(?: only| or later| or any later version| plus)?"


def signature_rules() -> tuple[Rule, ...]:
    """All rules in order. From specific to vague: identifiers, grants, names, and text parts."""
    # The words of a grant before a signature belong to it: "released under" the named license.
    rules = [_rule(label, priority, gate, rf"(?:{_GRANT})?(?:{pattern})", sure)
             for rows, priority, sure in GROUPS for label, gate, pattern in rows]
    for label, names, versions in FAMILIES:
        named = rf"(?:{names})"
        for version in versions:
            full = f"{label}-{version.replace(' clause', '-clause').replace(' ', '.')}"
            which = version if "clause" in version else _versioned(version)
            said = (rf"{version} {named}" if "clause" in version else
                    rf"{named}(?: licen[sc]e)?(?: agreement)? {which}|{which} of the {named} licen[sc]e")
            rules += [
                _rule(full, 10, "spdx", rf"spdx licen[sc]e identifier {label.replace('-', ' ')} {which}", 0.99),
                _rule(full, 20, names, rf"{_GRANT}(?:{said})(?: licen[sc]e)?", 0.97),
                _rule(full, 40, names, said, 0.85),
                _rule(full, 30, "licenses|licences", rf"(?:org|www|com) licen[sc]es (?:old licenses )?{label.replace('-', ' ')} {which}", 0.95),
            ]
        rules += [
            _rule(label, 12, "spdx", rf"spdx licen[sc]e identifier {label.replace('-', ' ')}", 0.98),
            _rule(label, 25, names, rf"{_GRANT}{named}(?: style)? licen[sc]e", 0.93),
            _rule(label, 35, "licenses|licences", rf"(?:org|www|com) licen[sc]es {label.replace('-', ' ')}", 0.9),
            _rule(label, 50, names, rf"{named}(?: style)? licen[sc]e", 0.75),
        ]
    for kind in CC_KINDS:
        parts = kind.split()
        spoken = " ".join(CC_PARTS[p] for p in parts)
        for version in ("", *CC_VERSIONS):
            label = "-".join(["cc", *parts] + [version.replace(" ", ".")] * bool(version))
            tail = rf" {_versioned(version)}(?: international| unported| generic)?" if version else ""
            plain = "" if version else r"(?! (?:by|nc|nd|sa)(?: |$))"
            step = 0 if version else 5
            rules += [
                _rule(label, 21 + step, "cc by", rf"{_GRANT}(?:a )?cc {kind}{plain}{tail}", 0.97),
                _rule(label, 41 + step, "cc by", rf"cc {kind}{plain}{tail}", 0.85),
                _rule(label, 22 + step, "creative commons attribution", rf"creative commons {spoken}(?: \d(?: \d)?)?{tail if version else ''}(?: (?:public )?licen[sc]e)?", 0.95),
                _rule(label, 31 + step, "creativecommons org", rf"creativecommons org licen[sc]es {kind}{plain}{tail}", 0.97),
            ]
    rules += [
        _rule("cc0", 22, "cc0", r"cc0(?: 1 0)?(?: universal)?", 0.95),
        _rule("cc0", 31, "creativecommons org publicdomain zero", r"creativecommons org publicdomain zero", 0.97),
        _rule("public-domain", 45, "the public domain", rf"(?:released|placed|dedicated) (?:in|into|to) the public domain", 0.9),
        _rule("unlicense", 22, "the unlicense|unlicense org", r"the unlicense|unlicense org", 0.9),
        _rule("mit", 60, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95),
        _rule("isc", 60, "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose", 0.9),
        _rule("bsd", 60, "redistribution and use", r"redistribution and use in source and binary forms with or without modification", 0.9),
        _rule("zlib", 60, "altered source versions", r"altered source versions must be plainly marked as such", 0.85),
        _rule("proprietary", 70, "all rights reserved", r"all rights reserved", 0.4),
        _rule("proprietary", 65, "proprietary and confidential", r"proprietary and confidential", 0.6),
        _rule("unknown", 90, "license|licence", rf"{_GRANT}(?:\S+ ){{0,4}}?licen[sc]e", 0.3),
    ]
    return tuple(sorted(rules, key=lambda r: r.priority))


RULES = signature_rules()
#: For each literal the places in RULES of the rules to try where it occurs.
LITERALS: dict[bytes, list[int]] = {}
for _place, _of in enumerate(RULES):
    for _literal in _of.literals:
        LITERALS.setdefault(_literal, []).append(_place)
#: The literals by their longest word: a line is searched for those whose word it has.
LITERALS_OF_WORD: dict[bytes, list[bytes]] = {}
for _literal in LITERALS:
    LITERALS_OF_WORD.setdefault(max(_literal.split(), key=len), []).append(_literal)
_BASE = [(f" {p} ".encode(), label) for p, label in BASE_PHRASES.items()]


def places(line: bytes, phrase: bytes) -> list[int]:
    """Starts of a blank-framed phrase in a blank-framed line; places may share words."""
    out, at = [], line.find(phrase)
    while at >= 0:
        out.append(at)
        at = line.find(phrase, at + 1)
    return out


def rules_for(line: bytes) -> list[Rule]:
    """The rules that may match the line, in order."""
    words = LITERALS_OF_WORD.keys() & line.split()
    found = [literal for word in words for literal in LITERALS_OF_WORD[word] if literal in line]
    return [RULES[k] for k in sorted({k for literal in found for k in LITERALS[literal]})]


@dataclass
class Scan:
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base_labels: str = ""
    labels: str = ""
    score: float = 0.0
    spans: tuple[tuple[int, int, str], ...] = ()


def accepted(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Of (priority, start, end, label, sure): those not within one of earlier order.

    ``reach[i]`` is a Fenwick tree over the starts that holds the furthest end accepted so far,
    so a text with many detections costs n log n.
    """
    starts = sorted({d[1] for d in found})
    reach = [0] * (len(starts) + 1)
    kept: list[tuple[int, int, int, str, float]] = []
    for d in sorted(found, key=lambda d: (d[0], d[1] - d[2], d[1], d[3])):
        place = bisect_left(starts, d[1]) + 1
        furthest, i = 0, place
        while i:
            furthest = max(furthest, reach[i])
            i -= i & -i
        if d[2] <= furthest:
            continue
        kept.append(d)
        while place < len(reach):
            reach[place] = max(reach[place], d[2])
            place += place & -place
    return kept


def scan_line(line: bytes) -> Scan:
    """Scans words joined by single blanks, with a blank before the first and after the last."""
    starts, base = [], set()
    for phrase, label in _BASE:
        at = places(line, phrase)
        starts += at
        if at:
            base.add(label)
    found = [(r.priority, m.start(), m.end(), r.label, r.sure)
             for r in rules_for(line) for m in r.pattern.finditer(line)]
    kept = accepted(found)
    out = Scan(len(starts), base_labels=",".join(sorted(base)),
               labels=",".join(sorted(base | {d[3] for d in kept})))
    if starts:
        word = [line.count(b" ", 0, s) for s in (min(starts), max(starts))]
        out.first_word, out.last_word = word
    doubt = 0.02 if base else 1.0
    for d in kept:
        doubt *= 1 - d[4]
    out.score = 1 - doubt
    if kept:
        blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20)
        begin, end = (np.searchsorted(blanks, [d[i] for d in kept]).tolist() for i in (1, 2))
        out.spans = tuple((b - 1, e, d[3]) for b, e, d in zip(begin, end, kept))
    return out


def scan_documents(docs: DataFrame, keep: list[Column | str]) -> DataFrame:
    """``keep`` columns, the counts and labels of each whole text, and word spans by label."""
    kept = docs.select(*keep)
    rows = docs.select(*keep, docs["text"].alias("_text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.texts_of(batch.column(batch.num_columns - 1))
            n_words = []
            for _, _, data, starts in common.chunks(texts):
                begin, _ = common.word_spans(_TABLE[data])
                n_words.append(np.diff(np.searchsorted(begin, starts)))
            results = [scan_line(b" %s " % b" ".join(text.translate(_SPACED).split())) for text in texts]
            column = lambda name, kind: pa.array([getattr(r, name) for r in results], kind)
            spans = pa.array([[f"{s}:{e}:{label}" for s, e, label in r.spans] for r in results], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                 column("n_base", pa.int64()), column("first_word", pa.int64()), column("last_word", pa.int64()),
                 column("base_labels", pa.string()), column("labels", pa.string()), column("score", pa.float64()), spans],
                names=[*batch.schema.names[:-1], *names])

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    kinds = [LongType()] * 4 + [StringType()] * 2 + [DoubleType()]
    fields = [StructField(n, k) for n, k in zip(names, kinds)]
    schema = StructType([*kept.schema.fields, *fields]).add("spans", ArrayType(StringType()))
    return rows.mapInArrow(scanned, schema)
