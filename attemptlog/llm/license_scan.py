"""License scan (operator 9).

Ordered signature rules over the words of a text. Every rule is an expression over words; a
blank in it stands for whatever separates two words. Rules are gated: an Aho-Corasick pass
finds which gate words a text has, and only rules whose gate words all occur are tried.
Detections of a lower priority that lie inside one of a higher priority are suppressed, so
"GNU Lesser General Public License 2.1" is not also plain "lgpl".

Words are runs of ASCII letters and digits and of anything that is not ASCII, A-Z counting
as a-z. Independent of the rules, every place of the base phrases is counted, and their
labels always stay.

Defined results: a null or empty text has no words and no detections. Each row gives one row,
null and repeated keys included; texts are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import map_rows, texts_of

WORD = rb"0-9a-z\x80-\xff"
GAP = b"[^" + WORD + b"]+"
#: Phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

LIC = "licen[cs]e"
V = "(?: version)? (?:v ?)?"
#: label, gate words, name of the license. More specific names stand first.
NAMES = (
    ("apache-1.1", "apache", f"apache(?: software)?(?: {LIC})?{V}1 1"),
    ("apache-2.0", "apache", f"apache(?: software)?(?: {LIC})?{V}2(?: 0)?"),
    ("apache", "apache", f"apache(?: software)? {LIC}"),
    ("agpl-3.0", "affero", f"(?:gnu )?affero general public {LIC}{V}3(?: 0)?"),
    ("agpl", "affero", f"(?:gnu )?affero general public {LIC}"),
    ("lgpl-2.0", "general public", f"(?:gnu )?(?:lesser|library) general public {LIC}{V}2 0"),
    ("lgpl-2.1", "general public", f"(?:gnu )?(?:lesser|library) general public {LIC}{V}2 1"),
    ("lgpl-3.0", "general public", f"(?:gnu )?lesser general public {LIC}{V}3(?: 0)?"),
    ("lgpl", "general public", f"(?:gnu )?(?:lesser|library) general public {LIC}"),
    ("gpl-1.0", "general public", f"(?:gnu )?general public {LIC}{V}1(?: 0)?"),
    ("gpl-2.0", "general public", f"(?:gnu )?general public {LIC}{V}2(?: 0)?"),
    ("gpl-3.0", "general public", f"(?:gnu )?general public {LIC}{V}3(?: 0)?"),
    ("gpl", "general public", f"(?:gnu )?general public {LIC}"),
    ("gpl-2.0", "gpl", "(?:gnu )?gpl ?v?2(?: 0)?"),
    ("gpl-3.0", "gpl", "(?:gnu )?gpl ?v?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl ?v?2 1"),
    ("lgpl-3.0", "lgpl", "(?:gnu )?lgpl ?v?3(?: 0)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl ?v?3(?: 0)?"),
    ("gfdl-1.2", "free documentation", f"(?:gnu )?free documentation {LIC}{V}1 2"),
    ("gfdl-1.3", "free documentation", f"(?:gnu )?free documentation {LIC}{V}1 3"),
    ("gfdl", "free documentation", f"(?:gnu )?free documentation {LIC}"),
    ("mit-0", "attribution", f"mit no attribution(?: {LIC})?"),
    ("mit", "mit", f"mit {LIC}"),
    ("mit", "expat", f"expat {LIC}"),
    ("x11", "x11", f"x11 {LIC}"),
    ("isc", "isc", f"isc {LIC}"),
    ("0bsd", "bsd", f"(?:zero clause|0 clause|free public) bsd(?: {LIC})?"),
    ("bsd-2-clause", "bsd", f"(?:2|two) clause bsd(?: {LIC})?|simplified bsd {LIC}"),
    ("bsd-3-clause", "bsd", f"(?:3|three) clause bsd(?: {LIC})?|(?:new|modified) bsd {LIC}"),
    ("bsd-4-clause", "bsd", f"(?:4|four) clause bsd(?: {LIC})?|original bsd {LIC}"),
    ("bsd", "bsd", f"bsd(?: style)? {LIC}"),
    ("mpl-1.1", "mozilla", f"mozilla public {LIC}{V}1 1"),
    ("mpl-2.0", "mozilla", f"mozilla public {LIC}{V}2(?: 0)?"),
    ("mpl", "mozilla", f"mozilla public {LIC}"),
    ("epl-1.0", "eclipse", f"eclipse public {LIC}{V}1(?: 0)?"),
    ("epl-2.0", "eclipse", f"eclipse public {LIC}{V}2(?: 0)?"),
    ("epl", "eclipse", f"eclipse public {LIC}"),
    ("edl-1.0", "eclipse", f"eclipse distribution {LIC}"),
    ("cddl-1.0", "distribution", f"common development and distribution {LIC}"),
    ("cpl-1.0", "common public", f"common public {LIC}"),
    ("cpal-1.0", "attribution", f"common public attribution {LIC}"),
    ("eupl-1.2", "european union", f"european union public {LIC}"),
    ("artistic-1.0", "artistic", f"artistic {LIC}{V}1(?: 0)?"),
    ("artistic-2.0", "artistic", f"artistic {LIC}{V}2(?: 0)?"),
    ("artistic", "artistic", f"artistic {LIC}"),
    ("bsl-1.0", "boost", f"boost software {LIC}"),
    ("busl-1.1", "business source", f"business source {LIC}"),
    ("sspl-1.0", "server side", f"server side public {LIC}"),
    ("elastic-2.0", "elastic", f"elastic {LIC}"),
    ("zlib", "zlib", f"zlib(?: libpng)? {LIC}"),
    ("libpng", "libpng", f"libpng {LIC}"),
    ("openssl", "openssl", f"openssl {LIC}"),
    ("psf-2.0", "python", f"python(?: software foundation)? {LIC}"),
    ("psf-2.0", "psf", f"psf(?: software foundation)? {LIC}"),
    ("php-3.01", "php", f"php {LIC}"),
    ("ruby", "ruby", f"ruby {LIC}"),
    ("postgresql", "postgresql", f"postgresql {LIC}"),
    ("wtfpl", "want to public", f"do what the [a-z]+ you want to public {LIC}"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("ofl-1.1", "open font", f"(?:sil )?open font {LIC}"),
    ("odbl-1.0", "open database", f"open database {LIC}"),
    ("odc-by-1.0", "open data commons", f"open data commons attribution {LIC}"),
    ("pddl-1.0", "public domain", f"public domain dedication(?: and)? {LIC}"),
    ("ogl-uk", "open government", f"open government {LIC}"),
    ("bigscience-rail", "responsible ai", f"responsible ai {LIC}"),
    ("cecill", "cecill", f"cecill(?: [abc])?(?: {LIC})?"),
    ("ms-pl", "microsoft", f"microsoft public {LIC}"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {LIC}"),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {LIC}"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "commons zero", "creative commons zero"),
    *(
        (
            "-".join(["cc", *parts.split(), version]).rstrip("-"),
            gate,
            f"{start} {words}" + (f" {version[0]} {version[2]}" if version else ""),
        )
        for parts, long in (
            ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
            ("by nc sa", "attribution non ?commercial share ?alike"),
            ("by nc", "attribution non ?commercial"),
            ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
            ("by sa", "attribution share ?alike"),
            ("by", "attribution"),
        )
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0", "")
        for gate, start, words in (
            ("cc by", "cc", parts), ("creative commons", "creative commons", long)
        )
    ),
)
#: How a name is used: gate words, words around the name, priority (lowest first), weight.
USES = (
    ("spdx", "spdx {license} identifier {name}", 0, 1.0),
    ("licen", "(?:licensed|released|distributed|published|available|provided) under"
     " (?:the )?(?:terms of )?(?:the )?{name}", 1, 0.95),
    ("subject to", "subject to (?:the )?(?:terms of )?(?:the )?{name}", 2, 0.9),
    ("", "{name}", 3, 0.75),
)
#: Signatures that are not a use of a name: label, gates, expression, priority, weight.
OTHERS = (
    ("mit", ("permission is hereby granted",), "permission is hereby granted free of charge to any"
     " person obtaining a copy of this software", 1, 0.95),
    ("isc", ("permission to use",), "permission to use copy modify and or distribute this software"
     " for any purpose", 1, 0.95),
    ("bsd", ("redistribution and use",), "redistribution and use in source and binary forms", 1, 0.9),
    ("proprietary", ("confidential",), "proprietary and confidential", 2, 0.8),
    ("proprietary", ("proprietary",), f"proprietary {LIC}|under (?:a )?proprietary", 2, 0.8),
    ("public-domain", ("public domain",), "(?:in|into|to) the public domain", 2, 0.8),
    ("public-domain", ("public domain",), "public domain", 4, 0.6),
    ("copyleft", ("copyleft",), "copyleft", 4, 0.5),
    ("no-warranty", ("warranty",), "without warranty of any kind|without any warranty", 4, 0.4),
    ("copyright", ("copyright",), "copyright(?: c| ©)?(?: \\d{4})?", 5, 0.4),
    ("reserved", ("rights reserved",), "(?:all|some|no) rights reserved", 5, 0.5),
)
BASE_WEIGHT = 0.5


def _bytes(expression: str) -> re.Pattern:
    joined = expression.encode().replace(b" ?", b"(?:\0)?").replace(b" ", GAP)
    joined = joined.replace(b"\0", GAP)
    return re.compile(rb"(?<![" + WORD + rb"])(?:" + joined + rb")(?![" + WORD + rb"])")


def signatures() -> list[tuple[str, tuple[str, ...], str, int, float]]:
    """All rules (label, gates, expression, priority, weight) in their order."""
    made = [
        (label, tuple(g for g in (gate, use_gate) if g),
         use.format(name=f"(?:{name})", license=LIC), priority, weight)
        for use_gate, use, priority, weight in USES
        for label, gate, name in NAMES
    ]
    return sorted([*made, *OTHERS], key=lambda rule: rule[3])


class Scanner:
    def __init__(self):
        rules = signatures()
        self.rules = [(label, _bytes(expr), p, w) for label, _, expr, p, w in rules]
        self.base = [(label, _bytes(phrase)) for phrase, label in BASE.items()]
        # Gates of several words hold where their first words do; the rule decides the rest.
        self.by_gates: dict[frozenset[str], list[int]] = {}
        for i, (_, gates, _, _, _) in enumerate(rules):
            self.by_gates.setdefault(frozenset(g.split()[0] for g in gates), []).append(i)
        self.automaton = ahocorasick.Automaton()
        words = {g for gates in self.by_gates for g in gates} | {p.split()[0] for p in BASE}
        for word in words:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()
        # No text has a detection without one of these; they are looked for first.
        self.rare = [b"licen", b"rights", b"copyright", b"copyleft", b"spdx", b"domain", b"cc",
                     b"commons", b"gpl", b"warranty", b"proprietary", b"confidential", b"bsd",
                     b"permission", b"redistribution", b"cecill", b"attribution", b"apache"]
        self.word = np.zeros(256, bool)
        self.word[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True

    def __call__(self, low: bytes) -> tuple[list[tuple], list[tuple]]:
        """Detections kept (start, end, label, priority, weight) and base places, in words."""
        if not any(word in low for word in self.rare):
            return [], []
        seen = {word for _, word in self.automaton.iter(low.decode("latin-1"))}
        found = []
        for gates, members in self.by_gates.items():
            if gates <= seen:
                for i in members:
                    label, expression, priority, weight = self.rules[i]
                    found += [
                        (priority, i, m.start(), m.end(), label, weight)
                        for m in expression.finditer(low)
                    ]
        places = [(m.start(), label) for label, e in self.base for m in e.finditer(low)]
        if not found and not places:
            return [], []
        inside = self.word[np.frombuffer(low, np.uint8)]
        inside[1:] &= ~inside[:-1]
        firsts = np.flatnonzero(inside)
        at = lambda offset: int(np.searchsorted(firsts, offset))
        kept = [
            (at(start), at(end), label, priority, weight)
            for priority, _, start, end, label, weight in _outermost(sorted(found))
        ]
        return sorted(kept), sorted((at(start), label) for start, label in places)


def _outermost(found: list[tuple]) -> list[tuple]:
    """Detections, best first, without those inside an earlier one or overlapping its equal.

    Kept intervals are never nested, so sorted by start they are also sorted by end.
    """
    starts, ends, kept = [], [], []
    for one in found:
        start, end = one[2], one[3]
        i = bisect_right(starts, start)
        if i and ends[i - 1] >= end:
            continue
        # Those kept that lie inside the new one have a higher priority and stay.
        inside = i < len(starts) and ends[i] <= end
        if not inside and not (i and starts[i - 1] == start):
            starts.insert(i, start)
            ends.insert(i, end)
        kept.append(one)
    return kept


_SCANNER: list[Scanner] = []
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
DETECTION = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()),
     ("priority", pa.int32()), ("weight", pa.float64())]
)
PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])


def _rows(key: pa.Array, column: pa.Array) -> dict:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    scan = _SCANNER[0]
    data, offsets = texts_of(column)
    low = data.tobytes().translate(_LOWER)
    inside = scan.word[np.frombuffer(low, np.uint8)]
    fresh = offsets[:-1][offsets[:-1] < len(low)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[fresh] = inside[fresh]
    counted = np.concatenate([[0], np.cumsum(begins)])
    results = [scan(low[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    names = DETECTION.names
    return {
        "k": key,
        "n_words": pa.array(counted[offsets[1:]] - counted[offsets[:-1]], pa.int64()),
        "detections": pa.array(
            [[dict(zip(names, d)) for d in kept] for kept, _ in results], pa.list_(DETECTION)
        ),
        "places": pa.array(
            [[{"word": w, "label": name} for w, name in places] for _, places in results],
            pa.list_(PLACE),
        ),
    }


def scan(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, n_words, detections (in words, end exclusive) and places of base phrases."""
    schema = (
        f"k {dict(df.dtypes)[key]}, n_words bigint, detections array<struct<start:bigint,"
        "end:bigint,label:string,priority:int,weight:double>>,"
        " places array<struct<word:bigint,label:string>>"
    )
    plain = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return map_rows(plain, ["k", "t"], schema, _rows).withColumnRenamed("k", key)


def summary(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, n_words, base places counted and labelled, all labels, and a score.

    The score is the weight of the strongest detection that was kept, 0 without any.
    """
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    places, found = F.col("places"), F.col("detections")
    weights = F.when(F.size(places) > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0))
    return scan(df, key, text).select(
        key,
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places["word"]).alias("first_word"),
        F.array_max(places["word"]).alias("last_word"),
        joined(places["label"]).alias("base_labels"),
        joined(F.concat(places["label"], found["label"])).alias("labels"),
        F.greatest(weights, F.coalesce(F.array_max(found["weight"]), F.lit(0.0))).alias("score"),
    )
