"""Secret scan (operator 10).

An Aho-Corasick automaton finds the keywords of all rules in one pass over a text. A rule's
expression is tried only where one of its keywords starts, anchored there; what it matches
must then pass the rule's own test: a minimum length, an embedded checksum (the last six
characters of some access tokens are the CRC-32 of the others in base 62), or a header that
decodes. Runs of hex digits have no keyword and are found as runs.

Defined results: a null or empty text has no spans. Every row gives one row, whatever its key
(null and repeated keys included), and texts are scanned whole. Matches of one kind don't
overlap and are taken from the left, a failing match included; spans of different kinds may.
Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import base64
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import map_rows

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def base62_crc(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the body before them."""
    body, check = match[1], match[2].decode()
    value, digits = zlib.crc32(body), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == check


def json_header(match: re.Match) -> bool:
    """The first part decodes to a JSON object that names an algorithm."""
    head = match[1]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(found, dict) and "alg" in found


#: kind, keywords (lower case, each at the start of the expression), expression, test.
RULES = (
    (
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    ("access", ("akia",), rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    (
        "hosted_git",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])",
        base62_crc,
    ),
    ("registry", ("npm_",), rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])", base62_crc),
    (
        "web_token",
        ("eyj",),
        rb"(eyJ[A-Za-z0-9_-]{8,})\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*",
        json_header,
    ),
    (
        "private_key",
        ("-----begin ",),
        rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----",
        lambda m: True,
    ),
    ("chat", ("xox",), rb"xox[abprs]-[0-9]{8,}-[A-Za-z0-9-]{16,}", lambda m: True),
    ("payment", ("sk_live_", "rk_live_"), rb"[sr]k_live_[A-Za-z0-9]{20,}", lambda m: True),
)
#: Kinds whose expression can start anywhere in a run of these and reads it to its end: where it
#: fails once it fails at every later start of the run, as what follows the run is the same.
RUNS = {"web_token": re.compile(rb"[A-Za-z0-9_-]*")}
HEX_MIN = 24
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *(rule[0] for rule in RULES[2:]))
_ORDER = {kind: i for i, kind in enumerate(KINDS)}
_HEX = re.compile(rb"[0-9a-f]{%d,}" % HEX_MIN)


class Scanner:
    def __init__(self):
        self.find = ahocorasick.Automaton()
        for rule, (_, keywords, _, _) in enumerate(RULES):
            for word in keywords:
                self.find.add_word(word, (rule, len(word)))
        self.find.make_automaton()
        self.tries = [re.compile(pattern).match for _, _, pattern, _ in RULES]
        self.runs = [RUNS.get(kind) for kind, _, _, _ in RULES]

    def __call__(self, text: bytes) -> list[tuple[int, int, str]]:
        """(start, order of the kind, end) in bytes, sorted."""
        found = [(m.start(), _ORDER["hex"], m.end()) for m in _HEX.finditer(text)]
        hits = [
            (end + 1 - length, rule)
            for end, (rule, length) in self.find.iter(text.lower().decode("latin-1"))
        ]
        done = [0] * len(RULES)
        for start, rule in sorted(hits):
            if start < done[rule]:
                continue
            if not (match := self.tries[rule](text, start)):
                if self.runs[rule]:
                    done[rule] = self.runs[rule].match(text, start).end()
                continue
            done[rule] = match.end()
            if RULES[rule][3](match):
                found.append((start, _ORDER[RULES[rule][0]], match.end()))
        return sorted(found)


_SCANNER: list[Scanner] = []


def _spans(column: pa.Array) -> pa.Array:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    scan, out = _SCANNER[0], []
    for text in column.to_pylist():
        raw = (text or "").encode()
        spans = scan(raw) if raw else []
        if spans and len(raw) != len(text):
            # Bytes that don't continue a code point, before each offset.
            points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
            at = lambda i: int(points[i - 1]) if i else 0
            spans = [(at(start), kind, at(end)) for start, kind, end in spans]
        out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    return pa.array(out, pa.list_(kind))


def scan(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``key`` and ``spans`` (kind, start, end), by start, then kind as listed."""
    kind = dict(df.dtypes)[key]
    rows = lambda k, t: {"k": k, "spans": _spans(t)}
    plain = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return map_rows(plain, ["k", "t"], f"k {kind}, spans {SPANS}", rows).withColumnRenamed("k", key)


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256, spans."""
    spans = F.col("spans")
    of = lambda *kinds: F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return scan(df, key, text).select(
        key,
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(of(*BASE)), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )
