"""Texts of a megabyte that hold little but what the scanners look for."""

import time

import pytest

from attemptlog.llm import license_scan, secret_scan


@pytest.mark.parametrize("text,places", [(b"copyright x " * 87_000, 87_000), (b"cc by " * 170_000, 170_000), (b"mit license gpl " * 30_000, 0)])
def test_many_licenses_take_linear_time(text, places):
    began = time.monotonic()
    kept, base = license_scan.Scanner()(text)
    assert time.monotonic() - began < 60
    assert len(kept) >= 30_000 and len(base) in (0, places)


@pytest.mark.parametrize(
    "text", [b"eyJ" * 350_000, b"eyJabcdefgh." * 90_000, b"eyJ_" * 250_000 + b".abcdefgh.", b"xoxb-" * 200_000, b"token " * 170_000, b"sk_live_" * 130_000]
)
def test_many_keywords_take_linear_time(text):
    began = time.monotonic()
    secret_scan.Scanner()(text)
    assert time.monotonic() - began < 20


def brute(text):
    """Web tokens by trying every place."""
    rule = next(r for r in secret_scan.RULES if r[0] == "web_token")
    import re

    found, at = [], 0
    pattern = re.compile(rule[2])
    while at < len(text):
        match = pattern.match(text, at)
        if match:
            if rule[3](match):
                found.append((at, match.end()))
            at = match.end()
        else:
            at += 1
    return found


def test_runs_that_fail_once_fail_later():
    good = b"eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc"
    texts = [good, b"eyJ" + good, b"eyJeyJeyJ " + good, b"eyJeyJeyJ.eyJ" + good, b"eyJ.eyJ." + good, good + good, b"xeyJ-" + good + b"." + good]
    for text in texts:
        got = [(a, b) for a, k, b in secret_scan.Scanner()(text) if secret_scan.KINDS[k] == "web_token"]
        assert got == brute(text), text
