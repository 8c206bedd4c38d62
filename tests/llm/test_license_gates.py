import re

import pytest

from attemptlog.llm import license_scan


def alternatives(expression):
    """The texts that an expression of words may stand for, each optional part in and out."""
    tree = re._parser.parse(expression)

    def walk(items):
        texts = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                ends = [chr(arg)]
            elif name == "IN":
                kind, first = str(arg[0][0]), arg[0][1]
                ends = ["0" if kind == "CATEGORY" else chr(first if kind == "LITERAL" else first[0])]
            elif name == "ANY":
                ends = ["a"]
            elif name == "SUBPATTERN":
                ends = walk(arg[3])
            elif name == "BRANCH":
                ends = [t for branch in arg[1] for t in walk(branch)]
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, _, inner = arg
                some = walk(inner)
                ends = [t * max(low, 1) for t in some] + ([""] if low == 0 else [])
            else:
                raise AssertionError(name)
            texts = [a + b for a in texts for b in dict.fromkeys(ends)]
        return texts

    return walk(tree)


@pytest.mark.parametrize("label, gate, name", license_scan.NAMES)
def test_every_alternative_has_its_gate(label, gate, name):
    first = gate.split()[0]
    assert all(first in text for text in alternatives(name)), (label, gate)


@pytest.mark.parametrize("label, gates, expression, priority, weight", license_scan.OTHERS)
def test_every_alternative_of_other_rules(label, gates, expression, priority, weight):
    for text in alternatives(expression.replace("{license}", license_scan.LIC)):
        assert all(gate.split()[0] in text for gate in gates), (label, gates, text)


@pytest.mark.parametrize("text, label", [("licensed under the psf license", "psf-2.0"),
                                         ("licensed under the expat license", "mit")])
def test_alternatives_are_found(text, label):
    found, _ = license_scan.Scanner()(text.encode())
    assert label in [d[2] for d in found]
