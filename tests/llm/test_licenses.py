"""Licence scan: rules, gates, suppression, and the whole against a plain reading."""

import random
import re
import re._parser as parser

import pytest
from pyspark.sql import functions as F

from newslens.llm import licenses
from newslens.llm.license_rules import BASE, CONFIDENCE, PHRASES, ROOTS, RULES

from .conftest import frame


def samples(tree, limit=60):
    """Strings that a simple pattern matches: all its branches, repeats at both ends."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            parts = [chr(arg)]
        elif name == "NOT_LITERAL":
            parts = ["z"]
        elif name == "IN":
            negated = str(arg[0][0]) == "NEGATE"
            parts = ["z"] if negated else [chr(a) for o, a in arg if str(o) == "LITERAL"]
        elif name == "SUBPATTERN":
            parts = samples(arg[3], limit)
        elif name == "BRANCH":
            parts = [s for branch in arg[1] for s in samples(branch, limit)]
        else:
            low, high, inner = arg
            once = samples(inner, limit)
            parts = [s * low for s in once] + [s * max(low, 1) for s in once if low == 0]
        out = [a + b for a in out for b in dict.fromkeys(parts)][:limit]
    return out


def test_there_are_hundreds_of_rules_and_gates_never_hide_a_match():
    assert len(RULES) > 300
    for rule in RULES:
        for text in samples(parser.parse(rule.regex)):
            assert re.fullmatch(rule.regex, text), (rule, text)
            assert rule.keyword in text, (rule, text)
            plain = text.replace("-", "")
            assert any(root in plain for root in ROOTS), (rule, text)


def reading(text):
    """The same result without Spark: every rule over the words, suppression by definition."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    line = "".join(f"-{w} " for w in words)
    spans = []
    for rule in RULES:
        for m in re.finditer(rule.regex, line):
            first = line[: m.start()].count(" ")
            spans.append((first, first + m.group().count(" ") - 1, rule))
    base = [s for s in spans if s[2].tier == BASE]

    def inside(s):
        return any(
            e is not s and e[0] <= s[0] and e[1] >= s[1]
            and (e[2].tier, -(e[1] - e[0]), e[2].rule) < (s[2].tier, -(s[1] - s[0]), s[2].rule)
            for e in spans
        )

    kept = [s for s in spans if s[2].tier == BASE or not inside(s)]
    starts = [s[0] for s in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({s[2].label for s in base})), ",".join(sorted({s[2].label for s in kept})),
        max((CONFIDENCE[s[2].tier] for s in kept), default=0.0), len(spans), len(kept),
    )


def mixed(seed):
    r = random.Random(seed)
    pieces = ["mit license", "Apache License, Version 2.0", "GNU Lesser General Public License v2.1", "the", "permit", "MIT/X11 license",
              "All rights\nreserved", "SPDX-License-Identifier: GPL-2.0-only", "Licensed under CC BY-NC 4.0", "http://www.apache.org/licenses/LICENSE-2.0",
              "general public license", "Éé ñ", "// * -", "public domain", "is in the public domain", "Apache", "license"]
    return " ".join(r.choice(pieces) for _ in range(r.randint(0, 25)))


def test_against_a_plain_reading(spark):
    texts = [mixed(i) for i in range(60)] + [r for r in (None, "", " - ", " mit license", "MIT LICENSEİ", "K mit license")]
    # Of each rule one text that it matches.
    texts += [samples(parser.parse(rule.regex))[-1].replace("-", " ") for rule in RULES]
    rows = list(enumerate(texts))
    got = {r[0]: tuple(r)[1:] for r in licenses.summary(licenses.scan(frame(spark, rows))).collect()}
    for i, text in rows:
        assert got[i] == reading(text), (text, got[i], reading(text))


def test_containment(spark):
    text = "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"
    found = licenses.scan(frame(spark, [(1, text)])).collect()[0]["detections"]
    assert [(s["label"], s["tier"]) for s in found if s["kept"]] == [("apache-2.0", 1), ("apache", BASE)]
    assert any(s["tier"] == 3 and not s["kept"] for s in found)
    assert all(a["first"] <= b["first"] for a, b in zip(found, found[1:]))


def test_many_spans_in_one_text(spark):
    n = 20_000
    out = licenses.summary(licenses.scan(frame(spark, [(1, "Mit License.\n" * n + "general public license")]))).collect()[0]
    assert (out["n_base"], out["first_word"], out["last_word"]) == (n + 1, 0, 2 * n)
    assert out["base_labels"] == "gpl,mit"


def test_odd_rows(spark, odd, empty):
    out = licenses.summary(licenses.scan(odd)).collect()
    assert len(out) == odd.count()
    assert {r["n_words"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert all(r["n_base"] == 0 and r["first_word"] is None and r["labels"] == "" for r in out)
    none = licenses.summary(licenses.scan(empty))
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_no_python_on_the_main_path(spark, odd):
    plan = licenses.summary(licenses.scan(odd))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("text,labels", [
    (" ".join(p for _, p in PHRASES), "apache,gpl,mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Released under the MIT License.", "mit"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
])
def test_labels(spark, text, labels):
    assert licenses.summary(licenses.scan(frame(spark, [(1, text)]))).select(F.col("labels")).collect()[0][0] == labels
