"""Licence scan: ordered signature rules with a keyword prefilter, in expressions only.

A text becomes words in lower case, one token each, so a rule is a pattern over words and
needs to know nothing about line ends, comment signs or punctuation. Rules are tried where
the text holds one of a few roots and the rule's own keyword. What they find are spans of
words with a tier; a span inside one of the same or a better tier is suppressed. Spans of
the base phrases always stay.

All of it is one expression per row over the text: no join, no shuffle, no row is copied.
A text of any length is taken whole; the work grows with its length times the rules whose
keyword it holds. Spans are swept once in order of their start, in chunks, so that a text
with very many of them costs no square.

A null text counts as an empty one, which has no words and no spans. Repeated rows are
reported once each, null ids as they are; an empty table gives an empty result. Only the
id and the text are read, so further columns of any name do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.text import let
from newslens.llm.license_rules import BASE, CONFIDENCE, ROOTS, RULES, Rule

# What is no part of a word once A-Z are in lower case, and what a word is
# before. A class that lists what it takes is several times as fast as its complement.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Spans swept in one piece; appending copies a piece, never the whole list.
CHUNK = 256

SPAN = "struct<first:int,last:int,tier:int,rule:int,label:string>"
FOUND = "array<struct<first:int,last:int,tier:int,rule:int,label:string,kept:boolean>>"


def tokens(text: Column) -> Column:
    """The words of a text as ``-one -two -three ``; '' if there is none."""
    apart = F.btrim(F.regexp_replace(F.translate(text, UPPER, LOWER), APART, " -"), F.lit(" -"))
    return let(apart, lambda t: F.when(t == "", "").otherwise(F.concat(F.lit("-"), t, F.lit(" "))))


def _count(piece: Column) -> Column:
    """Number of tokens in a piece of tokens: each has one blank."""
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def _chunks(values: Column) -> Column:
    pieces = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    cut = F.transform(pieces, lambda i: F.slice(values, i * CHUNK + 1, F.lit(CHUNK)))
    return F.when(F.size(values) > 0, cut).otherwise(F.slice(F.array(values), 1, 0))


def running(values: Column, start: Column, step: Callable, state: str, item: str) -> Column:
    """``step(state, value) -> struct(state, item)`` over an array; the items in order.

    A fold that appends to one array copies it at each step. Here a piece of ``CHUNK``
    values is folded at a time and pieces are put together at the end.
    """
    one = f"struct<state:{state},items:array<{item}>>"
    all_ = f"struct<state:{state},pieces:array<array<{item}>>>"

    def piece(begin: Column, chunk: Column) -> Column:
        def add(acc: Column, value: Column) -> Column:
            return let(
                step(acc["state"], value),
                lambda s: F.struct(s["state"].alias("state"), F.concat(acc["items"], F.array(s["item"])).alias("items")).cast(one),
            )

        return F.aggregate(chunk, F.struct(begin.alias("state"), F.array().alias("items")).cast(one), add)

    def put(acc: Column, chunk: Column) -> Column:
        return let(
            piece(acc["state"], chunk),
            lambda p: F.struct(
                p["state"].alias("state"), F.concat(acc["pieces"], F.array(p["items"])).alias("pieces")
            ).cast(all_),
        )

    zero = F.struct(start.alias("state"), F.array().alias("pieces")).cast(all_)
    return F.aggregate(_chunks(values), zero, put, lambda acc: F.flatten(acc["pieces"]))


def _spans(text: Column, rule: Column) -> Column:
    """Where a rule matches: an array of spans of words."""

    def located(matches: Column) -> Column:
        between = F.split(text, rule["regex"], -1)
        sizes = F.zip_with(
            matches, between, lambda m, b: F.struct(_count(F.coalesce(b, F.lit(""))).alias("gap"), _count(m).alias("size"), m.isNull().alias("end"))
        )
        sizes = F.filter(sizes, lambda s: ~s["end"])

        def step(before: Column, s: Column) -> Column:
            first = before + s["gap"]
            last = first + s["size"] - 1
            span = F.struct(
                first.alias("first"), last.alias("last"), rule["tier"].alias("tier"), rule["rule"].alias("rule"), rule["label"].alias("label")
            )
            return F.struct((last + 1).alias("state"), span.alias("item"))

        return running(sizes, F.lit(0), step, "int", SPAN)

    nothing = F.from_json(F.lit("[]"), f"array<{SPAN}>")
    return let(
        F.regexp_extract_all(text, rule["regex"], F.lit(0)),
        lambda m: F.when(F.size(m) > 0, located(m)).otherwise(nothing),
    )


def _kept(spans: Column) -> Column:
    """The spans in order, each with whether it stays.

    In order of start, then of falling end, then of tier, whatever contains a span stands
    before it; so the furthest end of each tier so far tells whether one does.
    """
    order = F.transform(
        spans, lambda s: F.struct(s["first"].alias("first"), (-s["last"]).alias("back"), s["tier"].alias("tier"), s["rule"].alias("rule"), s["label"].alias("label"))
    )
    tiers = max(CONFIDENCE)

    def step(ends: Column, s: Column) -> Column:
        last = -s["back"]
        inside = F.array_max(F.slice(ends, 1, s["tier"])) >= last
        now = F.transform(
            ends, lambda e, i: F.when((i + 1 == s["tier"]) & (e < last), last).otherwise(e)
        )
        kept = (s["tier"] == BASE) | ~inside
        item = F.struct(
            s["first"].alias("first"), last.alias("last"), s["tier"].alias("tier"), s["rule"].alias("rule"), s["label"].alias("label"), kept.alias("kept")
        )
        return F.struct(now.alias("state"), item.alias("item"))

    item = SPAN[:-1] + ",kept:boolean>"
    none = F.array(*[F.lit(-1)] * tiers)
    return running(F.array_sort(order), none, step, "array<int>", item)


def table_of(rules: Sequence[Rule]) -> Column:
    """The rules by keyword, as one value of the plan."""
    by_keyword: dict[str, list[dict]] = {}
    for r in rules:
        by_keyword.setdefault(r.keyword, []).append({"rule": r.rule, "tier": r.tier, "label": r.label, "regex": r.regex})
    groups = [{"keyword": k, "rules": v} for k, v in by_keyword.items()]
    layout = "array<struct<keyword:string,rules:array<struct<rule:int,tier:int,label:string,regex:string>>>>"
    return F.from_json(F.lit(json.dumps(groups)), layout)


def detections(text: Column, rules: Sequence[Rule] = RULES, roots: Sequence[str] = ROOTS) -> Column:
    """Spans of words that a rule matches, by start: first, last, tier, rule, label, kept.

    ``roots`` are pieces of words of which every match of every rule holds one.
    """
    table = table_of(rules)

    def found(words: Column) -> Column:
        groups = F.filter(table, lambda g: F.contains(words, g["keyword"]))
        spans = F.flatten(F.transform(groups, lambda g: F.flatten(F.transform(g["rules"], lambda r: _spans(words, r)))))
        return let(spans, lambda s: F.when(F.size(s) > 0, _kept(s)).otherwise(F.from_json(F.lit("[]"), FOUND)))

    text = F.coalesce(text.cast("string"), F.lit(""))
    any_root = let(
        F.lower(text),
        lambda low: F.exists(F.array(*[F.lit(r) for r in roots]), lambda r: F.contains(low, r)),
    )
    return F.when(any_root, let(tokens(text), found)).otherwise(F.from_json(F.lit("[]"), FOUND))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, detections) of every row."""
    return documents.select(
        key, word_count(F.col(text)).alias("n_words"), detections(F.col(text)).alias("detections")
    )


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """One row per scanned row: what the base phrases and what all rules say of it.

    ``score`` is how sure the best span that stayed is: 1 for words of a licence text down
    to 0.6 for a mere mention, 0 if there is none.
    """
    known = F.array(*[F.lit(CONFIDENCE[t]) for t in sorted(CONFIDENCE)])
    key = scanned.columns[0]
    split = scanned.select(
        key,
        "n_words",
        F.size("detections").cast("bigint").alias("n_found"),
        F.filter("detections", lambda s: s["tier"] == BASE).alias("base"),
        F.filter("detections", lambda s: s["kept"]).alias("kept"),
    )
    sure = F.array_max(F.transform("kept", lambda s: F.element_at(known, s["tier"])))
    return split.select(
        key,
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["first"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["first"])).cast("bigint").alias("last_word"),
        _labels(F.col("base")).alias("base_labels"),
        _labels(F.col("kept")).alias("labels"),
        F.coalesce(sure, F.lit(0.0)).alias("score"),
        "n_found",
        F.size("kept").cast("bigint").alias("n_kept"),
    )
