r"""Secrets by regular expression, found through a trigram inverted index.

For each rule a Boolean trigram query is derived from its expression: the
literal strings that every match must contain one of, each as the set of its
trigrams.  ``postings`` is the inverted index of the trigrams that the rules
ask for (others cannot decide a query and are left out); ``candidates``
intersects the postings of a string and unites the strings of a rule.  Only
candidates are verified with the expression.  A rule whose expression has no
mandatory trigram scans every text.

Everything is DataFrame expressions.  Matches come from the Java engine; the
place of a match is the length of the pieces and matches before it.

Defined results: a null text counts as empty and has no spans; a repeated row
is scanned again and gives the same spans; documents without a match are
returned with zero counts; extra columns are ignored.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationspark.llm.shared import let, whole_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches, leftmost and without overlap; a match stays
    when its group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules, in their order.  A run of characters of one class is
#: matched whole, so a least length there can stand in the expression; where
#: a failing match may hide a later one, it is tested after the match.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Rules that this method adds.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("forge", r"(ghp|gho|ghs|ghu)_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
)
RULES = BASE + ADDED

#: Alternatives that are followed at once; beyond, a string ends there.
MOST_STRINGS = 64


def required_strings(pattern: str) -> set[str]:
    """Lower-case strings one of which is in every match; empty if none of
    three characters or more is mandatory."""
    found: list[set[str]] = []

    def ended(strings: set[str]) -> None:
        if strings and min(map(len, strings)) >= 3:
            found.append(strings)

    def whole(items) -> set[str] | None:
        """All strings that the items can match, if these are few."""
        out = {""}
        for op, arg in items:
            if op is rc.LITERAL:
                ways = {chr(arg).lower()}
            elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
                ways = {chr(a).lower() for _, a in arg}
            elif op is rc.SUBPATTERN:
                ways = whole(arg[3])
            elif op is rc.BRANCH:
                parts = [whole(b) for b in arg[1]]
                ways = None if None in parts else set().union(*parts)
            elif op is rc.MAX_REPEAT and arg[1] == 1:
                ways = whole(arg[2])
                ways = ways if ways is None or arg[0] else ways | {""}
            else:
                ways = None
            if ways is None or len(out) * len(ways) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in ways}
        return out

    strings = {""}
    for item in rp.parse(pattern):
        ways = whole([item])
        if ways is not None and "" not in ways and len(strings) * len(ways) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in ways}
        else:
            ended(strings)
            strings = {""}
    ended(strings)
    return max(found, key=lambda s: min(map(len, s)), default=set())


def trigrams(string: str) -> list[str]:
    return sorted({string[i:i + 3] for i in range(len(string) - 2)})


def trigram_queries(rules=RULES) -> dict[str, list[list[str]]]:
    """For each rule that has one: any of these lists, all trigrams of it."""
    return {r.kind: [trigrams(s) for s in sorted(strings)]
            for r in rules if (strings := required_strings(r.pattern))}


def postings(docs: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """``(trigram, doc_id)`` of the trigrams in the queries."""
    asked = sorted({t for parts in queries.values() for p in parts for t in p})
    has = let(F.lower(whole_text()), lambda low: F.array_compact(F.array(
        *[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in asked])))
    return docs.select("doc_id", F.explode(has).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """``(doc_id, kinds)``: the rules whose trigram query holds for a document."""
    parts = [(t, kind, i, len(part)) for kind, ps in queries.items() for i, part in enumerate(ps) for t in part]
    asked = index.sparkSession.createDataFrame(parts, "trigram string, kind string, part int, size int")
    hits = (index.join(F.broadcast(asked), "trigram")
            .groupBy("doc_id", "kind", "part", "size")
            .agg(F.count_distinct("trigram").alias("got")).filter("got = size"))
    return hits.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of ``(start, rule's place, end)`` of the rule's matches."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    tested = (F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
              if rule.group else whole)
    nothing = F.array().cast("array<struct<start:int,place:int,end:int,size:int>>")

    def step(state, match):
        start = state["at"] + match["before"]
        end = start + match["size"]
        one = F.struct(start.alias("start"), F.lit(order).alias("place"), end.alias("end"),
                       match["tested"].alias("size"))
        return F.struct(end.alias("at"), F.array_append(state["found"], one).alias("found"))

    # the last piece follows the last match
    matches = F.zip_with(F.slice(pieces, 1, F.size(pieces) - 1), F.arrays_zip(
        whole.alias("size"), tested.alias("tested")), lambda b, m: F.struct(
        b.alias("before"), m["size"].alias("size"), m["tested"].alias("tested")))
    start = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    spans = F.aggregate(matches, start, step, lambda s: s["found"])
    if rule.least:
        spans = F.filter(spans, lambda s: s["size"] >= rule.least)
    return F.when(F.rlike(text, pattern), spans).otherwise(nothing)


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """``(doc_id, spans)``: per document its spans ``(start, place, end)``,
    ordered; ``place`` is the rule's place in ``rules``."""
    queries = trigram_queries(rules)
    texts = docs.select("doc_id", whole_text().alias("text"))
    hits = candidates(postings(docs, queries), queries).withColumnRenamed("doc_id", "found_id")
    rows = texts.join(hits, texts["doc_id"].eqNullSafe(hits["found_id"]), "left")
    found = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, order)
        if rule.kind in queries:
            asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            spans = F.when(asked, spans).otherwise(
                F.array().cast("array<struct<start:int,place:int,end:int,size:int>>"))
        found.append(spans)
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def digest(found: DataFrame, rules=RULES, base=BASE) -> DataFrame:
    """The spans as text and the counts of the base rules."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["place"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(place: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(base)]
    of_base = F.filter("spans", lambda s: s["place"] < len(base))
    return found.select("doc_id", *counts, F.sha2(joined(of_base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
