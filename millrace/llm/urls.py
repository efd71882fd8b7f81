"""URL filters: pattern rules, each found through the rarest literal token it needs.

A rule is a regular expression over host and path, together with literal tokens that every URL it
fits has.  The tokens of all URLs are counted, each rule is filed under its rarest one, and a URL
runs the expressions of those rules only that its own tokens fetch.  All of it is column functions:
no shuffle but that of the token counts, no Python.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower
case.  Path: what follows up to ``?``, ``#`` or the end.  A null URL and one without ``://`` have
both empty, fit no rule and get the default verdict.  Rules are given with the call and travel in
the plan; their number does not depend on the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .batches import column

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_TOKEN = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path; of several that fit, ``rank`` and name decide."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    listed: bool = False

    @property
    def rank(self) -> tuple[bool, int]:
        return self.listed, len(self.name)


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host and its subdomains, for paths that start with ``path``."""
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    # The last token of the path may go on in the URL.
    whole = re.split(NO_TOKEN, host) + re.split(NO_TOKEN, path.lower())[:-1]
    return Rule(host + path, verdict, pattern, tuple(t for t in whole if t), listed=True)


# The listed rules.
LISTED = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)


def host_word_rule(word: str) -> Rule:
    """A rule for hosts with ``word`` as a label or as a part of one between hyphens."""
    return Rule(f"{word} host", "block", rf"^(?:[^/]*[.-])?{word}(?:[.-][^/]*)?(?:/|\z)", (word,))


def server_rule(label: str) -> Rule:
    """A rule for hosts with ``label`` before a domain, as in ``ads.example.net``."""
    return Rule(f"{label} server", "block", rf"^(?:[^/]*\.)?{label}\.[^/.]+\.[^/]", (label,))


def page_rule(path: str) -> Rule:
    """A rule for paths with the names ``path``, of which the last may have an ending."""
    tokens = tuple(t for t in re.split(NO_TOKEN, path) if t)
    return Rule(f"{path} page", "block", rf"/{re.escape(path)}(?:[./]|\z)", tokens)


# Our own patterns for hosts and paths that no listed rule covers, each with a token it needs.
PATTERNS = (
    *map(host_word_rule, ("casino", "doubleclick", "escort", "malware", "phishing", "pills",
                          "poker", "porn", "spam", "viagra", "warez", "xxx")),
    *map(server_rule, ("ad", "ads", "adserver", "adservice")),
    *map(page_rule, ("cart/checkout", "cgi-bin", "login", "logout", "signin", "signup",
                     "wp-admin", "wp-login", "xmlrpc")),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, split, k), F.lit("")) for k in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def tokens_of(place: Column) -> Column:
    return F.array_distinct(F.split(F.translate(place, UPPER, LOWER), NO_TOKEN))


def token_counts(pages: DataFrame, rules: Iterable[Rule], url_col: str = "url") -> dict[str, int]:
    """How many URLs have each literal token of the rules."""
    wanted = sorted({token for rule in rules for token in rule.tokens})
    host, path = url_parts(column(url_col))
    # One row for each token of the rules comes back.
    found = pages.select(F.explode(F.filter(
        tokens_of(F.concat(host, path)), lambda t: t.isin(wanted))).alias("token")) \
        .groupBy("token").count().collect()
    return {r.token: r["count"] for r in found}


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = LISTED + PATTERNS,
               default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, ``rule`` (a listed one, else null), ``verdict`` and
    ``fits`` (the names of all rules that fit, best first).

    Listed rules go before patterns, longer names before shorter.  Repeated rows give repeated
    results.
    """
    rules = sorted(rules, key=lambda r: (r.rank, r.name), reverse=True)
    counts = token_counts(pages, rules, url_col)
    index: dict[str, list[int]] = {}
    always = [i for i, rule in enumerate(rules) if not rule.tokens]
    for i, rule in enumerate(rules):
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            index.setdefault(rarest, []).append(i)

    def numbers(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<int>")

    host, path = url_parts(column(url_col))
    parts = pages.select(column(id_col), host.alias("host"), path.alias("path"))
    place = F.concat("host", "path")
    fetched = numbers(always)
    if index:
        postings = F.create_map(*[x for t, ids in index.items() for x in (F.lit(t), numbers(ids))])
        hits = F.filter(tokens_of(place), lambda t: t.isin(list(index)))
        fetched = F.concat(fetched, F.flatten(F.transform(hits, lambda t: postings[t])))
    names = F.array(*[F.lit(rule.name) for rule in rules])
    # Literal patterns are compiled once, and run only where their rule was fetched.
    tried = [F.when(F.array_contains("fetched", i),
                    F.when(F.regexp_like("place", F.lit(rule.pattern)), F.lit(i)))
             for i, rule in enumerate(rules)]
    judged = parts.withColumn("place", place).withColumn("fetched", fetched).withColumn(
        "fits", F.array_compact(F.array(*tried)) if rules else numbers([]))
    best = F.get("fits", F.lit(0))
    listed = F.array(*[F.lit(rule.listed) for rule in rules])
    verdict = F.array(*[F.lit(rule.verdict) for rule in rules])
    return judged.select(
        column(id_col), "host", "path", F.when(F.get(listed, best), F.get(names, best)).alias("rule"),
        F.coalesce(F.get(verdict, best), F.lit(default)).alias("verdict"),
        F.transform("fits", lambda i: names[i]).alias("fits"),
    )
