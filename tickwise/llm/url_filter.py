"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path``.  Each rule is filed under one literal token that
every URL it fits must contain whole: the one that the corpus has least often.  A URL's own
tokens fetch the candidate rules, and only those run their regular expression.  Rules
without a whole token are candidates for every URL.

Pattern language: ``||`` at the start anchors at the host or a subdomain boundary, ``|`` at
the start anchors at the host's start, ``^`` is a separator (any character but letters, digits,
``%``, ``_`` and ``/``, or an end of the host or of a path's part), ``*`` is any run without
``/``; the rest is literal.

Defined cases.  Null URLs and URLs without ``://`` have an empty host and path, fit no rule
that names a token and get the default verdict.  Repeated rows are judged alike; an empty
table gives an empty result; other columns are never read.  Rule lists longer than
``RULES_PER_BLOCK`` are applied block after block, so a task holds one block per pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules compiled into one task's index.
RULES_PER_BLOCK = 50_000
_TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for the URLs that fit ``pattern``; of several, the highest rank decides,
    then the longest name, then the name."""

    name: str
    pattern: str
    verdict: str
    rank: int = 0


def site_rule(site: str, verdict: str, rank: int = 1) -> UrlRule:
    """A rule for ``host/path``: the host, its subdomains, and paths that start alike."""
    return UrlRule(site, "||" + site, verdict, rank)


def word_rule(word: str, verdict: str = "block") -> UrlRule:
    """A rule for a whole word of the host name."""
    return UrlRule(word, f"||*^{word}^", verdict)


def rule_regex(pattern: str) -> re.Pattern:
    """The pattern as a regular expression over host + path, to be searched."""
    head = ""
    if pattern.startswith("||"):
        head, pattern = r"\A(?:[^/]*\.)?", pattern[2:]
    elif pattern.startswith("|"):
        head, pattern = r"\A", pattern[1:]
    parts = {"*": "[^/]*", "^": r"(?:[^0-9A-Za-z%_/\u0080-\U0010ffff]|\A|\Z|(?=/)|(?<=/))"}
    return re.compile(head + "".join(parts.get(c) or re.escape(c) for c in pattern), re.DOTALL)


def whole_tokens(pattern: str) -> list[str]:
    """The literal tokens that stand whole in every URL the pattern fits."""
    body, found = pattern.lstrip("|"), []
    for m in _TOKEN.finditer(body):
        left = body[m.start() - 1] if m.start() else ("" if pattern.startswith("|") else "*")
        right = body[m.end()] if m.end() < len(body) else "*"
        if left != "*" and right != "*":
            found.append(m[0])
    return found


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where there is no ``://``."""
    rest = F.when(F.contains(url, F.lit("://")),
                  F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    after = F.substring(F.coalesce(rest, F.lit("")), F.length(host) + 1, F.length(rest) + 1)
    path = F.regexp_extract(F.coalesce(after, F.lit("")), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many rows (host, path) of ``urls`` each token stands; one row per token."""
    names = [*dict.fromkeys(tokens)]
    target = F.concat("host", "path")
    each = urls.select(F.explode(F.array_distinct(
        F.split(target, "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))).alias("token"))
    wanted = each.filter(F.col("token").isin(names)).groupBy("token").count()
    return {r["token"]: r["count"] for r in wanted.toLocalIterator()}


def rule_index(rules: Sequence[UrlRule], counts: dict[str, int]) -> dict[str, list]:
    """Rules by their rarest whole token; under "" those without one."""
    index: dict[str, list] = {}
    for rule in rules:
        tokens = whole_tokens(rule.pattern)
        key = min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default="")
        index.setdefault(key, []).append((rule, rule_regex(rule.pattern)))
    return index


def best_rule(target: str, index: dict[str, list]) -> UrlRule | None:
    best, key = None, None
    for token in {"", *_TOKEN.findall(target)}:
        for rule, regex in index.get(token, ()):
            new = (rule.rank, len(rule.name), rule.name)
            if (key is None or new > key) and regex.search(target):
                best, key = rule, new
    return best


def _block(df: DataFrame, rules: Sequence[UrlRule], counts: dict[str, int]) -> DataFrame:
    """Adds what ``rules`` say to the columns rank, rule and verdict."""
    schema = df.schema
    rules = list(rules)

    def run(frames: Iterator) -> Iterator:
        index = rule_index(rules, counts)
        for pdf in frames:
            old = zip(pdf["_rank"], pdf["_rule"], pdf["_verdict"], strict=True)
            rows = []
            for target, (rank, name, verdict) in zip(pdf["host"] + pdf["path"], old, strict=True):
                best = best_rule(target, index)
                if best and (best.rank, len(best.name), best.name) > (rank, len(name), name):
                    rank, name, verdict = best.rank, best.name, best.verdict
                rows.append((rank, name, verdict))
            pdf["_rank"], pdf["_rule"], pdf["_verdict"] = zip(*rows, strict=True) if rows else ((), (), ())
            yield pdf

    return df.mapInPandas(run, schema)


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], default: str = "allow",
               rules_per_block: int = RULES_PER_BLOCK) -> DataFrame:
    """page_id, host, path, rule, rank and verdict for every row of ``pages`` (page_id, url).

    ``rule`` names the deciding rule, or is null where the default decides.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    counts = token_counts(urls, [t for r in rules for t in whole_tokens(r.pattern)])
    out = urls.select("*", F.lit(-1).alias("_rank"), F.lit("").alias("_rule"),
                      F.lit(default).alias("_verdict"))
    for at in range(0, len(rules), rules_per_block):
        out = _block(out, rules[at:at + rules_per_block], counts)
    return out.select("page_id", "host", "path",
                      F.when(F.col("_rank") >= 0, F.col("_rule")).alias("rule"),
                      F.when(F.col("_rank") >= 0, F.col("_rank")).alias("rank"),
                      F.col("_verdict").alias("verdict"))
