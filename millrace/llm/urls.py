"""URL filters: pattern rules found by their rarest literal token.

A rule's pattern is matched against ``host + path``. ``||`` at its start means
"the host or any subdomain of it, from a label's beginning", ``*`` is any run
of characters, all else is literal; without ``||`` it may match anywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"
#: Rules that one pass over the URLs takes along; more rules are more passes.
BLOCK = 50_000


@dataclass(frozen=True)
class UrlRule:
    """``name`` is reported. Of the rules that match, the one with the greatest
    ``rank`` wins, then the longest pattern, then the first by name."""

    name: str
    verdict: str
    pattern: str
    rank: int = 0

    def regex(self) -> str:
        anchored = self.pattern.startswith("||")
        body = ".*".join(map(re.escape, self.pattern.removeprefix("||").split("*")))
        return rf"\A(?:[^/]*\.)?{body}" if anchored else body

    def tokens(self) -> list[str]:
        """Tokens that any matching URL has as whole tokens.

        A token at the pattern's edge or beside ``*`` may go on in the URL.
        """
        body = self.pattern.removeprefix("||")
        left = self.pattern.startswith("||")
        found = []
        for m in re.finditer(TOKEN, body):
            before = m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and left
            after = m.end() < len(body) and body[m.end()] != "*"
            if before and after:
                found.append(m[0])
        return found


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(rest, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(targets: DataFrame, target: Column, tokens: Iterable[str]) -> dict[str, int]:
    """How many URLs have each of the rules' tokens. What comes back is bounded by the rules."""
    wanted = sorted(set(tokens))
    if not wanted:
        return {}
    asked = targets.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    own = F.array_distinct(F.regexp_extract_all(target, F.lit(f"({TOKEN})"), 1))
    found = targets.select(F.explode(own).alias("token")).join(asked, "token").groupBy("token").count()
    return {t: n for t, n in found.collect()}


def rule_index(rules: Iterable[UrlRule], counts: Mapping[str, int]) -> dict[str, list[UrlRule]]:
    """Rules by their rarest token; those without one stand under the empty token."""
    index: dict[str, list[UrlRule]] = {}
    for rule in rules:
        token = min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(token, []).append(rule)
    return index


def _matcher(index: dict[str, list[UrlRule]]):
    order = lambda r: (-r.rank, -len(r.pattern), r.name)
    plain = {t: sorted(((order(r), r.regex(), r) for r in found), key=lambda x: x[0]) for t, found in index.items()}

    def winners(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ready = {t: [(o, re.compile(x, re.S), r) for o, x, r in found] for t, found in plain.items()}
        words = re.compile(TOKEN)

        def best(target: str):
            held = None
            for token in {"", *words.findall(target)}:
                for key, pattern, rule in ready.get(token, ()):
                    if held is not None and held[0] <= key:
                        break
                    if pattern.search(target):
                        held = key, rule
                        break
            if held is None:
                return None, None, None, None
            rule = held[1]
            return rule.name, rule.verdict, rule.rank, len(rule.pattern)

        for batch in batches:
            yield pd.DataFrame([best(t) for t in batch], columns=["rule", "verdict", "rank", "length"])

    return F.pandas_udf(winners, "rule string, verdict string, rank int, length int")


def judge_urls(
    pages: DataFrame, rules: Iterable[UrlRule], url: str = "url", block: int = BLOCK
) -> DataFrame:
    """The pages with ``host``, ``path`` and ``found`` (rule, verdict, rank, length; nulls if none).

    Rules are configuration and travel with the tasks, ``block`` at a time;
    each further block is a further pass that keeps the better of two winners.
    Null and odd URLs have an empty host and path, which a rule without
    literals could still match. Repeated rows, extra columns and empty tables
    need no care: each row is judged alone. Columns of the same three names
    are replaced.
    """
    rules = list(rules)
    target = F.concat(F.col("host"), F.col("path"))
    split = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    counts = token_counts(split, target, (t for r in rules for t in r.tokens()))
    nothing = F.lit(None).cast("struct<rule:string,verdict:string,rank:int,length:int>")
    judged = split.withColumn("found", nothing)
    for low in range(0, len(rules), block):
        index = rule_index(rules[low : low + block], counts)
        judged = judged.withColumn("__next", _matcher(index)(target))
        order = lambda c: F.struct(f"{c}.rank", f"{c}.length")
        better = F.col("__next.rule").isNotNull() & (
            F.col("found.rule").isNull() | (order("__next") > order("found"))
        )
        judged = judged.withColumn("found", F.when(better, F.col("__next")).otherwise(F.col("found")))
        judged = judged.drop("__next")
    return judged
