"""URL filters: pattern rules indexed by their rarest literal token.

A rule is (host, path, verdict): it fits its host and all subdomains, where the url's path starts with the rule's
path; `*` in a path stands for any run of characters. The longest fitting rule wins (longest text, then longest host,
then `block` before `allow`). Each rule is filed under one of its whole literal tokens, the one that fewest rules hold;
a url's tokens fetch candidate rules, and only those run their regular expressions.

Null urls and urls without `://` have an empty host and path, fit no rule and get the default verdict. Urls are judged
whole, however long. Repeated urls and page ids are judged row by row. An empty table gives an empty result, as no rules give
all rows the default. Extra columns are kept; the operator's own columns replace any of the same name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_WORD = re.compile(r"[0-9A-Za-z]+")
#: Up to so many rules the index is sent to every worker; beyond it, rules and urls meet in a join on the token.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """For host + path, host in lower case; the host's end is the path's slash or the text's end."""
        path = ".*".join(map(re.escape, self.path.split("*")))
        return rf"(?s)^(?:[^/]*\.)?{re.escape(self.host.lower())}(?=/|$){path}"

    def tokens(self) -> list[str]:
        """Those whole tokens that any fitting url must have: none that a longer path or `*` could lengthen."""
        found = _WORD.findall(self.host.lower())
        for m in _WORD.finditer(self.path):
            ends = m.end() < len(self.path) and self.path[m.end()] != "*"
            if ends and not (m.start() and self.path[m.start() - 1] == "*"):
                found.append(m.group())
        return list(dict.fromkeys(found))

    @property
    def order(self) -> tuple:
        return (-len(self.text), -len(self.host), self.verdict != "block", self.text)


def parse(text: str, verdict: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host.lower(), slash + path, verdict)


def index(rules: list[Rule]) -> dict[str | None, list[tuple[Rule, str]]]:
    """Rarest token -> rules in winning order; rules without any whole token stand under None."""
    held = Counter(t for r in rules for t in r.tokens())
    filed: dict[str | None, list[Rule]] = defaultdict(list)
    for r in sorted(rules, key=lambda r: r.order):
        filed[min(r.tokens(), key=lambda t: (held[t], -len(t), t), default=None)].append(r)
    return dict(filed)


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    part = lambda i: F.coalesce(F.regexp_extract(F.col(url), r"://([^/?#]*)([^?#]*)", i), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.withColumns({"host": F.translate(part(1), upper, upper.lower()), "path": part(2)})


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule (its text, null where none fits) and verdict."""
    rows = parsed(pages, url)
    return _by_index(rows, rules, default) if len(rules) <= BROADCAST_RULES else _by_join(rows, rules, default)


def _by_index(rows: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(index(rules))

    @F.pandas_udf("rule string, verdict string")
    def winner(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        filed = {t: [(r.order, re.compile(r.pattern), r) for r in rs] for t, rs in sent.value.items()}
        always = filed.pop(None, [])
        for hosts, paths in batches:
            out = []
            for host, path in zip(hosts, paths):
                best = None
                if host or path:
                    key = host + path
                    for token in {*_WORD.findall(key), None}:
                        for order, pattern, r in filed.get(token, ()) if token else always:
                            if best is not None and order >= best[0]:
                                break  # rules under a token stand in winning order
                            if pattern.match(key):
                                best = (order, r)
                                break
                out.append((best[1].text, best[1].verdict) if best else (None, default))
            yield pd.DataFrame(out, columns=["rule", "verdict"])

    return rows.withColumn("__won", winner("host", "path")).withColumns({"rule": F.col("__won.rule"), "verdict": F.col("__won.verdict")}).drop("__won")


def _by_join(rows: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same for more rules than a worker should hold: distinct urls' tokens meet the rules in a shuffled join."""
    spark = rows.sparkSession
    kind = T.StructType([T.StructField(n, t) for n, t in (("token", T.StringType()), ("place", T.IntegerType()), ("pattern", T.StringType()), ("__rule", T.StringType()), ("__verdict", T.StringType()))])
    filed = [(t or "", r) for t, rs in index(rules).items() for r in rs]
    place = {r: k for k, r in enumerate(sorted({r for _, r in filed}, key=lambda r: r.order))}
    table = spark.createDataFrame([(t, place[r], r.pattern, r.text, r.verdict) for t, r in filed], kind)
    urls = rows.select("host", "path").distinct().withColumn("__key", F.concat("host", "path")).where("__key <> ''")
    tokens = F.array_distinct(F.concat(F.regexp_extract_all("__key", F.lit("[0-9A-Za-z]+"), F.lit(0)), F.array(F.lit(""))))
    met = urls.withColumn("token", F.explode(tokens)).join(table, "token").where(F.expr("__key rlike pattern"))
    won = met.groupBy("host", "path").agg(F.min_by(F.struct("__rule", "__verdict"), "place").alias("__won"))
    out = rows.join(won, ["host", "path"], "left")
    out = out.withColumns({"rule": F.col("__won.__rule"), "verdict": F.coalesce("__won.__verdict", F.lit(default))}).drop("__won")
    return out.select(*rows.columns, *[c for c in ("rule", "verdict") if c not in rows.columns])
