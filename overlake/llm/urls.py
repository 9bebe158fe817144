"""URL filters: rules found by their rarest token; built-in functions only.

Two kinds of rules.  A host rule ``example.org/es/`` fits its host and all subdomains, where
the path begins with the rule's.  A pattern such as ``||ads.example.com/`` or ``^casino^`` is
searched for anywhere, letter case aside: ``*`` stands for any characters, ``^`` for one that
is no ASCII letter or digit, or either end, ``||`` for the beginning of the host or of one of its
parent domains, ``|`` for the beginning or end; ``@@`` before it marks an exception.

Method.  Every rule names the literal tokens (runs of ASCII letters and digits) that a fitting
URL must hold whole.  Each rule is indexed by the one that the fewest URLs hold.  The tokens of
a URL fetch the rules indexed by them, and only these run their regular expressions.  A rule
without such a token is indexed by the empty text, which every URL holds, so none is lost.

Of fitting host rules the longest decides, with equal length the one of the longer host, then
an allowing one; without any, an exception allows, else a pattern blocks, else the default.

Rules are the caller's list, one index row each, which bounds what is broadcast.  Equal URLs
are judged once: they meet in a partial aggregate before the shuffle, and a join that Spark can
split by size hands the verdicts back to all rows, so a URL on many rows is no hot group.

A URL that is null or without ``://`` has empty host and path and takes the default.  Rows may
repeat; a null key is a row like others; very long URLs are taken whole; other columns are
left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile("[0-9a-z]+")
_DEFAULT = "allow"


def _quoted(text: str) -> str:
    """A literal for a regular expression, alike in all dialects."""
    return re.sub(r"([^0-9A-Za-z/_:\-=&, \x80-\U0010ffff])", r"\\\1", text)


@dataclass(frozen=True)
class Rule:
    """``regex`` runs on the address as it is (host rules) or in lower case (patterns)."""

    text: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    by_host: bool = False
    host_length: int = 0

    @property
    def strength(self) -> tuple:
        """Of fitting rules the greatest decides."""
        size = (len(self.text), self.host_length) if self.by_host else (0, 0)
        return (self.by_host, *size, self.action == "allow", self.text)


def host_rule(action: str, text: str) -> Rule:
    """``host/path``; the path may be ``/`` alone."""
    host, slash, path = text.partition("/")
    if not host or not slash or re.search("[?#]", text):
        raise ValueError(f"not a host and a path: {text!r}")
    host = host.translate(str.maketrans(_UPPER, _LOWER))
    found = [(m.group(), m.end()) for m in _TOKEN.finditer(f"{host}/{path}".translate(str.maketrans(_UPPER, _LOWER)))]
    # What ends the rule may go on in the URL.
    whole = tuple(dict.fromkeys(t for t, end in found if end < len(text)))
    return Rule(f"{host}/{path}", action, rf"^(?:[^/?#]*\.)?{_quoted(f'{host}/{path}')}", whole, True, len(host))


def pattern(text: str) -> Rule:
    """A rule of the pattern syntax; it blocks, or allows as an exception."""
    action, body = ("allow", text[2:]) if text.startswith("@@") else ("block", text)
    body = body.translate(str.maketrans(_UPPER, _LOWER))
    start = "||" if body.startswith("||") else "|" if body.startswith("|") else ""
    body = body[len(start) :]
    end = "|" if body.endswith("|") else ""
    body = body[: len(body) - len(end)]
    if not body.strip("*^"):
        raise ValueError(f"a pattern needs some literal text: {text!r}")
    regex = {"||": r"^(?:[^/?#]*\.)?", "|": "^", "": ""}[start]
    for i, c in enumerate(body):
        # The end of the address closes a pattern as well as a character does.
        closing = "(?:[^0-9a-z]|$)" if i else "(?:[^0-9a-z]|^)"
        regex += {"*": r"[\s\S]*", "^": closing}.get(c) or _quoted(c)
    tokens = {}
    for m in _TOKEN.finditer(body):
        left = body[m.start() - 1] if m.start() else "|" if start else "*"
        right = body[m.end()] if m.end() < len(body) else "|" if end else "*"
        if left != "*" and right != "*":
            tokens[m.group()] = None
    return Rule(text, action, regex + ("$" if end else ""), tuple(tokens))


# The host rules of the query, in their order.
HOST_RULES = (
    host_rule("allow", "org/"),
    host_rule("block", "example.org/es/"),
    host_rule("block", "example.org/en/1"),
    host_rule("allow", "com/fr/"),
    host_rule("block", "com/de/"),
)
#: What web corpora commonly leave out: shops of a kind, gambling, adult content, link farms, trackers.
PATTERNS = tuple(
    map(
        pattern,
        (
            "^pills^", "^viagra^", "^casino^", "^poker^", "^porn^", "^xxx^", "^warez^", "^torrent^", "^adult^", "^spam-farm^",
            "||doubleclick.net/", "/adserver/", "@@||wikipedia.org/",
        ),
    )
)
RULES = HOST_RULES + PATTERNS


def _parts() -> tuple[Column, Column, Column]:
    """Host, path, and everything after the host of the column ``_url``; empty texts where there is no ``://``."""
    rest = F.when(F.col("_url").contains("://"), F.expr("substring(_url, locate('://', _url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.regexp_replace(rest, "^[^/?#]*", "")
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(after, "^[^?#]*", 0), after


def _table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """(rank, text, action, regex, by_host, tokens) of every rule; the rank orders by strength."""
    ordered = sorted(set(rules), key=lambda r: r.strength)
    none = F.array().cast("array<string>")
    rows = [
        F.struct(
            F.lit(i).alias("rank"),
            F.lit(r.text).alias("rule_text"),
            F.lit(r.action).alias("action"),
            F.lit(r.regex).alias("regex"),
            F.lit(r.by_host).alias("by_host"),
            (F.array(*map(F.lit, r.tokens)) if r.tokens else none).alias("tokens"),
        )
        for i, r in enumerate(ordered)
    ]
    if not rows:
        return _table(spark, [pattern("^x^")]).limit(0)
    return spark.range(1).select(F.inline(F.array(*rows)))


def addresses(pages: DataFrame, url: str = "url") -> DataFrame:
    """(url, address, low, tokens) of every distinct URL that has ``://``."""
    own = pages.select(F.col(url).alias("_url")).where(F.col("_url").contains("://")).distinct()
    host, _, after = _parts()
    address = F.concat(host, after)
    low = F.translate(address, _UPPER, _LOWER)
    tokens = F.array_distinct(F.concat(F.split(low, "[^0-9a-z]+"), F.array(F.lit(""))))
    return own.select("_url", address.alias("address"), low.alias("low"), tokens.alias("tokens"))


def index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule with ``token``, the rarest among the URLs of those it needs."""
    wanted = rules.select("rank", F.explode_outer("tokens").alias("token"))
    names = F.broadcast(wanted.select("token").distinct())
    held = urls.select(F.explode("tokens").alias("token")).join(names, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("rank").orderBy(F.coalesce("n", F.lit(0)), "token")
    chosen = (
        wanted.join(F.broadcast(held), "token", "left")
        .withColumn("nth", F.row_number().over(rarest))
        .where("nth = 1")
        .select("rank", F.coalesce("token", F.lit("")).alias("token"))
    )
    return rules.drop("tokens").join(F.broadcast(chosen), "rank")


def candidates(urls: DataFrame, indexed: DataFrame) -> DataFrame:
    """(_url, target, rank, regex): the rules that each URL's tokens fetch."""
    # One row per rule of the caller's list.
    met = urls.withColumn("token", F.explode("tokens")).join(F.broadcast(indexed), "token")
    target = F.when(F.col("by_host"), F.col("address")).otherwise(F.col("low"))
    return met.select("_url", target.alias("target"), "rank", "regex")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", default: str = _DEFAULT) -> DataFrame:
    """The rows of ``pages`` with a struct ``filtered``: host, path, rule, pattern and verdict."""
    spark = pages.sparkSession
    listed = _table(spark, rules)
    urls = addresses(pages, url)
    fitting = candidates(urls, index(urls, listed)).where("rlike(target, regex)")
    decided = fitting.groupBy("_url").agg(F.max("rank").alias("rank"))
    decided = decided.join(F.broadcast(listed.select("rank", "rule_text", "action", "by_host")), "rank")
    decided = decided.select("_url", F.struct("rule_text", "action", "by_host").alias("_by"))
    host, path, _ = _parts()
    by_host = F.col("_by.by_host")
    filtered = F.struct(
        host.alias("host"),
        path.alias("path"),
        F.when(by_host, F.col("_by.rule_text")).alias("rule"),
        F.when(~by_host, F.col("_by.rule_text")).alias("pattern"),
        F.coalesce(F.col("_by.action"), F.lit(default)).alias("verdict"),
    )
    columns = [c for c in pages.columns if c != "filtered"]
    whole = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_page"), F.col(url).alias("_url"))
    return whole.join(decided, "_url", "left").select("_page.*", filtered.alias("filtered"))
