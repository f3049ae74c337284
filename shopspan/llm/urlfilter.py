"""Verdicts on URLs: host and path rules first, then patterns found through their rarest token.

Every pattern rule names the literal tokens that each URL it fits must contain. The rule is filed under the
one that is rarest in the table. A URL's own tokens fetch the rules filed under them, and only those run
their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class HostRule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class PatternRule(NamedTuple):
    pattern: str  # searched in the URL with A-Z lower-cased
    tokens: tuple[str, ...]  # runs of a-z, 0-9 that every fitting URL contains as whole runs
    verdict: str


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)

#: Whole words of a host name that tell advertising, gambling, drug, adult and spam hosts.
BAD_HOST_WORDS = ("ad", "adserver", "ads", "adult", "bets", "betting", "casino", "escorts", "gambling", "phishing", "pills",
                  "poker", "porn", "spam", "viagra", "warez", "xxx")

#: Of these, words that count only as a host's first label or behind ``www.``: ad-hoc.org and the country .ad are ordinary.
FIRST_LABELS = ("ad",)


def _host_word(word: str) -> PatternRule:
    """Blocks hosts with the word between dots, hyphens or other marks; user names and ports are no part of it."""
    named = (rf"(www[.])?{word}([.:][^/?#@]*)?" if word in FIRST_LABELS
             else rf"([^/?#@]*[^a-z0-9/?#@])?{word}([^a-z0-9/?#@][^/?#@]*)?")
    return PatternRule(rf"^[^:/?#]*://([^/?#]*@)?{named}([/?#]|$)", (word,), "block")


PATTERN_RULES = (
    *map(_host_word, BAD_HOST_WORDS),
    PatternRule(r"/(wp-)?login([./?#]|$)", ("login",), "block"),
    PatternRule(r"/wp-admin/", ("wp", "admin"), "block"),
    PatternRule(r"[?&]sessionid=", ("sessionid",), "block"),
    PatternRule(r"/(go|out|away|redirect)([.][a-z]+)?/?[?]([^#]*&)?ref=", ("ref",), "block"),
    PatternRule(r"/blog/([^?#]*/)?(trackback|comment-page-[0-9]+)([/?#]|$)", ("blog",), "block"),
    PatternRule(r"/checkout/cart([/?#]|$)", ("checkout", "cart"), "block"),
    PatternRule(r"/tag/[^/?#]+/feed([/?#]|$)", ("tag", "feed"), "block"),
    PatternRule(r"[.](exe|apk)[?]download=1", ("download",), "block"),
    PatternRule(r"/docs/[a-z]+/page=[0-9]+", ("docs", "page"), "allow"),
)

#: Pattern rules travel with every task.
MOST_RULES = 1_000_000

_TOKEN = re.compile("[a-z0-9]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


class HostIndex:
    """Rules by host; a URL asks for its host and every parent domain."""

    def __init__(self, rules: Iterable[HostRule]):
        self.rules: dict[str, list[HostRule]] = {}
        for r in rules:
            self.rules.setdefault(r.host, []).append(r)

    def find(self, host: str, path: str) -> HostRule | None:
        best, rest = None, host
        while rest:
            for r in self.rules.get(rest, ()):
                if path.startswith(r.path) and (best is None or (len(r.name), r.name) > (len(best.name), best.name)):
                    best = r
            _, _, rest = rest.partition(".")
        return best


class PatternIndex:
    def __init__(self, rules: Iterable[PatternRule], counts: dict[str, int]):
        self.rules: dict[str, list[tuple[str, str]]] = {}
        for r in rules:
            rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
            self.rules.setdefault(rarest, []).append((r.pattern, r.verdict))
        self.compiled: dict[str, re.Pattern] = {}
        self.runs = 0

    def _fits(self, pattern: str, url: str) -> bool:
        """Patterns are compiled when first fetched: a task meets few of many rules."""
        self.runs += 1
        found = self.compiled.get(pattern)
        if found is None:
            found = self.compiled[pattern] = re.compile(pattern)
        return found.search(url) is not None

    def verdict(self, url: str) -> str:
        """Any fitting allow rule wins over block rules; without a fitting rule a URL is allowed."""
        url = url.translate(_TO_LOWER)
        blocked = False
        for token in self.rules.keys() & set(_TOKEN.findall(url)):
            for pattern, verdict in self.rules[token]:
                if not (blocked and verdict == "block") and self._fits(pattern, url):
                    if verdict == "allow":
                        return verdict
                    blocked = True
        return "block" if blocked else "allow"


def rules_from(table: DataFrame) -> list[PatternRule]:
    """Pattern rules of a table (pattern string, tokens array<string>, verdict string), in the order of their patterns.

    The list is what every task of ``judge_urls`` takes along, so it must hold fewer than ``MOST_RULES``. Rows
    with a null, without tokens or with a verdict other than allow and block are errors, not skipped.
    """
    rows = table.select("pattern", "tokens", "verdict").orderBy("pattern", "verdict").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} pattern rules")
    bad = [r for r in rows if r.pattern is None or not r.tokens or None in r.tokens or r.verdict not in ("allow", "block")]
    if bad:
        raise ValueError(f"not a rule: {bad[0]}")
    return [PatternRule(r.pattern, tuple(r.tokens), r.verdict) for r in rows]


def _judge(host_rules, pattern_rules, counts):
    def run(batches):
        hosts, patterns = HostIndex(host_rules), PatternIndex(pattern_rules, counts)
        for batch in batches:
            rules, verdicts = [], []
            for url, host, path in zip(*(batch.column(c).to_pylist() for c in ("url", "host", "path"))):
                rule = hosts.find(host, path)
                rules.append(rule and rule.name)
                verdicts.append(rule.verdict if rule else patterns.verdict(url))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("host"), batch.column("path"),
                 pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return run


def judge_urls(pages: DataFrame, host_rules: Iterable[HostRule] = HOST_RULES,
               pattern_rules: Iterable[PatternRule] = PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    Needs page_id and url; other columns are not read. Of the host rules that fit, the longest decides, the
    last by name among equals; else the patterns do, and rule is null. A null URL or one without ``://`` has an
    empty host and path and is allowed unless a pattern fits. Repeated rows and null ids stay. No rules:
    everything is allowed. An empty table gives an empty result.

    Scale: a first pass counts only the tokens that rules name, summed per task; the second judges rows
    without a shuffle. The rules are the caller's list and travel with the task.
    """
    host_rules, pattern_rules = list(host_rules), list(pattern_rules)
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    named = sorted({t for r in pattern_rules for t in r.tokens})
    tokens = rows.select(F.explode(F.array_intersect(
        F.split(F.translate("url", _UPPER, _LOWER), "[^a-z0-9]+"), F.lit(named) if named else F.array().cast("array<string>")
    )).alias("token"))
    counts = {r["token"]: r["count"] for r in tokens.groupBy("token").count().collect()}
    return rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).mapInArrow(
        _judge(host_rules, pattern_rules, counts), "page_id long, host string, path string, rule string, verdict string"
    )


def _sql() -> str:
    fits = lambda verdict: " OR ".join(f"regexp_matches(low, '{r.pattern}')" for r in PATTERN_RULES if r.verdict == verdict)
    return rf"""
WITH parts AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url,
         translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
split AS (
  SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
matched AS (
  SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM split, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rid
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN {fits("allow")} THEN 'allow' WHEN {fits("block")} THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN matched USING (rid)
"""


ORACLE_SQL = _sql()
