"""URL filtering by pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path + query``. Every whole token (run of
ASCII letters and digits) that a matching URL must contain is a candidate key;
the rule is filed under the one that the fewest URLs hold. A URL looks up its
own tokens, and only the rules found there run their regular expressions, so
the cost per URL hardly depends on the number of rules. Rules without a whole
token are tried on every URL.

Null URLs and URLs without ``://`` have an empty host and path and fit no rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrow import with_columns

#: The rule set is broadcast, so its size is checked.
MAX_RULES = 1_000_000
ALLOW, BLOCK = "allow", "block"

_TOKEN = re.compile(r"[0-9a-z]+")
_SPLIT = re.compile(r"([^/?#]*)([^?#]*)(.*)", re.S)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in the target; ``tokens`` are whole tokens that every match contains."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...] = field(default=())
    #: 1 for rules that name a site, which go before general patterns (0)
    priority: int = 1


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for ``host`` with all its subdomains and every path that starts with ``path``."""
    if not path.startswith("/"):
        raise ValueError(f"the path of a site rule starts with '/': {path!r}")
    whole = _TOKEN.findall(host.translate(_LOWER)) + _TOKEN.findall(re.sub(r"[0-9A-Za-z]+\Z", "", path).lower())
    return Rule(host + path, verdict, rf"\A(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}", tuple(whole))


def wildcard_rule(verdict: str, text: str) -> Rule:
    """A general pattern: ``*`` is any run of characters, ``^`` a character other than a letter, digit, ``_ - . %``, or the end."""
    parts = {"*": ".*", "^": r"(?:[^0-9A-Za-z_.%-]|\Z)"}
    pattern = "".join(parts.get(c) or re.escape(c) for c in text)
    whole = [m.group().lower() for m in re.finditer("[0-9A-Za-z]+", text)
             if m.start() > 0 and text[m.start() - 1] != "*" and m.end() < len(text) and text[m.end()] != "*"]
    return Rule(text, verdict, pattern, tuple(whole), 0)


#: Site rules of the check query.
SITE_RULES = (
    site_rule(ALLOW, "org", "/"),
    site_rule(BLOCK, "example.org", "/es/"),
    site_rule(BLOCK, "example.org", "/en/1"),
    site_rule(ALLOW, "com", "/fr/"),
    site_rule(BLOCK, "com", "/de/"),
)
#: General patterns: pages that hold no prose.
PAGE_RULES = tuple(wildcard_rule(BLOCK, text) for text in (
    "/ads^", "/banner^", "/cgi-bin/", "/login^", "/signup^", "/cart^", "/checkout^", "/wp-admin/", "/search^",
    "?sessionid=", "&sessionid=", "/rss^*.xml^", ".exe^", ".zip^", "^ref=x^",
))


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host in lower case, path, rest from ``?`` or ``#`` on)."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    host, path, tail = _SPLIT.match(rest).groups()
    return host.translate(_LOWER), path, tail


def token_frequencies(df: DataFrame, rules: tuple[Rule, ...], url_col: str = "url") -> dict[str, int]:
    """How many URLs hold each token that some rule may be filed under; one row per such token comes back."""
    wanted = sorted({t for r in rules for t in r.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url_col)), F.lit("([0-9a-z]+)"), F.lit(1)))
    found = F.array_intersect(tokens, F.lit(wanted)) if wanted else F.array().cast("array<string>")
    counts = df.select(F.explode(found).alias("token")).groupBy("token").count()
    return {r["token"]: r["count"] for r in counts.collect()}


class RuleIndex:
    """Rules filed under their rarest token; compiled when first used."""

    def __init__(self, rules: tuple[Rule, ...], frequency: dict[str, int]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules exceed {MAX_RULES}")
        self.filed: dict[str, list[Rule]] = {}
        self.always: list[Rule] = []
        for rule in rules:
            if rule.tokens:
                key = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t))
                self.filed.setdefault(key, []).append(rule)
            else:
                self.always.append(rule)
        self.compiled: dict[str, re.Pattern] = {}

    def best(self, target: str) -> Rule | None:
        """The rule that decides: site rules before general ones, then the longest, then the first by name."""
        filed = self.filed
        some = [r for t in set(_TOKEN.findall(target.translate(_LOWER))) if t in filed for r in filed[t]]
        hits = [r for r in [*some, *self.always] if self._fits(r, target)]
        return min(hits, key=lambda r: (-r.priority, -len(r.name), r.name)) if hits else None

    def _fits(self, rule: Rule, target: str) -> bool:
        pattern = self.compiled.get(rule.pattern)
        if pattern is None:
            pattern = self.compiled[rule.pattern] = re.compile(rule.pattern, re.S)
        return pattern.search(target) is not None


def judge(df: DataFrame, site_rules: tuple[Rule, ...] = SITE_RULES, page_rules: tuple[Rule, ...] = PAGE_RULES,
          default: str = ALLOW, url_col: str = "url", carry: list[str] | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``pattern`` and ``verdict`` of each URL.

    ``rule`` names the longest fitting site rule, else null; ``pattern`` the general pattern that decided where
    no site rule fits, else null; ``verdict`` is that rule's, else ``default``. Columns of these names give way
    to the results. Two passes over the URL column (token frequencies, then rules), no shuffle of rows. Every row is
    judged by its own URL alone, so repeated rows get equal verdicts; an empty table has none. Letters A-Z are folded,
    in the lookup as in the rules, and no others.
    """
    rules = (*site_rules, *page_rules)
    index = df.sparkSession.sparkContext.broadcast(RuleIndex(rules, token_frequencies(df, rules, url_col)))

    def compute(urls):
        best, out = index.value.best, {"host": [], "path": [], "rule": [], "pattern": [], "verdict": []}
        for url in urls:
            host, path, tail = split_url(url)
            rule = best(host + path + tail) if host else None
            out["host"].append(host)
            out["path"].append(path)
            out["rule"].append(rule.name if rule and rule.priority else None)
            out["pattern"].append(rule.name if rule and not rule.priority else None)
            out["verdict"].append(rule.verdict if rule else default)
        return out

    return with_columns(df, [url_col], carry, "host string, path string, rule string, pattern string, verdict string",
                        compute)


def judge_sql(table: str = "pages") -> str:
    """DuckDB SQL for :func:`judge` with the default rules: every rule against every URL, site rules as plain strings."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def site(rule: Rule) -> str:
        host, path = rule.name.split("/", 1)
        return (f"(host = {quoted(host)} OR ends_with(host, {quoted('.' + host)})) AND starts_with(path, {quoted('/' + path)})")

    def page(rule: Rule) -> str:
        return f"regexp_matches(target, {quoted(rule.pattern.replace(chr(92) + 'Z', chr(92) + 'z'))}, 's')"

    def cases(rules, test, value):
        ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
        return " ".join(f"WHEN {test(r)} THEN {quoted(value(r))}" for r in ordered)

    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM {table}),
parts AS (
  SELECT page_id, rest,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
aimed AS (SELECT *, host || substr(rest, length(host) + 1) AS target FROM parts)
SELECT page_id, host, path,
       CASE WHEN host = '' THEN NULL {cases(SITE_RULES, site, lambda r: r.name)} END AS rule,
       nullif(CASE WHEN host = '' THEN NULL {cases(SITE_RULES, site, lambda r: '')}
                   {cases(PAGE_RULES, page, lambda r: r.name)} END, '') AS pattern,
       CASE WHEN host = '' THEN 'allow' {cases(SITE_RULES, site, lambda r: r.verdict)}
            {cases(PAGE_RULES, page, lambda r: r.verdict)} ELSE 'allow' END AS verdict
FROM aimed"""
