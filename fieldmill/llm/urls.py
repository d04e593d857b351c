"""URL filters: allow and block rules by host and path, and pattern rules that are indexed by a token.

A pattern rule names the literal tokens that any URL it matches must hold. It is indexed under the one of them
that is rarest in the URLs at hand, so a URL's tokens fetch few candidate rules, and only those run their
regular expression. The rules are parameters; the index goes into the query as a literal, so it is refused
beyond ``MOST_RULES`` rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES = 10_000
_SEPARATORS = "[^a-z0-9]+"


@dataclass(frozen=True)
class HostRule:
    """Decides a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs that match ``pattern``; each of ``tokens`` is a word of every URL that does.

    Where no single word is in all of them, ``one_of`` names words of which every such URL holds one at least.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    one_of: tuple[str, ...] = ()


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)
PATTERN_RULES = (
    PatternRule("pills", r"(?i)://[^/?#]*\bcheap[-.]pills\b", ("cheap", "pills")),
    PatternRule("pharmacy", r"(?i)\b(?:online|cheap)[-.]?pharmacy\b", (), ("pharmacy", "onlinepharmacy", "cheappharmacy")),
    PatternRule("spam farm", r"(?i)://[^/?#]*\bspam[-.]farm\b", ("spam", "farm")),
    PatternRule("casino", r"(?i)://[^/?#]*\bcasino\b", ("casino",)),
    PatternRule("poker", r"(?i)\bpoker[-./]", ("poker",)),
    PatternRule("adult", r"(?i)://[^/?#]*\b(?:xxx|porn)\b", (), ("xxx", "porn")),
    PatternRule("malware", r"(?i)\bmalware[-.](?:download|host)\b", ("malware",)),
    PatternRule("warez", r"(?i)\bwarez\b", ("warez",)),
    PatternRule("tracker", r"(?i)[?&]click_?id=[0-9a-f]{16,}", (), ("click", "clickid")),
    PatternRule("session link", r"(?i)[?&;]jsessionid=[0-9a-f]{8,}", ("jsessionid",)),
)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``.

    The host ends before ``/``, ``?`` or ``#`` and has A-Z lower-cased; the path ends before ``?`` or ``#``.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    known = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(known, "://") > 0, F.substring(known, F.instr(known, "://") + 3, F.length(known))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, upper.lower()), path


def host_rule(host: Column, path: Column, rules: tuple[HostRule, ...] = HOST_RULES) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null."""
    return F.coalesce(*[_fits(host, path, rule) for rule in sorted(rules, key=lambda r: (-len(r.name), r.name))])


def _fits(host: Column, path: Column, rule: HostRule) -> Column:
    inside = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
    return F.when(
        inside & F.startswith(path, F.lit(rule.path)), F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
    )


def url_tokens(url: Column) -> Column:
    """The distinct lower-case words of a URL."""
    return F.array_distinct(F.split(F.lower(F.coalesce(url, F.lit(""))), _SEPARATORS))


def token_index(pages: DataFrame, rules: tuple[PatternRule, ...], url_col: str = "url") -> dict[str, list[PatternRule]]:
    """Each rule under its token that the fewest URLs hold, or under every one of ``one_of``. A rule with neither is tried on all URLs.

    Ties go to the first in alphabetical order. One count over all URLs, of the rules' own tokens only.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} pattern rules")
    wanted = sorted({token for rule in rules for token in rule.tokens})
    held = pages.select(F.explode(F.array_intersect(url_tokens(pages[url_col]), F.lit(wanted))).alias("token"))
    counts = {row["token"]: row["count"] for row in held.groupBy("token").count().collect()} if wanted else {}
    index: dict[str, list[PatternRule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda token: (counts.get(token, 0), token), default="")
        for token in rule.one_of if rule.one_of and not rule.tokens else (rarest,):
            index.setdefault(token, []).append(rule)
    return index


def _pattern_hits(url: Column, index: dict[str, list[PatternRule]]) -> Column:
    """Names of the pattern rules that match, among those whose token the URL holds."""
    if not index:
        return F.array().cast("array<string>")
    described = lambda rules: F.array(*[F.struct(F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern")) for r in rules])
    by_token = F.create_map(*[x for token, rules in sorted(index.items()) for x in (F.lit(token), described(rules))])
    keys = F.array_intersect(F.array_union(url_tokens(url), F.array(F.lit(""))), F.lit(sorted(index)))
    fetched = F.array_distinct(F.flatten(F.transform(keys, lambda token: F.try_element_at(by_token, token))))
    return F.transform(F.filter(fetched, lambda rule: F.regexp_like(F.coalesce(url, F.lit("")), rule["pattern"])), lambda r: r["name"])


def judge_urls(
    pages: DataFrame,
    keep: list[str],
    url_col: str = "url",
    host_rules: tuple[HostRule, ...] = HOST_RULES,
    pattern_rules: tuple[PatternRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """The columns ``keep`` as the struct ``doc`` with ``host``, ``path``, ``rule``, ``patterns`` and ``verdict``.

    The longest fitting host rule decides; without one a URL is blocked if a pattern rule matches, else allowed. A
    null URL, or one without ``://``, has an empty host and path, fits no host rule, and is judged by patterns
    alone. Repeated rows are judged each; columns of ``pages`` may have any names.
    """
    index = token_index(pages, pattern_rules, url_col)
    rows = pages.select(F.struct(*[pages[c] for c in keep]).alias("doc"), pages[url_col].alias("url"))
    host, path = parts(F.col("url"))
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rows = rows.select(
        "*", host_rule(F.col("host"), F.col("path"), host_rules).alias("decided"), _pattern_hits(F.col("url"), index).alias("patterns")
    )
    by_pattern = F.when(F.size("patterns") > 0, "block").otherwise("allow")
    return rows.select(
        "doc",
        "host",
        "path",
        F.col("decided.name").alias("rule"),
        "patterns",
        F.coalesce("decided.verdict", by_pattern).alias("verdict"),
    )
