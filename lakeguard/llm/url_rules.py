"""URL filter rules indexed by their rarest literal token.

A rule is a regular expression over ``://host/path?query`` with the
literal tokens every match must contain.  Token counts over all URLs choose
the rarest of them as the rule's index key; a URL then fetches only the rules
filed under its own tokens (and the few rules without one) and runs nothing
but their expressions.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and matches no rule; repeated rows and equal page ids are judged one by one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeguard.llm.common import map_texts, small_batches

TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    regex: str
    literals: tuple[str, ...]   # whole tokens that any matching URL contains
    rank: int                   # the fitting rule with the highest (tier, rank) wins
    tier: int = 0


def host_path_rule(verdict: str, name: str) -> Rule:
    """Rule ``host/path``: fits the host and its subdomains where the path starts with the rule's.

    Longer rules outrank shorter ones.
    """
    host, _, path = name.partition("/")
    path = "/" + path
    # The last token of the path may go on in the URL, so only tokens that end inside the rule count.
    whole = TOKEN.findall(host.lower()) + [m[0] for m in TOKEN.finditer(path.lower()) if m.end() < len(path)]
    regex = rf"^://(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(name, verdict, regex, tuple(dict.fromkeys(whole)), len(name), 1)


# The host and path rules of the query.
HOST_RULES = (
    host_path_rule("allow", "com/"),
    host_path_rule("block", "example.com/en/"),
    host_path_rule("allow", "www.example.com/en/"),
    host_path_rule("block", "net/es/"),
    host_path_rule("block", "net/fr/"),
)
# Pattern rules, for URLs that no host rule fits.
PATTERN_RULES = (
    Rule("tracking-feed", "block", r"[?&]utm_source=feed(?:&|#|$)", ("utm", "source", "feed"), 3),
    Rule("referral", "block", r"[?&]ref=[^&#]*", ("ref",), 2),
    # Alternatives are rules of their own, so that each is filed under its token.
    *(Rule("adult-path", "block", f"/{token}/", (token,), 1) for token in ("adult", "xxx")),
    *(Rule("advert", "block", f"/{token}/", (token,), 1) for token in ("ad", "ads")),
)
DEFAULT_VERDICT = "allow"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return re.sub(r"[A-Z]+", lambda m: m[0].lower(), host), slash + path


def token_counts(urls: DataFrame, rules, url: str = "url") -> dict[str, int]:
    """How many URLs hold each token of the rules; no other token reaches the driver."""
    wanted = sorted({t for r in rules for t in r.literals})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit(TOKEN.pattern), 0))
    rows = (urls.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, wanted)))).alias("t"))
            .groupBy("t").count().collect())
    return {t: 0 for t in wanted} | {r["t"]: r["count"] for r in rows}


def build_index(rules, counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest literal token; those without one under ``""``."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        key = min(rule.literals, key=lambda t: (counts.get(t, 0), t)) if rule.literals else ""
        index.setdefault(key, []).append(rule)
    return index


def judge(urls: DataFrame, keep: list[str], rules=HOST_RULES + PATTERN_RULES, url: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """Columns ``keep`` with host, path, the winning host rule and pattern, the verdict and how many rules ran.

    The index holds the rules alone and travels with the task code.
    """
    small_batches(urls.sparkSession)
    index = build_index(rules, token_counts(urls, rules, url))
    compiled = {k: [(r, re.compile(r.regex)) for r in v] for k, v in index.items()}

    def one(value):
        host, path = split_url(value)
        if not host and not path:
            return host, path, None, None, default, 0
        text = f"://{host}{value.split('://', 1)[1][len(host):]}"
        found = list(compiled.get("", ()))
        for token in dict.fromkeys(TOKEN.findall(text.lower())):
            found += compiled.get(token, ())
        fit = [r for r, regex in found if regex.search(text)]
        best = max(fit, key=lambda r: (r.tier, r.rank, r.name), default=None)
        return (host, path, best.name if best and best.tier else None,
                best.name if best and not best.tier else None, best.verdict if best else default, len(found))

    names = ["host", "path", "rule", "pattern", "verdict", "n_rules_run"]
    types = [pa.string()] * 5 + [pa.int64()]

    def fn(values):
        return dict(zip(names, map(list, zip(*map(one, values)))))

    return map_texts(urls, keep, fn, dict(zip(names, types)),
                     "host string, path string, rule string, pattern string, verdict string, n_rules_run long", text=url)
