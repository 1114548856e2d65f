"""URL filters: pattern rules found through their rarest literal token.

Every rule has literal tokens (runs of a-z and 0-9) that stand whole in each address it matches. Their
frequency is counted over the addresses of the table, and a rule is filed under its rarest one; a rule without a
literal token is filed under the empty token. The tokens of an address fetch the rules filed under them, and
only these run their regular expressions.

Site rules (host and path) judge first, the longest one wins. Where none fits, the pattern rules judge, the first in
order wins; where none matches, the address is allowed.

The index is a hash table inside the plan: an array of buckets by the token's hash, so a lookup costs the same
for ten rules and for thousands, and addresses are neither exploded nor shuffled. The rules are the caller's
list, so their size is known on the driver; the only thing collected is one count per literal token.

Everything is DataFrame and SQL. Cases: a null address or one without ``://`` has an empty host and path, no rule and
the verdict of an empty address. Repeated rows are judged each. Ties between site rules of one length go to the
first in order. Empty tables give no rows. Of further columns, ``judged`` keeps those named, whatever their names.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import LOWER, UPPER
from vitrine.llm.spans import literal

ALLOW, BLOCK = "allow", "block"
#: Host, path and verdict of the site rules.
SITES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK))


class Rule(NamedTuple):
    """``pattern`` runs over host and path; every match holds each of ``tokens`` as a whole token; ``length`` is 0 for pattern rules."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    length: int = 0


def tokens_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", "".join(c.lower() if c.isascii() else c for c in text))


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``; its last token counts only if it ends there."""
    found = tokens_of(host + path)
    whole = found if not (host + path)[-1:].isascii() or not (host + path)[-1:].isalnum() else found[:-1]
    return Rule(host + path, verdict, rf"^(?:[^/]*[.])?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(whole)), len(host + path))


def word_rule(name: str, verdict: str, *words: str) -> list[Rule]:
    """One rule per word of the host: the word stands between dots, hyphens or the host's ends."""
    return [Rule(name, verdict, rf"^(?:[^/]*[.-])?{w}(?:[.:-][^/]*)?(?:/|\z)", (w,)) for w in words]


def part_rule(name: str, verdict: str, *parts: str) -> list[Rule]:
    """One rule per part of the path, a whole step between slashes, whatever its case."""
    return [Rule(name, verdict, rf"^[^/]*/(?s:.*/)?(?i:{re.escape(p)})(?:/|\z)", tuple(dict.fromkeys(tokens_of(p)))) for p in parts]


def file_rule(name: str, verdict: str, *endings: str) -> list[Rule]:
    return [Rule(name, verdict, rf"^[^/]*/(?s:.*)[.](?i:{e})\z", (e,)) for e in endings]


#: Hand-written pattern rules in order of priority.
PATTERNS = (
    *word_rule("gambling", BLOCK, "casino", "casinos", "poker", "roulette", "slots", "betting", "bets", "jackpot", "lottery", "bingo"),
    *word_rule("adult", BLOCK, "adult", "adults", "porn", "xxx", "sex", "nsfw", "escort", "escorts", "camgirls", "hentai"),
    *word_rule("pharmacy", BLOCK, "viagra", "cialis", "pills", "rx"),
    *word_rule("advertising", BLOCK, "ads", "adserver", "adservice", "doubleclick", "banner", "banners", "popunder", "affiliate", "affiliates"),
    *word_rule("tracking", BLOCK, "track", "tracker", "tracking", "telemetry", "analytics", "beacon", "pixel", "metrics"),
    *word_rule("malware", BLOCK, "malware", "phishing", "warez", "crack", "keygen", "torrents"),
    *word_rule("shorteners", BLOCK, "tinyurl", "bitly", "adfly"),
    *part_rule("accounts", BLOCK, "login", "log-in", "signin", "sign-in", "signup", "sign-up", "register", "logout", "my-account", "password-reset"),
    *part_rule("shopping", BLOCK, "cart", "basket", "checkout", "wishlist", "add-to-cart"),
    *part_rule("machinery", BLOCK, "wp-admin", "wp-login.php", "xmlrpc.php", "cgi-bin", "phpmyadmin", ".git", ".env", "feed", "rss", "trackback"),
    *part_rule("searches", BLOCK, "search", "tag", "tags", "archive", "calendar", "print"),
    *file_rule("binaries", BLOCK, "exe", "msi", "dmg", "apk", "zip", "rar", "7z", "gz", "iso", "jar", "bin"),
    *file_rule("media", BLOCK, "jpg", "jpeg", "png", "gif", "webp", "svg", "mp3", "mp4", "avi", "mov", "wav"),
    *file_rule("assets", BLOCK, "css", "js", "woff", "woff2", "ico", "map"),
    Rule("numeric host", BLOCK, r"^[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?::[0-9]+)?(?:/|\z)", ()),
    Rule("encoded host", BLOCK, r"^(?:[^/]*[.])?xn--", ("xn",)),
    Rule("endless path", BLOCK, r"^[^/]*(?:/[^/]*){25}", ()),
)
RULES = (*(site_rule(*s) for s in SITES), *PATTERNS)

ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TOKENS = f"array_distinct(concat(split(translate(concat(host, path), '{UPPER}', '{LOWER}'), '[^a-z0-9]+'), array('')))"


def addressed(pages: DataFrame, keep: list[str], url: str = "url") -> DataFrame:
    """kept, host (A-Z lowered) and path of every address."""
    raw = pages.select(F.struct(*keep).alias("kept"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    return raw.selectExpr("kept", f"translate(regexp_extract(url, {literal(ADDRESS)}, 1), '{UPPER}', '{LOWER}') as host", f"regexp_extract(url, {literal(ADDRESS)}, 2) as path")


def token_counts(addresses: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(token, n): how many addresses hold each literal token of the rules; every such token has a row."""
    every = sorted({t for r in rules for t in r.tokens})
    if not every:
        return addresses.sparkSession.createDataFrame([], "token string, n bigint")
    listed = f"array({', '.join(map(literal, every))})"
    counted = addresses.selectExpr(f"explode(array_intersect({TOKENS}, {listed})) as token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    blank = addresses.sparkSession.sql(f"select explode({listed}) as token, 0L as n")
    return counted.unionByName(blank).groupBy("token").agg(F.sum("n").alias("n"))


def filed(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by the token that a rule is filed under: its rarest, of equally rare ones the smallest."""
    out: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        out.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(i)
    return out


ENTRY = "array<struct<token: string, rules: array<struct<rank: int, length: int, name: string, verdict: string, pattern: string>>>>"


def index_of(addresses: DataFrame, rules: tuple[Rule, ...]) -> tuple[str, int]:
    """SQL of the bucket array and its size; the counts of the literal tokens come to the driver, one row each."""
    by_token = filed(rules, {r["token"]: r["n"] for r in token_counts(addresses, rules).collect()})
    size = max(1, 2 * len(by_token))
    buckets: list[list[str]] = [[] for _ in range(size)]
    names = sorted(by_token)
    if names:
        places = addresses.sparkSession.sql(f"select t, pmod(xxhash64(t), {size}) as b from (select explode(array({', '.join(map(literal, names))})) as t)").collect()
        for place in places:
            held = ", ".join(
                f"named_struct('rank', {i}, 'length', {rules[i].length}, 'name', {literal(rules[i].name)}, 'verdict', '{rules[i].verdict}', 'pattern', {literal(rules[i].pattern)})"
                for i in by_token[place["t"]]
            )
            buckets[place["b"]].append(f"named_struct('token', {literal(place['t'])}, 'rules', array({held}))")
    return "array(" + ", ".join(f"cast(array({', '.join(b)}) as {ENTRY})" for b in buckets) + ")", size


def judged(pages: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """kept, host, path, rule (the site rule), pattern (name of the pattern rule), verdict and n_candidates of every address."""
    addresses = addressed(pages, keep, url)
    table, size = index_of(addresses, rules)
    fetched = addresses.selectExpr(
        "kept", "host", "path",
        f"flatten(flatten(transform({TOKENS}, t -> transform(filter(({table})[cast(pmod(xxhash64(t), {size}) as int)], e -> e.token = t), e -> e.rules)))) as candidates",
    )
    matched = fetched.selectExpr("kept", "host", "path", "size(candidates) as n_candidates", "filter(candidates, r -> concat(host, path) rlike r.pattern) as hits")
    site = "array_max(transform(filter(hits, r -> r.length > 0), r -> named_struct('length', r.length, 'turn', -r.rank, 'name', r.name, 'verdict', r.verdict)))"
    shape = "array_min(transform(filter(hits, r -> r.length = 0), r -> named_struct('rank', r.rank, 'name', r.name, 'verdict', r.verdict)))"
    chosen = matched.selectExpr("kept", "host", "path", "n_candidates", f"{site} as site", f"{shape} as shape")
    return chosen.selectExpr(
        "kept", "host", "path", "site.name as rule", "if(site is null, shape.name, null) as pattern",
        f"coalesce(site.verdict, shape.verdict, '{ALLOW}') as verdict", "n_candidates",
    )


def url_filter(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and pattern of every page."""
    return judged(pages, ["page_id"]).selectExpr("kept.page_id as page_id", "host", "path", "rule", "verdict", "pattern")


def url_filter_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in plain SQL: every rule runs on every address."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {r.length}, {quoted(r.name)}, '{r.verdict}', {quoted(r.pattern)})" for i, r in enumerate(rules))
    address = quoted(ADDRESS)
    return f"""WITH r(rank, length, name, verdict, pattern) AS (VALUES {rows}),
        a AS (SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(coalesce(url, ''), {address}, 1), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(coalesce(url, ''), {address}, 2) AS path FROM pages),
        h AS (SELECT k, rank, length, name, verdict FROM a, r WHERE regexp_matches(host || path, pattern)),
        s AS (SELECT k, arg_max(name, length * 1000 - rank) AS rule, arg_max(verdict, length * 1000 - rank) AS verdict FROM h WHERE length > 0 GROUP BY k),
        p AS (SELECT k, arg_min(name, rank) AS pattern, arg_min(verdict, rank) AS verdict FROM h WHERE length = 0 GROUP BY k)
        SELECT page_id, host, path, rule, coalesce(s.verdict, p.verdict, '{ALLOW}') AS verdict, CASE WHEN rule IS NULL THEN pattern END AS pattern
        FROM a LEFT JOIN s USING (k) LEFT JOIN p USING (k)"""
