import re
from urllib.parse import urlsplit

import duckdb
from helpers import SF

from vitrine.llm.queries import ORACLES
from vitrine.llm.url_filters import ALLOW, BLOCK, PATTERNS, RULES, SITES, Rule, addressed, filed, judged, site_rule, token_counts, tokens_of, url_filter

PAGE = "page_id bigint, url string, html string, host string, rule string, kept string"

URLS = [
    None, "", "no scheme here", "http://", "https://Example.ORG/es/x", "https://example.org/es", "https://a.b.example.org/en/17?q=/es/", "http://example.org/en/2",
    "http://notexample.org/es/1", "http://org", "http://org/", "http://x.com/fr/", "http://x.com/FR/", "http://com/de/1#/fr/", "http://x.com:80/de/", "http://user@x.com/de/y",
    "https://casino-win.example.net/en/1", "https://casinos.net", "http://mycasino.net/", "http://shop.net/a/Login/", "http://shop.net/login?x", "http://shop.net/a/blogin",
    "http://cdn.net/x.EXE", "http://cdn.net/x.exe?y", "http://cdn.net/exe", "http://10.0.0.1:8080/x", "http://xn--p1ai.net/", "http://a.net" + "/b" * 30, "http://a.net/" + "w" * 50_000 + "/cart/",
    "http://a.net/c/ü/tag/ß", "http://a.net/\n/cart/", "x://y://z/w", "HTTP://ADULT.NET/%20", "http://example.org/en/1", "http://sub.com/de/login", "http://porn.com/fr/1",
]


def want(url):
    """Every rule on every address, the site rules without a pattern."""
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in SITES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        _, rule, verdict = max(fit)
        return host, path, rule, verdict, None
    hit = next((r for r in PATTERNS if re.search(r.pattern.replace(r"\z", r"\Z"), host + path)), None)
    return host, path, None, hit.verdict if hit else ALLOW, hit.name if hit else None


def test_against_every_rule_on_every_address(spark):
    rows = [(i, u, None, "h", "r", "k") for i, u in enumerate(URLS)] + [(None, None, None, None, None, None), (3, URLS[4], "x", "", "", ""), (3, URLS[4], "x", "", "", "")]
    got = url_filter(spark.createDataFrame(rows, PAGE)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *want(u)) for i, u, *_ in rows), key=key)
    by_url = {u: want(u) for u in URLS}
    assert by_url["https://Example.ORG/es/x"][2:4] == ("example.org/es/", BLOCK) and by_url["http://example.org/en/2"][2:4] == ("org/", ALLOW)
    assert by_url["http://org"][2] is None and by_url["http://x.com/FR/"][2] is None


def test_the_table_and_a_plain_parser(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in table.select("page_id", "url").collect()}
    got = {r["page_id"]: r for r in url_filter(table).collect()}
    assert set(got) == set(urls)
    for k, u in urls.items():
        assert (got[k]["host"], got[k]["path"]) == (urlsplit(u).netloc.lower(), urlsplit(u).path)
        assert tuple(got[k])[1:] == want(u)


def test_sql_on_hard_addresses(spark):
    rows = [(i, u) for i, u in enumerate(URLS)]
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    out = db.execute(ORACLES["op11_url_filter"])
    names = [c[0] for c in out.description]
    expected = sorted((dict(zip(names, r, strict=True)) for r in out.fetchall()), key=lambda r: r["page_id"])
    got = sorted((r.asDict() for r in url_filter(spark.createDataFrame(rows, "page_id bigint, url string")).collect()), key=lambda r: r["page_id"])
    assert got == expected


def test_tokens_stand_whole_in_every_match():
    assert site_rule("example.org", "/en/1", BLOCK).tokens == ("example", "org", "en")
    for u in URLS:
        host, path, *_ = want(u)
        for r in RULES:
            if re.search(r.pattern.replace(r"\z", r"\Z"), host + path):
                assert set(r.tokens) <= set(tokens_of(host + path)), (r, u)


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://common.net/{'rare' if i == 0 else 'often'}/x") for i in range(9)], "page_id bigint, url string")
    rules = (Rule("a", BLOCK, "^common[.]net/rare/", ("common", "net", "rare")), Rule("b", BLOCK, "^common[.]net/", ("common", "net")), Rule("c", ALLOW, "x", ()))
    counts = {r["token"]: r["n"] for r in token_counts(addressed(pages, ["page_id"]), rules).collect()}
    assert counts == {"common": 9, "net": 9, "rare": 1}
    assert filed(rules, counts) == {"rare": [0], "common": [1], "": [2]}
    got = {r["kept"]["page_id"]: r["n_candidates"] for r in judged(pages, ["page_id"], rules).collect()}
    assert got == {0: 3, **{i: 2 for i in range(1, 9)}}


def test_many_rules_and_ties(spark):
    rules = (*(site_rule(f"h{i}.net", "/", BLOCK) for i in range(3000)), site_rule("h7.net", "/", ALLOW))
    pages = spark.createDataFrame([(i, f"http://w.h{i}.net/x") for i in range(0, 4000, 7)], "page_id bigint, url string")
    got = {r["kept"]["page_id"]: (r["rule"], r["verdict"], r["n_candidates"]) for r in judged(pages, ["page_id"], rules).collect()}
    assert all(got[i] == ((f"h{i}.net/", BLOCK, 1 + (i == 7)) if i < 3000 else (None, ALLOW, 0)) for i in range(0, 4000, 7))


def test_empty_tables_and_no_rules(spark):
    nothing = spark.createDataFrame([], PAGE)
    assert url_filter(nothing).count() == 0
    got = judged(spark.createDataFrame([(1, "http://x.com/de/")], "page_id bigint, url string"), ["page_id"], ()).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [(None, ALLOW)]


def test_no_python_and_no_shuffle(spark):
    plan = url_filter(spark.read.parquet(f"{SF}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan and "html" not in plan
