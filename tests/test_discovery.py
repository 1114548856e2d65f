"""Discovery over stored bodies, exports, and page files."""

import pytest

from vitrine import fixed
from vitrine.operators import discovery, export
from vitrine.operators.skus import unique_skus
from vitrine.plans import jobs
from vitrine.schemas import PAGES, PRODUCT_ROW, Shop
from vitrine.sources.pages import read_html_files, read_raw_csv

SHOP = Shop("https://shop.example/")
B = "https://shop.example/"


def ordered(urls):
    return [r.url for r in urls.orderBy("position").collect()]


def locs(*values):
    return "<urlset>" + "".join(f"<url><loc> {v} </loc></url>" for v in values) + "</urlset>"


def test_sitemaps(spark):
    bodies = spark.createDataFrame(
        [
            (B + "s.xml", locs(B + "product-sitemap2.xml", B + "a/", B + "product_cat-product-sitemap.xml", B + "s.xml", B + "post-sitemap.xml")),
            (B + "product-sitemap2.xml", locs(B + "b/", B + "a/", B + "cat/x/", "https://other.org/c/", "<![CDATA[" + B + "d/]]>") + "<loc>broken"),
            (B + "post-sitemap.xml", locs(B + "post/")),
            (B + "product_cat-product-sitemap.xml", locs(B + "no/")),
        ],
        "url string, body string",
    )
    assert ordered(discovery.sitemap_urls(bodies, [B + "s.xml", B + "none.xml"], SHOP)) == [B + "a/", B + "b/", B + "d/"]


def test_api_stops(spark):
    def links(*pages):
        rows = [(i, s, t, b) for i, s, t, b in pages]
        frame = spark.createDataFrame(rows, "page_no int, status int, total_pages int, body string")
        return ordered(discovery.api_urls(frame, SHOP))

    one, two, three = (f'[{{"link": "{B}{c}/"}}, {{"x": 1}}]' for c in "abc")
    assert links((1, 200, 3, one), (2, 200, 3, two), (3, 200, 3, three)) == [B + "a/", B + "b/", B + "c/"]
    assert links((1, 200, 9, one), (2, 400, 9, two), (3, 200, 9, three)) == [B + "a/"]
    assert links((1, 200, 9, one), (3, 200, 9, three)) == [B + "a/"]
    assert links((1, 200, 1, one), (2, 200, 9, two)) == [B + "a/"]
    assert links((1, 200, 9, "[]"), (2, 200, 9, two)) == [] and links((1, 200, 9, "oops")) == []


def test_crawl_with_cycle_bound_and_fallback(spark):
    def page(name, nxt, *items):
        li = "".join(f'<li class="product"><a href="{i}">x</a></li>' for i in items)
        return (B + f"cat/{name}/", f'<html><body>{li}<a href="/noise/">n</a><a class="next page-numbers" href="{nxt}">→</a>')

    pages = spark.createDataFrame(
        [page("a", "/cat/a2/", "/p1/", "/cart/"), page("a2", "/cat/a/", "/p2/", "/p1/"), page("b", "", "/p3/"),
         page("l0", "/cat/l1/", "/q0/"), page("l1", "/cat/l2/", "/q1/"), page("l2", "/cat/l3/", "/q2/"), page("l3", "", "/q3/")],
        "url string, html string",
    )
    home = spark.createDataFrame([(B, '<a href="/cat/b/">b</a><a href="/x/">x</a><a href="/cat/a/">a</a>')], "url string, html string")
    assert ordered(discovery.home_category_urls(home, pages, SHOP)) == [B + "p3/", B + "p1/", B + "p2/"]
    seeds = spark.createDataFrame([(0, "/cat/l0/")], "seed_ord int, url string")
    assert ordered(discovery.category_urls(seeds, pages, SHOP, bound=3)) == [B + "q0/", B + "q1/", B + "q2/"]
    nothing = spark.createDataFrame([], "url string, body string")
    no_api = spark.createDataFrame([], "page_no int, status int, total_pages int, body string")
    assert ordered(discovery.all_site_urls(nothing, no_api, home, pages, SHOP)) == [B + "p3/", B + "p1/", B + "p2/"]


def test_limit_fetch_and_rejects(spark):
    urls = spark.createDataFrame([("/a/", 3), (B + "b/", 1), (B + "b/", 0), ("", 2)], "url string, position long")
    pages = spark.createDataFrame([(1, B + "b/", "x")], PAGES)
    unique = discovery.unique_urls(urls)
    assert ordered(unique) == [B + "b/", "/a/"] and ordered(discovery.limited(unique, 1)) == [B + "b/"]
    assert [r.url for r in jobs.fetched(unique, pages, SHOP).collect()] == [B + "b/"]
    assert [r.url for r in jobs.not_fetched(unique, pages, SHOP).collect()] == ["/a/"]


def test_exports(spark, tmp_path):
    row = {c: "" for c in PRODUCT_ROW.names} | {
        "seller_sku": "1", "item_name": 'a "b"\nc, d', "item_notes": [f"n{i}" for i in range(7)],
        "images": [f"i{i}" for i in range(12)], "map_price": 2.5, "raw_variation": '{"a": "b"}'}
    rows = spark.createDataFrame([row], PRODUCT_ROW)
    out = export.feed(rows).first().asDict()
    assert out["item_note_6"] == "n5" and "item_note_7" not in out
    assert (out["main_image_url"], out["other_image_url_1"], out["other_image_url_9"]) == ("i0", "i1", "i9")
    assert all(out[c] is None for c in fixed.FEED_EMPTY_COLUMNS) and out["map_price"] == 2.5
    short = export.feed(rows, ["brand", "brand", "item_note", "unknown"]).first().asDict()
    assert short == {"brand_1": "", "brand_2": None, "item_note_1": "n0", "unknown": None}
    export.write_csv(export.raw_export(rows), str(tmp_path / "csv"))
    assert read_raw_csv(spark, str(tmp_path / "csv")).first().asDict() == row
    assert export.write_feed(rows, str(tmp_path / "feed"), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "feed")).count() == 1
    assert not export.write_feed(rows.limit(0), str(tmp_path / "none"))


def test_html_files(spark, tmp_path):
    (tmp_path / "b.html").write_bytes("б�".encode())
    (tmp_path / "a.html").write_bytes(b"x\xffy")
    pages = read_html_files(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [p.html for p in pages] == ["xy", "б�"] and pages[0].url.startswith("file:")
    assert [p.html for p in read_html_files(spark, str(tmp_path), limit=1).collect()] == ["xy"]


def test_whole_and_limited_lists_give_the_same_rows(spark):
    html = '<meta property="og:type" content="product"><meta property="og:image" content="/i{0}.jpg">' \
           '<meta property="product:price:amount" content="{0}"><title>t{0}</title>single-product'
    pages = spark.createDataFrame([(9 - i, f"{B}u{i}/", html.format(i)) for i in range(5)], PAGES)
    urls = spark.createDataFrame([(f"{B}u{i}/", i * 10) for i in (4, 1, 2, 7)], "url string, position long")
    whole = sorted(map(tuple, jobs.discovered_rows(urls, pages, SHOP).collect()))
    picked = sorted(map(tuple, jobs.discovered_rows(urls, pages, SHOP, limit=9).collect()))
    assert whole == picked and [r[0] for r in whole] == [0, 1, 2]  # dense ranks of the addresses
    assert len(jobs.discovered_rows(urls, pages, SHOP, limit=2).collect()) == 2


def test_nothing_is_cut_off(spark):
    """350 pages in a chain, 250 API pages, two index bodies and numbered sitemaps beyond thirty."""
    edges = spark.createDataFrame([(f"u{i}", f"u{i + 1}") for i in range(349)], "url string, next_url string")
    seeds = spark.createDataFrame([(5, "u0")], "seed_ord int, url string")
    met = discovery.page_chains(seeds, edges).collect()
    assert {(r.url, r.depth) for r in met} == {(f"u{i}", i) for i in range(350)}
    assert discovery.page_chains(seeds, edges, bound=9).count() == 9
    round_trip = edges.unionByName(spark.createDataFrame([("u349", "u7")], edges.schema))
    assert discovery.page_chains(seeds, round_trip).count() == 350
    api = spark.createDataFrame([(i, 200, 300, f'[{{"link": "{B}p{i}/"}}]') for i in range(1, 251)], "page_no int, status int, total_pages int, body string")
    assert ordered(discovery.api_urls(api, SHOP)) == [f"{B}p{i}/" for i in range(1, 251)]
    assert len(ordered(discovery.api_urls(api, SHOP, page_bound=199))) == 199
    bodies = spark.createDataFrame(
        [(B + "sitemap_index.xml", locs(B + "product-sitemap-b.xml")), (B + "sitemap_index1.xml", locs(B + "product-sitemap-c.xml")),
         (B + "product-sitemap-b.xml", locs(B + "b/")), (B + "product-sitemap-c.xml", locs(B + "c/")),
         (B + "product-sitemap77.xml", locs(B + "z/")), (B + "product-sitemap2.xml", locs(B + "y/"))],
        "url string, body string",
    )
    nothing = spark.createDataFrame([], "url string, html string")
    found = discovery.all_site_urls(bodies, api, nothing, nothing, SHOP)
    assert ordered(found) == [B + "b/", B + "c/", B + "y/", B + "z/"]
    assert ordered(discovery.all_site_urls(bodies, api, nothing, nothing, SHOP, seeds=[B + "sitemap_index1.xml"])) == [B + "c/"]


def test_one_page_per_address(spark):
    html = '<meta property="og:type" content="product"><meta property="og:image" content="/i.jpg">' \
           '<meta property="product:price:amount" content="1"><title>t</title><span class="sku">a</span>'
    pages = spark.createDataFrame([(1, B + "u/", html), (2, B + "u/", html)], PAGES)
    urls = spark.createDataFrame([(B + "u/", 4)], "url string, position long")
    rows = unique_skus(jobs.discovered_rows(urls, pages, SHOP)).collect()
    assert [(r.url_ord, r.seller_sku) for r in rows] == [(0, "a")]
    with pytest.raises(ValueError):
        twice = jobs.discovered_rows(urls, pages, SHOP)
        unique_skus(twice.unionByName(twice))


def test_rejects_name_their_reason(spark):
    product = '<meta property="og:type" content="product"><title>t</title>'
    pages = spark.createDataFrame([(1, B + "a/", product), (2, B + "b/", "<p>no"), (3, B + "c/", product + '<meta property="og:image" content="/i.jpg"><meta property="product:price:amount" content="1">')], PAGES)
    urls = spark.createDataFrame([(B + f"{c}/", i) for i, c in enumerate("abcd")], "url string, position long")
    got = {r.url[-2]: r.reason for r in jobs.not_product_pages(urls, pages, SHOP).collect()}
    assert got == {"a": "no exportable row", "b": "no product page", "d": "no stored page"}


def test_dense_numbers(spark):
    urls = spark.range(1000).selectExpr("concat('u', id) AS url", "array(id % 7, id) AS position").repartition(5)
    got = [r.url for r in discovery.densely_numbered(urls).orderBy("position").collect()]
    want = [f"u{i}" for i in sorted(range(1000), key=lambda i: (i % 7, i))]
    assert got == want and {r.position for r in discovery.densely_numbered(urls).collect()} == set(range(1000))


def test_golden_rows_and_byte_order_mark(spark, tmp_path):
    """The sample's three records, shortened, with byte-order mark, quoted line breaks and doubled quotes."""
    head = ",".join(PRODUCT_ROW.names)
    lines = [
        'https://s/1/,505,505,"A1 ""x"" 500 мл",K | L,А1,А1,Обем,500 мл,,,n1 | n2,"one\n\ntwo",K | А1,https://s/i.jpg,1.6,500,,ml,instock,',
        'https://s/2/,2307,21161,T - 5 л.,K,B,B,Обем,5 л.,,,n,d,K,https://s/a.jpg | https://s/b.jpg,11.6,5,,l,,"{""attribute_pa_tuba"": ""5l""}"',
        'https://s/2/,2307,21142,T - 1 л.,K,B,B,Обем,1 л.,,,n,d,K,https://s/c.jpg | https://s/b.jpg,2.81,1,,l,,"{""attribute_pa_tuba"": ""1lbutilka""}"',
    ]
    (tmp_path / "raw.csv").write_bytes(b"\xef\xbb\xbf" + "\n".join([head, *lines, ""]).encode())
    rows = read_raw_csv(spark, str(tmp_path / "raw.csv")).orderBy("map_price").collect()
    assert [(r.product_url, r.listing_id, r.seller_sku, r.map_price, r.net_content, r.net_content_unit, len(r.images)) for r in rows] == [
        ("https://s/1/", "505", "505", 1.6, "500", "ml", 1), ("https://s/2/", "2307", "21142", 2.81, "1", "l", 2), ("https://s/2/", "2307", "21161", 11.6, "5", "l", 2)]
    assert rows[0].item_description == "one\n\ntwo" and rows[0].item_name == 'A1 "x" 500 мл' and rows[1].raw_variation == '{"attribute_pa_tuba": "1lbutilka"}'
