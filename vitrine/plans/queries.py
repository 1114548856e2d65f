"""The registered queries: every operator over the given tables or pages derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.content import find_size, parse_price, pick_notes, split_notes, variant_type
from vitrine.functions.sqltext import each, first, keep, let, lit
from vitrine.functions.text import LINE_BREAKS, clean_text, sku_suffix, squeeze, truncate, unescape, unique_filled
from vitrine.functions.urls import (
    is_probable_product_url,
    is_shop_furniture,
    normalize_image_url,
    normalize_url,
    slug_from_url,
)
from vitrine.operators import discovery, export, facts, skus, variants
from vitrine.operators.nodes import attr, element_scopes, elements, keep_inside, node_text, with_nodes
from vitrine.plans import jobs, render
from vitrine.session import scratch_path
from vitrine.sources.pages import read_addresses, read_html_files, read_pages, read_raw_csv

SHOP = render.SHOP
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_of")] = fn
    return fn


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet", spark.sparkContext.defaultParallelism)


def _addresses(spark: SparkSession, sf: str) -> DataFrame:
    return read_addresses(spark, f"{sf}/pages.parquet")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _rendered_rows(spark: SparkSession, sf: str) -> DataFrame:
    return variants.product_rows(render.product_pages(spark, sf), SHOP)


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    pages = facts.maybe_product_pages(render.product_pages(spark, sf))
    return facts.where_kept(facts.product_facts(pages, SHOP), "is_product")


def _single_fact(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        column = f"array_join({name}, ' | ')" if name in ("categories", "base_images", "item_notes") else name
        return _facts(spark, sf).selectExpr("page_id", f"{column} AS {name}")

    return run


# --- scans -------------------------------------------------------------------


@query
def page_scan(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet").selectExpr("page_id", "url", "length(html) AS html_chars")


@query
def sitemap_locs(spark, sf):
    places = _addresses(spark, sf).selectExpr("page_id AS place", "url")
    return discovery.sitemap_locs(render.sitemap_bodies(places, "https://shop.example/product-sitemap"))


@query
def sitemap_children(spark, sf):
    places = _addresses(spark, sf).selectExpr("page_id AS place", "url")
    index = render.sitemap_index(places, "https://shop.example/product-sitemap", "https://shop.example/sitemap_index.xml")
    return discovery.sitemap_locs(index).where(discovery.is_product_sitemap("loc")).select("loc")


@query
def api_links(spark, sf):
    places = _addresses(spark, sf).selectExpr("page_id AS place", "url")
    return discovery.api_links(render.api_bodies(places))


@query
def nav_links(spark, sf):
    return discovery.scoped_links(_pages(spark, sf), lambda e: f"{e}.tag = 'li'")


@query
def category_links(spark, sf):
    return discovery.links_with(_pages(spark, sf), "/t", "url")


@query
def raw_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "raw-csv")
    export.write_csv(export.raw_export(_rendered_rows(spark, sf)), path)
    return export.raw_export(read_raw_csv(spark, path))


@query
def html_files(spark, sf):
    """The pages written as a file each and read back, numbered in path order."""
    path = scratch_path(spark, "html-files")
    _pages(spark, sf).select("page_id", "html").write.partitionBy("page_id").text(path)
    files = read_html_files(spark, path)
    return files.selectExpr(
        "CAST(regexp_extract(url, 'page_id=([0-9]+)', 1) AS BIGINT) AS page_id", "page_id AS place",
        "md5(regexp_replace(html, '\\n$', '')) AS html_md5",
    )


# --- sinks -------------------------------------------------------------------


@query
def raw_export(spark, sf):
    return export.raw_export(_rendered_rows(spark, sf))


@query
def feed_export(spark, sf):
    return jobs.page_feed(render.product_pages(spark, sf), SHOP)


@query
def feed_in_order(spark, sf):
    shown = ["row_no", "listing_id", "seller_sku", "reference_link", "main_image_url"]
    return export.feed_in_order(skus.unique_skus(_rendered_rows(spark, sf))).select(*shown)


# --- page facts ----------------------------------------------------------------


@query
def page_meta(spark, sf):
    flagged = facts.with_elements(render.product_pages(spark, sf))
    props = {
        "og_type": "og:type", "og_title": "og:title", "brand": "product:brand",
        "retailer_item_id": "product:retailer_item_id", "amount": "product:price:amount",
    }
    return flagged.selectExpr("page_id", *[f"{facts.meta(p)} AS {c}" for c, p in props.items()])


@query
def page_title(spark, sf):
    noded = with_nodes(_pages(spark, sf)).selectExpr("page_id", "nodes", f"{elements('nodes')} AS elems")

    def text_of(tag: str) -> str:
        found = first(keep("elems", lambda e: f"{e}.tag = {lit(tag)}"))
        return clean_text(let(found, lambda e: node_text("nodes", e)), 500, decode=0)

    return noded.selectExpr("page_id", f"{text_of('h1')} AS h1_text", f"{text_of('title')} AS doc_title")


QUERIES["product_title"] = _single_fact("title")
QUERIES["canonical_url"] = _single_fact("product_url")
QUERIES["page_brand"] = _single_fact("brand")
QUERIES["page_sku"] = _single_fact("own_sku")
QUERIES["page_categories"] = _single_fact("categories")
QUERIES["page_description"] = _single_fact("item_description")
QUERIES["page_notes"] = _single_fact("item_notes")
QUERIES["page_images"] = _single_fact("base_images")
QUERIES["page_price"] = _single_fact("base_price")
QUERIES["page_availability"] = _single_fact("availability")


@query
def url_slug(spark, sf):
    return _addresses(spark, sf).selectExpr("page_id", f"{slug_from_url('url')} AS slug")


@query
def page_text(spark, sf):
    noded = with_nodes(_pages(spark, sf)).selectExpr(
        "page_id", "nodes", f"{first(keep('nodes', lambda n: f'{n}.tag = {lit("article")}'))} AS article"
    )
    return noded.selectExpr("page_id", f"{facts.block_text('nodes', 'article')} AS article_text")


@query
def text_notes(spark, sf):
    return _table(spark, sf, "documents").selectExpr(
        "doc_id", f"array_join({pick_notes('array(text)')}, ' | ') AS notes"
    )


@query
def note_pieces(spark, sf):
    return _table(spark, sf, "documents").selectExpr("doc_id", f"size({split_notes('text')}) AS n_pieces")


@query
def keywords(spark, sf):
    return _table(spark, sf, "part").selectExpr(
        "p_partkey", f"{facts.keywords('array(p_type, p_brand, p_type)', 'p_brand')} AS keyword_attributes"
    )


@query
def variant_type_of(spark, sf):
    label = """CASE p_partkey % 6 WHEN 0 THEN 'Аромат' WHEN 1 THEN 'Main COLOR' WHEN 2 THEN 'Разфасовка'
        WHEN 3 THEN concat(' ', p_name, '  kind') WHEN 4 THEN '' ELSE 'Цвят и мирис' END"""
    return _table(spark, sf, "part").selectExpr("p_partkey", f"{variant_type(label, 'p_type')} AS variation_type")


@query
def net_content(spark, sf):
    text = """concat(p_name, ' x', p_size, CASE p_partkey % 6 WHEN 0 THEN ' мл' WHEN 1 THEN ' Л.' WHEN 2 THEN ' kg'
        WHEN 3 THEN ' гр.' WHEN 4 THEN ' грама' ELSE '' END, ' / ', p_size, ',5',
        CASE p_partkey % 6 WHEN 0 THEN 'МЛ.' WHEN 1 THEN ' литра' WHEN 2 THEN 'кг' WHEN 3 THEN ' g' WHEN 4 THEN 'грама'
        ELSE ' милилитра' END, ' and 7 л')"""
    sized = _table(spark, sf, "part").selectExpr("p_partkey", f"{find_size(text)} AS size")
    return sized.selectExpr(
        "p_partkey", "size.display AS display", "size.number AS net_content", "size.unit AS net_content_unit"
    )


@query
def array_spread(spark, sf):
    lines = _table(spark, sf, "documents").selectExpr("doc_id", f"split(text, {lit(LINE_BREAKS)}) AS lines")
    return lines.selectExpr("doc_id", *[f"get(lines, {i}) AS line_{i + 1}" for i in range(6)])


# --- predicates ------------------------------------------------------------------


@query
def product_pages(spark, sf):
    every = render.product_pages(spark, sf).unionByName(
        _pages(spark, sf).selectExpr("-1 - page_id AS page_id", "url", "html")
    )
    flagged = facts.with_elements(facts.maybe_product_pages(every))
    return facts.where_kept(flagged, "is_product").select("page_id", "url")


@query
def product_urls(spark, sf):
    flat = "regexp_replace(url, '/(en|de)/', '/')"
    return _addresses(spark, sf).selectExpr(
        "page_id", f"{flat} AS flat_url", f"{is_probable_product_url(flat, 'example.com')} AS is_probable"
    )


@query
def exportable_rows(spark, sf):
    return jobs.exportable(_rendered_rows(spark, sf)).select("url_ord", "var_idx", "seller_sku", "map_price")


@query
def visible_variations(spark, sf):
    return facts.where_kept(variants.with_variations(_facts(spark, sf)), "size(variations) > 0").selectExpr(
        "page_id",
        "size(variations) AS n_visible",
        "array_join(transform(variations, v -> coalesce(nullif(v.variation.sku, ''), '-')), ',') AS skus",
    )


@query
def variation_json(spark, sf):
    return variants.with_variations(_facts(spark, sf)).selectExpr("page_id", "inline(slice(variations, 1, size(variations)))").selectExpr(
        "page_id",
        "idx",
        "try_cast(variation.display_price AS DOUBLE) AS display_price",
        "coalesce(variation.image.full_src, variation.image.src) AS image",
        "array_join(transform(attributes, a -> concat(a.key, '=', a.value)), ';') AS attributes",
    )


@query
def event_props_json(spark, sf):
    return _table(spark, sf, "events").selectExpr(
        "event_id", f"from_json({unescape('props')}, 'struct<k: bigint>').k AS k"
    )


@query
def variation_pairs(spark, sf):
    return variants.with_variations(_facts(spark, sf)).selectExpr("page_id", "inline(slice(variations, 1, size(variations)))").selectExpr(
        "page_id", "idx", "posexplode(slice(pairs, 1, size(pairs))) AS (place, pair)"
    ).selectExpr("page_id", "idx", "place", "pair.type AS variation_type", "pair.value AS variation_value")


@query
def variation_rows(spark, sf):
    return export.raw_export(_rendered_rows(spark, sf).where("raw_variation <> ''"))


@query
def simple_rows(spark, sf):
    return export.raw_export(_rendered_rows(spark, sf).where("raw_variation = ''"))


@query
def image_filter(spark, sf):
    url = """concat('https://cdn.example/', CASE p_partkey % 5 WHEN 0 THEN 'LOGO/' WHEN 1 THEN 'x-logo-' WHEN 2 THEN 'a/'
        WHEN 3 THEN 'Top-Seller/' ELSE 'img32x32.gif?' END, replace(p_name, ' ', '-'), p_partkey, '.png')"""
    return _table(spark, sf, "part").selectExpr("p_partkey", f"{url} AS url").where(f"NOT {is_shop_furniture('url')}")


# --- joins -------------------------------------------------------------------------


def _listed(spark, sf):
    """Page addresses as a URL list, every third one without a stored page."""
    return _addresses(spark, sf).selectExpr(
        "CASE WHEN page_id % 3 = 2 THEN concat(url, '-gone') ELSE url END AS url", "page_id AS position"
    )


@query
def url_page_join(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet")  # every second address is stored twice
    again = pages.where("page_id % 2 = 0").selectExpr("page_id + 1000000000 AS page_id", "url", "'' AS html")
    joined = jobs.fetched(_listed(spark, sf), pages.unionByName(again), SHOP)
    return joined.selectExpr("position", "url", "length(html) AS html_chars")


@query
def url_page_rejects(spark, sf):
    return jobs.not_fetched(_listed(spark, sf), _addresses(spark, sf), SHOP)


@query
def scoped_nodes(spark, sf):
    noded = with_nodes(_pages(spark, sf)).selectExpr("page_id", "nodes", f"{elements('nodes')} AS elems")
    links = keep_inside("elems", keep("elems", lambda e: f"{e}.tag = 'nav'"), lambda e: f"{e}.tag = 'a'")
    shown = each(
        links,
        lambda a: f"named_struct('href', {attr(a, 'href')}, 'text', {clean_text(node_text('nodes', a), decode=0)})",
    )
    return noded.selectExpr("page_id", f"posexplode({shown}) AS (place, link)").selectExpr(
        "page_id", "place", "link.href AS href", "link.text AS text"
    )


# --- aggregations, windows, limits ---------------------------------------------------


@query
def url_dedupe(spark, sf):
    pages = _addresses(spark, sf)
    doubled = pages.selectExpr("concat(' ', url) AS url", "page_id + 1000000000 AS position").unionByName(
        pages.selectExpr("url", "page_id AS position")
    )
    return discovery.unique_urls(doubled)


@query
def line_dedupe(spark, sf):
    lines = each(f"split(text, {lit(LINE_BREAKS)})", clean_text)
    return _table(spark, sf, "documents").selectExpr(
        "doc_id", f"array_join({unique_filled(lines)}, '\\n') AS lines"
    )


@query
def first_node(spark, sf):
    noded = with_nodes(_pages(spark, sf)).selectExpr(
        "page_id", "nodes", f"{first(keep('nodes', lambda n: f'{n}.kind = {lit("o")} AND {n}.tag = {lit("p")}'))} AS p"
    )
    return noded.selectExpr("page_id", f"{clean_text(node_text('nodes', 'p', ''), decode=0)} AS first_paragraph")


@query
def run_counts(spark, sf):
    """Counts of a run that writes feed and raw export, each address listed twice."""
    pages = render.product_pages(spark, sf)
    counts = jobs.export_site(
        _twice_listed(pages), pages, SHOP, scratch_path(spark, "feed"), scratch_path(spark, "raw")
    )
    return spark.createDataFrame([(counts.urls_found, counts.rows_exported)], "urls_found bigint, rows_exported bigint")


def _sku_input(spark, sf):
    return _table(spark, sf, "part").selectExpr(
        "p_partkey AS url_ord", "1 AS var_idx", "replace(p_name, ' ', '-') AS seller_sku", "'' AS listing_id",
        "'' AS product_url", "p_brand AS variation_variant_1", "p_name AS item_name",
    )


@query
def unique_skus(spark, sf):
    return skus.unique_skus(_sku_input(spark, sf)).selectExpr("url_ord AS p_partkey", "seller_sku")


@query
def unique_skus_colliding(spark, sf):
    """Bases that are the names which repeats of the base before them would get."""
    rows = _sku_input(spark, sf).selectExpr(
        "url_ord", "var_idx",
        """CASE url_ord % 4 WHEN 0 THEN concat('b', url_ord DIV 4) WHEN 1 THEN concat('b', url_ord DIV 4)
            WHEN 2 THEN concat('b', url_ord DIV 4, '-x') ELSE concat('b', url_ord DIV 4) END AS seller_sku""",
        "listing_id", "product_url", "'x' AS variation_variant_1", "item_name",
    )
    return skus.unique_skus(rows).selectExpr("url_ord AS p_partkey", "seller_sku")


@query
def node_scopes(spark, sf):
    every = ("a", "h1", "title", "nav", "ul", "article", "footer", "li", "p", "b", "div", "head", "body", "html")
    return element_scopes(_pages(spark, sf), every).selectExpr(
        "page_id", "ord", "tag", "end AS end_ord"
    )


@query
def url_limit(spark, sf):
    urls = _addresses(spark, sf).selectExpr("url", "page_id AS position")
    return discovery.limited(urls, 100)


@query
def text_truncate(spark, sf):
    return _table(spark, sf, "documents").selectExpr("doc_id", f"{truncate(squeeze('text'), 200)} AS short_text")


# --- set operations and iteration -------------------------------------------------------


def _some(spark, sf, test):
    return _addresses(spark, sf).where(test).selectExpr("url", "page_id AS position")


@query
def url_union(spark, sf):
    """The first list has nested positions, the others plain numbers; places are shown joined."""
    nested = _some(spark, sf, "page_id % 3 = 1").selectExpr("url", "array(position % 5, position) AS position")
    every = discovery.url_union(nested, _some(spark, sf, "page_id % 2 = 0"), _some(spark, sf, "true"))
    return every.selectExpr("url", "array_join(position, '.') AS place")


@query
def source_fallback(spark, sf):
    return discovery.first_nonempty(
        _some(spark, sf, "url LIKE 'ftp:%'"), _some(spark, sf, "url LIKE 'https:%'"), _some(spark, sf, "true")
    ).selectExpr("url", "position[0] AS position")


@query
def next_page_chain(spark, sf):
    """Pages of one host point to the next page of the host, the last one back to the first."""
    from pyspark.sql import Window

    hosted = _addresses(spark, sf).selectExpr("page_id", "regexp_extract(url, '^(https?://[^/]+)', 1) AS host")
    # blocks of page ids keep the windows below small on any host
    block = Window.partitionBy("host", F.expr("page_id DIV 100000")).orderBy("page_id")
    chained = hosted.select(
        "host",
        F.expr("page_id DIV 100000").alias("block"),
        "page_id",
        F.coalesce(F.lead("page_id").over(block), F.min("page_id").over(block.rowsBetween(Window.unboundedPreceding, 0))).alias("next_id"),
        F.row_number().over(block).alias("place"),
    )
    address = "concat(host, '/list/', {id}, '/')"
    html = f"""concat('<html><head><link rel="next" href="', {address.format(id='next_id')}, '"></head></html>')"""
    pages = chained.selectExpr(f"{address.format(id='page_id')} AS url", f"{html} AS html")
    seeds = chained.where("place = 1").selectExpr("page_id AS seed_ord", f"{address.format(id='page_id')} AS url")
    return discovery.page_chains(seeds, discovery.listing_facts(pages, SHOP).select("url", "next_url"))


@query
def category_crawl(spark, sf):
    found = discovery.home_category_urls(render.home_pages(spark, sf), render.listing_pages(spark, sf), SHOP)
    return discovery.densely_numbered(found).selectExpr("url", "position AS place")


# --- scalar functions ------------------------------------------------------------------------


@query
def clean_text_of(spark, sf):
    return _pages(spark, sf).selectExpr(
        "page_id", f"{clean_text('regexp_extract(html, \'<h1>(.*?)</h1>\', 1)', 60)} AS heading"
    )


@query
def entity_decode(spark, sf):
    return _pages(spark, sf).selectExpr(
        "page_id", f"{unescape('regexp_extract(html, \'(?s)<footer>(.*)\', 1)')} AS footer",
        f"{unescape('regexp_extract(html, \'<title>(.*?)</title>\', 1)')} AS title",
    )


@query
def price_parse(spark, sf):
    amount = "format_string('%.2f', p_retailprice)"
    text = f"""CASE p_partkey % 6 WHEN 0 THEN concat('Price: ', {amount}, ' €')
        WHEN 1 THEN concat(replace({amount}, '.', ','), '&nbsp;&euro; / 12.00 €')
        WHEN 2 THEN concat('5 лв ', {amount}, 'EUR') WHEN 3 THEN concat('1 ', replace({amount}, '.', ','), ' eur.')
        WHEN 4 THEN concat({amount}, ' euros') ELSE concat({amount}, ' лв') END"""
    return _table(spark, sf, "part").selectExpr("p_partkey", f"{parse_price(text)} AS price")


@query
def url_normalize(spark, sf):
    links = discovery.scoped_links(_pages(spark, sf), lambda e: f"{e}.tag = 'nav'")
    return links.selectExpr(
        "url",
        "ord",
        f"{normalize_url('href', 'url')} AS absolute",
        f"{normalize_url('substring(href, 2)', 'url')} AS relative",
        f"{normalize_url('concat(\'/\', href)', 'url')} AS without_scheme",
        f"{normalize_url('concat(\'?\', href)', 'url')} AS query_only",
        f"{normalize_url('concat(\' ../x\', href)', 'url')} AS upward",
    )


@query
def image_normalize(spark, sf):
    url = """concat(CASE p_partkey % 3 WHEN 0 THEN '/img/' WHEN 1 THEN '//cdn.example/webp-express/webp-images/' ELSE 'https://a.example/' END,
        p_partkey, CASE p_partkey % 4 WHEN 0 THEN '-300x300.jpg' WHEN 1 THEN '-64x800.png.webp' WHEN 2 THEN '-301x300.jpg' ELSE '.webp' END)"""
    return _table(spark, sf, "part").selectExpr("p_partkey", f"{normalize_image_url(url, lit(SHOP.base_url))} AS image")


@query
def sku_slug(spark, sf):
    return _table(spark, sf, "part").selectExpr(
        "p_partkey", f"{sku_suffix('concat(\'-\', p_type, \' № \', p_partkey, \' / \', p_name, \' & more text.\')')} AS suffix"
    )


# --- jobs -----------------------------------------------------------------------------------------


@query
def product_rows(spark, sf):
    rows = _rendered_rows(spark, sf)
    return export.raw_export(rows)


def _urls_of(pages):
    return pages.selectExpr("page_id AS place", "url")


def _stored_twice(spark, sf):
    """Rendered pages, every third address stored a second time under a larger number, with other content."""
    pages = render.product_pages(spark, sf)
    again = pages.where("page_id % 3 = 0").selectExpr("page_id + 1000000000000 AS page_id", "url", "replace(html, '€', 'EUR') AS html")
    return pages.unionByName(again)


def _twice_listed(pages):
    urls = pages.where("page_id < 1000000000000").selectExpr("url", "page_id AS position")
    return urls.unionByName(urls.selectExpr("url", "position + 1000000000 AS position"))


@query
def discovered_rows(spark, sf):
    pages = _stored_twice(spark, sf)
    rows = jobs.discovered_rows(_twice_listed(pages), pages, SHOP)
    return rows.select("url_ord", "var_idx", "seller_sku", "item_name", "map_price")


@query
def discovered_rows_limited(spark, sf):
    pages = _stored_twice(spark, sf)
    rows = jobs.discovered_rows(_twice_listed(pages), pages, SHOP, limit=100)
    return rows.select("url_ord", "var_idx", "seller_sku", "item_name", "map_price")


@query
def rejected_urls(spark, sf):
    pages = _stored_twice(spark, sf)
    gone = _twice_listed(pages).selectExpr("CASE WHEN position % 11 = 0 THEN concat(url, '&gone') ELSE url END AS url", "position")
    return jobs.not_product_pages(gone, pages, SHOP)


@query
def site_feed(spark, sf):
    """The main job: rendered sitemaps to addresses, pages, rows, unique SKUs and the feed."""
    pages = _stored_twice(spark, sf)
    urls = pages.where("page_id < 1000000000000").selectExpr("page_id AS place", "url")
    prefix = "https://shop.example/product-sitemap-part"
    bodies = render.sitemap_bodies(urls, prefix).unionByName(render.sitemap_index(urls, prefix, "https://shop.example/sitemap_index.xml"))
    found = discovery.all_site_urls(
        bodies, render.api_bodies(urls), render.home_pages(spark, sf), render.listing_pages(spark, sf), SHOP
    )
    return jobs.site_feed(found, pages, SHOP)


@query
def all_site_urls(spark, sf):
    urls = _urls_of(render.parts(spark, sf).selectExpr("k AS page_id", "url"))
    prefix = "https://shop.example/product-sitemap-part"
    index = render.sitemap_index(urls, prefix, "https://shop.example/sitemap_index.xml")
    bodies = render.sitemap_bodies(urls, prefix).unionByName(index)
    found = discovery.all_site_urls(
        bodies, render.api_bodies(urls), render.home_pages(spark, sf), render.listing_pages(spark, sf), SHOP
    )
    return discovery.densely_numbered(found).selectExpr("url", "position AS place")


def _mode_rows(spark, sf, mode, url):
    """A run from one address; stored pages have the addresses that listings and sitemaps name."""
    urls = _urls_of(render.parts(spark, sf).selectExpr("k AS page_id", "url"))
    prefix = "https://shop.example/product-sitemap-part"
    sources = jobs.Sources(
        render.sitemap_bodies(urls, prefix), render.api_bodies(urls), render.home_pages(spark, sf), render.listing_pages(spark, sf)
    )
    pages = render.product_pages(spark, sf).selectExpr("page_id", "regexp_extract(url, '^([^?]*)', 1) AS url", "html")
    return jobs.mode_feed(mode, url, sources, pages, SHOP).selectExpr("listing_id", "seller_sku", "item_name", "map_price")


@query
def single_product_feed(spark, sf):
    """The product with the smallest number that has variations."""
    url = render.parts(spark, sf).where("k % 20 = 5").orderBy("k").first()["url"]
    return _mode_rows(spark, sf, "single_product", url)


@query
def category_feed(spark, sf):
    return _mode_rows(spark, sf, "category", "https://shop.example/cat/c5/0/")


@query
def sitemap_feed(spark, sf):
    return _mode_rows(spark, sf, "sitemap", "https://shop.example/product-sitemap-part0.xml")
