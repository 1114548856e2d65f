"""Product URLs from stored sitemaps, listing-API bodies and category pages.

Order travels as ``position``, an array of numbers that is compared from the left
(source, page, place in the page, ...), so sources nest without sharing bits; it is
only sorted where a limit or dense numbers need it.  A caller's lists may carry a
plain number instead.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from vitrine import fixed
from vitrine.functions.sqltext import bind, each, first, keep, leading, let, lit, missing
from vitrine.functions.text import clean_text, unescape
from vitrine.functions.urls import is_probable_product_url, normalize_url
from vitrine.operators.nodes import attr, elements, has_class, keep_inside, with_nodes
from vitrine.schemas import Shop
from vitrine.session import scratch_path

#: XML tokens: comment, CDATA, processing instruction, tag, text; what never ends runs to the end of the body.
XML_TOKEN = (
    r"(?s)<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?.*?(?:\?>|\z)"
    r"""|<[^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+>?|[^<]++"""
)
LOC_OPEN, LOC_CLOSE = r"(?s)^<loc(?:[\s/].*)?>\z", r"^</loc\s*>\z"
CDATA_MARKS = r"(?s)^<!\[CDATA\[|\]\]>$"


def position(*parts: str) -> str:
    """The parts as one order, the first counting most."""
    return f"array({', '.join(f'CAST({p} AS BIGINT)' for p in parts)})"


def path_of(frame: DataFrame, column: str = "position") -> str:
    """The column as an array, whether it is one or a plain number."""
    return column if isinstance(frame.schema[column].dataType, ArrayType) else position(column)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unique_urls(urls: DataFrame) -> DataFrame:
    """Keep-first unique: cleaned, empty dropped, the smallest position of each URL."""
    return (
        urls.selectExpr(f"{clean_text('url')} AS url", "position")
        .where("url <> ''")
        .groupBy("url")
        .agg(F.min("position").alias("position"))
    )


def url_union(*sources: DataFrame) -> DataFrame:
    """Concatenate ``(url, position)`` lists in the given order and keep first occurrences."""
    ranked = [s.selectExpr("url", f"concat({position(str(i))}, {path_of(s)}) AS position") for i, s in enumerate(sources)]
    every = ranked[0]
    for more in ranked[1:]:
        every = every.unionByName(more)
    return unique_urls(every)


def first_nonempty(*sources: DataFrame) -> DataFrame:
    """The first of the lists that holds anything."""
    every = None
    for i, s in enumerate(sources):
        tagged = s.selectExpr("url", f"{path_of(s)} AS position", f"{i} AS source_rank")
        every = tagged if every is None else every.unionByName(tagged)
    chosen = every.agg(F.min("source_rank").alias("source_rank"))  # one row
    return every.join(F.broadcast(chosen), "source_rank", "left_semi").select("url", "position")


#: Up to so many URLs one task merges what the others have cut.
SMALL_LIMIT = 10_000


def limited(urls: DataFrame, limit: int = 0) -> DataFrame:
    """First ``limit`` URLs; 0 keeps all.

    A larger limit counts ranges of the order: ranges that lie before the border are taken whole and unsorted, only
    the range that holds the border is sorted and cut.
    """
    if limit <= 0:
        return urls
    if limit <= SMALL_LIMIT:
        return urls.orderBy("position").limit(limit)
    ranged = stored(urls.repartitionByRange("position").withColumn("__range", F.spark_partition_id()), "limit-ranges")
    sizes = {r["__range"]: r["n"] for r in ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per range
    border, before = None, 0
    for k in sorted(sizes):
        if before + sizes[k] > limit:
            border = k
            break
        before += sizes[k]
    if border is None:
        return ranged.drop("__range")
    cut = ranged.where(F.col("__range") == border).orderBy("position").limit(limit - before)
    return ranged.where(F.col("__range") < border).unionByName(cut).drop("__range")


def densely_numbered(urls: DataFrame) -> DataFrame:
    """``position`` replaced by its rank from 0: ranges of the order are sorted apart, then shifted."""
    ranged = urls.repartitionByRange("position").sortWithinPartitions("position")
    placed = stored(
        ranged.selectExpr("*", "spark_partition_id() AS __range", "monotonically_increasing_id() & 8589934591L AS __place"),
        "url-ranges",
    )
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).select(
        "__range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start")
    )
    others = [f"`{c}`" for c in urls.columns if c != "position"]
    return placed.join(starts, "__range").selectExpr(*others, "__start + __place AS position")


# --- sitemaps ---------------------------------------------------------------


def _loc_texts(body: str) -> str:
    """Texts of the ``loc`` elements of an XML body: comments and processing instructions hold none, CDATA is literal."""

    def kind(t: str) -> str:
        return f"""CASE WHEN NOT startswith({t}, '<') THEN 't' WHEN startswith({t}, '<![CDATA[') THEN 'd'
            WHEN {t} RLIKE {lit(LOC_OPEN)} THEN CASE WHEN endswith({t}, '/>') THEN 'v' ELSE 'o' END
            WHEN {t} RLIKE {lit(LOC_CLOSE)} THEN 'c' ELSE 'x' END"""

    def text_of(t: str) -> str:
        literal = f"regexp_replace({t}.token, {lit(CDATA_MARKS)}, '')"
        return f"CASE {t}.kind WHEN 't' THEN {unescape(f'{t}.token')} WHEN 'd' THEN {literal} ELSE '' END"

    def texts(tokens: str) -> str:
        def of_closes(closes: str) -> str:
            def one(o: str) -> str:
                # up to the first end tag behind it; an element that never ends, as in a cut body, is none
                end = f"get({closes}, {leading(closes, lambda c: f'{c}.at < {o}.at')}).at"
                inner = let(end, lambda e: f"slice({tokens}, {o}.at + 2, {e} - {o}.at - 1)")
                return f"CASE WHEN {o}.kind = 'v' THEN '' ELSE array_join({each(inner, text_of)}, '') END"

            return keep(each(f"filter({tokens}, t -> t.kind IN ('o', 'v'))", one), lambda x: f"{x} IS NOT NULL")

        return bind(f"filter({tokens}, t -> t.kind = 'c')", of_closes)

    def shaped(raw: str) -> str:
        return f"transform({raw}, (t, i) -> named_struct('at', i, 'kind', {kind('t')}, 'token', t))"

    return bind(f"regexp_extract_all({body}, {lit(XML_TOKEN)}, 0)", lambda raw: bind(shaped(raw), texts))


def sitemap_locs(bodies: DataFrame, *more: str) -> DataFrame:
    """``(url, ord, loc)`` of stored sitemap bodies, and ``more`` of their columns."""
    return bodies.selectExpr("url", *more, f"posexplode({_loc_texts('body')}) AS (ord, raw)").selectExpr(
        "url", *more, "ord", f"{clean_text('raw')} AS loc"
    )


def is_sitemap(loc: str) -> str:
    return f"endswith(lower({loc}), '.xml')"


def is_product_sitemap(loc: str) -> str:
    """Sitemaps worth reading: product ones, but not those of product categories."""
    return f"""({is_sitemap(loc)} AND contains(lower({loc}), {lit(fixed.PRODUCT_SITEMAP_PART)})
        AND NOT contains(lower({loc}), {lit(fixed.CATEGORY_SITEMAP_PART)}))"""


def sitemap_seeds(bodies: DataFrame, shop: Shop) -> DataFrame:
    """``(seed, rank)``: stored index sitemaps, then the plain and the numbered product sitemaps of the shop's root."""
    name = f"regexp_extract(url, {lit('^' + re.escape(shop.base_url) + fixed.SITEMAP_NAMES)}, 1)"
    number = f"regexp_extract(url, {lit('^' + re.escape(shop.base_url) + fixed.SITEMAP_NAMES)}, 2)"
    named = bodies.selectExpr("url AS seed", f"{name} AS name", f"coalesce(try_cast({number} AS BIGINT), 0) AS number")
    ranked = named.where("name <> ''").selectExpr("seed", f"{position(f'CASE name WHEN {lit(fixed.SITEMAP_INDEX)} THEN 0 ELSE 1 END', 'number')} AS rank")
    return ranked.distinct()


def listed_seeds(bodies: DataFrame, seeds: list[str]) -> DataFrame:
    """Given seed addresses with their places in the list."""
    rows = ", ".join(f"({lit(s)}, {position(str(i), '0')})" for i, s in enumerate(seeds))
    return bodies.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(seed, rank)")


def sitemap_urls(bodies: DataFrame, seeds: DataFrame | list[str], shop: Shop) -> DataFrame:
    """Product URLs of the seed sitemaps and of the product sitemaps they name, two levels.

    Only bodies that are looked up are unfolded.  Of several stored bodies of an address every link counts.
    """
    base = lit(shop.base_url)
    ranks = seeds if isinstance(seeds, DataFrame) else listed_seeds(bodies, seeds)
    once = bodies.select("url", "body")
    asked = ranks.selectExpr("rank", "seed", f"{normalize_url('seed', base)} AS url").join(once, "url")
    top = sitemap_locs(asked, "rank", "seed")
    probable = is_probable_product_url("loc", shop.host_suffix, base)
    direct = top.where(f"NOT {is_sitemap('loc')} AND {probable}").selectExpr(
        "loc AS url", f"concat(rank, {position('0', 'ord')}) AS position"
    )
    children = top.where(f"{is_product_sitemap('loc')} AND loc <> seed").selectExpr(
        f"concat(rank, {position('1 + ord')}) AS child", f"{normalize_url('loc', base)} AS url"
    )
    nested = sitemap_locs(children.join(once, "url"), "child").where(probable).selectExpr(
        "loc AS url", f"concat(child, {position('ord')}) AS position"
    )
    return unique_urls(direct.unionByName(nested))


# --- listing API --------------------------------------------------------------


def api_links(bodies: DataFrame, page_bound: int | None = None) -> DataFrame:
    """``(page_no, ord, link)`` of the pages before the first failed, empty, broken or missing one.

    Reading also stops after the page whose total says that it is the last, and after ``page_bound`` if given.
    """
    within = f"page_no BETWEEN 1 AND {page_bound}" if page_bound else "page_no >= 1"
    items = bodies.where(within).selectExpr(
        "CAST(page_no AS INT) AS page_no",
        "status",
        "total_pages",
        "from_json(body, 'array<struct<link:string>>') AS items",
    )
    good = "coalesce(status, 200) < 400 AND coalesce(size(items), 0) > 0"
    last = f"page_no >= coalesce(total_pages, page_no) AND {good}"
    stops = items.selectExpr(
        f"CASE WHEN NOT ({good}) THEN page_no WHEN {last} THEN page_no + 1 END AS stop"
    ).unionByName(
        items.selectExpr("page_no + 1 AS stop")
        .unionByName(bodies.sparkSession.sql("SELECT 1 AS stop"))
        .join(items.selectExpr("page_no AS stop"), "stop", "left_anti")
    )
    stop = stops.agg(F.min("stop").alias("stop"))  # one row
    return (
        items.join(F.broadcast(stop), F.expr("page_no < stop"))
        .selectExpr("page_no", "posexplode(slice(items.link, 1, size(items))) AS (ord, link)")
        .where("link <> ''")
    )


def api_urls(bodies: DataFrame, shop: Shop, page_bound: int | None = None) -> DataFrame:
    probable = is_probable_product_url("link", shop.host_suffix, lit(shop.base_url))
    links = api_links(bodies, page_bound).where(probable)
    return unique_urls(links.selectExpr("link AS url", f"{position('page_no', 'ord')} AS position"))


# --- category pages -----------------------------------------------------------


def _scoped(elems: str, scope, link=lambda e: "true") -> str:
    """hrefs of the ``a[href]`` elements inside scope elements, in page order."""
    found = keep_inside(elems, keep(elems, scope), lambda e: f"{e}.tag = 'a' AND {attr(e, 'href')} <> '' AND {link(e)}")
    return each(found, lambda e: attr(e, "href"))


def scoped_links(pages: DataFrame, scope, link=lambda e: "true") -> DataFrame:
    """``(url, ord, href)`` of the ``a[href]`` elements inside scope elements, in page order."""
    noded = with_nodes(pages.select("url", "html")).selectExpr("url", f"{elements('nodes')} AS elems")
    return noded.selectExpr("url", f"posexplode({_scoped('elems', scope, link)}) AS (ord, href)")


def listing_facts(pages: DataFrame, shop: Shop) -> DataFrame:
    """``(url, next_url, hrefs)`` of listing pages, each cut once; of several stored copies the smallest counts.

    The next page is ``link[rel=next]``, else the pagination's next link; the links stand inside product items.
    """
    noded = with_nodes(pages.select("url", "html")).selectExpr("url", f"{elements('nodes')} AS elems")
    declared = first(
        keep("elems", lambda e: f"{e}.tag = 'link' AND array_contains(split({attr(e, 'rel')}, '\\\\s+'), 'next')")
    )
    shown = first(
        keep("elems", lambda e: f"{e}.tag = 'a' AND {has_class(e, 'next')} AND {has_class(e, 'page-numbers')}")
    )
    href = let(f"coalesce({declared}, {shown})", lambda e: attr(e, "href"))
    products = _scoped("elems", lambda e: f"{e}.tag = 'li' AND {has_class(e, 'product')}")
    cut = noded.selectExpr("url", f"{missing(normalize_url(href, lit(shop.base_url)))} AS next_url", f"{products} AS hrefs")
    return cut.groupBy("url").agg(F.min(F.struct("next_url", "hrefs")).alias("f")).selectExpr("url", "f.next_url", "f.hrefs")


def listing_links(facts: DataFrame, shop: Shop) -> DataFrame:
    """Probable product links of listing pages."""
    return facts.selectExpr("url", "posexplode(hrefs) AS (ord, href)").selectExpr(
        "url", "ord", f"{normalize_url('href', lit(shop.base_url))} AS link"
    ).where(is_probable_product_url("link", shop.host_suffix))


def links_with(pages: DataFrame, fragment: str, base: str, *more: str) -> DataFrame:
    """``(url, ord, link)`` and ``more`` of the pages' columns: links whose href, and absolute form too, holds the fragment."""
    noded = with_nodes(pages.select("url", "html", *more)).selectExpr("url", "nodes", *more)
    hrefs = each(
        keep("nodes", lambda n: f"{n}.kind IN ('o', 'v') AND {n}.tag = 'a' AND contains({attr(n, 'href')}, {lit(fragment)})"),
        lambda n: attr(n, "href"),
    )
    return (
        noded.selectExpr("url", *more, f"posexplode({hrefs}) AS (ord, href)")
        .selectExpr("url", *more, "ord", f"{normalize_url('href', base)} AS link")
        .where(f"contains(link, {lit(fragment)})")
    )


def page_chains(seeds: DataFrame, edges: DataFrame, bound: int | None = None) -> DataFrame:
    """``(seed_ord, url, depth)``: the pages met from each seed, within ``bound`` steps if given.

    Every page has at most one next page (of several the smallest), so steps can be
    doubled: round k knows the page 2^k steps on, and 300 pages take 9 rounds.  A walk
    that meets a page again only repeats pages, so the smallest depth per page is the
    walk, and a round that meets no new page is the last.
    """
    jumps = stored(edges.where("next_url IS NOT NULL").groupBy("url").agg(F.min("next_url").alias("target")), "jumps")
    met = seeds.selectExpr("seed_ord", "url", "0 AS depth").groupBy("seed_ord", "url").agg(F.min("depth").alias("depth"))
    known, stride = met.count(), 1
    while bound is None or stride < bound:
        further = met.join(jumps, "url").selectExpr("seed_ord", "target AS url", f"depth + {stride} AS depth")
        within = f"depth < {bound}" if bound else "true"
        met = stored(
            met.unionByName(further).where(within).groupBy("seed_ord", "url").agg(F.min("depth").alias("depth")), "met"
        )
        now = met.count()
        if now == known:
            break
        known, stride = now, stride * 2
        onward = jumps.selectExpr("target AS url", "url AS origin").join(jumps, "url")
        jumps = stored(onward.selectExpr("origin AS url", "target"), "jumps")
    return met


def category_urls(seeds: DataFrame, pages: DataFrame, shop: Shop, bound: int | None = None) -> DataFrame:
    """Product URLs of the categories ``(seed_ord, url)``, page after page, category after category."""
    starts = seeds.selectExpr("seed_ord", f"{normalize_url('url', lit(shop.base_url))} AS url")
    facts = stored(listing_facts(pages, shop), "listing-facts")
    found = page_chains(starts, facts.select("url", "next_url"), bound).join(listing_links(facts, shop), "url")
    return unique_urls(
        found.selectExpr("link AS url", f"concat({path_of(starts, 'seed_ord')}, {position('depth', 'ord')}) AS position")
    )


def home_category_urls(home: DataFrame, pages: DataFrame, shop: Shop, bound: int | None = None) -> DataFrame:
    """Product URLs of all categories that the home pages link to; several pages are told apart by ``page_id``."""
    home = home if "page_id" in home.columns else home.withColumn("page_id", F.lit(0))
    links = links_with(home, fixed.CATEGORY_FRAGMENT, lit(shop.base_url), "page_id")
    seeds = unique_urls(links.selectExpr("link AS url", f"{position('page_id', 'ord')} AS position"))
    return category_urls(seeds.selectExpr("position AS seed_ord", "url"), pages, shop, bound)


def all_site_urls(
    sitemap_bodies: DataFrame, api_bodies: DataFrame, home: DataFrame, listing_pages: DataFrame, shop: Shop,
    seeds: list[str] | None = None,
) -> DataFrame:
    """Sitemaps, else the listing API, else the category crawl.

    Each source is only worked through when the ones before it came out empty.
    """
    asked = seeds or sitemap_seeds(sitemap_bodies, shop)
    by_sitemap = stored(sitemap_urls(sitemap_bodies, asked, shop), "sitemap-urls")
    if not by_sitemap.isEmpty():
        return by_sitemap
    by_api = stored(api_urls(api_bodies, shop), "api-urls")
    return by_api if not by_api.isEmpty() else home_category_urls(home, listing_pages, shop)
