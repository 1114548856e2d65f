"""End-to-end jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.sqltext import lit
from vitrine.functions.urls import normalize_url
from vitrine.operators.discovery import (
    all_site_urls,
    category_urls,
    densely_numbered,
    limited,
    listed_seeds,
    sitemap_urls,
    stored,
    unique_urls,
)
from vitrine.operators.export import RunCounts, feed, stored_counted, write_feed
from vitrine.operators.lookup import maybe_listed
from vitrine.operators.skus import unique_skus
from vitrine.operators.variants import product_rows
from vitrine.schemas import Shop

EXPORTABLE = "item_name <> '' AND size(images) > 0 AND map_price IS NOT NULL"


def exportable(rows: DataFrame) -> DataFrame:
    """Rows with a name, an image and a price."""
    return rows.where(EXPORTABLE)


def page_choice(urls: DataFrame, pages: DataFrame, shop: Shop) -> DataFrame:
    """``(page_id, url, position)`` of the listed URLs that have a stored page.

    Of several stored copies of an address the one with the smallest page number counts; URLs without
    a stored page drop out.  Only addresses and numbers are read.
    """
    wanted = urls.selectExpr("url", "position", f"{normalize_url('url', lit(shop.base_url))} AS fetch_url")
    numbers = pages.selectExpr("page_id", "url AS fetch_url").groupBy("fetch_url").agg(F.min("page_id").alias("page_id"))
    return wanted.join(numbers, "fetch_url").select("page_id", "url", "position")


def fetched(urls: DataFrame, pages: DataFrame, shop: Shop) -> DataFrame:
    """Bodies of the listed URLs ``(position, url, html)``, one per URL.

    For those who want the bodies themselves: only they travel, pages that are not listed stay where they are.
    Rows are better made with ``rows_in_place``.
    """
    choice = stored(page_choice(urls, pages, shop), "page-choice")
    near = maybe_listed(pages.select("page_id", "html"), choice)
    return choice.join(near, "page_id").select("position", "url", "html")


def rows_in_place(choice: DataFrame, pages: DataFrame, shop: Shop) -> DataFrame:
    """Product rows of the chosen pages (``page_id`` and ``position``, a written table), ``url_ord`` being the position.

    Pages outside the choice are left out by a broadcast bitmap of fixed size before they are cut, the others are cut
    where they are read, and only their rows meet the choice: no HTML is shuffled, whether the list is short or whole.
    """
    rows = product_rows(maybe_listed(pages, choice), shop, absolute=True).withColumnRenamed("url_ord", "page_id")
    shown = [f"`{c}`" for c in rows.columns if c != "page_id"]
    return rows.join(choice.select("page_id", "position"), "page_id").selectExpr("position AS url_ord", *shown)


def not_fetched(urls: DataFrame, pages: DataFrame, shop: Shop) -> DataFrame:
    """Listed URLs without a stored page."""
    wanted = urls.selectExpr("url", "position", f"{normalize_url('url', lit(shop.base_url))} AS fetch_url")
    return wanted.join(pages.selectExpr("url AS fetch_url"), "fetch_url", "left_anti").select("position", "url")


def discovered_rows(urls: DataFrame, pages: DataFrame, shop: Shop, limit: int = 0) -> DataFrame:
    """URL list to exportable product rows: unique, limit, page lookup, extraction, row test.

    The pages are chosen by number on slim columns, which are written once; ``url_ord`` is the dense rank of the URL.
    """
    chosen = densely_numbered(limited(unique_urls(urls), limit))
    choice = stored(page_choice(chosen, pages, shop).select("page_id", "position"), "page-choice")
    return exportable(rows_in_place(choice, pages, shop))


def page_feed(pages: DataFrame, shop: Shop) -> DataFrame:
    """Pages straight to the feed, without the row test."""
    return feed(unique_skus(product_rows(pages, shop)))


def not_product_pages(urls: DataFrame, pages: DataFrame, shop: Shop) -> DataFrame:
    """Rejects: ``(position, url, reason)`` of listed URLs that lead to no exportable row."""
    chosen = densely_numbered(unique_urls(urls))
    choice = stored(page_choice(chosen, pages, shop).select("page_id", "position"), "page-choice")
    rows = rows_in_place(choice, pages, shop).groupBy("url_ord").agg(F.max(F.expr(EXPORTABLE)).alias("exported"))
    stored_ones = choice.selectExpr("position AS stored_at", "true AS stored")
    judged = chosen.join(stored_ones, chosen.position == stored_ones.stored_at, "left").join(
        rows, chosen.position == rows.url_ord, "left"
    )
    reason = """CASE WHEN stored IS NULL THEN 'no stored page' WHEN exported IS NULL THEN 'no product page'
        WHEN NOT exported THEN 'no exportable row' END"""
    return judged.selectExpr("position", "url", f"{reason} AS reason").where("reason IS NOT NULL")


def site_feed(urls: DataFrame, pages: DataFrame, shop: Shop, limit: int = 0) -> DataFrame:
    """URL list to the feed."""
    return feed(unique_skus(discovered_rows(urls, pages, shop, limit)))


def export_site(
    urls: DataFrame, pages: DataFrame, shop: Shop, path: str, raw_path: str | None = None,
    template: list[str] | None = None, limit: int = 0,
) -> RunCounts:
    """The whole run: URL list to the written feed and raw export, and the counts of the very run that wrote them.

    Pages are scanned once for their rows; the counts are observed while list and rows are written.
    """
    listed, found = stored_counted(unique_urls(urls), "listed-urls")
    rows = unique_skus(discovered_rows(listed, pages, shop, limit))
    return write_feed(rows, path, raw_path, template, found)


@dataclass(frozen=True)
class Sources:
    """What a crawl has stored for discovery."""

    sitemap_bodies: DataFrame
    api_bodies: DataFrame
    home: DataFrame
    listing_pages: DataFrame


MODES = ("all_site", "single_product", "category", "sitemap")


def mode_urls(mode: str, url: str, sources: Sources, shop: Shop) -> DataFrame:
    """The URL list ``(url, position)`` of a run: the whole site, one product, one category or one sitemap."""
    if mode == "single_product":
        return listed_seeds(sources.home, [url]).selectExpr("seed AS url", "rank AS position")
    if mode == "category":
        seed = listed_seeds(sources.home, [url]).selectExpr("rank AS seed_ord", "seed AS url")
        return category_urls(seed, sources.listing_pages, shop)
    if mode == "sitemap":
        return sitemap_urls(sources.sitemap_bodies, [url], shop)
    if mode != "all_site":
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    return all_site_urls(sources.sitemap_bodies, sources.api_bodies, sources.home, sources.listing_pages, shop)


def mode_feed(mode: str, url: str, sources: Sources, pages: DataFrame, shop: Shop, limit: int = 0) -> DataFrame:
    """A run from its mode and address to the feed."""
    return site_feed(mode_urls(mode, url, sources, shop), pages, shop, limit)


def files_feed(files: DataFrame, shop: Shop) -> DataFrame:
    """HTML files (``read_html_files``) to the feed, in path order, without the row test."""
    return page_feed(files, shop)
