"""Registered queries against their SQL on the smallest tables, and the shape of the main plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare
from vitrine.operators.facts import maybe_product_pages
from vitrine.operators.variants import product_rows
from vitrine.plans.jobs import page_choice
from vitrine.plans.oracles import ORACLES
from vitrine.plans.queries import QUERIES
from vitrine.plans.render import SHOP
from vitrine.sources.pages import read_pages

SF = "/root/testdata/sf0.001"
QUICK = (
    "page_scan", "nav_links", "page_title", "page_text", "text_notes", "line_dedupe", "net_content", "variant_type",
    "url_normalize", "image_normalize", "node_scopes", "first_node", "sitemap_locs", "api_links", "unique_skus",
    "product_rows", "feed_export", "raw_csv_roundtrip", "visible_variations", "url_union", "unique_skus_colliding",
    "category_crawl", "all_site_urls", "discovered_rows", "rejected_urls", "site_feed",
)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, db, name):
    _, verdict = compare(spark, db, name, SF)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_pages_to_rows_does_not_shuffle(spark):
    plan = product_rows(read_pages(spark, f"{SF}/pages.parquet"), SHOP)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
    scan = maybe_product_pages(read_pages(spark, f"{SF}/pages.parquet")).select("url")
    assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()


def test_a_url_list_chooses_pages_before_their_html_is_read(spark):
    pages = read_pages(spark, f"{SF}/pages.parquet")
    choice = page_choice(pages.selectExpr("url", "page_id AS position"), pages, SHOP)
    assert "html" not in choice._jdf.queryExecution().executedPlan().toString()
