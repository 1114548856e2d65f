"""Page facts: what one product page says about its product.

All facts of a page are computed in the page's own row from its node array, in
a few projections that each reuse the arrays picked by the one before.  There is
no join per fact and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine import fixed
from vitrine.functions.content import parse_price, pick_notes
from vitrine.functions.sqltext import any_of, bind, each, first, first_filled, keep, let, lit, lits, missing
from vitrine.functions.text import LINE_BREAKS, clean_text, contains_any, squeeze, unescape, unique_filled
from vitrine.functions.urls import is_shop_furniture, normalize_image_url, normalize_url, slug_from_url
from vitrine.operators.nodes import (
    attr,
    content,
    elements,
    has_class,
    inside,
    keep_inside,
    node_text,
    outer_html,
    outermost,
    with_nodes,
)
from vitrine.schemas import Shop

# A page without any of these strings cannot pass the product-page test, so it is
# dropped before it is cut into nodes.  References such as &#45; may spell them too.
MAYBE_PRODUCT = (
    r"(?i)og:type|single-product|product-template-default|product_title"
    r"|&(?:#|colon|hyphen|dash|lowbar|UnderBar)"
)


def maybe_product_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Cheap superset of the product pages, tested on the raw HTML at the scan."""
    return pages.where(f"{html} RLIKE {lit(MAYBE_PRODUCT)}")


def page_metas(elems: str) -> str:
    """``meta`` elements as ``struct(property, name, content, raw)``; ``content`` is cleaned."""
    return each(
        keep(elems, lambda e: f"{e}.tag = 'meta'"),
        lambda m: f"""named_struct('property', {attr(m, 'property')}, 'name', {attr(m, 'name')},
            'content', {clean_text(attr(m, 'content'))}, 'raw', {attr(m, 'content')})""",
    )


def meta(prop: str, metas: str = "metas") -> str:
    """``meta[property=…]``, else ``meta[name=…]``; an empty property tag still wins."""
    by = [first(keep(metas, lambda m, k=key: f"{m}.{k} = {lit(prop)}")) for key in ("property", "name")]
    return f"coalesce(coalesce({by[0]}, {by[1]}).content, '')"


def first_element(elems: str, test) -> str:
    return first(keep(elems, test))


def _link(rel: str) -> str:
    """href of the first ``link`` with the relation."""
    found = first_element(
        "elems", lambda e: f"{e}.tag = 'link' AND array_contains(split({attr(e, 'rel')}, '\\\\s+'), {lit(rel)})"
    )
    return attr(f"{found}", "href")


def is_product_page() -> str:
    """Product by declared type, by body class, or by title plus product furniture."""
    furniture = any_of(
        "elems",
        lambda e: f"""{e}.tag = 'form' AND ({has_class(e, 'cart')} OR {has_class(e, 'variations_form')})
            OR {has_class(e, 'product_meta')} OR {has_class(e, 'woocommerce-product-gallery')}""",
    )
    return f"""(lower({meta('og:type')}) = 'product'
        OR arrays_overlap(coalesce(body_classes, array()), array('single-product', 'product-template-default'))
        OR h1 IS NOT NULL AND ({meta('product:price:amount')} <> '' OR {furniture}))"""


def block_lines(nodes: str, element: str) -> str:
    """Distinct cleaned text lines of an element, without scripts, forms and buttons."""

    def lines(below: str) -> str:
        def texts(dropped: str) -> str:
            shown = keep(
                below,
                lambda n: f"{n}.kind = 't' AND NOT {inside(n, dropped)}",
            )
            pieces = f"flatten({each(shown, lambda n: f'split({n}.text, {lit(LINE_BREAKS)})')})"
            return unique_filled(each(pieces, lambda p: squeeze(unescape(squeeze(p)))))

        return bind(outermost(keep(below, lambda n: f"{n}.kind = 'o' AND {n}.tag IN ('noscript', 'form', 'button')")), texts)

    return let(content(nodes, element), lines)


def block_text(nodes: str, element: str) -> str:
    return f"array_join({block_lines(nodes, element)}, '\\n')"


def _in_class(name: str, test) -> str:
    """Elements that pass the test inside an element of the class, in page order."""
    return keep_inside("elems", keep("elems", lambda e: has_class(e, name)), test)


def title() -> str:
    doc_title = first_element("elems", lambda e: f"{e}.tag = 'title'")
    # a meta value was decoded in its attribute and when read; like any text it is decoded once more when cleaned
    fallback = first_filled(unescape(meta("og:title")), let(doc_title, lambda t: node_text("nodes", t)))
    raw = f"CASE WHEN h1 IS NOT NULL THEN {node_text('nodes', 'h1')} ELSE {fallback} END"
    return clean_text(raw, fixed.TITLE_LIMIT, decode=0)


def brand() -> str:
    block = "pwb-single-product-brands"
    by_link = f"{clean_text(attr(first(_in_class(block, lambda e: f'{e}.tag = {lit("a")} AND {attr(e, "title")} IS NOT NULL')), 'title'))}"
    by_image = f"{clean_text(attr(first(_in_class(block, lambda e: f'{e}.tag = {lit("img")} AND {attr(e, "alt")} IS NOT NULL')), 'alt'))}"
    return first_filled(meta("product:brand"), by_link, by_image)


def sku() -> str:
    wrappers = keep("elems", lambda e: has_class(e, "sku_wrapper"))
    marked = bind(
        outermost(wrappers),
        lambda w: keep("elems", lambda e: f"{has_class(e, 'sku')} AND ({e}.tag = 'span' OR {inside(e, w)})"),
    )
    values = each(marked, lambda e: clean_text(node_text("nodes", e), decode=0))
    real = keep(values, lambda v: f"{v} <> '' AND lower({v}) NOT IN ({lits(fixed.PLACEHOLDER_SKUS)})")
    short = f"regexp_extract({_link('shortlink')}, '[?&]p=(\\\\d+)', 1)"
    return first_filled(meta("product:retailer_item_id"), first(real), short)


def categories() -> str:
    links = _in_class(
        "posted_in",
        lambda e: f"""{e}.tag = 'a' AND ({attr(e, 'rel')} = 'tag'
            OR contains({attr(e, 'href')}, {lit(fixed.CATEGORY_FRAGMENT)}))""",
    )
    names = keep(
        each(links, lambda e: clean_text(node_text("nodes", e), decode=0)),
        lambda n: f"{n} <> '' AND lower({n}) NOT IN ({lits(fixed.SHOP_ROOT_CATEGORIES)})",
    )
    by_class = each(
        keep("coalesce(body_classes, array())", lambda c: f"startswith({c}, 'product_cat-')"),
        lambda c: f"replace(replace({c}, 'product_cat-', ''), '-', ' ')",
    )
    chosen = let(names, lambda n: f"CASE WHEN size({n}) > 0 THEN {n} ELSE {by_class} END")
    return unique_filled(each(chosen, lambda c: clean_text(c)))


_DESCRIPTION_BLOCKS = (
    lambda e: has_class(e, "woocommerce-product-details__short-description"),
    lambda e: f"{attr(e, 'id')} = 'tab-description'",
    lambda e: has_class(e, "woocommerce-Tabs-panel--description"),
)


def description_blocks() -> str:
    """``array<struct(text, items)>`` of the description elements that exist."""

    def block(e: str) -> str:
        items = keep(content("nodes", e), lambda n: f"{n}.kind = 'o' AND {n}.tag = 'li'")
        texts = each(items, lambda li: clean_text(node_text("nodes", li), fixed.NOTE_LIMIT, decode=0))
        long_enough = keep(texts, lambda t: f"length({t}) >= {fixed.LIST_ITEM_MIN_LENGTH}")
        return f"named_struct('text', {block_text('nodes', e)}, 'items', {long_enough})"

    found = ", ".join(first_element("elems", test) for test in _DESCRIPTION_BLOCKS)
    return each(keep(f"array({found})", lambda e: f"{e} IS NOT NULL"), block)


def _meta_description() -> str:
    return clean_text(first_filled(meta("og:description"), meta("description")))


def description(blocks: str = "blocks") -> str:
    """Distinct block texts with a blank line between; else the meta description."""
    parts = unique_filled(each(blocks, lambda b: clean_text(f"{b}.text")))
    return first_filled(f"array_join({parts}, '\\n\\n')", _meta_description())


def notes(blocks: str = "blocks") -> str:
    """Short notes from the block texts and their list items, else from the meta description."""
    own = f"""flatten({each(blocks, lambda b: f"concat(CASE WHEN {b}.text <> '' THEN array({b}.text) "
        f"ELSE CAST(array() AS ARRAY<STRING>) END, {b}.items)")})"""
    no_text = f"NOT {any_of(blocks, lambda b: f'{b}.text <> {lit("")}')}"
    spare = f"CASE WHEN {no_text} THEN array({_meta_description()}) ELSE CAST(array() AS ARRAY<STRING>) END"
    return pick_notes(f"concat({own}, {spare})")


def images(shop: Shop) -> str:
    """Gallery links, gallery pictures, then the meta image; originals, first ten."""
    gallery = "woocommerce-product-gallery"
    links = each(
        _in_class(gallery, lambda e: f"{e}.tag = 'a' AND {attr(e, 'href')} IS NOT NULL"), lambda e: attr(e, "href")
    )
    pictures = each(
        _in_class(gallery, lambda e: f"{e}.tag = 'img'"),
        lambda e: first_filled(*[attr(e, a) for a in ("data-large_image", "data-src", "src")]),
    )
    shared = each(keep("metas", lambda m: f"{m}.property = 'og:image'"), lambda m: f"{m}.raw")
    urls = each(f"concat({links}, {pictures}, {shared})", lambda u: normalize_image_url(u, lit(shop.base_url)))
    wanted = keep(urls, lambda u: f"{u} <> '' AND NOT {is_shop_furniture(u)}")
    return f"slice({unique_filled(each(wanted, lambda u: clean_text(u)))}, 1, {fixed.MAX_IMAGES})"


def price() -> str:
    """Meta amount, else the reduced price, else the price block's HTML, else its text."""

    def priced(e: str) -> str:
        return f"({e}.tag = 'p' AND {has_class(e, 'price')} OR {has_class(e, 'main-price')})"

    def block_test(e: str) -> str:
        return f"""({e}.tag = 'p' AND ({has_class(e, 'price')} OR {has_class(e, 'main-price')})
            OR {e}.tag = 'span' AND {has_class(e, 'price')})"""

    stated = f"round(try_cast(replace({missing(meta('product:price:amount'))}, ',', '.') AS DOUBLE), 2)"
    reduced_scopes = keep_inside("elems", keep("elems", priced), lambda e: f"{e}.tag = 'ins'")
    reduced = first(keep_inside("elems", reduced_scopes, lambda e: has_class(e, "woocommerce-Price-amount")))
    by_reduced = let(reduced, lambda e: parse_price(node_text("nodes", e), decode=0))
    by_block = let(
        first_element("elems", block_test),
        lambda e: f"""coalesce(nullif({parse_price(outer_html('nodes', e), decode=2)}, 0D),
            {parse_price(node_text('nodes', e), decode=0)})""",
    )
    return f"coalesce({stated}, {by_reduced}, {by_block})"


def canonical_url(shop: Shop, url: str = "url", absolute: bool = False) -> str:
    """The page's stated address, else ``url``, which is taken as it is when it is ``absolute`` already."""
    stated = [_link("canonical"), meta("og:url")]
    if absolute:
        return first_filled(normalize_url(first_filled(*stated), lit(shop.base_url)), url)
    return normalize_url(first_filled(*stated, url), lit(shop.base_url))


def availability() -> str:
    return first_filled(meta("product:availability"), meta("og:availability"))


def keywords(categories_expr: str, brand_expr: str) -> str:
    """Categories and brand, distinct, joined."""
    return f"array_join({unique_filled(f'concat({categories_expr}, array({brand_expr}))')}, ' | ')"


def with_elements(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Nodes, elements, metas, body classes, product title and the product-page flag."""
    others = [f"`{c}`" for c in pages.columns if c != html]
    noded = with_nodes(pages, html).selectExpr(*others, "nodes", f"{elements('nodes')} AS elems")
    body = first_element("elems", lambda e: f"{e}.tag = 'body'")
    h1 = first_element("elems", lambda e: f"{e}.tag = 'h1' AND {has_class(e, 'product_title')}")
    picked = noded.selectExpr(
        *others, "nodes", "elems", f"{page_metas('elems')} AS metas", f"{body}.classes AS body_classes", f"{h1} AS h1"
    )
    return picked.selectExpr("*", f"{is_product_page()} AS is_product")


def where_kept(frame: DataFrame, test: str) -> DataFrame:
    """Filter by a column that was costly to compute.

    A plain filter would be pushed below the projections, with a copy of all the
    expressions behind the column; unfolding a one-element array is not.
    """
    kept = frame.selectExpr("*", f"explode(CASE WHEN {test} THEN array(true) END) AS __kept")
    return kept.drop("__kept")


def product_facts(pages: DataFrame, shop: Shop, absolute: bool = False) -> DataFrame:
    """Facts of every page; on pages that are no product pages they are empty.

    ``absolute``: the pages' addresses are normalized already and must not be decoded again.
    """
    others = [f"`{c}`" for c in pages.columns if c != "html"]
    flagged = with_elements(pages)
    # without nodes the expressions below have nothing to do
    emptied = flagged.selectExpr(
        *others,
        "is_product",
        "body_classes",
        "metas",
        "h1",
        "CASE WHEN is_product THEN nodes END AS nodes",
        "CASE WHEN is_product THEN elems END AS elems",
    )
    blocks = emptied.selectExpr("*", f"{description_blocks()} AS blocks")
    facts = blocks.selectExpr(
        *others,
        "is_product",
        "nodes",
        "elems",
        f"{canonical_url(shop, absolute=absolute)} AS product_url",
        f"{title()} AS title",
        f"{brand()} AS brand",
        f"{sku()} AS own_sku",
        f"{categories()} AS categories",
        f"{description()} AS item_description",
        f"{notes()} AS item_notes",
        f"{images(shop)} AS base_images",
        f"{price()} AS base_price",
        f"{availability()} AS availability",
    )
    return facts.selectExpr(
        "*",
        f"{first_filled('own_sku', slug_from_url('product_url'))} AS listing_id",
        f"{keywords('categories', 'brand')} AS keyword_attributes",
    )
