"""Shop pages written from the ``part`` and ``supplier`` tables.

The driver's ``pages`` are articles; product operators need product pages.  Each
part becomes one page whose facts sit in a place that depends on its key (meta
tag, element, body class …), so that extraction has to walk every branch, while
the expected facts follow directly from the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.schemas import Shop

SHOP = Shop("https://shop.example/")
SITEMAP_SIZE = 1000
API_PAGE_SIZE = 100
LISTING_SIZE = 20
CATEGORY_SPAN = 2000
HOME_SPAN = 100 * CATEGORY_SPAN

_PRICE = "format_string('%.2f', p_retailprice)"


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with a supplier each and the page address."""
    return spark.sql(
        f"""SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, p_retailprice, s_name,
              concat('https://shop.example/p-', p_partkey, '-', replace(p_name, ' ', '-'), '/') AS url
            FROM (SELECT *, p_partkey % (SELECT count(*) FROM parquet.`{sf}/supplier.parquet`) AS sk
                  FROM parquet.`{sf}/part.parquet`)
            JOIN parquet.`{sf}/supplier.parquet` ON s_suppkey = sk"""
    )


def _meta(key: str, name: str, value: str) -> str:
    return f"concat('<meta {key}=\"{name}\" content=\"', {value}, '\">')"


def _variation(j: int) -> str:
    """JSON text of variation ``j``."""
    rest = {
        1: f"""concat('"display_price": ', format_string('%.2f', p_retailprice + 1), ', "sku": ', k * 10 + 1,
            ', "image": {{"full_src": "https://shop.example/img/', k, '-v1-600x600.jpg", "src": "/x.jpg"}}')""",
        2: """'"display_price": "abc", "sku": "", "image": false, "variation_is_visible": true'""",
        3: """concat('"image": {"src": "/img/', k, '-v3.jpg"}')""",
    }[j]
    return f"""concat('{{"attributes": {{"attribute_pa_obem": "{j}l", "attribute_color": "deep-{j}"}}, ', {rest}, '}}')"""


_HIDDEN = """'{"variation_is_visible": false, "attributes": {"attribute_pa_obem": "9l"}, "sku": "hidden"}'"""
_NULLED = """'{"variation_is_visible": null, "attributes": {"attribute_pa_obem": "8l"}, "sku": "nulled"}'"""
_INACTIVE = """'{"variation_is_active": false, "attributes": [], "sku": "inactive"}'"""


def _variation_form() -> str:
    third = f"CASE WHEN (k DIV 4) % 2 = 1 THEN concat(', ', {_variation(3)}) ELSE '' END"
    json = f"""concat('[', {_HIDDEN}, ', ', {_variation(1)}, ', ', {_variation(2)}, {third}, ', ', {_NULLED}, ', ', {_INACTIVE},
        CASE WHEN k % 12 = 5 THEN '' ELSE ']' END)"""
    escaped = f"replace(replace({json}, '&', '&amp;'), '\"', '&quot;')"
    return f"""concat('<form class="variations_form cart" data-product_variations="', {escaped}, '"><table><tr>',
        '<th class="label"><label for="o">Разфасовка</label></th><td><select name="attribute_pa_obem" id="pa_obem">',
        '<option value="">Избери</option><option value="1l">1 л.</option><option value="2l">2 л.<option value="3l">3&nbsp;л.',
        '</select></td></tr></table><div><select name="attribute_color" id="pa_main_color"><option value="">-</option>',
        '</select></div></form>')"""


def _page_html() -> str:
    link = "concat('/p-', k, '-', replace(p_name, ' ', '-'), '/')"
    head = f"""concat('<!DOCTYPE html><html lang="bg"><head><meta charset="utf-8"><title>Shop &mdash; ', p_name, '</title>',
        CASE WHEN k % 3 = 0 THEN concat({_meta('property', 'og:type', "'Product'")},
            {_meta('property', 'og:title', "concat(p_name, ' &amp;amp;amp; ', p_brand, ' ', p_size, ' мл')")}) ELSE '' END,
        CASE WHEN k % 5 < 3 THEN concat('<link rel="canonical" href="', {link}, '">')
             WHEN k % 5 = 3 THEN {_meta('property', 'og:url', 'url')} ELSE '' END,
        CASE WHEN (k DIV 2) % 3 = 0 THEN {_meta('property', 'product:brand', 'p_brand')} ELSE '' END,
        CASE WHEN (k DIV 3) % 4 = 0 THEN {_meta('name', 'product:retailer_item_id', "concat('R', k)")}
             WHEN (k DIV 3) % 4 = 2 THEN concat('<link rel="shortlink" href="https://shop.example/?p=', k, '">') ELSE '' END,
        CASE WHEN k % 5 = 0 THEN {_meta('property', 'product:price:amount', _PRICE)}
             WHEN k % 5 = 1 THEN {_meta('property', 'product:price:amount', f"replace({_PRICE}, '.', ',')")} ELSE '' END,
        CASE WHEN k % 4 IN (0, 2) THEN {_meta('property', 'product:availability', "'instock'")} ELSE '' END,
        CASE WHEN k % 4 IN (1, 2) THEN {_meta('property', 'og:availability', "'available for order'")} ELSE '' END,
        CASE WHEN k % 6 = 0 THEN {_meta('property', 'og:description',
            "concat(p_name, ' by ', s_name, '. Type ', p_type, ' goods &amp; more.')")} ELSE '' END,
        CASE WHEN k % 8 <> 3 THEN {_meta('property', 'og:image', "concat('//shop.example/img/', k, '-a.jpg')")} ELSE '' END,
        '<script>var t = "<h1 class=\\'product_title\\'>no</h1>";</script></head>')"""
    body_class = """concat('<body class="page', CASE WHEN k % 3 = 1 THEN ' single-product' ELSE '' END,
        CASE WHEN k % 7 = 0 THEN concat(' product_cat-', lower(p_type), '-goods') ELSE '' END, '">')"""
    heading = """CASE WHEN k % 3 = 0 THEN '<h1>Welcome</h1>'
        ELSE concat('<h1 class="entry-title product_title">', p_name, ' <span>&amp; ', p_brand, '</span>', CHR(10), p_size, ' мл</h1>') END"""
    price = f"""CASE k % 5
        WHEN 2 THEN concat('<p class="price"><del><span class="woocommerce-Price-amount amount">5.00 €</span></del> <ins>',
            '<span class="woocommerce-Price-amount amount">', replace({_PRICE}, '.', ','), '&nbsp;&euro;</span></ins></p>')
        WHEN 3 THEN concat('<p class="main-price"><span class="amount"><bdi>', {_PRICE}, '</bdi>&nbsp;€</span></p>')
        WHEN 4 THEN concat('<span class="price">', replace({_PRICE}, '.', ','), ' EUR</span>') ELSE '' END"""
    brand = """CASE (k DIV 2) % 3
        WHEN 1 THEN concat('<div class="pwb-single-product-brands"><a title="', s_name, '" href="/brand/x/">x</a></div>')
        WHEN 2 THEN concat('<div class="pwb-single-product-brands"><a href="/brand/x/"><img alt="', s_name, '" src="/b.png"></a></div>')
        ELSE '' END"""
    sku = """CASE (k DIV 3) % 4 WHEN 1 THEN concat('<span class="sku_wrapper">SKU: <b class="sku"> S', k % 500, ' </b></span>')
        WHEN 2 THEN '<span class="sku">Няма</span>' ELSE '' END"""
    categories = """CASE WHEN k % 7 = 0 THEN '' ELSE concat('<span class="posted_in">In: <a href="/c/1/" rel="tag">', p_type,
        '</a>, <a href="/cat/shop/">Магазин</a>, <a href="/cat/l/">', p_brand, ' line</a>, <a rel="tag" href="/c/1/">',
        p_type, '</a><a href="/other/">other</a></span>') END"""
    gallery = """CASE WHEN k % 8 = 3 THEN '' ELSE concat('<div class="woocommerce-product-gallery images"><a href="/img/', k,
        '-a-300x300.jpg"><img src="/img/', k, '-b-100x100.jpg.webp"></a><a href="https://cdn.shop.example/wp/webp-express/webp-images/',
        k, '-c.png.webp">full</a><a href="#">zoom</a><img data-src="/img/logo-', k, '.png" src="/img/', k, '-z.jpg"></div>') END"""
    text = """CASE WHEN k % 6 = 0 THEN '' ELSE concat('<div class="woocommerce-product-details__short-description"><p>', p_name,
        ' is a ', p_type, ' product. It is made by ', s_name, '!</p></div>',
        '<div id="tab-description" class="panel woocommerce-Tabs-panel--description"><h2>Описание</h2><p>Size is ', p_size,
        ' units<br>brand ', p_brand, ' here.</p><ul><li>Item ', p_name, ' one<li>Item ', p_type, ' two</ul>',
        '<script>var d = "</div>";</script><form>hidden <b>form</b></form><noscript>none</noscript><p>Size is ', p_size,
        ' units</p></div>') END"""
    form = f"""CASE WHEN k % 4 = 1 THEN {_variation_form()} ELSE '<form class="cart"><button>Buy</button></form>' END"""
    cards = """'<ul><li class="product"><a class="woocommerce-LoopProduct-link" href="/other-product/">Other</a>
        <span class="pwb-brands-in-loop"><a title="Loop brand">Loop</a></span></li></ul>'"""
    product = f"""concat({head}, {body_class}, {heading}, '<div class="summary">', {price}, {brand},
        '<div class="product_meta">', {sku}, {categories}, '</div></div>', {gallery}, {text}, {form}, {cards}, '</body></html>')"""
    blog = f"""concat('<html><head><meta property="og:type" content="article"><title>', p_name, '</title></head>',
        '<body class="single-post"><h1>', p_name, '</h1><h2 class="product_title">', p_brand, '</h2><form class="cart"></form>',
        '<p>Read about single-product shops.</p>', {cards}, '</body></html>')"""
    return f"CASE WHEN k % 10 = 9 THEN {blog} ELSE {product} END"


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """``(page_id, url, html)``, one page per part; every tenth is a blog page."""
    # page work is heavy and part rows are slim: spread the rows over all cores before the pages are written
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slim = parts(spark, sf).repartition(spread, "k")
    return slim.selectExpr("k AS page_id", "concat(url, '?ref=', k) AS url", f"{_page_html()} AS html")


# --- discovery bodies -----------------------------------------------------------
# Lists are collected per block of fixed size, so no body grows with the data.


def _loc_body(items: str) -> str:
    locs = f"transform(array_sort(collect_list(struct(place, {items} AS item))), x -> concat('<url><loc> ', x.item, ' </loc></url>'))"
    return f"concat('<?xml version=\"1.0\"?><urlset>', array_join({locs}, ''), '</urlset>')"


def sitemap_bodies(urls: DataFrame, prefix: str) -> DataFrame:
    """Leaf sitemaps ``{prefix}{block}.xml`` of ``(place, url)``."""
    escaped = "replace(url, '&', '&amp;')"
    return (
        urls.selectExpr(f"place DIV {SITEMAP_SIZE} AS block", "place", f"{escaped} AS item")
        .groupBy("block")
        .agg(_expr(_loc_body("item")).alias("body"))
        .selectExpr(f"concat('{prefix}', block, '.xml') AS url", "body")
    )


def sitemap_index(urls: DataFrame, prefix: str, name: str) -> DataFrame:
    """Index bodies that name every leaf, next to sitemaps that must not be followed."""
    blocks = urls.selectExpr(f"place DIV {SITEMAP_SIZE} AS place").distinct()
    names = blocks.selectExpr(
        f"place DIV {SITEMAP_SIZE} AS part",
        "place",
        f"concat('{prefix}', place, '.xml</loc><loc>https://shop.example/product_cat-product-sitemap', place,"
        " '.xml</loc><loc>https://shop.example/post-sitemap', place, '.xml') AS item",
    )
    return names.groupBy("part").agg(_expr(_loc_body("item")).alias("body")).selectExpr(
        f"CASE WHEN part = 0 THEN '{name}' ELSE replace('{name}', '.xml', concat(part, '.xml')) END AS url", "body"
    )


def api_bodies(urls: DataFrame) -> DataFrame:
    """API pages of ``(place, url)``, then an empty page, then one that must not be read."""
    pages = (
        urls.selectExpr(f"CAST(place DIV {API_PAGE_SIZE} + 1 AS INT) AS page_no", "place", "url")
        .groupBy("page_no")
        .agg(
            _expr(
                "to_json(transform(array_sort(collect_list(struct(place, url))), x -> named_struct('link', x.url)))"
            ).alias("body")
        )
    )
    last = pages.agg(_expr("max(page_no)").alias("last"))
    after = last.selectExpr(
        "explode(array(named_struct('page_no', last + 1, 'body', '[]'), "
        "named_struct('page_no', last + 2, 'body', '[{\"link\": \"https://shop.example/late/\"}]'))) AS p"
    ).selectExpr("p.page_no", "p.body")
    return pages.unionByName(after).selectExpr("page_no", "200 AS status", "1000000000 AS total_pages", "body")


def _category(k: str) -> str:
    return f"({k} % 10 + 10 * ({k} DIV {CATEGORY_SPAN}))"


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Category pages of 20 products; the last page of a category points back to its first."""
    placed = parts(spark, sf).selectExpr(
        f"{_category('k')} AS category", f"(k % {CATEGORY_SPAN} DIV 10) DIV {LISTING_SIZE} AS page", "k AS place", "url"
    )
    pages = placed.groupBy("category", "page").agg(
        _expr(
            """array_join(transform(array_sort(collect_list(struct(place, url))), x -> concat(
               '<li class="product type"><a class="woocommerce-LoopProduct-link" href="', replace(x.url, 'https://shop.example', ''),
               '">p</a><a href="/cart/?add=1">+</a></li>')), '')"""
        ).alias("items")
    )
    last = pages.groupBy("category").agg(_expr("max(page)").alias("last_page"))
    address = "concat('https://shop.example/cat/c', category, '/', {page}, '/')"
    next_href = f"CASE WHEN page < last_page THEN {address.format(page='page + 1')} ELSE {address.format(page=0)} END"
    link = f"""CASE WHEN category % 2 = 0 THEN concat('<link rel="next" href="', {next_href}, '">') ELSE '' END"""
    shown = f"""CASE WHEN category % 2 = 1 THEN concat('<a class="next page-numbers" href="', {next_href}, '">&rarr;</a>') ELSE '' END"""
    return pages.join(last, "category").selectExpr(
        f"{address.format(page='page')} AS url",
        f"""concat('<html><head>', {link}, '</head><body><a href="/outside/">o</a><ul>', items, '</ul>', {shown}, '</body></html>') AS html""",
    )


def home_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Home page with the category links, one row per block of categories."""
    categories = parts(spark, sf).selectExpr(f"{_category('k')} AS c", f"k DIV {HOME_SPAN} AS block").distinct()
    return categories.groupBy("block").agg(
        _expr(
            """concat('<html><body><a href="/about/">a</a>', array_join(transform(array_sort(collect_list(c)),
               x -> concat('<a href="/cat/c', x, '/0/">c</a>')), ''), '</body></html>')"""
        ).alias("html")
    ).selectExpr("block AS page_id", "'https://shop.example/' AS url", "html")


def _expr(sql: str):
    from pyspark.sql import functions as F

    return F.expr(sql)
