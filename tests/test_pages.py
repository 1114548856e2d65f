"""Hand-written pages, one per branch of the extraction; plus node scopes on broken HTML."""

import time

import pytest

from vitrine.operators.nodes import page_nodes
from vitrine.operators.variants import product_rows
from vitrine.schemas import PAGES, Shop

SHOP = Shop("https://shop.example/")
H1 = '<h1 class="product_title">Гел</h1>'
PRODUCT = '<meta property="og:type" content="product">'


def variable(json, extra=""):
    escaped = json.replace("&", "&amp;").replace('"', "&quot;")
    return f'<body>{PRODUCT}{H1}<form class="variations_form" data-product_variations="{escaped}">{extra}</form>'


CASES = {
    "body_class": '<body class="x single-product product_cat-a-b product_cat-c"><h1 class="product_title">Гел 2 кг</h1>',
    "title_and_form": f'<body>{H1}<form class="cart"></form>',
    "title_only": f"<body>{H1}<p>single-product</p>",
    "blog_with_cards": '<meta property="og:type" content="article"><body><h2 class="product_title">x</h2><form class="cart">',
    "sale_price": f'<body>{PRODUCT}{H1}<p class="price"><del><span class="woocommerce-Price-amount">9 €</span></del>'
    '<ins><span class="woocommerce-Price-amount">7,50 €</span></ins></p>',
    "bad_meta_price": f'<body>{PRODUCT}<meta property="product:price:amount" content="free">{H1}<span class="price">3 лв. / 1.60 EUR</span>',
    "placeholder_sku": f'<link rel="shortlink" href="/?x=1&amp;p=77"><body>{PRODUCT}{H1}<span class="sku">N/A</span>',
    "empty_property_wins": f'<meta property="product:brand" content=""><meta name="product:brand" content="B"><body>{PRODUCT}{H1}'
    '<div class="pwb-single-product-brands"><a title="">x<img alt="Марка"></a></div>',
    "meta_description": f'<meta name="description" content="Дълго описание на гел."><body>{PRODUCT}{H1}<div id="tab-description"> <script>x</script></div>',
    "inline_tags_split_lines": f'<body>{PRODUCT}{H1}<div id="tab-description"><p>едно <b>две</b> три <b>две</b><br>край<noscript>n</noscript></p></div>',
    "hidden_variations": variable(
        '[{"variation_is_visible":false,"sku":"h"},{"variation_is_active":false,"sku":"i"},{"sku":"v","attributes":{"attribute_pa_cvyat":"tamno-sin"}}]'
    ),
    "broken_json": variable('[{"sku":"v"'),
    "no_attributes": variable('[{"sku":12,"attributes":[],"image":false,"display_price":"x"},{"attributes":{"a":""}}]'),
    "order_and_labels": variable(
        '[{"attributes":{"attribute_z":"1","attribute_pa_a":"b-c"},"display_price":2.5}]',
        '<table><tr><th class="label"><label>Аромат:</label></th><td><select name="attribute_z"><option value="1">Роза</table>'
        '<select name="attribute_pa_a" id="pa_big_box"></select>',
    ),
    "double_encoded": f"<title>t</title><body>{PRODUCT}<h1 class='product_title'>A &amp;amp; B &#1042;&nbsp;</h1>",
}


@pytest.fixture(scope="module")
def rows(spark):
    pages = spark.createDataFrame(
        [(i, f"https://shop.example/{name}/", html) for i, (name, html) in enumerate(CASES.items())], PAGES
    )
    out = {name: [] for name in CASES}
    names = list(CASES)
    for r in product_rows(pages, SHOP).orderBy("url_ord", "var_idx").collect():
        out[names[r.url_ord]].append(r)
    return out


def test_page_test(rows):
    assert not rows["title_only"] and not rows["blog_with_cards"]
    assert len(rows["body_class"]) == len(rows["title_and_form"]) == 1


def test_simple_facts(rows):
    r = rows["body_class"][0]
    assert (r.category, r.variation_type_1, r.variation_variant_1, r.net_content, r.net_content_unit) == (
        "a b | c", "Обем", "2 кг", "2", "kg")
    assert (r.product_url, r.listing_id, r.seller_sku) == ("https://shop.example/body_class/", "body_class", "body_class")
    assert rows["title_and_form"][0].variation_variant_1 == "Стандартен" and rows["title_and_form"][0].map_price is None
    assert rows["sale_price"][0].map_price == 7.5 and rows["bad_meta_price"][0].map_price == 1.6
    assert rows["placeholder_sku"][0].listing_id == "77"
    assert rows["empty_property_wins"][0].brand == "Марка"
    assert rows["double_encoded"][0].item_name == "A & B В"


def test_descriptions(rows):
    r = rows["meta_description"][0]
    assert r.item_description == "Дълго описание на гел." and r.item_notes == ["Дълго описание на гел."]
    assert rows["inline_tags_split_lines"][0].item_description == "едно две три край"


def test_variations(rows):
    (only,) = rows["hidden_variations"]
    assert (only.seller_sku, only.variation_type_1, only.variation_variant_1) == ("v", "Cvyat", "tamno sin")
    assert only.item_name == "Гел - tamno sin"
    (simple,) = rows["broken_json"]
    assert simple.raw_variation == "" and simple.seller_sku == "broken_json"
    first, second = rows["no_attributes"]
    assert (first.seller_sku, first.variation_type_1, first.variation_variant_1, first.raw_variation) == ("12", "Вариант", "1", "{}")
    assert (second.seller_sku, second.variation_variant_1, second.item_name) == ("no_attributes-2", "", "Гел")
    (two,) = rows["order_and_labels"]
    assert (two.variation_type_1, two.variation_variant_1) == ("Аромат", "Роза")
    assert (two.variation_type_2, two.variation_variant_2, two.map_price) == ("Big Box", "b c", 2.5)
    assert two.raw_variation == '{"attribute_z": "1", "attribute_pa_a": "b-c"}'


def test_scopes_of_broken_html(spark):
    html = "<div><p>a<p>b<b>c</div>d<ul><li>1<li>2<ul><li>3</ul><li>4</ul><b>open</p></i>" + "<i>x</i>" * 300
    nodes = page_nodes(spark.createDataFrame([(1, "u", html)], PAGES)).collect()
    scope = {(n.tag, n.ord): n.end for n in nodes if n.kind == "o"}
    assert [(t, o, e) for (t, o), e in scope.items()][:10] == [
        ("div", 0, 7), ("p", 1, 3), ("p", 3, 7), ("b", 5, 7), ("ul", 9, 20), ("li", 10, 12), ("li", 12, 18),
        ("ul", 14, 17), ("li", 15, 17), ("li", 18, 20)]
    assert scope[("b", 21)] == len(nodes) and all(scope[k] == k[1] + 2 for k in scope if k[0] == "i")


@pytest.mark.parametrize("tag", ["b", "div"])
def test_scopes_of_deep_pages_grow_with_their_tags(spark, tag):
    def seconds(n):
        page = spark.createDataFrame([(1, "x", "<html><body>" + f"<{tag}>x" * n)], PAGES)
        started = time.time()
        assert page_nodes(page).selectExpr("count(end) AS n").first().n == 2 * n + 2
        return time.time() - started

    seconds(50)
    small, large = seconds(2000), seconds(8000)
    assert large < 8 * small + 8


def test_title_is_decoded_three_times(spark):
    html = f'{PRODUCT}<meta property="og:title" content="a &amp;amp;amp; b"><meta property="og:image" content="/i.jpg">'
    assert product_rows(spark.createDataFrame([(1, "u", html)], PAGES), SHOP).first().item_name == "a & b"


def test_flags_by_their_json_type(spark):
    flags = {"null": 0, "false": 0, "0": 0, "0.0": 0, '""': 0, "[]": 0, "{}": 0, "true": 1, "1": 1, '"false"': 1, '"0"': 1}
    json = "[" + ", ".join(f'{{"variation_is_visible": {f}, "sku": "s{i}"}}' for i, f in enumerate(flags)) + "]"
    rows = product_rows(spark.createDataFrame([(1, "u", variable(json))], PAGES), SHOP).collect()
    assert [r.seller_sku for r in rows] == [f"s{i}" for i, shown in enumerate(flags.values()) if shown]


def test_variations_false_is_a_simple_product(spark):
    rows = product_rows(spark.createDataFrame([(1, "u", variable("false"))], PAGES), SHOP).collect()
    assert len(rows) == 1 and rows[0].raw_variation == ""


def test_ends_of_elements_without_tags_inside(spark):
    """Their ends come from the next tag, and their openings still end what they end."""
    from vitrine.operators.nodes import page_nodes

    odd = "<p>a<p>b</p><b>c</b><b></i></b><li>d</li><ul><li>e<li>f</li></ul><B>g</b><br></br><h1></h1></h1><i><i>h</i></i><td>x</td></td>"
    got = page_nodes(spark.createDataFrame([(1, odd)], "page_id bigint, html string")).where("kind = 'o'").orderBy("ord")
    assert [(r["tag"], r["ord"], r["end"]) for r in got.collect()] == [
        ("p", 0, 2), ("p", 2, 4), ("b", 5, 7), ("b", 8, 10), ("li", 11, 13), ("ul", 14, 20), ("li", 15, 17), ("li", 17, 19),
        ("b", 21, 23), ("h1", 26, 27), ("i", 29, 33), ("i", 30, 32), ("td", 34, 36),
    ]


def test_names_and_attributes_of_odd_tags(spark):
    html = "<P\n CLASS = \"x\ty\" id=z/><br / ></P q=1><script-x y><scripty a=1></!x><a b =1 c= 'd>e' f g==h><1><li"
    nodes = page_nodes(spark.createDataFrame([(1, "u", html)], PAGES)).orderBy("ord").collect()
    assert [(n.kind, n.tag, {a.k: a.v for a in n.attrs}) for n in nodes] == [
        ("v", "p", {"class": "x\ty", "id": "z/"}), ("v", "br", {}), ("c", "p", {}), ("x", "", {}), ("o", "scripty", {"a": "1"}),
        ("x", "", {}), ("o", "a", {"b": "1", "c": "d>e", "f": "", "g": "=h"}), ("t", "", {}), ("t", "", {}), ("t", "", {}),
    ]
    assert nodes[0].classes == ["x", "y"]


def test_tags_are_named_for_the_whole_page(spark):
    """Two passes over the page give tokens and names; no token meets a pattern of its own for its name."""
    from vitrine.operators.nodes import with_nodes

    plan = with_nodes(spark.createDataFrame([(1, "u", "<p>")], PAGES))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(" in plan and "'^</?([A-Za-z]" not in plan and "^</?([A-Za-z]" not in plan
    assert plan.count("regexp_extract_all(html") == 2
