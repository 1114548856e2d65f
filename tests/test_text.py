"""Column expressions against the Python library or stated values."""

import html
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from vitrine.functions import content, text, urls
from vitrine.functions.sqltext import first_filled, lit, missing
from vitrine.functions.text import squeeze

ENTITIES = [
    "a &amp; b", "&amp;amp;", "&lt;p&gt;", "&euro; &EUR", "&copy &copyx &notit; &notin;", "&#8364;&#x20AC;",
    "&#0;&#128;&#x9F;&#129;", "&#xD800;&#x110000;&#99999999999;", "&#1;&#11;x", "&unknown; & &&", "&#;&#x;",
    "&quot;&apos;&nbsp;|", "&fjlig;&NotEqualTilde;", "&amp", "&ampersand", "plain", "", "&#13;", "&#38;lt;",
]


def one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(F.expr(expr("v"))).collect()]


def test_unescape_equals_standard_library(spark):
    assert one(spark, ENTITIES, text.unescape) == [html.unescape(v) for v in ENTITIES]
    twice = [html.unescape(html.unescape(v)) for v in ENTITIES]
    assert one(spark, ENTITIES, lambda c: text.unescape(c, 2)) == twice


def test_clean_and_truncate(spark):
    values = ["  a  \x1c b\n", None, "&nbsp;x&nbsp;", "abcdef  gh"]
    assert one(spark, values, text.clean_text) == ["a b", "", "x", "abcdef gh"]
    assert one(spark, ["abcde", "abcdef", "abcd fgh"], lambda c: text.clean_text(c, 5)) == ["abcde", "abcd…", "abcd…"]
    assert one(spark, ["abc  defgh"], lambda c: text.clean_text(c, 5)) == ["abc…"]


def test_title_case_as_python(spark):
    values = ["аромат на цвят", "l'eau de-x", "1лбутилка", "ABC def"]
    assert one(spark, values, text.title_case) == [v.title() for v in values]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("1,60 €", 1.6), ("1 234,56 €", 234.56), ("1 50 €", 150.0), ("12,00 € 10,00 €", 12.0),
        ("3.13 лв. / 1.60 EUR", 1.6), ("5 лв", None), ("", None), (None, None), ("7&nbsp;&euro;", 7.0), ("1\t50 €", None),
    ],
)
def test_price(spark, value, expected):
    assert one(spark, [value], content.parse_price) == [expected]


def test_sizes(spark):
    cases = {
        "500 мл": ("500 мл", "500", "ml"), "5 л.": ("5 л", "5", "l"), "1,5L": ("1.5 л", "1.5", "l"),
        "10 x 500 МЛ.": ("500 мл", "500", "ml"), "10x500мл": ("", "", ""), "500 грама": ("", "", ""),
        "2.5 кг": ("2.5 кг", "2.5", "kg"), "250гр.": ("250 г", "250", "g"), "3 литра сапун": ("3 л", "3", "l"),
        "20 милилитра": ("20 мл", "20", "ml"), "": ("", "", ""),
    }
    got = one(spark, list(cases), content.find_size)
    assert [tuple(g) for g in got] == list(cases.values())


def test_variant_types(spark):
    df = spark.createDataFrame(
        [("Аромат", "лавандула", "Аромат"), ("Color", "red", "Цвят"), ("Туба", "5 л.", "Обем"),
         ("Модел", "X", "Модел"), ("", "X", "Вариант"), ("Цвят", "мирис", "Аромат")],
        "l string, v string, e string",
    )
    assert all(r.e == r.g for r in df.select("e", F.expr(content.variant_type("l", "v")).alias("g")).collect())


def test_notes(spark):
    value = "Първо изречение тук. Второ! кратко • точка с текст - друга точка тук\nкрай на текста"
    got = one(spark, [value], lambda c: content.pick_notes(f"array({c})"))[0]
    assert got == ["Първо изречение тук.", "точка с текст", "друга точка тук край на текста"]


URLS = ["/a/b", "a", "../c", "./d", "//cdn.x/y", "https://o.x/z", "?q=1", "#f", "mailto:a@b", "a//b", "/a/../b/.", "",
        "a/../../g?x=/../y", "HTTP://UP.x/", "  /s  ", "..", "x/", "/a//b",
        "#", "?", "a#", "a?", "a?#f", "https:a", "https:/a", "http:a"]


@pytest.mark.parametrize("base", ["https://shop.example/cat/x/", "https://shop.example/p?q=2", "https://shop.example"])
def test_urls_resolve_as_python(spark, base):
    def expected(u):
        u2 = u.strip()
        if not u:
            return ""
        if u2.startswith("//"):
            return "https:" + u2
        return u2 if u2.lower().startswith(("http://", "https://")) else urljoin(base, u2)

    assert one(spark, URLS, lambda c: urls.normalize_url(c, lit(base))) == [expected(u) for u in URLS]


def test_images(spark):
    base = "https://shop.example/"
    got = one(
        spark,
        ["x-300x300.jpg", "x.jpg.webp", "/wp/webp-express/webp-images/a-64x800.png.webp", "y-301x300.jpg"],
        lambda c: urls.normalize_image_url(c, lit(base)),
    )
    assert got == [base + "x.jpg", base + "x.jpg", base + "wp/a.png", base + "y-301x300.jpg"]
    assert one(spark, ["https://a/LOGO-x.png", "https://a/b.png"], urls.is_shop_furniture) == [True, False]


def test_slugs_and_product_urls(spark):
    assert one(spark, ["https://h/a/b-c/", "https://h/", "https://h/x y!z?p=1"], urls.slug_from_url) == ["b-c", "product", "x-y-z"]
    values = ["https://shop.example/a", "https://shop.example/a/b", "https://shop.example/product/b", "https://x.org/a",
              "https://shop.example/", "https://myshop.example/a", "https://shop.example/CART-holder", "/rel"]
    got = one(spark, values, lambda c: urls.is_probable_product_url(c, "shop.example", lit("https://shop.example/")))
    assert got == [True, False, True, False, False, True, False, True]
    assert one(spark, ["№ 5 / a_b", "", "x" * 40, "-.-"], text.sku_suffix) == ["no-5-a_b", "variant", "x" * 28, "variant"]


def test_json_text(spark):
    df = spark.sql("""select map('b"x', '5\\n л', 'a', '\\\\') as m""")
    assert df.select(F.expr(text.json_object("map_entries(m)"))).first()[0] == '{"b\\"x": "5\\n л", "a": "\\\\"}'


def test_a_choice_stands_once_in_the_plan(spark):
    """``nullif`` would double a choice at every level of nesting, and with it the work."""
    nested = first_filled(first_filled(first_filled("concat(a, '-mark')", "b"), "c"), "d")
    frame = spark.createDataFrame([("", "", None, "d"), (None, "b", "c", "d")], "a string, b string, c string, d string")
    chosen = frame.selectExpr(f"{nested} AS chosen")
    assert [r.chosen for r in chosen.collect()] == ["-mark", "b"]
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("-mark") == 1
    assert [r.x for r in frame.selectExpr(f"{missing('a')} AS x").collect()] == [None, None]


def test_runs_of_blanks_of_every_kind(spark):
    blanks = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
    texts = [f"a{b}b {b} c{b}{b}d{b}" for b in blanks] + ["a\u200bb", "a!~\x84\xa1b", "\U0001f600  x y", " "]
    got = [r.x for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").selectExpr(f"{squeeze('t')} AS x").collect()]
    assert got[: len(blanks)] == ["a b c d"] * len(blanks)
    assert got[len(blanks) :] == ["a\u200bb", "a!~\x84\xa1b", "\U0001f600 x y", ""]
