"""Variations of a product page, and the product rows of a page."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine import fixed
from vitrine.functions.content import find_size, variant_type
from vitrine.functions.sqltext import bind, each, first, first_filled, keep, leading, let, lit, missing
from vitrine.functions.text import clean_text, json_object, title_case, unescape, unique_filled
from vitrine.functions.urls import is_shop_furniture, normalize_image_url
from vitrine.operators.facts import maybe_product_pages, product_facts
from vitrine.operators.nodes import attr, content, has_class, node_text
from vitrine.schemas import PRODUCT_ROW, VARIATIONS, Shop


def parse_variations(raw: str) -> str:
    """Escaped JSON text to an array of variations; NULL when it is broken or absent."""
    return f"from_json({missing(unescape(raw))}, {lit(VARIATIONS)})"


#: JSON values that count as unset: null, false, zero and everything empty.
UNSET = r"""^(?:null|false|-?0(?:[.]0*)?(?:[eE].*)?|""|\[\]|\{\})$"""


def visible_variations(variations: str) -> str:
    """Variations that are both visible and active; a flag that is absent counts as set, JSON null as unset."""
    shown = " AND ".join(
        f"coalesce(to_json({{v}}.{flag}) NOT RLIKE {lit(UNSET)}, true)"
        for flag in ("variation_is_visible", "variation_is_active")
    )
    return keep(f"coalesce({variations}, array())", lambda v: shown.replace("{v}", v))


def option_tables(form: str = "form") -> str:
    """``array<struct(attribute, label, options)>`` for the attribute selects of the form.

    The label is the first ``label`` of the innermost table row around the select,
    else it is made from the select's id.
    """
    rows = keep("elems", lambda e: f"{e}.tag = 'tr'")

    def table(s: str) -> str:
        around = keep(rows, lambda r: f"{r}.ord < {s}.ord AND {s}.ord < {r}.end")
        label = let(
            f"try_element_at({around}, -1)",
            lambda r: let(
                first(keep(content("nodes", r), lambda n: f"{n}.kind = 'o' AND {n}.tag = 'label'")),
                lambda el: clean_text(node_text("nodes", el), decode=0),
            ),
        )
        by_id = title_case(f"replace(replace({attr(s, 'id')}, 'pa_', ''), '_', ' ')")
        options = keep(
            content("nodes", s), lambda n: f"{n}.kind = 'o' AND {n}.tag = 'option' AND {attr(n, 'value')} <> ''"
        )
        pairs = each(
            options,
            lambda o: f"""named_struct('slug', {attr(o, 'value')},
                'label', {clean_text(node_text('nodes', o), decode=0)})""",
        )
        name = first_filled(attr(s, "data-attribute_name"), attr(s, "name"), attr(s, "id"))
        return f"named_struct('attribute', {name}, 'label', {first_filled(label, by_id)}, 'options', {pairs})"

    selects = keep(
        content("nodes", form),
        lambda n: f"{n}.kind = 'o' AND {n}.tag = 'select' AND startswith({attr(n, 'name')}, 'attribute_')",
    )
    return each(selects, table)


def label_index(tables: str = "tables") -> str:
    """``array<struct<key, place, label>>`` of a page's labels, sorted: of an attribute by its name, of an option by name and slug."""
    none = "CAST(array() AS ARRAY<STRUCT<key: STRING, place: INT, label: STRING>>)"

    def entry(key: str, label: str) -> str:
        return f"named_struct('key', {key}, 'place', 0, 'label', {label})"

    def of_table(t: str) -> str:
        options = each(f"{t}.options", lambda o: entry(f"{_option_key(f'{t}.attribute', f'{o}.slug')}", f"{o}.label"))
        return f"concat(array({entry(f'{t}.attribute', f'{t}.label')}), {options})"

    # of tables with one name the last one counts whole, so options of the ones before must not be found
    last = bind(tables, lambda all_: f"filter({all_}, (t, i) -> NOT exists(slice({all_}, i + 2, size({all_})), u -> u.attribute = t.attribute))")
    listed = f"flatten({each(last, of_table)})"
    return f"coalesce(sort_array(transform({listed}, (e, i) -> named_struct('key', e.key, 'place', i, 'label', e.label))), {none})"


def _option_key(attribute: str, slug: str) -> str:
    return f"concat({attribute}, chr(0), {slug})"


def label_of(key: str, index: str) -> str:
    """Label of the last entry of the key by bisection, NULL without one; ``index`` is a name."""
    until = leading(index, lambda e: f"{e}.key <= {key}")
    return let(until, lambda n: f"CASE WHEN {n} > 0 AND {index}[{n} - 1].key = {key} THEN {index}[{n} - 1].label END")


def attribute_pairs(attributes: str, index: str = "labels") -> str:
    """``array<struct(type, value)>`` for the attributes of one variation, in their order."""

    def labelled(e: str) -> str:
        plain = f"replace(replace(replace({e}.key, 'attribute_pa_', ''), 'attribute_', ''), '_', ' ')"
        label = first_filled(let(f"{e}.key", lambda k: label_of(k, index)), title_case(plain))
        listed = let(_option_key(f"{e}.key", f"{e}.value"), lambda k: label_of(k, index))
        value = first_filled(listed, clean_text(f"replace({e}.value, '-', ' ')"))
        return f"named_struct('label', {label}, 'value', {value})"

    return each(
        each(f"map_entries({attributes})", labelled),
        lambda p: f"named_struct('type', {variant_type(f'{p}.label', f'{p}.value')}, 'value', {p}.value)",
    )


def with_variations(facts: DataFrame) -> DataFrame:
    """Add ``variations``: the visible ones with their type/value pairs."""
    form = first(keep("elems", lambda e: f"{e}.tag = 'form' AND {has_class(e, 'variations_form')}"))
    formed = facts.selectExpr("*", f"{form} AS form")
    parsed = formed.selectExpr(
        "*",
        f"{visible_variations(parse_variations(attr('form', 'data-product_variations')))} AS raw_variations",
    )
    tabled = parsed.selectExpr("*", f"CASE WHEN size(raw_variations) > 0 THEN {option_tables()} END AS tables")
    keep_columns = [f"`{c}`" for c in facts.columns if c not in ("nodes", "elems")]
    pairs = attribute_pairs("v.attributes", "labels")
    variations = f"""transform(raw_variations, (v, i) -> named_struct('idx', i + 1, 'variation', v,
            'attributes', coalesce(map_entries(v.attributes), array()),
            'pairs', coalesce({missing_pairs(pairs)}, array(named_struct('type', {lit(fixed.TYPE_OTHER)},
                'value', CAST(i + 1 AS STRING))))))"""
    # bound once a page: as a column the optimizer might sort the labels anew for every attribute
    indexed = f"aggregate(CAST(array() AS ARRAY<INT>), {label_index()}, (a, i) -> a, labels -> {variations})"
    return tabled.selectExpr(*keep_columns, f"{indexed} AS variations")


def missing_pairs(pairs: str) -> str:
    """NULL when a variation names no attribute."""
    return let(pairs, lambda p: f"CASE WHEN size({p}) > 0 THEN {p} END")


def _variation_images(shop: Shop) -> str:
    own = first_filled("v.variation.image.full_src", "v.variation.image.url", "v.variation.image.src")
    own = clean_text(normalize_image_url(own, lit(shop.base_url)))
    every = unique_filled(f"concat(array({own}), base_images)")
    return f"slice({keep(every, lambda u: f'NOT {is_shop_furniture(u)}')}, 1, {fixed.MAX_IMAGES})"


def _row(**fields: str) -> str:
    """A struct with the product-row fields, shared page facts filled in."""
    shared = {
        "product_url": "product_url",
        "listing_id": "listing_id",
        "category": "category",
        "brand": "brand",
        "trademark": "brand",
        "item_notes": "item_notes",
        "item_description": "item_description",
        "keyword_attributes": "keyword_attributes",
        "total_net_content": "''",
        "availability": "availability",
    }
    shared.update(fields)
    return "named_struct(" + ", ".join(f"'{c}', {shared[c]}" for c in PRODUCT_ROW.names) + ")"


def _variable_row(shop: Shop) -> str:
    def sized(v: str) -> str:
        values = each("v.pairs", lambda p: f"{p}.value")
        shown = f"array_join({keep(values, lambda x: f'{x} <> {lit("")}')}, ', ')"
        size = find_size(f"concat(array_join({values}, ' '), ' ', title)")
        return f"named_struct('shown', {shown}, 'size', {size})"

    def row(s: str) -> str:
        longer = clean_text(f"concat(title, ' - ', {s}.shown)", fixed.TITLE_LIMIT)
        return _row(
            seller_sku=first_filled(clean_text("v.variation.sku"), "concat(listing_id, '-', v.idx)"),
            item_name=f"""CASE WHEN {s}.shown <> '' AND NOT contains(lower(title), lower({s}.shown))
                THEN {longer} ELSE title END""",
            variation_type_1="v.pairs[0].type",
            variation_variant_1="v.pairs[0].value",
            variation_type_2="coalesce(get(v.pairs, 1).type, '')",
            variation_variant_2="coalesce(get(v.pairs, 1).value, '')",
            images=_variation_images(shop),
            map_price="coalesce(round(try_cast(v.variation.display_price AS DOUBLE), 2), base_price)",
            net_content=f"{s}.size.number",
            net_content_unit=f"{s}.size.unit",
            raw_variation=json_object("v.attributes"),
        )

    return let(sized("v"), row)


def _simple_row() -> str:
    return _row(
        seller_sku="listing_id",
        item_name="title",
        variation_type_1=f"CASE WHEN size.display <> '' THEN {lit(fixed.TYPE_SIZE)} ELSE {lit(fixed.TYPE_OTHER)} END",
        variation_variant_1=f"CASE WHEN size.display <> '' THEN size.display ELSE {lit(fixed.STANDARD_VARIANT)} END",
        variation_type_2="''",
        variation_variant_2="''",
        images="base_images",
        map_price="base_price",
        net_content="size.number",
        net_content_unit="size.unit",
        raw_variation="''",
    )


def product_rows(pages: DataFrame, shop: Shop, order: str = "page_id", absolute: bool = False) -> DataFrame:
    """Pages to product rows, one per sellable item, with ``(url_ord, var_idx)`` as their order.

    ``absolute``: the pages' addresses are normalized already.

    One narrow stage from scan to rows: a page's rows are built as an array in its
    own row and then unfolded, variable and simple products alike.
    """
    candidates = maybe_product_pages(pages).selectExpr(f"CAST({order} AS BIGINT) AS url_ord", "url", "html")
    facts = with_variations(product_facts(candidates, shop, absolute))
    ready = facts.selectExpr("*", "array_join(categories, ' | ') AS category", f"{find_size('title')} AS size")
    variable = f"transform(variations, v -> {_variable_row(shop)})"
    rows = f"CASE WHEN size(variations) > 0 THEN {variable} ELSE array({_simple_row()}) END"
    # unfolding an expression (not a column) keeps the page test out of the filters
    # that the optimizer would copy below the node building
    return ready.selectExpr(
        "url_ord", f"posexplode(CASE WHEN is_product THEN {rows} END) AS (pos, row)"
    ).selectExpr("url_ord", "pos + 1 AS var_idx", "row.*")
