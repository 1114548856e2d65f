"""The registered queries as plain SQL over the same tables.

For pages rendered from ``part`` and ``supplier`` the SQL never looks at HTML: it
states what each page says straight from the columns, so a match shows that the
extraction found it.
"""

from __future__ import annotations

from vitrine import fixed

# --- facts of the rendered pages ------------------------------------------------

PARTS = """
parts AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, p_retailprice, s_name,
         'https://shop.example/p-' || p_partkey || '-' || replace(p_name, ' ', '-') || '/' AS url,
         'p-' || p_partkey || '-' || replace(p_name, ' ', '-') AS slug,
         printf('%.2f', p_retailprice) AS amount
  FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
)"""

FACTS = (
    PARTS
    + """,
facts AS (
  SELECT *,
    CASE WHEN k % 5 = 4 THEN url || '?ref=' || k ELSE url END AS product_url,
    p_name || ' & ' || p_brand || ' ' || p_size || ' мл' AS title,
    CASE WHEN (k // 2) % 3 = 0 THEN p_brand ELSE s_name END AS brand,
    CASE (k // 3) % 4 WHEN 0 THEN 'R' || k WHEN 1 THEN 'S' || (k % 500) WHEN 2 THEN CAST(k AS VARCHAR) ELSE '' END AS own_sku,
    CASE (k // 3) % 4 WHEN 0 THEN 'R' || k WHEN 1 THEN 'S' || (k % 500) WHEN 2 THEN CAST(k AS VARCHAR) ELSE slug END AS listing_id,
    CASE WHEN k % 7 = 0 THEN lower(p_type) || ' goods' ELSE p_type || ' | ' || p_brand || ' line' END AS category,
    p_name || ' is a ' || p_type || ' product. It is made by ' || s_name || '!' AS short_text,
    'Описание Size is ' || p_size || ' units brand ' || p_brand || ' here. Item ' || p_name || ' one Item ' || p_type || ' two' AS tab_text,
    p_name || ' by ' || s_name || '. Type ' || p_type || ' goods & more.' AS meta_text,
    CASE WHEN k % 8 = 3 THEN '' ELSE 'https://shop.example/img/' || k || '-a.jpg | https://cdn.shop.example/wp/' || k
      || '-c.png | https://shop.example/ | https://shop.example/img/' || k || '-b.jpg' END AS base_images,
    round(p_retailprice, 2) AS base_price,
    CASE k % 4 WHEN 0 THEN 'instock' WHEN 1 THEN 'available for order' WHEN 2 THEN 'instock' ELSE '' END AS availability,
    k % 4 = 1 AND k % 12 <> 5 AS is_variable
  FROM parts WHERE k % 10 <> 9
), texts AS (
  SELECT *,
    CASE WHEN k % 6 = 0 THEN meta_text ELSE short_text || chr(10) || chr(10) || tab_text END AS item_description,
    CASE WHEN k % 6 = 0 THEN p_name || ' by ' || s_name || '. | Type ' || p_type || ' goods & more.'
      ELSE p_name || ' is a ' || p_type || ' product. | It is made by ' || s_name || '! | Описание Size is ' || p_size
        || ' units brand ' || p_brand || ' here. | Item ' || p_name || ' one Item ' || p_type || ' two | Item ' || p_name
        || ' one | Item ' || p_type || ' two' END AS item_notes,
    category || ' | ' || brand AS keyword_attributes
  FROM facts
)"""
)

ROWS = (
    FACTS
    + """,
variations AS (
  SELECT *, unnest(range(1, 3 + (k // 4) % 2)) AS j FROM texts WHERE is_variable
), product_rows AS (
  SELECT k AS url_ord, 1 AS var_idx, product_url, listing_id, listing_id AS seller_sku, title AS item_name, category, brand,
    brand AS trademark, 'Обем' AS variation_type_1, p_size || ' мл' AS variation_variant_1, '' AS variation_type_2,
    '' AS variation_variant_2, item_notes, item_description, keyword_attributes, base_images AS images,
    base_price AS map_price, CAST(p_size AS VARCHAR) AS net_content, '' AS total_net_content, 'ml' AS net_content_unit,
    availability, '' AS raw_variation
  FROM texts WHERE NOT is_variable
  UNION ALL
  SELECT k, CAST(j AS INT), product_url, listing_id,
    CASE j WHEN 1 THEN CAST(k * 10 + 1 AS VARCHAR) ELSE listing_id || '-' || j END,
    title || ' - ' || j || ' л., deep ' || j, category, brand, brand, 'Обем', j || ' л.', 'Цвят', 'deep ' || j, item_notes,
    item_description, keyword_attributes,
    concat_ws(' | ', CASE j WHEN 1 THEN 'https://shop.example/img/' || k || '-v1.jpg'
      WHEN 3 THEN 'https://shop.example/img/' || k || '-v3.jpg' END, nullif(base_images, '')),
    CASE j WHEN 1 THEN round(p_retailprice + 1, 2) ELSE base_price END, CAST(j AS VARCHAR), '', 'l', availability,
    '{"attribute_pa_obem": "' || j || 'l", "attribute_color": "deep-' || j || '"}'
  FROM variations
)"""
)

_ROW_COLUMNS = """product_url, listing_id, seller_sku, item_name, category, brand, trademark, variation_type_1,
  variation_variant_1, variation_type_2, variation_variant_2, item_notes, item_description, keyword_attributes, images,
  map_price, net_content, total_net_content, net_content_unit, availability, raw_variation"""

# the sequential SKU rule where no made-up name meets another base
_SUFFIX = r"""left(regexp_replace(regexp_replace(replace({v}, '№', 'no'), 'SKU_NON_WORD', '-', 'g'),
  '^[-_.]+|[-_.]+$', '', 'g'), 28)""".replace("SKU_NON_WORD", fixed.SKU_NON_WORD_PATTERN).replace("28)", f"{fixed.SKU_SUFFIX_LIMIT})")

UNIQUE = """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY seller_sku ORDER BY url_ord, var_idx) AS n FROM {rows}
), rooted AS (
  SELECT *, seller_sku || '-' || {suffix} AS root,
    row_number() OVER (PARTITION BY seller_sku || '-' || {suffix}, n > 1 ORDER BY url_ord, var_idx) AS nth
  FROM numbered
), uniquely AS (
  SELECT * REPLACE (CASE WHEN n = 1 THEN seller_sku WHEN nth = 1 THEN root ELSE root || '-' || nth END AS seller_sku) FROM rooted
)"""

_DECODE = "replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _decode(x: str, times: int = 1) -> str:
    for _ in range(times):
        x = _DECODE.format(x=x)
    return x


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_BLANK}+', ' ', 'g'))"


def _truncate(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN regexp_replace(left({x}, {n - 1}), '{_BLANK}+$', '') || '…' ELSE {x} END"


def _facts(columns: str) -> str:
    return f"WITH {FACTS} SELECT k AS page_id, {columns} FROM texts"


_NAV = r"regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
_NAV_LINKS = f"""links AS (
  SELECT page_id, url, unnest(regexp_extract_all({_NAV}, '(?s)<a href="([^"]*)">(.*?)</a>', 1)) AS href,
    unnest(regexp_extract_all({_NAV}, '(?s)<a href="([^"]*)">(.*?)</a>', 2)) AS text,
    generate_subscripts(regexp_extract_all({_NAV}, '(?s)<a href="([^"]*)">(.*?)</a>', 1), 1) - 1 AS ord
  FROM pages)"""

_LINES = r"string_split_regex({x}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"


def _kept_lines(source: str, key: str, pieces: str, cleaned: str, separator: str = "chr(10)") -> str:
    return f"""pieces AS (
  SELECT {key}, unnest({pieces}) AS piece, generate_subscripts({pieces}, 1) AS ord FROM {source}
), cleaned AS (SELECT {key}, ord, {cleaned} AS line FROM pieces),
kept AS (SELECT {key}, line, min(ord) AS ord FROM cleaned WHERE line <> '' GROUP BY {key}, line),
joined AS (SELECT {key}, string_agg(line, {separator} ORDER BY ord) AS lines FROM kept GROUP BY {key})"""


_NOTE_PIECES = r"""string_split_regex(regexp_replace(replace(text, chr(10), ' '), '([.!?])B+', '\1' || chr(1), 'g'), '\x01|B*[•\-–]B+')""".replace(
    "B", _BLANK
)
_NOTE = _truncate("piece", 700).replace("piece", _squeeze(_decode("piece")))

_TYPE_LABEL = """CASE p_partkey % 6 WHEN 0 THEN 'Аромат' WHEN 1 THEN 'Цвят' WHEN 2 THEN 'Обем'
  WHEN 3 THEN p_name || ' kind' WHEN 4 THEN 'Вариант' ELSE 'Аромат' END"""

def _feed(rows: str, more: str = "") -> str:
    """The feed of some product rows."""
    named = UNIQUE.format(rows=rows, suffix=_SUFFIX.format(v="variation_variant_1"))
    return (
        f"""WITH {ROWS}{more} {named}
        SELECT listing_id, seller_sku, item_name, category, product_url AS reference_link, brand, trademark,
          variation_type_1 AS "Variation_type_1", variation_variant_1 AS "Variation_Variants_1",
          variation_type_2 AS "Variation_type_2", variation_variant_2 AS "Variation_Variants_2", """
    + ", ".join(f"string_split(item_notes, ' | ')[{i}] AS item_note_{i}" for i in range(1, 7))
    + """, item_description, keyword_attributes AS "Keyword_attributes",
          string_split(nullif(images, ''), ' | ')[1] AS main_image_url, """
    + ", ".join(f"string_split(nullif(images, ''), ' | ')[{i + 1}] AS other_image_url_{i}" for i in range(1, 10))
    + """, map_price, net_content AS "Net_content", total_net_content AS "Total_net_content",
          net_content_unit AS "Net_content_unit", """
    + ", ".join(
        f"CAST(NULL AS VARCHAR) AS {c}"
        for c in ("quantity", "item_length", "item_width", "item_height", "item_weight", "item_volume_unit",
                  "item_weight_unit", "shipping_template")
    )
    + " FROM uniquely"
    )


_DISCOVERED = f"""WITH {ROWS}, placed AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS place FROM parts),
  listed AS (SELECT * FROM product_rows JOIN placed ON k = url_ord)"""

_FLAT = "regexp_replace(url, '/(en|de)/', '/')"
_PATH = r"trim(regexp_extract({u}, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')"
_HOST = r"regexp_extract({u}, '^[a-z]+://([^/?#]*)', 1)"
_BAD_PATHS = "|".join(fixed.NON_PRODUCT_PATH_PARTS)

def _picked(test: str) -> str:
    """Feed columns of the exportable rows that pass a test."""
    rows = _feed("picked", f", picked AS (SELECT * FROM product_rows WHERE images <> '' AND {test})")
    return f"SELECT listing_id, seller_sku, item_name, map_price FROM ({rows})"


ORACLES: dict[str, str] = {
    "page_scan": "SELECT page_id, url, length(html) AS html_chars FROM pages",
    "sitemap_locs": """SELECT 'https://shop.example/product-sitemap' || (page_id // 1000) || '.xml' AS url,
        CAST(row_number() OVER (PARTITION BY page_id // 1000 ORDER BY page_id) - 1 AS INT) AS ord, url AS loc FROM pages""",
    "sitemap_children": "SELECT DISTINCT 'https://shop.example/product-sitemap' || (page_id // 1000) || '.xml' AS loc FROM pages",
    "api_links": """SELECT CAST(page_id // 100 + 1 AS INT) AS page_no,
        CAST(row_number() OVER (PARTITION BY page_id // 100 ORDER BY page_id) - 1 AS INT) AS ord, url AS link FROM pages""",
    "nav_links": f"WITH {_NAV_LINKS} SELECT url, CAST(ord AS INT) AS ord, {_decode('href')} AS href FROM links",
    "category_links": f"""WITH {_NAV_LINKS} SELECT url,
        CAST(row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS INT) AS ord,
        regexp_extract(url, '^(https?://[^/]+)', 1) || {_decode('href', 2)} AS link FROM links WHERE contains(href, '/t')""",
    "raw_csv_roundtrip": f"WITH {ROWS} SELECT {_ROW_COLUMNS} FROM product_rows",
    "raw_export": f"WITH {ROWS} SELECT {_ROW_COLUMNS} FROM product_rows",
    "product_rows": f"WITH {ROWS} SELECT {_ROW_COLUMNS} FROM product_rows",
    "variation_rows": f"WITH {ROWS} SELECT {_ROW_COLUMNS} FROM product_rows WHERE raw_variation <> ''",
    "simple_rows": f"WITH {ROWS} SELECT {_ROW_COLUMNS} FROM product_rows WHERE raw_variation = ''",
    "feed_export": _feed("product_rows"),
    "page_meta": f"""WITH {PARTS} SELECT k AS page_id,
        CASE WHEN k % 10 = 9 THEN 'article' WHEN k % 3 = 0 THEN 'Product' ELSE '' END AS og_type,
        CASE WHEN k % 10 <> 9 AND k % 3 = 0 THEN p_name || ' &amp; ' || p_brand || ' ' || p_size || ' мл' ELSE '' END AS og_title,
        CASE WHEN k % 10 <> 9 AND (k // 2) % 3 = 0 THEN p_brand ELSE '' END AS brand,
        CASE WHEN k % 10 <> 9 AND (k // 3) % 4 = 0 THEN 'R' || k ELSE '' END AS retailer_item_id,
        CASE WHEN k % 10 = 9 THEN '' WHEN k % 5 = 0 THEN amount WHEN k % 5 = 1 THEN replace(amount, '.', ',') ELSE '' END AS amount
        FROM parts""",
    "page_title": f"""SELECT page_id,
        {_truncate(_squeeze(_decode("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)", 2)), 500)} AS h1_text,
        {_truncate(_squeeze(_decode("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)", 2)), 500)} AS doc_title FROM pages""",
    "product_title": _facts("title"),
    "canonical_url": _facts("product_url"),
    "page_brand": _facts("brand"),
    "page_sku": _facts("own_sku"),
    "page_categories": _facts("category AS categories"),
    "page_description": _facts("item_description"),
    "page_notes": _facts("item_notes"),
    "page_images": _facts("base_images"),
    "page_price": _facts("base_price"),
    "page_availability": _facts("availability"),
    "url_slug": r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_extract(url, '^[a-z]+://[^?#]*/([^/?#]+)/?(?:[?#]|$)', 1),
        '[^A-Za-z0-9_-]+', '-', 'g'), '-'), ''), 'product') AS slug FROM pages""",
    "page_text": "WITH articles AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1) AS body FROM pages), "
    + _kept_lines("articles", "page_id", _LINES.format(x="regexp_replace(body, '<[^>]*>', chr(10), 'g')"), _squeeze(_decode("piece", 3)))
    + " SELECT page_id, coalesce(lines, '') AS article_text FROM articles LEFT JOIN joined USING (page_id)",
    "text_notes": f"""WITH pieces AS (
          SELECT doc_id, unnest({_NOTE_PIECES}) AS piece, generate_subscripts({_NOTE_PIECES}, 1) AS ord FROM documents
        ), cleaned AS (SELECT doc_id, ord, {_NOTE} AS note FROM pieces),
        firsts AS (SELECT doc_id, note, min(ord) AS ord FROM cleaned WHERE length(note) >= 10 GROUP BY doc_id, note),
        top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS place FROM firsts),
        joined AS (SELECT doc_id, string_agg(note, ' | ' ORDER BY ord) AS notes FROM top WHERE place <= 6 GROUP BY doc_id)
        SELECT doc_id, coalesce(notes, '') AS notes FROM documents LEFT JOIN joined USING (doc_id)""",
    "note_pieces": f"""WITH pieces AS (SELECT doc_id, unnest({_NOTE_PIECES}) AS piece FROM documents),
        counted AS (SELECT doc_id, count(*) AS n FROM pieces WHERE length({_NOTE}) >= 10 GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n, 0) AS INT) AS n_pieces FROM documents LEFT JOIN counted USING (doc_id)""",
    "keywords": "SELECT p_partkey, p_type || ' | ' || p_brand AS keyword_attributes FROM part",
    "variant_type": f"SELECT p_partkey, {_TYPE_LABEL} AS variation_type FROM part",
    "net_content": """SELECT p_partkey,
        CASE p_partkey % 6 WHEN 4 THEN '7 л' ELSE p_size || '.5' || CASE p_partkey % 6
          WHEN 0 THEN ' мл' WHEN 1 THEN ' л' WHEN 2 THEN ' кг' WHEN 3 THEN ' г' ELSE ' мл' END END AS display,
        CASE p_partkey % 6 WHEN 4 THEN '7' ELSE p_size || '.5' END AS net_content,
        CASE p_partkey % 6 WHEN 0 THEN 'ml' WHEN 1 THEN 'l' WHEN 2 THEN 'kg' WHEN 3 THEN 'g' WHEN 4 THEN 'l' ELSE 'ml' END
          AS net_content_unit FROM part""",
    "array_spread": "SELECT doc_id, "
    + ", ".join(f"{_LINES.format(x='text')}[{i}] AS line_{i}" for i in range(1, 7))
    + " FROM documents",
    "product_pages": f"WITH {PARTS} SELECT k AS page_id, url || '?ref=' || k AS url FROM parts WHERE k % 10 <> 9",
    "product_urls": f"""SELECT page_id, {_FLAT} AS flat_url, {_HOST.format(u=_FLAT)} LIKE '%example.com'
          AND ({_PATH.format(u=_FLAT)} <> '' AND NOT contains({_PATH.format(u=_FLAT)}, '/') OR {_PATH.format(u=_FLAT)} LIKE 'product/%')
          AND NOT regexp_matches(lower({_PATH.format(u=_FLAT)}), '{_BAD_PATHS}') AS is_probable FROM pages""",
    "exportable_rows": f"WITH {ROWS} SELECT url_ord, var_idx, seller_sku, map_price FROM product_rows WHERE images <> ''",
    "visible_variations": f"""WITH {ROWS} SELECT k AS page_id, CAST(max(j) AS INT) AS n_visible,
        string_agg(CASE j WHEN 1 THEN CAST(k * 10 + 1 AS VARCHAR) ELSE '-' END, ',' ORDER BY j) AS skus FROM variations GROUP BY k""",
    "variation_json": f"""WITH {ROWS} SELECT k AS page_id, CAST(j AS INT) AS idx,
        CASE j WHEN 1 THEN round(p_retailprice + 1, 2) END AS display_price,
        CASE j WHEN 1 THEN 'https://shop.example/img/' || k || '-v1-600x600.jpg' WHEN 3 THEN '/img/' || k || '-v3.jpg' END AS image,
        'attribute_pa_obem=' || j || 'l;attribute_color=deep-' || j AS attributes FROM variations""",
    "event_props_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "variation_pairs": f"""WITH {ROWS} SELECT k AS page_id, CAST(j AS INT) AS idx, 0 AS place, 'Обем' AS variation_type,
          j || ' л.' AS variation_value FROM variations
        UNION ALL SELECT k, CAST(j AS INT), 1, 'Цвят', 'deep ' || j FROM variations""",
    "image_filter": """SELECT p_partkey, 'https://cdn.example/a/' || replace(p_name, ' ', '-') || p_partkey || '.png' AS url
        FROM part WHERE p_partkey % 5 = 2""",
    "url_page_join": """SELECT page_id AS position, url, length(html) AS html_chars FROM pages WHERE page_id % 3 <> 2""",
    "url_page_rejects": "SELECT page_id AS position, url || '-gone' AS url FROM pages WHERE page_id % 3 = 2",
    "scoped_nodes": f"""WITH {_NAV_LINKS} SELECT page_id, CAST(ord AS INT) AS place, {_decode('href')} AS href,
        {_squeeze(_decode('text', 2))} AS text FROM links""",
    "url_dedupe": "SELECT trim(url) AS url, min(page_id) AS position FROM pages GROUP BY 1",
    "line_dedupe": "WITH "
    + _kept_lines("documents", "doc_id", _LINES.format(x="text"), _squeeze(_decode("piece")))
    + " SELECT doc_id, coalesce(lines, '') AS lines FROM documents LEFT JOIN joined USING (doc_id)",
    "first_node": f"""SELECT page_id, {_squeeze(_decode("regexp_replace(regexp_extract(html, '(?s)<p>(.*?)(?:</p>|<p>|</article>)', 1), '<[^>]*>', '', 'g')", 2))}
        AS first_paragraph FROM pages""",
    "run_counts": f"""WITH {ROWS} SELECT (SELECT count(*) FROM part) AS urls_found,
        (SELECT count(*) FROM product_rows WHERE images <> '') AS rows_exported""",
    "unique_skus": "WITH input AS (SELECT p_partkey AS url_ord, 1 AS var_idx, replace(p_name, ' ', '-') AS seller_sku, p_brand FROM part)"
    + UNIQUE.format(rows="input", suffix=_SUFFIX.format(v="p_brand"))
    + " SELECT url_ord AS p_partkey, seller_sku FROM uniquely",
    "node_scopes": r"""WITH tokens AS (
          SELECT page_id, regexp_extract_all(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>|<[^>]*>|[^<]+') AS t FROM pages
        ), flat AS (SELECT page_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS ord, len(t) AS total FROM tokens),
        tags AS (SELECT page_id, ord, total, starts_with(token, '</') AS closes, regexp_extract(token, '^</?([a-z0-9]+)', 1) AS tag FROM flat
          WHERE token LIKE '<%'),
        bounded AS (SELECT *, min(CASE WHEN tag = 'p' OR tag = 'article' AND closes THEN ord END)
          OVER (PARTITION BY page_id ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS block_end FROM tags),
        ended AS (SELECT *, CASE WHEN tag IN ('p', 'b') THEN block_end ELSE lead(ord) OVER (PARTITION BY page_id, tag ORDER BY ord) END AS next_ord FROM bounded
          WHERE tag IN ('a', 'h1', 'title', 'nav', 'ul', 'article', 'footer', 'li', 'p', 'b', 'div', 'head', 'body', 'html'))
        SELECT page_id, CAST(ord AS INT) AS ord, tag, CAST(coalesce(next_ord, total) AS INT) AS end_ord FROM ended WHERE NOT closes""",
    "url_limit": "SELECT url, page_id AS position FROM pages ORDER BY page_id LIMIT 100",
    "text_truncate": f"SELECT doc_id, {_truncate(_squeeze('text'), 200)} AS short_text FROM documents",
    "url_union": """SELECT url, array_to_string(min(position), '.') AS place FROM (
          SELECT url, [0, page_id % 5, page_id] AS position FROM pages WHERE page_id % 3 = 1
          UNION ALL SELECT url, [1, page_id] FROM pages WHERE page_id % 2 = 0
          UNION ALL SELECT url, [2, page_id] FROM pages) GROUP BY url""",
    "source_fallback": "SELECT url, page_id AS position FROM pages WHERE url LIKE 'https:%'",
    "next_page_chain": """WITH hosted AS (
          SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS host, page_id // 100000 AS block FROM pages
        ), placed AS (
          SELECT *, min(page_id) OVER (PARTITION BY host, block) AS seed_ord,
            CAST(row_number() OVER (PARTITION BY host, block ORDER BY page_id) - 1 AS INT) AS depth FROM hosted)
        SELECT seed_ord, host || '/list/' || page_id || '/' AS url, depth FROM placed""",
    "category_crawl": f"""WITH {PARTS} SELECT url, row_number() OVER (ORDER BY k // 200000, k % 10 + 10 * (k // 2000), k) - 1 AS place FROM parts""",
    "all_site_urls": f"WITH {PARTS} SELECT url, row_number() OVER (ORDER BY k) - 1 AS place FROM parts",
    "clean_text": f"""SELECT page_id, {_truncate(_squeeze(_decode("regexp_extract(html, '<h1>(.*?)</h1>', 1)")), 60)} AS heading FROM pages""",
    "entity_decode": f"""SELECT page_id, {_decode("regexp_extract(html, '(?s)<footer>(.*)', 1)")} AS footer,
        {_decode("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title FROM pages""",
    "price_parse": """SELECT p_partkey, CASE WHEN p_partkey % 6 < 4 THEN round(p_retailprice, 2) END AS price FROM part""",
    "url_normalize": f"""WITH {_NAV_LINKS}, decoded AS (
          SELECT url, ord, {_decode('href', 2)} AS h, regexp_extract(url, '^(https?://[^/]+)', 1) AS origin,
            regexp_extract(url, '^([^?#]*/)', 1) AS folder, regexp_extract(url, '^([^?#]*)', 1) AS page FROM links)
        SELECT url, CAST(ord AS INT) AS ord, origin || h AS absolute, folder || substr(h, 2) AS relative,
          'https:' || '/' || h AS without_scheme, page || '?' || h AS query_only,
          regexp_replace(folder, '[^/]+/$', '') || 'x' || h AS upward FROM decoded""",
    "image_normalize": """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'https://shop.example/img/' WHEN 1 THEN 'https://cdn.example/'
          ELSE 'https://a.example/' END || p_partkey || CASE p_partkey % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.png'
          WHEN 2 THEN '-301x300.jpg' ELSE '' END AS image FROM part""",
    "sku_slug": """SELECT p_partkey, left(p_type || '-no-' || p_partkey || '-' || replace(p_name, ' ', '-') || '-more-text', 28) AS suffix FROM part""",
    "discovered_rows": _DISCOVERED + " SELECT place AS url_ord, var_idx, seller_sku, item_name, map_price FROM listed WHERE images <> ''",
    "discovered_rows_limited": _DISCOVERED
    + " SELECT place AS url_ord, var_idx, seller_sku, item_name, map_price FROM listed WHERE images <> '' AND place < 100",
    "rejected_urls": f"""WITH {ROWS}, urls AS (
          SELECT k, url || '?ref=' || k || CASE WHEN k % 11 = 0 THEN '&gone' ELSE '' END AS url, k AS position FROM parts
          UNION ALL SELECT k, url || '?ref=' || k || CASE WHEN (k + 1000000000) % 11 = 0 THEN '&gone' ELSE '' END, k + 1000000000 FROM parts
        ), uniq AS (SELECT url, min(k) AS k, min(position) AS position FROM urls GROUP BY url),
        placed AS (SELECT *, row_number() OVER (ORDER BY position) - 1 AS place FROM uniq),
        kept AS (SELECT url_ord, bool_or(images <> '') AS exported FROM product_rows GROUP BY url_ord)
        SELECT place AS position, url, CASE WHEN url LIKE '%&gone' THEN 'no stored page' WHEN exported IS NULL THEN 'no product page'
          ELSE 'no exportable row' END AS reason
        FROM placed LEFT JOIN kept ON k = url_ord WHERE url LIKE '%&gone' OR exported IS NULL OR NOT exported""",
    "site_feed": _feed("exported", f""", exported AS (SELECT * FROM product_rows WHERE images <> '')"""),
    "unique_skus_colliding": """SELECT p_partkey, 'b' || (p_partkey // 4) || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '-x'
          WHEN 2 THEN '-x-x' ELSE '-x-2' END AS seller_sku FROM part""",
    "html_files": """SELECT page_id, row_number() OVER (ORDER BY CAST(page_id AS VARCHAR) || '/') - 1 AS place, md5(html) AS html_md5 FROM pages""",
    "feed_in_order": f"""SELECT row_no, listing_id, seller_sku, product_url AS reference_link, main_image_url FROM (
        WITH {ROWS} {UNIQUE.format(rows="product_rows", suffix=_SUFFIX.format(v="variation_variant_1"))}
        SELECT *, row_number() OVER (ORDER BY url_ord, var_idx) - 1 AS row_no, nullif(string_split(images, ' | ')[1], '') AS main_image_url FROM uniquely)""",
    "single_product_feed": _picked("url_ord = (SELECT min(p_partkey) FROM part WHERE p_partkey % 20 = 5)"),
    "category_feed": _picked("url_ord % 10 + 10 * (url_ord // 2000) = 5"),
    "sitemap_feed": _picked("url_ord // 1000 = 0"),
}
