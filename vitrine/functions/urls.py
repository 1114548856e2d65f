"""URL expressions: resolution, image normalisation, slugs, product-URL test."""

from __future__ import annotations

from vitrine import fixed
from vitrine.functions.sqltext import let, lit, missing
from vitrine.functions.text import BLANK, contains_any, unescape

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"


def url_host(url: str) -> str:
    """Network location (with port and user part), ``''`` when there is none."""
    return f"regexp_extract({url}, {lit(rf'^(?:{_SCHEME})?//([^/?#]*)')}, 1)"


def url_path(url: str) -> str:
    return f"regexp_extract({url}, {lit(rf'^(?:{_SCHEME})?(?://[^/?#]*)?([^?#]*)')}, 1)"


def _resolve_dots(path: str) -> str:
    """Remove ``.`` and ``..`` segments; a final one leaves a trailing slash."""

    def body(p: str) -> str:
        kept = f"""aggregate(split({p}, '/'), CAST(array() AS ARRAY<STRING>),
            (acc, seg) -> CASE WHEN seg = '..' THEN slice(acc, 1, greatest(size(acc) - 1, 0))
                               WHEN seg = '.' THEN acc ELSE concat(acc, array(seg)) END)"""
        closed = f"""concat({kept}, CASE WHEN {p} RLIKE {lit(r'(?:^|/)[.]{1,2}$')} THEN array('')
            ELSE CAST(array() AS ARRAY<STRING>) END)"""
        return f"""CASE WHEN {p} RLIKE {lit(r'(?:^|/)[.]{1,2}(?:/|$)')}
            THEN regexp_replace(array_join({closed}, '/'), '^(?!/)', '/') ELSE {p} END"""

    return let(path, body)


def normalize_url(url: str, base: str, decode: int = 1) -> str:
    """Decode, trim, make absolute against ``base`` (a SQL expression); missing stays ``''``."""
    trimmed = (
        f"regexp_replace({unescape(f'coalesce({url}, {lit("")})', decode)}, {lit(f'(?U)^{BLANK}+|{BLANK}+$')}, '')"
    )
    origin = f"regexp_extract({base}, {lit(rf'^({_SCHEME}//[^/?#]*)')}, 1)"
    folder = f"concat('/', regexp_extract({url_path(base)}, '^/?(.*/)?[^/]*$', 1))"

    scheme = f"lower(regexp_extract({base}, {lit(f'^({_SCHEME})')}, 1))"

    def relative(u: str) -> str:
        path = f"regexp_extract({u}, '^([^?#]*)', 1)"
        tail = f"regexp_extract({u}, '^[^?#]*(.*)$', 1)"
        below = f"regexp_replace(concat({folder}, {path}), '/{{2,}}', '/')"
        return f"""CASE WHEN {u} = '' THEN regexp_extract({base}, '^([^#]*)', 1)
            WHEN startswith({u}, '#') THEN concat(regexp_extract({base}, '^([^#]*)', 1), {u})
            WHEN startswith({u}, '?') THEN concat(regexp_extract({base}, '^([^?#]*)', 1), {u})
            WHEN startswith({u}, '/') THEN concat({origin}, {_resolve_dots(path)}, {tail})
            ELSE concat({origin}, {_resolve_dots(below)}, {tail}) END"""

    def body(u: str) -> str:
        own = f"lower(regexp_extract({u}, {lit(f'^({_SCHEME})')}, 1))"
        # the base's own scheme without a host is no scheme; an empty fragment and an empty query are dropped
        bare = f"CASE WHEN {own} <> '' THEN substring({u}, length({own}) + 1) ELSE {u} END"
        shown = f"regexp_replace(regexp_replace({bare}, '^([^#]*)#$', '$1'), '^([^?#]*)[?](#.*)?$', '$1$2')"
        return f"""CASE WHEN coalesce({url}, '') = '' THEN ''
            WHEN startswith({u}, '//') THEN concat('https:', {u})
            WHEN {u} RLIKE '^(?i:https?)://' OR {own} NOT IN ('', {scheme}) THEN {u}
            WHEN {u} = '' THEN {base}
            ELSE {let(shown, relative)} END"""

    return let(trimmed, body)


def normalize_image_url(url: str, base: str, decode: int = 1) -> str:
    """Original picture behind a cached WebP copy or a thumbnail."""
    out = f"replace({normalize_url(url, base, decode)}, {lit(fixed.WEBP_CACHE_PATH)}, '')"
    return f"regexp_replace(regexp_replace({out}, '[.]webp$', ''), {lit(fixed.THUMB_PATTERN)}, '')"


def is_shop_furniture(url: str) -> str:
    """Logos, badges, loaders and placeholders, which never go to the feed."""
    return contains_any(f"lower({url})", fixed.SKIPPED_IMAGE_PARTS)


def slug_from_url(url: str) -> str:
    """Last path segment made safe; ``product`` when nothing is left."""
    last = f"regexp_extract({url_path(url)}, '([^/]*)/*$', 1)"
    slug = f"trim(BOTH '-' FROM regexp_replace({last}, '[^A-Za-z0-9_-]+', '-'))"
    return f"coalesce({missing(slug)}, 'product')"


def is_probable_product_url(url: str, host_suffix: str, base: str | None = None) -> str:
    """Shop host, one path segment (or ``product/…``), none of the taxonomy parts."""

    def body(u: str) -> str:
        def path_ok(p: str) -> str:
            return f"""({p} <> '' AND NOT contains({p}, '/') OR startswith({p}, 'product/'))
                AND NOT {contains_any(f'lower({p})', fixed.NON_PRODUCT_PATH_PARTS)}"""

        inside = let(f"trim(BOTH '/' FROM {url_path(u)})", path_ok)
        return f"(endswith({url_host(u)}, {lit(host_suffix)}) AND {inside})"

    return let(normalize_url(url, base) if base else url, body)
