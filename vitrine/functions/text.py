"""Text expressions: entity decoding, blank squeezing, truncation, slugs."""

from __future__ import annotations

from html.entities import html5

from vitrine import fixed
from vitrine.functions.sqltext import each, keep, let, lit, missing

# Blanks as Unicode sees them, plus the four ASCII separators that Java's \s leaves out.
BLANK = r"[\s\x1c-\x1f]"
BLANKS = rf"(?U){BLANK}+"
# the same blanks one by one; the ranges before && refuse almost every other character after a comparison or two
_BLANKS = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ANY_BLANK = rf"[[^!-\x{{84}}\x{{A1}}-\x{{167F}}\x{{3001}}-\x{{10FFFF}}]&&[{_BLANKS}]]"
# the runs that are not one space already: one character decides at places without a blank
UNEVEN_BLANKS = rf"{_ANY_BLANK}(?:(?<! )|(?={_ANY_BLANK})){_ANY_BLANK}*+"
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_FREQUENT = (
    "amp;", "quot;", "lt;", "gt;", "nbsp;", "apos;", "euro;", "copy;", "middot;", "ndash;", "mdash;", "hellip;",
    "laquo;", "raquo;", "bdquo;", "ldquo;", "rdquo;", "lsquo;", "rsquo;", "bull;", "reg;", "trade;", "deg;", "times;",
)


def _entity_table() -> str:
    """The standard HTML5 name table as one constant: ``\x01name\x02characters`` repeated.

    One string is far lighter in a plan than a map of 2,231 entries; the frequent
    names do not get here.
    """
    return lit("".join(f"\x01{name}\x02{characters}" for name, characters in html5.items()) + "\x01")


def _unterminated_names() -> str:
    """Alternation of the names that HTML accepts without a semicolon, longest first."""
    names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return "^&(" + "|".join(names) + ")"


_ENTITIES = _entity_table()
_UNTERMINATED = lit(_unterminated_names())
_UNDEFINED_1252 = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
_WINDOWS_1252 = lit(
    "".join(chr(b) if b in _UNDEFINED_1252 else bytes([b]).decode("cp1252") for b in range(0x80, 0xA0))
)


def code_point(cp: str) -> str:
    """Character for a Unicode code point (``chr`` wraps above 255)."""
    return f"decode(unhex(lpad(hex({cp}), 8, '0')), 'UTF-32')"


def _numeric(token: str) -> str:
    digits = f"regexp_extract({token}, '^&#[xX]?0*([0-9a-fA-F]*)', 1)"

    def value(d: str) -> str:
        return f"""CASE WHEN {d} = '' THEN 0L WHEN length({d}) > 7 THEN 1114112L
            WHEN lower(substring({token}, 3, 1)) = 'x' THEN CAST(conv({d}, 16, 10) AS BIGINT)
            ELSE try_cast({d} AS BIGINT) END"""

    def character(n: str) -> str:
        return f"""CASE WHEN {n} = 0 OR {n} BETWEEN 55296 AND 57343 OR {n} > 1114111 THEN {lit(chr(0xFFFD))}
            WHEN {n} BETWEEN 128 AND 159 THEN substring({_WINDOWS_1252}, CAST({n} - 127 AS INT), 1)
            WHEN {n} BETWEEN 1 AND 8 OR {n} = 11 OR {n} BETWEEN 14 AND 31 OR {n} = 127
              OR {n} BETWEEN 64976 AND 65007 OR {n} % 65536 >= 65534 THEN ''
            ELSE {code_point(n)} END"""

    return let(let(digits, value), character)


def _named(token: str) -> str:
    """Full name, else the longest name that needs no semicolon and the rest, else the token."""

    def looked_up(name: str) -> str:
        # an absent name leaves the table itself, which begins with the separator
        tail = f"substring_index({_ENTITIES}, concat('\\u0001', {name}, '\\u0002'), -1)"
        return f"CASE WHEN {name} <> '' THEN {missing(f"substring_index({tail}, '\\u0001', 1)")} END"

    names = f"array(substring({token}, 2), regexp_extract({token}, {_UNTERMINATED}, 1))"
    found = each(names, lambda n: f"named_struct('name', {n}, 'value', {looked_up(n)})")
    return let(
        found,
        lambda f: f"coalesce({f}[0].value, concat({f}[1].value, substring({token}, length({f}[1].name) + 2)), {token})",
    )


def _decode_once(text: str) -> str:
    frequent = " ".join(f"WHEN {lit('&' + name)} THEN {lit(html5[name])}" for name in _FREQUENT)

    def decode(t: str) -> str:
        return f"""CASE WHEN NOT startswith({t}, '&') OR {t} = '&' THEN {t}
            WHEN startswith({t}, '&#') THEN {_numeric(t)}
            ELSE CASE {t} {frequent} ELSE {_named(t)} END END"""

    return f"array_join({each(f'regexp_extract_all({text}, {lit(_REFERENCE + "|[^&]+|&")}, 0)', decode)}, '')"


def unescape(text: str, times: int = 1) -> str:
    """HTML character references to characters, ``times`` rounds; untouched without ``&``."""

    def body(t: str) -> str:
        if times == 1:
            decoded = _decode_once(t)
        else:
            decoded = f"""aggregate(array_repeat(1, {times}), {t},
                (acc, i) -> CASE WHEN contains(acc, '&') THEN {_decode_once('acc')} ELSE acc END)"""
        return f"CASE WHEN contains({t}, '&') THEN {decoded} ELSE {t} END"

    return let(text, body) if times else text


def squeeze(text: str) -> str:
    """Every run of blanks to one blank, none at the ends."""
    return f"trim(regexp_replace({text}, {lit(UNEVEN_BLANKS)}, ' '))"


def truncate(text: str, limit: int) -> str:
    """Over-long text to ``limit - 1`` characters, right-trimmed, and an ellipsis."""
    return let(
        text,
        lambda t: f"""CASE WHEN length({t}) > {limit}
            THEN concat(regexp_replace(substring({t}, 1, {limit - 1}), {lit(f'(?U){BLANK}+$')}, ''), '…')
            ELSE {t} END""",
    )


def clean_text(text: str, limit: int | None = None, decode: int = 1) -> str:
    """Missing to ``''``, decode, squeeze, truncate."""
    out = squeeze(unescape(f"coalesce({text}, '')", decode))
    return truncate(out, limit) if limit else out


def unique_filled(items: str) -> str:
    """Keep-first unique over an array of cleaned texts, empty ones dropped."""
    return f"array_distinct({keep(items, lambda x: f'{x} <> {lit("")}')})"


def title_case(text: str) -> str:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = f"regexp_extract_all({text}, {lit(chr(92) + 'p{L}+|' + chr(92) + 'P{L}+')}, 0)"
    cased = each(runs, lambda r: f"concat(upper(substring({r}, 1, 1)), lower(substring({r}, 2)))")
    return f"array_join({cased}, '')"


def contains_any(text: str, parts: tuple[str, ...]) -> str:
    """True when the text holds one of the literal parts."""
    return f"({text} RLIKE {lit('|'.join(p.replace('.', chr(92) + '.') for p in parts))})"


def sku_suffix(text: str) -> str:
    """Compact suffix for a repeated SKU."""
    safe = f"regexp_replace(replace({clean_text(text)}, '№', 'no'), {lit(fixed.SKU_NON_WORD_PATTERN)}, '-')"
    ends = f"regexp_replace({safe}, '^[-_.]+|[-_.]+$', '')"
    return f"coalesce({missing(f'substring({ends}, 1, {fixed.SKU_SUFFIX_LIMIT})')}, 'variant')"


def json_object(entries: str) -> str:
    """Map entries as JSON with ``": "`` and ``", "`` between, in entry order."""

    def quoted(value: str) -> str:
        return let(f"to_json(array({value}))", lambda j: f"substring({j}, 2, length({j}) - 2)")

    pairs = each(entries, lambda e: f"concat({quoted(f'{e}.key')}, ': ', {quoted(f'{e}.value')})")
    return f"concat('{{', array_join({pairs}, ', '), '}}')"
