"""Price, net content, variation-type and note expressions."""

from __future__ import annotations

from vitrine import fixed
from vitrine.functions.sqltext import each, keep, let, lit, missing
from vitrine.functions.text import clean_text, contains_any, unescape


def parse_price(text: str, decode: int = 1) -> str:
    """First number followed by a euro mark, as DOUBLE; NULL when there is none."""
    plain = f"replace({unescape(text, decode)}, {lit(chr(0xA0))}, ' ')"
    raw = f"replace(replace(regexp_extract({plain}, {lit(fixed.PRICE_PATTERN)}, 1), ' ', ''), ',', '.')"
    return f"round(try_cast({missing(raw)} AS DOUBLE), 2)"


def find_size(text: str) -> str:
    """First size in the text as ``struct(display, number, unit)``, empty strings if none."""

    def hit(t: str) -> str:
        pattern = lit(fixed.SIZE_PATTERN)
        return f"""named_struct('number', replace(regexp_extract({t}, {pattern}, 1), ',', '.'),
            'raw', replace(lower(regexp_extract({t}, {pattern}, 2)), '.', ''))"""

    def with_unit(h: str) -> str:
        return f"""named_struct('number', {h}.number, 'unit', CASE WHEN {h}.number = '' THEN ''
            WHEN {h}.raw RLIKE '^(?:мл|ml|мил)' THEN 'ml'
            WHEN {h}.raw IN ('л', 'l') OR startswith({h}.raw, 'лит') THEN 'l'
            WHEN {h}.raw IN ('кг', 'kg') THEN 'kg' ELSE 'g' END)"""

    def shown(h: str) -> str:
        return f"""named_struct('display', CASE {h}.unit WHEN '' THEN ''
            WHEN 'ml' THEN concat({h}.number, ' мл') WHEN 'l' THEN concat({h}.number, ' л')
            WHEN 'kg' THEN concat({h}.number, ' кг') ELSE concat({h}.number, ' г') END,
            'number', {h}.number, 'unit', {h}.unit)"""

    return let(let(let(text, hit), with_unit), shown)


def variant_type(label: str, value: str) -> str:
    """Scent, then colour, then size words; else the label; else the generic type."""
    return let(
        f"lower(concat({label}, ' ', {value}))",
        lambda both: f"""CASE WHEN {contains_any(both, fixed.SCENT_WORDS)} THEN {lit(fixed.TYPE_SCENT)}
            WHEN {contains_any(both, fixed.COLOUR_WORDS)} THEN {lit(fixed.TYPE_COLOUR)}
            WHEN {contains_any(both, fixed.SIZE_WORDS)} THEN {lit(fixed.TYPE_SIZE)}
            ELSE coalesce({missing(clean_text(label))}, {lit(fixed.TYPE_OTHER)}) END""",
    )


def split_notes(candidate: str) -> str:
    """Sentence and bullet pieces of one text, cleaned, long enough ones only."""
    pieces = f"split(translate({candidate}, '\\n', ' '), {lit(fixed.SENTENCE_SPLIT_PATTERN)})"
    cleaned = each(pieces, lambda p: clean_text(p, fixed.NOTE_LIMIT))
    return keep(cleaned, lambda p: f"length({p}) >= {fixed.NOTE_MIN_LENGTH}")


def pick_notes(candidates: str) -> str:
    """First few distinct pieces over all candidate texts."""
    return f"slice(array_distinct(flatten({each(candidates, split_notes)})), 1, {fixed.MAX_NOTES})"
