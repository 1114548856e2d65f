"""Where a pattern matches in a text: SQL expressions, no Python at run time."""

from __future__ import annotations

from collections.abc import Callable

from vitrine.functions.sqltext import bind, leading, let

CHUNK, PIECE = 256, 512


def literal(value: str) -> str:
    """SQL string literal; raw, so that backslashes reach the pattern."""
    if "'" in value and '"' in value:
        return "concat(" + ", \"'\", ".join(literal(part) if part else "''" for part in value.split("'")) + ")"
    quote = '"' if "'" in value else "'"
    return f"r{quote}{value}{quote}"


def matches(text: str, pattern: str, gate: str | None = None, count: Callable[[str], str] | None = None) -> str:
    """SQL for array<struct<start, end, value>>: leftmost non-overlapping matches, in code points.

    The pattern must not match the empty string. Gaps between matches come from ``split``, their lengths
    give the positions. Positions are summed in chunks of 256 matches, so texts with very many matches
    don't copy a growing array once per match. Texts without a match (by ``gate``, a cheaper pattern that
    every text with a match fulfils) are not cut at all.

    With ``count`` (SQL over a piece of text) spans have ``before`` too: the sum of the counts of all gaps and matches before them.
    """
    p, g = literal(pattern), literal(gate or pattern)
    shape = f"struct<start: bigint, end: bigint, value: string{', before: bigint' if count else ''}>"
    empty, empty_parts = f"cast(array() as array<{shape}>)", f"cast(array() as array<array<{shape}>>)"
    found = "arrays_zip(regexp_extract_all({0}, {1}, 0), split({0}, {1}, -1))".format(text, p)  # '0': match, '1': gap before it
    chunks = f"sequence(0, greatest(size(z) - 2, 0) div {CHUNK})"
    cut = f"transform({chunks}, k -> slice(z, k * {CHUNK} + 1, least({CHUNK}, size(z) - 1 - k * {CHUNK})))"
    before = f"own.n + {count("m['1']")}" if count else ""
    more = f", 'before', cast({before} as bigint)" if count else ""
    span = f"named_struct('start', own.at + length(m['1']), 'end', own.at + length(m['1']) + length(m['0']), 'value', m['0']{more})"

    def state(at: str, n: str, own: str) -> str:
        return f"named_struct('at', {at}, " + (f"'n', cast({n} as bigint), " if count else "") + f"'own', {own})"

    counted = f"{before} + {count("m['0']")}" if count else ""
    chunk = f"""aggregate(part, {state('acc.at', 'acc.n', empty)},
        (own, m) -> {state("own.at + length(m['1']) + length(m['0'])", counted, f'concat(own.own, array({span}))')})"""
    return f"""if({text} rlike {g}, flatten(aggregate(
        transform(array({found}), z -> {cut})[0],
        {state('0L', '0L', empty_parts)},
        (acc, part) -> transform(array({chunk}), own -> {state('own.at', 'own.n', 'concat(acc.own, array(own.own))')})[0]
        ).own), {empty})"""


def pieces(text: str) -> str:
    """SQL: the text in pieces of ``PIECE`` code points, cut in one pass."""
    return f"regexp_extract_all({text}, '(?s).{{1,{PIECE}}}', 0)"


def cut(parts: str, start: str, end: str) -> str:
    """SQL: code points ``start`` to ``end`` (exclusive) of a text in ``pieces``, without a walk from its beginning."""
    first = f"cast(({start}) div {PIECE} as int)"
    joined_parts = f"array_join(slice({parts}, {first} + 1, cast(greatest(({end}) - 1, 0) div {PIECE} as int) - {first} + 1), '')"
    return f"if(({end}) > ({start}), substring({joined_parts}, cast(({start}) - {first} * {PIECE} + 1 as int), cast(({end}) - ({start}) as int)), '')"


def holds(spans: str, start: str, end: str) -> str:
    """SQL: one of ``spans`` (a name; in order, apart from each other) contains the interval."""
    return let(leading(spans, lambda s: f"{s}.start <= {start}"), lambda n: f"({n} > 0 and {spans}[{n} - 1].end >= {end})")


def meets(spans: str, start: str, end: str) -> str:
    """SQL: one of ``spans`` (a name; in order, apart from each other) overlaps the interval."""
    return let(leading(spans, lambda s: f"{s}.start < {end}"), lambda n: f"({n} > 0 and {spans}[{n} - 1].end > {start})")


def merged(spans: str) -> str:
    """SQL for array<struct<start, end, kind>>: overlapping spans as one, under the first one's kind; in order of start, end, kind."""
    ordered = f"array_sort(transform({spans}, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"
    empty = "cast(array() as array<struct<start: bigint, kind: string, closed: bigint>>)"

    def fold(all_: str) -> str:
        step = """case when x.start < b.edge then named_struct('edge', greatest(b.edge, x.end), 'out', b.out)
            else named_struct('edge', x.end, 'out', concat(b.out, array(named_struct('start', x.start, 'kind', x.kind, 'closed', b.edge)))) end"""
        inner = f"aggregate(slice({all_}, c * {CHUNK} + 1, {CHUNK}), named_struct('edge', a.edge, 'out', {empty}), (b, x) -> {step})"
        whole = let(inner, lambda r: f"named_struct('edge', {r}.edge, 'out', concat(a.out, {r}.out))")
        # a span ends where the next one found the edge
        closed = "transform(z.out, (o, i) -> named_struct('start', o.start, 'end', coalesce(get(z.out, i + 1).closed, z.edge), 'kind', o.kind))"
        return f"""aggregate(sequence(0, greatest(size({all_}) - 1, 0) div {CHUNK}), named_struct('edge', 0L, 'out', {empty}), (a, c) -> {whole}, z -> {closed})"""

    return bind(ordered, fold)


def joined(spans: str) -> str:
    """``kind:start:end``, comma-joined in the order of the array."""
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def of_kind(spans: str, kind: str) -> str:
    """Adds ``kind`` to spans and drops their text."""
    return f"transform({spans}, s -> named_struct('kind', '{kind}', 'start', s.start, 'end', s.end))"
