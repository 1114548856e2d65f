"""HTML as data: every page becomes an array of nodes with element scopes.

The array stays in the page's row, so cutting HTML into nodes, closing elements
and selecting inside scopes never shuffles: a page is handled where it is read.
``page_nodes`` explodes the array for those who want one row per node.

A node is ``struct(ord, end, kind, tag, classes, attrs, text)``: ``ord`` is the
position in the page, the content of an element is ``ord < x.ord < end``; kinds
are ``o`` (element), ``v`` (element without content), ``c`` (end tag), ``t``
(text) and ``x`` (comment, script, style, declaration).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine.functions.sqltext import bind, each, first, keep, leading, let, lit, lits
from vitrine.functions.text import unescape

TOKEN = (
    r"(?s)<!--.*?-->|(?i:<script\b.*?</script\s*>|<style\b.*?</style\s*>)"
    r"""|</?[A-Za-z!?](?:"[^"]*+"|'[^']*+'|[^'">]++)*+>|(?:[^<]++|<(?![A-Za-z/!?]))++|<"""
)
# the same tokens with the tag's name in a group, an end tag's with its slash; empty in text, scripts, comments and declarations
NAMED_TOKEN = TOKEN.replace(
    r"|</?[A-Za-z!?](?:", r"|<(?:(?=((?!(?i:script|style)\b)[A-Za-z][^\s/>]*|/[A-Za-z][^\s/>]*))|)/?[A-Za-z!?](?:"
)
# blanks are listed one by one, which a matcher looks up in one table
ATTRIBUTE = r"""(?s)([^ \t\n\x0B\f\r"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^ \t\n\x0B\f\r"'>]+))?"""

VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

# opening one of these tags ends an open element of the second list, unless one of the third stands between
PARAGRAPH_ENDERS = (
    "p", "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "main", "nav", "ol", "pre", "section", "table", "ul",
)
IMPLIED_ENDS = (
    (PARAGRAPH_ENDERS, ("p",), ("button", "td", "th", "table")),
    (("li",), ("li",), ("ul", "ol", "menu")),
    (("option", "optgroup"), ("option",), ("select", "datalist")),
    (("tr",), ("tr",), ("table",)),
    (("td", "th"), ("td", "th"), ("tr", "table")),
    (("thead", "tbody", "tfoot"), ("thead", "tbody", "tfoot"), ("table",)),
    (("dt", "dd"), ("dt", "dd"), ("dl",)),
)

# an end tag does not reach through an element of a later group than its own
CONTAINER_RANKS = (("div",), ("td", "th"), ("tr",), ("thead", "tbody", "tfoot"), ("table",), ("head", "body"), ("html",))

CHUNK = 256


def _attributes(body: str) -> str:
    """``array<struct(k, v)>`` of what follows a tag's name; the text before the first ``=`` is an attribute's name."""
    pattern = lit(ATTRIBUTE)

    def value(v: str) -> str:
        return unescape(f"CASE WHEN startswith({v}, '\"') OR startswith({v}, '\\'') THEN substring({v}, 2, length({v}) - 2) ELSE {v} END")

    def entry(m: str) -> str:
        def cut(at: str) -> str:
            # only blanks (and control characters) beside the sign need the pattern once more
            tight = f"substring({m}, {at} - 1, 1) > ' ' AND substring({m}, {at} + 1, 1) > ' '"
            loose = let(f"regexp_extract({m}, {pattern}, 2)", lambda v: f"named_struct('k', lower(regexp_extract({m}, {pattern}, 1)), 'v', {value(v)})")
            plain = let(f"substring({m}, {at} + 1)", lambda v: f"named_struct('k', lower(substring({m}, 1, {at} - 1)), 'v', {value(v)})")
            return f"CASE WHEN {at} = 0 THEN named_struct('k', lower({m}), 'v', '') WHEN {tight} THEN {plain} ELSE {loose} END"

        return let(f"locate('=', {m})", cut)

    return each(f"regexp_extract_all({body}, {pattern}, 0)", entry)


def _token_node(t: str, name: str) -> str:
    """Kind, tag, attributes and text of one token and its ``NAMED_TOKEN`` name."""
    none = "CAST(array() AS ARRAY<STRUCT<k: STRING, v: STRING>>)"

    def opened(g: str) -> str:
        closed = f"endswith({t}, '/>') OR contains({t}, '/') AND substring({t}, -2, 1) <= ' ' AND {t} RLIKE '/\\\\s*>$'"
        kind = f"CASE WHEN {g} IN ({lits(VOID_TAGS)}) OR {closed} THEN 'v' ELSE 'o' END"
        attrs = f"""CASE WHEN length({t}) = length({g}) + 2 THEN {none}
            WHEN contains({t}, ' ') OR {t} RLIKE '\\\\s' THEN {_attributes(f"substring({t}, length({g}) + 2)")} ELSE {none} END"""
        return f"named_struct('kind', {kind}, 'tag', {g}, 'attrs', {attrs}, 'text', {t})"

    # of a "<" that begins no token the matcher remembers the name it looked at
    return f"""CASE WHEN {name} = '' OR {t} = '<' THEN
            CASE WHEN startswith({t}, '<') AND {t} RLIKE '^(?:</?[!?]|(?i:<script\\\\b|<style\\\\b))'
                THEN named_struct('kind', 'x', 'tag', '', 'attrs', {none}, 'text', {t})
                ELSE named_struct('kind', 't', 'tag', '', 'attrs', {none}, 'text', {unescape(t, 2)}) END
        WHEN startswith({name}, '/') THEN named_struct('kind', 'c', 'tag', lower(substring({name}, 2)), 'attrs', {none}, 'text', {t})
        ELSE {let(f"lower({name})", opened)} END"""


# The stack of open elements is one string, innermost first: per element a mark, its tag (padded, or a digest of
# an odd one) and its position.  Copying a string is cheap enough for thousands of unclosed elements.
NAME, DIGITS = 15, 8
WIDTH = 1 + NAME + DIGITS


def _name(tag: str) -> str:
    return f"""CASE WHEN {tag} RLIKE '^[a-z0-9:_-]{{1,{NAME - 1}}}$' THEN rpad({tag}, {NAME}, ' ')
        ELSE concat('#', substring(md5({tag}), 1, {NAME - 1})) END"""


def _any_tag(tags: tuple[str, ...]) -> str:
    return lit(f"<(?:{'|'.join(tags)}) ")


def _place(stack: str, tags: tuple[str, ...]) -> str:
    """Where the innermost element of one of the tags stands in the stack; 0 without one."""
    if len(tags) == 1:
        mark = lit("<" + tags[0].ljust(NAME))  # most often absent, which contains() tells much faster
        return f"CASE WHEN contains({stack}, {mark}) THEN locate({mark}, {stack}) ELSE 0 END"
    return f"coalesce(array_min(filter(array({', '.join(_place(stack, (t,)) for t in tags)}), at -> at > 0)), 0)"


def _pops(stack: str, x: str) -> str:
    """How many characters of the stack (innermost first) belong to elements that the tag ``x`` ends."""

    def unless_blocked(position: str, blocked) -> str:
        return let(
            position,
            lambda p: f"""CASE WHEN {p} = 0 OR {p} > 1 AND ({blocked(f'substring({stack}, 1, {p} - 1)')})
                THEN 0 ELSE {p} + {WIDTH - 1} END""",
        )

    opening = "".join(
        f" WHEN {x}.tag IN ({lits(tags)}) THEN "
        + unless_blocked(_place(stack, ended), lambda s, b=blockers: f"{s} RLIKE {_any_tag(b)}")
        for tags, ended, blockers in IMPLIED_ENDS
    )

    def closed_by(s: str) -> str:
        cases = ""
        for i, tags in enumerate(CONTAINER_RANKS[:-1]):
            above = tuple(t for group in CONTAINER_RANKS[i + 1 :] for t in group)
            cases += f" WHEN {x}.tag IN ({lits(tags)}) THEN {s} RLIKE {_any_tag(above)}"
        everything = tuple(t for group in CONTAINER_RANKS for t in group)
        return f"CASE{cases} WHEN {x}.tag = 'html' THEN false ELSE {s} RLIKE {_any_tag(everything)} END"

    return f"""CASE WHEN {x}.kind <> 'c' THEN CASE{opening} ELSE 0 END
        ELSE {unless_blocked(f"locate(concat('<', {_name(f'{x}.tag')}), {stack})", closed_by)} END"""


#: Where an element ends is one number, its position above this many bits and its end below.
END_BITS = 32
_BRANCHING = tuple(dict.fromkeys(t for tags, _, _ in IMPLIED_ENDS for t in tags))


def _element_ends(shapes: str) -> str:
    """``array<long>`` for all tokens, in ``ord`` order: ``ord`` above ``END_BITS`` bits, the end below.

    An element whose next tag is its own end tag leaves the stack as it was: it is settled by a look at its neighbour,
    and the fold only hears of it (kind ``l``) where its opening may end others.  The rest is
    a fold over the tags with the stack of open elements as its state.  The
    output grows per chunk, not per tag, so that long pages stay near linear.
    """
    empty = "CAST(array() AS ARRAY<BIGINT>)"

    def state(stack: str, out: str) -> str:
        return f"named_struct('stack', {stack}, 'out', {out})"

    def number(ord_: str, end: str) -> str:
        return f"shiftleft(CAST({ord_} AS BIGINT), {END_BITS}) + {end}"

    def ended(stack: str, at: str) -> str:
        # the piece before the first mark is empty
        ords = f"filter(split({stack}, '<'), o -> o <> '')"
        return each(ords, lambda o: number(f"CAST(right({o}, {DIGITS}) AS INT)", at))

    def popped(stack: str, n: str, at: str) -> str:
        one = f"array({number(f'CAST(substring({stack}, {WIDTH - DIGITS + 1}, {DIGITS}) AS INT)', at)})"
        return f"CASE WHEN {n} = {WIDTH} THEN {one} ELSE {ended(f'substring({stack}, 1, {n})', at)} END"

    def step(acc: str, x: str) -> str:
        entry = f"concat('<', {_name(f'{x}.tag')}, lpad(CAST({x}.ord AS STRING), {DIGITS}, '0'))"

        def change(n: str) -> str:
            rest = f"CASE WHEN {n} = 0 THEN {acc}.stack ELSE substring({acc}.stack, {n} + 1) END"
            out = f"CASE WHEN {n} = 0 THEN {acc}.out ELSE concat({acc}.out, {popped(f'{acc}.stack', n, f'{x}.ord')}) END"
            return f"""CASE WHEN {x}.kind = 'l' AND {n} = 0 THEN {acc}
                ELSE {state(f"CASE WHEN {x}.kind = 'o' THEN concat({entry}, {rest}) ELSE {rest} END", out)} END"""

        return let(_pops(f"{acc}.stack", x), change)

    def fold(tags: str, end: str) -> str:
        part = f"slice({tags}, c * {CHUNK} + 1, {CHUNK})"
        inner = f"aggregate({part}, {state('a.stack', empty)}, (b, x) -> {step('b', 'x')})"
        merged = let(inner, lambda r: state(f"{r}.stack", f"concat(a.out, {r}.out)"))
        return f"""aggregate(sequence(0, CAST(size({tags}) DIV {CHUNK} AS INT)), {state("''", empty)}, (a, c) -> {merged},
            z -> concat(z.out, {ended('z.stack', end)}))"""

    def both(all_: str) -> str:
        def told_apart(tags: str) -> str:
            # ``leaf``: where its end tag stands that is the next tag; ``closed``: the end tag of a leaf
            leaf = f"CASE WHEN x.kind = 'o' AND get({tags}, i + 1).kind = 'c' AND get({tags}, i + 1).tag = x.tag THEN get({tags}, i + 1).ord END"
            closed = f"(x.kind = 'c' AND i > 0 AND get({tags}, i - 1).kind = 'o' AND get({tags}, i - 1).tag = x.tag)"
            return f"transform({tags}, (x, i) -> named_struct('ord', x.ord, 'kind', x.kind, 'tag', x.tag, 'leaf', {leaf}, 'closed', {closed}))"

        def closing(told: str) -> str:
            leaves = each(f"filter({told}, s -> s.leaf IS NOT NULL)", lambda s: number(f"{s}.ord", f"{s}.leaf"))
            heard = f"filter({told}, s -> NOT s.closed AND (s.leaf IS NULL OR s.tag IN ({lits(_BRANCHING)})))"
            short = f"transform({heard}, s -> named_struct('ord', s.ord, 'kind', CASE WHEN s.leaf IS NULL THEN s.kind ELSE 'l' END, 'tag', s.tag))"
            return f"concat({leaves}, {let(short, lambda tags: bind(f'size({all_})', lambda end: fold(tags, end)))})"

        tags_only = f"filter({all_}, s -> s.kind IN ('o', 'c'))"
        others = each(f"filter({all_}, s -> s.kind <> 'o')", lambda s: number(f"{s}.ord", f"{s}.ord + 1"))
        return f"sort_array(concat({bind(tags_only, lambda t: bind(told_apart(t), closing))}, {others}))"

    return bind(shapes, both)


def with_nodes(pages: DataFrame, html: str = "html", keep_html: bool = False) -> DataFrame:
    """Replace the HTML column by ``nodes``; no shuffle."""
    others = [f"`{c}`" for c in pages.columns if keep_html or c != html]
    # tags are named for the whole page at once: a pattern for every token costs far more than a second pass
    tokens, names = f"regexp_extract_all({html}, {lit(TOKEN)}, 0)", f"regexp_extract_all({html}, {lit(NAMED_TOKEN)}, 1)"
    shaped = pages.selectExpr(*others, f"zip_with({tokens}, {names}, (t, n) -> {_token_node('t', 'n')}) AS __shapes")
    # the stack only needs position, kind and tag
    slim = shaped.selectExpr(
        *others,
        "__shapes",
        "transform(__shapes, (s, i) -> named_struct('ord', i, 'kind', s.kind, 'tag', s.tag)) AS __slim",
    )
    closed = slim.selectExpr(*others, "__shapes", f"{_element_ends('__slim')} AS __ends")
    classes = let(
        f"{first(keep('s.attrs', lambda a: f'{a}.k = {lit("class")}'))}.v",
        lambda v: f"CASE WHEN {v} = '' OR {v} RLIKE '\\\\s' THEN filter(split({v}, '\\\\s+'), q -> q <> '') WHEN {v} IS NOT NULL THEN array({v}) END",
    )
    return closed.selectExpr(
        *others,
        f"""zip_with(__shapes, __ends, (s, e) -> named_struct('ord', CAST(shiftright(e, {END_BITS}) AS INT), 'end', CAST(e & {(1 << END_BITS) - 1}L AS INT), 'kind', s.kind, 'tag', s.tag,
            'classes', CASE WHEN s.kind IN ('o', 'v') AND size(s.attrs) > 0 THEN {classes} END,
            'attrs', s.attrs, 'text', s.text)) AS nodes""",
    )


def page_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per node."""
    noded = with_nodes(pages, html)
    others = [f"`{c}`" for c in noded.columns if c != "nodes"]
    return noded.selectExpr(*others, "inline(nodes)")


def element_scopes(pages: DataFrame, tags: tuple[str, ...], html: str = "html") -> DataFrame:
    """Element scopes of the named tags, one row per element."""
    return page_nodes(pages, html).where(f"kind = 'o' AND tag IN ({lits(tags)})")


# --- selection inside a row ------------------------------------------------


def elements(nodes: str) -> str:
    return keep(nodes, lambda n: f"{n}.kind IN ('o', 'v')")


def attr(node: str, name: str) -> str:
    """Attribute value, NULL when absent; the first one counts."""
    return f"{first(keep(f'{node}.attrs', lambda a: f'{a}.k = {lit(name)}'))}.v"


def has_class(node: str, name: str) -> str:
    return f"coalesce(array_contains({node}.classes, {lit(name)}), false)"


def outermost(scopes: str) -> str:
    """``array<struct<ord, end>>``: the elements that lie in no other of ``scopes`` (in page order), merged once.

    Elements nest, so what lies in one of the scopes lies in one of these.  Like the element ends, the
    output grows per chunk.
    """
    empty = "CAST(array() AS ARRAY<STRUCT<ord: INT, end: INT>>)"

    def fold(all_: str) -> str:
        part = f"slice({all_}, c * {CHUNK} + 1, {CHUNK})"
        step = """CASE WHEN x.ord < b.edge THEN b ELSE named_struct('edge', x.end,
            'out', concat(b.out, array(named_struct('ord', x.ord, 'end', x.end)))) END"""
        inner = f"aggregate({part}, named_struct('edge', a.edge, 'out', {empty}), (b, x) -> {step})"
        merged = let(inner, lambda r: f"named_struct('edge', {r}.edge, 'out', concat(a.out, {r}.out))")
        chunks = f"sequence(0, CAST((size({all_}) - 1) DIV {CHUNK} AS INT))"
        return f"""CASE WHEN size({all_}) > 0 THEN aggregate({chunks}, named_struct('edge', -1, 'out', {empty}),
            (a, c) -> {merged}, z -> z.out) ELSE {empty} END"""

    return bind(scopes, fold)


def inside(node: str, merged: str) -> str:
    """True when the node lies in the content of one of the ``outermost`` scopes, found by bisection; ``merged`` is a name."""
    before = leading(merged, lambda s: f"{s}.ord < {node}.ord")
    return let(before, lambda n: f"({n} > 0 AND {merged}[{n} - 1].end > {node}.ord)")


def keep_inside(elems: str, scopes: str, test) -> str:
    """Elements that pass the test inside one of the scopes, in page order."""
    return bind(outermost(scopes), lambda m: keep(elems, lambda e: f"{test(e)} AND {inside(e, m)}"))


def content(nodes: str, element: str) -> str:
    """All nodes below an element."""
    return f"slice({nodes}, {element}.ord + 2, {element}.end - {element}.ord - 1)"


def node_text(nodes: str, element: str, separator: str = " ") -> str:
    """Text below an element, its text nodes joined in page order."""
    texts = keep(content(nodes, element), lambda n: f"{n}.kind = 't'")
    return f"array_join({each(texts, lambda n: f'{n}.text')}, {lit(separator)})"


def outer_html(nodes: str, element: str) -> str:
    """The element with its tags as one string."""
    span = f"slice({nodes}, {element}.ord + 1, {element}.end - {element}.ord + 1)"
    return f"array_join({each(span, lambda n: f'{n}.text')}, '')"
