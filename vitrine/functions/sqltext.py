"""Small helpers to write Spark SQL expressions as text.

The page facts are long nested expressions over arrays.  Written with the Column
API each of them costs hundreds of driver round trips; as SQL text it is parsed
in one.  Every function of this package therefore takes SQL expressions (column
names, lambda variables, literals) and returns a SQL expression.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable

_names = itertools.count()


def lit(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lits(values: Iterable[str]) -> str:
    """Comma-separated string literals."""
    return ", ".join(lit(v) for v in values)


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it by name inside ``body``.

    A fold over nothing hands its start value to the finishing lambda; unlike
    ``transform(array(value), …)[0]`` it does not copy what the body returns.
    """
    return body(value) if re.fullmatch(r"[A-Za-z_][\w.]*", value) else bind(value, body)


def bind(value: str, body: Callable[[str], str]) -> str:
    """Like ``let``, for columns too: the optimizer may put a column's expression in its place, and inside a
    lambda that is evaluated for every element."""
    name = f"v{next(_names)}"
    return f"aggregate(CAST(array() AS ARRAY<INT>), {value}, (a{name}, i{name}) -> a{name}, {name} -> {body(name)})"


def each(array: str, body: Callable[[str], str]) -> str:
    name = f"e{next(_names)}"
    return f"transform({array}, {name} -> {body(name)})"


def keep(array: str, test: Callable[[str], str]) -> str:
    name = f"e{next(_names)}"
    return f"filter({array}, {name} -> {test(name)})"


def any_of(array: str, test: Callable[[str], str]) -> str:
    name = f"e{next(_names)}"
    return f"exists({array}, {name} -> {test(name)})"


def leading(array: str, test: Callable[[str], str]) -> str:
    """How many of the first elements pass a test that no element passes after one that fails, by bisection.

    ``array`` should be a name: it is read at every step.
    """
    state, mid = f"s{next(_names)}", f"m{next(_names)}"
    halves = f"""CASE WHEN {state}.low >= {state}.high THEN {state} ELSE aggregate(CAST(array() AS ARRAY<INT>),
        CAST(({state}.low + {state}.high) DIV 2 AS INT), (a{mid}, i{mid}) -> a{mid},
        {mid} -> CASE WHEN {test(f'{array}[{mid}]')} THEN named_struct('low', {mid} + 1, 'high', {state}.high)
            ELSE named_struct('low', {state}.low, 'high', {mid}) END) END"""
    steps = f"CAST(ceil(log2(size({array}) + 1)) AS INT)"
    return f"""aggregate(array_repeat(0, {steps}), named_struct('low', 0, 'high', greatest(size({array}), 0)),
        ({state}, i{state}) -> {halves}, {state} -> {state}.low)"""


def first(array: str) -> str:
    """First element, NULL when there is none."""
    return f"get({array}, 0)"


def missing(text: str) -> str:
    """``''`` to NULL, so that ``coalesce`` walks over it.

    Bound: ``nullif`` is rewritten to an expression that holds its argument twice, and where choices nest each level doubles the work.
    """
    return let(text, lambda t: f"CASE WHEN {t} <> '' THEN {t} END")


def first_filled(*choices: str) -> str:
    """First choice that is neither NULL nor ``''``; ``''`` when there is none."""
    return f"coalesce({', '.join(missing(c) for c in choices)}, '')"
