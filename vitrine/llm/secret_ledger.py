"""Secret scans with an incremental ledger of blobs.

Every historical version of a text is a blob, addressed by the SHA-256 of its bytes. A ledger holds the
(blob, rule, version) triples that were scanned and what they gave. A scan looks only at blobs that some
current rule version has not seen, and there only for those rules; findings are joined back to every path
that holds the blob. Copies are scanned once.

Everything is DataFrame and SQL. Rules beyond the base kinds add spans of their own.

Cases: null text is the empty blob. Repeated rows are paths of their own. A blob without a finding has
ledger rows with no spans. Empty tables give no rows. Further columns of the paths are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import stage
from vitrine.llm.spans import joined, literal, matches

SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
LEDGER = f"blob string, rule string, version int, spans {SPANS}"


class Rule(NamedTuple):
    """A kind of secret; ``passes`` (SQL over s.value) drops matches that fail; a new pattern needs a new version."""

    kind: str
    version: int
    pattern: str
    gate: str
    passes: str = "true"


#: The base kinds in their order.
ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE = (
    Rule("assign", 1, rf"{ASSIGNED}([A-Za-z0-9+/_.=-]+)", r"(?i:passw|secret|token|api_?key)[a-zA-Z]*[\"'\x20]*[:=]", f"length(regexp_extract(s.value, {literal(rf'{ASSIGNED}([A-Za-z0-9+/_.=-]+)')}, 1)) >= 8"),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}+", "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{32,}+", r"[0-9a-f]{32}"),
)
#: Token formats with a prefix of their own.
FURTHER = (
    Rule("forge_token", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}+", "gh[pousr]_"),
    Rule("chat_token", 1, r"\bxox[abeprs]-[A-Za-z0-9-]{10,}+", "xox[abeprs]-"),
    Rule("maps_key", 1, r"\bAIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])", "AIza"),
    Rule("private_key", 1, r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", "PRIVATE KEY-----"),
    Rule("web_token", 1, r"\beyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", r"eyJ[A-Za-z0-9_-]+\.eyJ"),
)
RULES = BASE + FURTHER


def _scanned(rule: Rule) -> str:
    hits = f"filter({matches('text', rule.pattern, rule.gate)}, s -> {rule.passes})"
    return f"transform({hits}, s -> named_struct('kind', '{rule.kind}', 'start', s.start, 'end', s.end))"


#: Bits of the filter that picks the due rows where their texts stand; it bounds the broadcast, not the blobs.
FILTER_BITS, WORD = 1 << 25, 64
PLACE = "xxhash64(text, doc_id)"


def with_blob(paths: DataFrame, keep: list[str]) -> DataFrame:
    """kept, blob and place of every path; no texts."""
    whole = paths.selectExpr(f"struct({', '.join(f'`{c}`' for c in keep)}) as kept" if keep else "true as kept", "doc_id", "coalesce(text, '') as text")
    return whole.selectExpr("kept", "sha2(cast(text as binary), 256) as blob", f"{PLACE} as place")


def due_pairs(blobs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """blob, place (of one path that holds it) and due (rule kinds) of the blobs that some current rule version has not seen."""
    first = blobs.groupBy("blob").agg(F.min("place").alias("place"))
    every = ", ".join(f"'{r.kind}@{r.version}'" for r in rules)
    if ledger is None:
        return first.selectExpr("blob", "place", f"array({every}) as due")
    known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", F.col("version").cast("string"))).alias("known"))
    due = first.join(known, "blob", "left").selectExpr("blob", "place", f"array_except(array({every}), coalesce(known, cast(array() as array<string>))) as due")
    return due.where("size(due) > 0")


def _due_filter(due: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(word, bits): per rule a bitmap of the places that are due for it; at most ``FILTER_BITS / WORD`` rows."""
    hashed = due.selectExpr("due", f"pmod(xxhash64(place), {FILTER_BITS}L) as h").selectExpr("due", f"h div {WORD} as word", f"shiftleft(1L, cast(h % {WORD} as int)) as bit")
    bits = ", ".join(f"bit_or(if(array_contains(due, '{r.kind}@{r.version}'), bit, 0L))" for r in rules)
    return hashed.groupBy("word").agg(F.expr(f"array({bits})").alias("bits"))


def scan(paths: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, blobs: DataFrame | None = None) -> DataFrame:
    """New ledger rows: what the blobs of ``paths`` hold by rule versions that had not seen them.

    ``blobs`` is ``with_blob`` of the paths, if the caller has written it. One path per blob is chosen on slim rows;
    its text is scanned where it is read, as a broadcast bitmap of fixed size tells there what is due.
    A place that the bitmap takes for another's is scanned in vain, and its rows are left out at the end.
    """
    due = stage(due_pairs(with_blob(paths, []) if blobs is None else blobs, rules, ledger), "ledger-due")
    whole = paths.selectExpr("doc_id", "coalesce(text, '') as text").selectExpr("text", f"{PLACE} as place", f"pmod(xxhash64({PLACE}), {FILTER_BITS}L) as h")
    marked = whole.join(F.broadcast(_due_filter(due, rules)), F.expr(f"h div {WORD} = word"))
    asked = [f"getbit(bits[{i}], cast(h % {WORD} as int)) = 1" for i in range(len(rules))]
    each = ", ".join(f"if({a}, named_struct('rule', '{r.kind}', 'version', {r.version}, 'spans', {_scanned(r)}), null)" for r, a in zip(rules, asked, strict=True))
    found_here = marked.where(" or ".join(asked)).selectExpr("sha2(cast(text as binary), 256) as blob", "place", f"inline(filter(array({each}), r -> r is not null))")
    pairs = due.selectExpr("blob", "place", "explode(due) as pair")
    new = found_here.withColumn("pair", F.concat_ws("@", "rule", F.col("version").cast("string"))).join(pairs, ["blob", "place", "pair"])
    return new.dropDuplicates(["blob", "rule", "version"]).select("blob", "rule", "version", "spans")


def found(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its spans by the current rule versions, by start, then rule order; blobs without spans have no row."""
    order = "map(" + ", ".join(f"'{r.kind}', {i}" for i, r in enumerate(rules)) + ")"
    current = " or ".join(f"(rule = '{r.kind}' and version = {r.version})" for r in rules)
    merged = ledger.where(current).where("size(spans) > 0").groupBy("blob").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    by_start = f"array_sort(transform(spans, s -> named_struct('start', s.start, 'rank', {order}[s.kind], 'end', s.end, 'kind', s.kind)))"
    return merged.selectExpr("blob", f"transform({by_start}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end)) as spans")


def found_in(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """kept, blob and spans of every path of ``with_blob``; the ledger must cover the paths' blobs."""
    return (
        blobs.select("kept", "blob").join(found(ledger, rules), "blob", "left")
        .selectExpr("kept", "blob", f"coalesce(spans, cast(array() as {SPANS})) as spans")
    )


def findings(paths: DataFrame, ledger: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same, of the paths themselves."""
    return found_in(with_blob(paths, keep), ledger, rules)


def secrets(docs: DataFrame, ledger: DataFrame | None = None, increments: int = 2) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document.

    The paths come in ``increments``, by a hash of their ids: each scans what the ledger, written after the one before, doesn't hold yet.
    """
    blobs = stage(with_blob(docs, ["doc_id"]), "ledger-paths")
    turn = lambda column: F.pmod(F.xxhash64(column), F.lit(increments))
    whole = ledger
    for k in range(increments):
        new = stage(scan(docs.where(turn("doc_id") == k), RULES, whole, blobs.where(turn("kept.doc_id") == k)), "ledger-new")
        whole = new if whole is None else whole.unionByName(new)
    kinds = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = [f"cast(size(filter(base, s -> s.kind = '{r.kind}')) as bigint) as n_{r.kind}" for r in BASE]
    return (
        found_in(blobs, whole).selectExpr("kept.doc_id as doc_id", "spans", f"filter(spans, s -> s.kind in ({kinds})) as base")
        .selectExpr("doc_id", *counts, f"sha2({joined('base')}, 256) as base_sha256", f"{joined('spans')} as spans")
    )
