"""Sharding by a k-d tree over document metadata, balanced by bytes.

A node is split along its widest dimension (range over the whole table's range) at the weighted median of
bytes, or at the weighted share of its left leaves where their number is odd. The median is found by
histograms of 4096 bins that Spark sums for all nodes of a level at once, refined until the bin that holds
the cut weighs less than a thousandth of a leaf. The driver sees bins and cuts, never rows.

The query's dimensions come from the text alone (characters, bytes beyond one per character, CRC), and ties
fall in the order of the text's hash: equal texts are one point and share a shard. Only a group of equal
texts that weighs over a 64th of a leaf is spread by row, as it would upset the balance; at most 64 times
the number of shards can be that heavy.

Everything is DataFrame and SQL. Cases: null text weighs one byte. Null dimensions count as -1. Repeated
rows are placed each. With fewer rows than shards some shards stay empty. An empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import numbered, stage

BINS, TIE_TOP = 4096, 1 << 62
LAW = "bytes"


def text_dimensions(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    return {"chars": F.length(whole), "beyond": F.octet_length(whole) - F.length(whole), "crc": F.crc32(whole.cast("binary"))}


@dataclass
class Node:
    """A node of one level: its leaves, and the state of the search for its cut."""

    first_leaf: int
    leaves: int
    dim: int = 0
    low: int = 0
    width: int = 1
    value: int | None = None
    before: float = 0.0
    weight: float = 0.0
    cut: tuple[int, int] | None = None
    children: list[Node] = field(default_factory=list)

    @property
    def goal(self) -> float:
        return self.weight * (self.leaves // 2) / self.leaves


def _pick(values: list, place: str) -> str:
    """SQL: the entry of a literal array at the node."""
    return f"element_at(array({', '.join(str(v) + 'L' for v in values)}), cast({place} + 1 as int))"


def _of_dim(nodes: list[Node], names: list[str]) -> str:
    """SQL: the value of the node's dimension."""
    if not names[1:]:
        return names[0]
    picked = _pick([n.dim for n in nodes], "node")
    return f"case {picked} " + " ".join(f"when {i} then {name}" for i, name in enumerate(names)) + " end"


def _search(points: DataFrame, nodes: list[Node], names: list[str], tolerance: float) -> None:
    """One histogram over all nodes whose cut is open; narrows or settles each cut."""
    open_ones = {i for i, n in enumerate(nodes) if n.cut is None}
    by_tie = _pick([int(n.value is not None) for n in nodes], "node")
    exact = _pick([n.value or 0 for n in nodes], "node")
    low, width = _pick([n.low for n in nodes], "node"), _pick([n.width for n in nodes], "node")
    held = points.selectExpr("node", "size", f"{_of_dim(nodes, names)} as v", "tie").where(F.col("node").isin(*open_ones))
    held = held.where(f"{by_tie} = 0 or v = {exact}").selectExpr("node", "size", f"if({by_tie} = 1, tie, v) as key")
    held = held.where(f"key >= {low}").selectExpr("node", "size", "key", f"(key - {low}) div {width} as bin").where(f"bin < {BINS}")
    bins: dict[int, list] = {i: [] for i in open_ones}
    for r in held.groupBy("node", "bin").agg(F.sum("size").alias("w"), F.min("key").alias("least"), F.max("key").alias("most")).collect():
        bins[r["node"]].append((r["bin"], r["w"], r["least"], r["most"]))
    for i, own in bins.items():
        node = nodes[i]
        at = node.before
        for k, w, least, most in sorted(own):
            if at + w < node.goal:
                at += w
                continue
            cut = lambda key: (key, 0) if node.value is None else (node.value, key)  # noqa: B023, E731
            if w <= tolerance or (least == most and node.value is not None):
                nearer = least if node.goal - at <= at + w - node.goal else most + 1
                node.cut = cut(nearer)
            elif least == most:
                node.value, node.low, node.width, node.before = least, 0, TIE_TOP // BINS, at
            else:
                node.low, node.before = max(node.low + k * node.width, least), at
                node.width = max(1, -(-(most - node.low + 1) // BINS))
            break
        else:
            node.cut = (0, 0)


def leaves(points: DataFrame, names: list[str], shards: int) -> DataFrame:
    """``points`` (size, tie and the dimensions ``names``, all longs) with ``shard``."""
    level, out = [Node(0, shards)], points.withColumn("node", F.lit(0).cast("long"))
    whole: list[int] | None = None
    while any(n.leaves > 1 for n in level):
        spans = [x for name in names for x in (F.min(name).alias(f"{name}_low"), F.max(name).alias(f"{name}_high"))]
        seen = {r["node"]: r for r in out.groupBy("node").agg(F.sum("size").alias("w"), *spans).collect()}
        if whole is None:
            whole = [max(1, seen[0][f"{name}_high"] - seen[0][f"{name}_low"]) if seen else 1 for name in names]
            target = (seen[0]["w"] if seen else 0) / shards
        for i, node in enumerate(level):
            row = seen.get(i)
            if row is None or node.leaves == 1:
                node.cut = (TIE_TOP, 0)
                continue
            extents = [(row[f"{name}_high"] - row[f"{name}_low"]) / w for name, w in zip(names, whole, strict=True)]
            node.dim = extents.index(max(extents))
            node.low, node.weight = row[f"{names[node.dim]}_low"], row["w"]
            node.width = max(1, -(-(row[f"{names[node.dim]}_high"] - node.low + 1) // BINS))
        while any(n.cut is None for n in level):
            _search(out, level, names, target / 1000)
        value, tie = _pick([n.cut[0] for n in level], "node"), _pick([n.cut[1] for n in level], "node")
        right = f"v > {value} or (v = {value} and tie >= {tie})"
        moved = out.selectExpr("*", f"{_of_dim(level, names)} as v").selectExpr(*out.drop("node").columns, f"2 * node + if({right}, 1, 0) as node")
        out = stage(moved, "shard-level")  # a level's cuts aren't evaluated again by the next ones
        below = []
        for n in level:
            left = n.leaves // 2 or 1
            below += [Node(n.first_leaf, left), Node(n.first_leaf + left, max(n.leaves - left, 1))]
        level = below
    first = _pick([n.first_leaf for n in level], "node")
    return out.selectExpr(*out.drop("node").columns, f"cast({first} as int) as shard")


def shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    dims = text_dimensions(F.col("text"))
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select("doc_id", (F.octet_length(whole) + 1).cast("long").alias("size"), F.xxhash64(whole).alias("same"),
                    F.monotonically_increasing_id().alias("row_key"), *(F.coalesce(c.cast("long"), F.lit(-1)).alias(n) for n, c in dims.items())),
        "shard-points",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = [r["same"] for r in rows.groupBy("same").agg(F.sum("size").alias("w")).where(F.col("w") > total / count / 64).select("same").collect()]
    point = F.when(F.col("same").isin(*heavy), F.xxhash64("same", "row_key")).otherwise(F.col("same"))
    placed = stage(leaves(rows.withColumn("tie", F.shiftrightunsigned(point, 2)), list(dims), count), "shard-leaves")
    return numbered(placed, "shard", ["row_key"], "slot", placed.count()).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
