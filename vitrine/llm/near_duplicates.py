"""Near-duplicate documents by SimHash and multi-index hashing, at a similarity instead of a number of bits.

Documents are sets of ``SHINGLE``-word shingles. A wide SimHash fingerprint (bit i is set if more than half of the distinct shingles
set it) is cut into segments. Two documents of Jaccard J differ in a bit with probability acos(2J / (1 + J)) / pi, so the number of
segments is chosen such that a pair of Jaccard ``similar`` has a segment with at most one differing bit with probability ``RECALL``, and a
segment has a few bits more than the table's count of distinct documents needs (``Layout``).

Documents of equal shingle sets are one node. First every node is compared with the few smallest nodes of its segment values that it shares most segments with:
this settles large groups of near copies without all of their pairs. Then all nodes look up the Hamming
ball of radius one about each segment (a node probes only the values with one bit more, so every pair meets once), and every pair is
met whose nodes the first step has not put into one group; within a group a further link changes nothing. Pairs of
single nodes are fetched row by row. What meets a group, or a segment value of over ``CROWD`` single nodes, is a row per node and group or value,
and is compared in blocks of nodes inside the tasks (``block_links``): no row is made for a pair that turns out not to be near.
Pairs are verified twice: by the complete distance of the fingerprints, then by the exact Jaccard of the shingle sets of their texts.
Groups are connected components of what passes.

Cases: null, empty and wordless texts have no shingle and are one node, near no other. Fewer words than a shingle are one
shingle. Rows that share ``doc_id`` and text are copies; rows that share ``doc_id`` alone are different documents. Null ids come last
among the rows of a group. Empty tables give no rows. Further columns, maps included, are returned as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import byte_table, components, map_arrow, release, stage, union_all
from vitrine.operators.lookup import maybe_listed
from vitrine.session import clear_scratch, scratch_mark

SHINGLE, SIMILAR, RECALL = 5, 0.8, 0.95
LOWER = byte_table(gaps=False)
MEMO = 200_000
LEADERS = 3  # nodes that a node is compared with before the second step
WAVE = 4  # segments whose balls are looked up at once
CROWD = 64  # single nodes of a segment value that are met node by node
PRINTS, BLOCK = 256, 8_192  # nodes that are compared as one block by their fingerprints, shingles of those that are by their sets, about
WORDS, EARLY = 8, 4  # words of a fingerprint at least; those of them that travel with its probes
SPREAD = 2.0  # standard deviations that a true pair's distance may lie above its mean


def bit_difference(similar: float) -> float:
    """Probability that a fingerprint bit differs."""
    return math.acos(2 * similar / (1 + similar)) / math.pi


class Layout(NamedTuple):
    """``segments`` of ``bits`` bits each; fingerprints of ``words`` 64-bit words; at most ``near`` of all bits differ, at most ``first`` of the first ``early`` words."""

    segments: int
    bits: int
    words: int
    near: int
    first: int
    early: int = 1


def layout(nodes: int, similar: float = SIMILAR, recall: float = RECALL) -> Layout:
    q = bit_difference(similar)
    bits = min(32, max(16, math.ceil(math.log2(nodes + 1)) + 2))
    hit = (1 - q) ** bits + bits * q * (1 - q) ** (bits - 1)
    segments = math.ceil(math.log(1 - recall) / math.log(1 - hit))
    words = max(WORDS, -(-segments * bits // 64))
    limit = lambda n: math.ceil(n * q + SPREAD * math.sqrt(n * q * (1 - q)))
    early = min(EARLY, words)
    return Layout(segments, bits, words, limit(64 * words), limit(64 * early), early)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None, memo: dict[bytes, int], size: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(memo) > MEMO:
        memo.clear()
    for w in set(words).difference(memo):
        memo[w] = xxhash.xxh64_intdigest(w, 11)
    codes = np.array([memo[w] for w in words], dtype=np.uint64)
    n = max(1, len(codes) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(codes))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    return np.unique(_mixed(out))


def wide_fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit words; every word sees its own mix of the shingle hashes."""
    n = len(hashes)
    if not n:
        return np.zeros(words, dtype=np.uint64)
    salts = np.array([(0x9E3779B97F4A7C15 * (k + 1)) % (1 << 64) for k in range(words)], dtype=np.uint64)[:, None]
    set_bits = np.zeros((words, 64), dtype=np.int64)
    for first in range(0, n, 255):  # a byte counts that many
        mixed = _mixed(hashes[first : first + 255] + salts).astype("<u8")
        set_bits += np.add.reduce(np.unpackbits(mixed.view(np.uint8).reshape(words, -1, 8), axis=2, bitorder="little"), axis=1, dtype=np.uint8)
    return np.packbits(2 * set_bits > n, axis=1, bitorder="little").view("<u8").reshape(words).astype(np.uint64)


def node_of(hashes: np.ndarray) -> int:
    """A hash of the set; 0 for the empty one."""
    if not len(hashes):
        return 0
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), 5)], dtype=np.uint64).view(np.int64)[0])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("at"), F.col("text").cast("binary").alias("text"))


def nodes(docs: DataFrame, plan: Layout, size: int = SHINGLE) -> DataFrame:
    """doc_id, at (row key), node, size (distinct shingles) and fp (array of longs) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            found = [shingles(t, memo, size) for t in batch.column("text").to_pylist()]
            prints = np.array([wide_fingerprint(h, plan.words) for h in found], dtype=np.uint64).reshape(len(found), plan.words).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("at"), pa.array([node_of(h) for h in found], pa.int64())]
            columns += [pa.array([len(h) for h in found], pa.int32()), pa.array(prints.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "at", "node", "size", "fp"])

    inner = _texts(docs)
    schema = inner.select("doc_id", "at").schema.add("node", "long").add("size", "integer").add("fp", T.ArrayType(T.LongType()))
    return map_arrow(inner, run, schema)


def _segments(plan: Layout, chosen: range | None = None) -> str:
    """SQL: the values of all or the chosen segments, the segment's number above its bits."""
    parts = []
    for k in chosen or range(plan.segments):
        low = k * plan.bits
        word, shift = low // 64, low % 64
        value = f"shiftrightunsigned(fp[{word}], {shift})"
        if shift + plan.bits > 64:
            value = f"({value} | shiftleft(fp[{word + 1}], {64 - shift}))"
        parts.append(f"({value} & {(1 << plan.bits) - 1}L) + {k << plan.bits}L")
    return f"array({', '.join(parts)})"


def _distance(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)"


def _index(table: DataFrame, plan: Layout, similar: float | None, *more: str, chosen: range | None = None) -> DataFrame:
    """node, size, w0 ... (the early words), ``more`` columns and key of every (chosen) segment."""
    words = [f"fp[{k}] as w{k}" for k in range(plan.early)]
    return table.where("node <> 0").selectExpr("node", "size" if similar else "1 as size", *words, *more, f"explode({_segments(plan, chosen)}) as key")


def _side(plan: Layout, of: str) -> list[str]:
    return [f"node as {of}", f"size as n{of}", *(f"w{k} as w{of}{k}" for k in range(plan.early))]


def _may_be_near(plan: Layout, similar: float | None) -> str:
    """SQL: no more than ``first`` bits of the early words differ and, with ``similar``, the sizes allow that Jaccard."""
    differing = " + ".join(f"bit_count(wa{k} ^ wb{k})" for k in range(plan.early))
    return f"{differing} <= {plan.first} and least(na, nb) >= {similar or 1}D * greatest(na, nb)"


def leader_pairs(table: DataFrame, plan: Layout, similar: float | None = None) -> DataFrame:
    """(a, b): nodes with those ``LEADERS`` of the smallest nodes of their segment values that may be near and share most segments with them.

    At most ``LEADERS`` rows a node, whatever the groups; nodes that these don't settle are looked up in the second step.
    """
    index = _index(table, plan, similar)
    first = index.groupBy("key").agg(F.min(F.struct("node", "size", *(f"w{k}" for k in range(plan.early)))).alias("led")).select("key", "led.*")
    met = index.selectExpr("key", *_side(plan, "a")).join(first.selectExpr("key", *_side(plan, "b")), "key").where(f"a <> b and {_may_be_near(plan, similar)}")
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "b"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")).withColumn("place", place).where(F.col("place") <= LEADERS).select("a", "b")


def _heads(index: DataFrame, plan: Layout) -> DataFrame:
    """One row per key and root; of a root with several nodes without size and words, so that a group is not met node by node."""
    columns = ["size", *(f"w{k}" for k in range(plan.early))]
    many = index.where("not alone").select("key", "root").distinct()
    return index.where("alone").select("key", "root", *columns).unionByName(many, allowMissingColumns=True)


def ball_pairs(table: DataFrame, plan: Layout, similar: float | None = None) -> DataFrame:
    """(a, b): nodes that may be near and have a segment in which they differ in one bit at most.

    With the columns ``root`` and ``alone`` (it is the only node of its root) only pairs of different roots. ``WAVE`` segments
    are looked up at once: their index and shuffles are gone from the disk before the next ones are written.
    """
    table = table if "root" in table.columns else table.selectExpr("*", "node as root", "true as alone")
    waves = []
    for first in range(0, plan.segments, WAVE):
        begun = scratch_mark()
        waves.append(stage(_ball_wave(table, plan, similar, range(first, min(first + WAVE, plan.segments))), "near-met"))
        clear_scratch(table.sparkSession, begun, kept=1)
        release(table.sparkSession)
    return union_all(waves).distinct()


def _ball_wave(table: DataFrame, plan: Layout, similar: float | None, chosen: range) -> DataFrame:
    """The pairs of ``ball_pairs`` that the chosen segments find."""
    index = stage(_index(table, plan, similar, "root", "alone", chosen=chosen), "near-index")
    heads = _heads(index, plan).withColumnRenamed("root", "node")
    zeros = f"filter(sequence(0, {plan.bits - 1}), i -> getbit(key, i) = 0)"
    ball = f"explode(concat(array(named_struct('equal', true, 'key', key)), transform({zeros}, i -> named_struct('equal', false, 'key', key | shiftleft(1L, i))))) as met"
    probes = heads.selectExpr(*_side(plan, "a"), "if(size is null, key, null) as home", ball).select("*", "met.*").drop("met")
    # equal values meet from both sides
    met = probes.join(heads.selectExpr("key", *_side(plan, "b")), "key").where(
        f"a <> b and (not equal or a < b) and (na is null or nb is null or {_may_be_near(plan, similar)})"
    )
    fetched = stage(met.selectExpr("a", "b", "key", "home", "na is null as many_a", "nb is null as many_b"), "near-fetched")
    members = index.where("not alone").select("key", "root", "node", "size", *(f"w{k}" for k in range(plan.early)))
    nodes_of = table.where("alone").selectExpr("node", "size" if similar else "1 as size", *(f"fp[{k}] as w{k}" for k in range(plan.early)))
    groups = fetched.where("many_a or many_b")
    side_a = groups.where("many_a").withColumnsRenamed({"a": "ra", "b": "rb"}).join(members.selectExpr("key as home", "root as ra", *_side(plan, "a")), ["home", "ra"])
    lone_a = groups.where("not many_a").withColumnsRenamed({"a": "ra", "b": "rb"}).join(nodes_of.selectExpr("node as ra", *_side(plan, "a")), "ra")
    left = side_a.unionByName(lone_a)
    side_b = left.where("many_b").join(members.selectExpr("key", "root as rb", *_side(plan, "b")), ["key", "rb"])
    lone_b = left.where("not many_b").join(nodes_of.selectExpr("node as rb", *_side(plan, "b")), "rb")
    expanded = side_b.unionByName(lone_b).where(_may_be_near(plan, similar)).select("a", "b")
    every = fetched.where("not (many_a or many_b)").select("a", "b").unionByName(expanded)
    return every.selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct()


class Meets(NamedTuple):
    """What the balls of all segments find: (a, b) of single nodes, (ra, rb) of roots of which rb has several nodes, and (key, node) that look up a crowded value and that have it."""

    pairs: DataFrame
    roots: DataFrame
    probing: DataFrame
    crowd: DataFrame


def ball_meets(table: DataFrame, plan: Layout, similar: float | None = None) -> Meets:
    """The pairs of ``ball_pairs``, those with groups and in crowded segment values not unfolded; ``table`` has ``root`` and ``alone``."""
    waves = []
    for first in range(0, plan.segments, WAVE):
        begun = scratch_mark()
        waves.append(_meets_of_wave(table, plan, similar, range(first, min(first + WAVE, plan.segments))))
        clear_scratch(table.sparkSession, begun, kept=len(waves[-1]))
        release(table.sparkSession)
    fetched, probing, crowd = (union_all(list(x)) for x in zip(*waves, strict=True))
    roots = fetched.where("many_a or many_b").selectExpr(
        "if(many_a and many_b, least(a, b), if(many_b, a, b)) as ra", "if(many_a and many_b, greatest(a, b), if(many_b, b, a)) as rb"
    )
    pairs = fetched.where("not (many_a or many_b)").selectExpr("least(a, b) as a", "greatest(a, b) as b")
    return Meets(pairs.distinct(), roots.distinct(), probing, crowd)


def _meets_of_wave(table: DataFrame, plan: Layout, similar: float | None, chosen: range) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the chosen segments: (a, b, many_a, many_b) of roots, (key, node) that look up a crowded value, (key, node) that have it."""
    index = stage(_index(table, plan, similar, "root", "alone", chosen=chosen), "near-index")
    heads = _heads(index, plan).withColumnRenamed("root", "node")
    lone, many = heads.where("size is not null"), heads.where("size is null")
    held = lone.groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    crowded = stage(held.where(f"held > {CROWD}").select("key"), "near-crowded")
    bits = lambda set_: f"filter(sequence(0, {plan.bits - 1}), i -> getbit(key, i) = {set_})"
    ball = f"explode(concat(array(named_struct('equal', true, 'key', key)), transform({bits(0)}, i -> named_struct('equal', false, 'key', key | shiftleft(1L, i))))) as met"
    probes = heads.selectExpr(*_side(plan, "a"), ball).select("*", "met.*").drop("met")
    # single nodes of crowded values are looked up apart; equal values meet from both sides, a node and a group from that of the node
    looked_up = lone.join(held.where(f"held <= {CROWD}"), "key").select(lone.columns).unionByName(many.select(lone.columns))
    met = probes.join(looked_up.selectExpr("key", *_side(plan, "b")), "key").where(
        f"a <> b and (not equal or if((na is null) = (nb is null), a < b, nb is null)) and (na is null or nb is null or {_may_be_near(plan, similar)})"
    )
    fetched = met.selectExpr("a", "b", "na is null as many_a", "nb is null as many_b")
    own = index.where("alone").join(crowded, "key").select("key", "node")
    if not crowded.isEmpty():
        # a group with one bit less would look them up: they look it up instead
        below = own.selectExpr("node as a", f"explode(transform({bits(1)}, i -> key ^ shiftleft(1L, i))) as key")
        fetched = fetched.unionByName(below.join(many.selectExpr("key", "node as b"), "key").selectExpr("a", "b", "false as many_a", "true as many_b"))
    fetched = stage(fetched.distinct(), "near-fetched")
    asked_from = crowded.selectExpr("key as asked", f"explode(concat(array(key), transform({bits(1)}, i -> key ^ shiftleft(1L, i)))) as key")
    probing = stage(lone.join(asked_from, "key").selectExpr("asked as key", "node"), "near-probing")
    return fetched, probing, stage(own, "near-crowd")


def _sets(docs: DataFrame, table: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node and own (32-bit shingles, sorted) of the nodes in ``wanted``, from the texts."""
    wanted = stage(wanted.select("node").distinct().join(table.select("node", "at"), "node"), "near-wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            # 32 bits of a hash tell the shingles of two texts apart well enough for a share of them
            sets = [np.unique(shingles(t, memo, size) >> np.uint64(32)).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(sets, pa.binary())], names=["at", "own"])

    texts = maybe_listed(_texts(docs), wanted, "at").select("at", "text")
    return stage(map_arrow(texts, run, "at long, own binary").join(wanted, "at").select("node", "own").dropDuplicates(["node"]), "near-sets")


def _similar(x: np.ndarray, y: np.ndarray, similar: float) -> bool:
    """Whether two sets have that Jaccard."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similar * (len(x) + len(y) - common)


def verified(docs: DataFrame, table: DataFrame, pairs: DataFrame, plan: Layout, similar: float, size: int) -> DataFrame:
    """Pairs whose complete distance is near and whose shingle sets have a Jaccard of ``similar`` or more."""
    prints = table.select("node", "fp")
    close = stage(
        pairs.join(prints.selectExpr("node as a", "fp as fa"), "a").join(prints.selectExpr("node as b", "fp as fb"), "b")
        .where(f"{_distance('fa', 'fb')} <= {plan.near}").select("a", "b"), "near-close",
    )
    sets = _sets(docs, table, close.selectExpr("explode(array(a, b)) as node"), size)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True)
            keep = [_similar(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), similar) for x, y in both]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = close.join(sets.selectExpr("node as a", "own as xa"), "a").join(sets.selectExpr("node as b", "own as xb"), "b").select("a", "b", "xa", "xb")
    return map_arrow(both, judge, "a long, b long")


def near_in_block(fp: np.ndarray, size: int, root: int, others: tuple, plan: Layout, similar: float) -> np.ndarray:
    """Which of the other nodes (roots, fingerprints, sizes) with another root a node may be linked to, as ``ball_pairs`` and the complete distance say, nearest first."""
    roots, prints, sizes = others
    differ = fp ^ prints
    apart = np.bitwise_count(differ).sum(axis=1)
    may = np.flatnonzero((apart <= plan.near) & (roots != root) & (np.minimum(size, sizes) >= similar * np.maximum(size, sizes)))
    may = may[np.bitwise_count(differ[may, : plan.early]).sum(axis=1) <= plan.first]
    bits = np.unpackbits(differ[may].view(np.uint8), axis=1, bitorder="little")[:, : plan.segments * plan.bits]
    may = may[(bits.reshape(len(may), plan.segments, plan.bits).sum(axis=2, dtype=np.uint8) <= 1).any(axis=1)]
    return may[np.argsort(apart[may], kind="stable")]


def _in_blocks(left: DataFrame, right: DataFrame, facts: DataFrame, weight: str, limit: int) -> DataFrame:
    """crowd, target, l and r: the nodes on either side of a target, with the columns of ``facts``, in blocks of about ``limit`` by the sum of ``weight``; every block meets every block of the other side."""
    at = ["crowd", "target"]
    held = F.struct(*facts.columns)

    def counted(side: DataFrame) -> DataFrame:
        return side.join(facts, "node").groupBy(*at).agg(F.expr(f"ceil(sum({weight}) / {limit})").alias("blocks"))

    def blocks(side: DataFrame, counts: DataFrame, name: str) -> DataFrame:
        dealt = side.join(counts, at).selectExpr(*at, "node", "pmod(xxhash64(node), blocks) as block")
        return dealt.join(facts, "node").select(*at, "block", held.alias("held")).groupBy(*at, "block").agg(F.collect_list("held").alias(name))

    per_right = stage(counted(right), "near-blocks")
    asking = blocks(left, counted(left), "l").drop("block").join(per_right, at).selectExpr(*at, "l", "explode(sequence(0L, blocks - 1)) as block")
    return asking.join(blocks(right, per_right, "r"), [*at, "block"]).select(*at, "l", "r")


def _columns(held: pa.ListScalar) -> dict[str, np.ndarray | list]:
    """The columns of a block: fingerprints as rows of words, sets as arrays."""
    rows = held.values
    out = dict(zip((f.name for f in rows.type), rows.flatten(), strict=True))
    prints = out["fp"].flatten().to_numpy().view(np.uint64).reshape(len(rows), -1)
    more = {"own": [np.frombuffer(x, "<u4") for x in out["own"].to_pylist()]} if "own" in out else {}
    return {k: out[k].to_numpy() for k in ("node", "root", "size")} | {"fp": prints} | more


def block_links(docs: DataFrame, table: DataFrame, meets: Meets, plan: Layout, similar: float, size: int) -> DataFrame:
    """(a, b): links of nodes with the groups and with the crowds that they have met, one of a node with a root of the other side's block.

    The nodes on either side of a group or a segment value are dealt to blocks by their hash, and every block of one side meets every
    block of the other as a row; all their pairs are compared in the task. First by fingerprints, which leaves the nodes that are
    near one of the other side at all, then these with their sets, nearest first: a further link to the same root changes nothing.
    """
    member = table.select("root", "node")
    left = meets.roots.join(member.withColumnRenamed("root", "ra"), "ra").selectExpr("false as crowd", "rb as target", "node").unionByName(
        meets.probing.selectExpr("true as crowd", "key as target", "node")
    )
    right = meets.roots.select("rb").distinct().join(member.withColumnRenamed("root", "rb"), "rb").selectExpr("false as crowd", "rb as target", "node").unionByName(
        meets.crowd.selectExpr("true as crowd", "key as target", "node")
    )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for crowd, target, l, r in zip(*(batch.column(c) for c in ("crowd", "target", "l", "r")), strict=True):  # noqa: E741
                x, y = _columns(l), _columns(r)
                found = [near_in_block(x["fp"][i], x["size"][i], x["root"][i], (y["root"], y["fp"], y["size"]), plan, similar) for i in range(len(x["node"]))]
                asking = x["node"][[i for i, j in enumerate(found) if len(j)]]
                met = y["node"][np.unique(np.concatenate(found))]
                n = len(asking) + len(met)
                columns = [pa.array([crowd.as_py()] * n, pa.bool_()), pa.array([target.as_py()] * n, pa.int64())]
                columns += [pa.array(np.concatenate([asking, met]), pa.int64()), pa.array([True] * len(asking) + [False] * len(met), pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["crowd", "target", "node", "asks"])

    prints = table.select("node", "root", "size", "fp")
    close = stage(map_arrow(_in_blocks(stage(left.distinct(), "near-left"), stage(right, "near-right"), prints, "1", PRINTS), near, "crowd boolean, target long, node long, asks boolean").distinct(), "near-sides")
    facts = stage(prints.join(_sets(docs, table, close, size), "node"), "near-facts")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for l, r in zip(batch.column("l"), batch.column("r"), strict=True):  # noqa: E741
                x, y = _columns(l), _columns(r)
                found = []
                for i in range(len(x["node"])):
                    reached: set[int] = set()
                    for j in near_in_block(x["fp"][i], x["size"][i], x["root"][i], (y["root"], y["fp"], y["size"]), plan, similar).tolist():
                        if y["root"][j] not in reached and _similar(x["own"][i], y["own"][j], similar):
                            reached.add(y["root"][j])
                            found.append((x["node"][i], y["node"][j]))
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    sides = [close.where(test).drop("asks") for test in ("asks", "not asks")]
    return map_arrow(_in_blocks(*sides, facts, "size", BLOCK).select("l", "r"), linked, "a long, b long")


def grouped(docs: DataFrame, similar: float = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """doc_id, at and root of every row: rows with one root are near-duplicates, directly or through others."""
    spark, begun = docs.sparkSession, scratch_mark()
    plan = layout(docs.count(), similar)
    rows = stage(nodes(docs, plan, size), "near-rows")
    table = stage(rows.groupBy("node").agg(F.min("at").alias("at"), F.first("size").alias("size"), F.first("fp").alias("fp")), "near-nodes")
    mark = scratch_mark()
    first = stage(verified(docs, table, leader_pairs(table, plan, similar), plan, similar, size), "near-first")
    clear_scratch(spark, mark, kept=1)
    mark = scratch_mark()
    settled = components(first, "near-first").selectExpr("id as node", "component_id as root")
    rooted = stage(table.join(settled, "node", "left").selectExpr(*table.columns, "coalesce(root, node) as root", "root is null as alone"), "near-rooted")
    clear_scratch(spark, mark, kept=1)
    release(spark)
    mark = scratch_mark()
    meets = ball_meets(rooted, plan, similar)
    in_blocks = stage(block_links(docs, rooted, meets, plan, similar, size), "near-in-blocks")
    second = stage(verified(docs, rooted, meets.pairs, plan, similar, size).unionByName(in_blocks), "near-second")
    clear_scratch(spark, mark, kept=1)
    release(spark)
    roots = components(first.unionByName(second), "near").selectExpr("id as node", "component_id as root")
    members = stage(rows.join(roots, "node", "left").select("doc_id", "at", F.coalesce("root", "node").alias("root")), "near-members")
    clear_scratch(spark, begun, kept=1)
    return members


def keep_one(docs: DataFrame, similar: float = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """One row of every group, all columns: that of the smallest doc_id (null ids last), of rows that share it the one of the smallest row key.

    Of rows that share id and text, the one of the smallest hash of its other columns stays (columns that can't be hashed don't count).
    """
    begun = scratch_mark()
    members = grouped(docs, similar, size)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "at")
    kept = stage(members.groupBy("root").agg(F.min(order).alias("f")).selectExpr("f.at as _at").distinct(), "near-kept")
    clear_scratch(docs.sparkSession, begun, kept=1)
    release(docs.sparkSession)
    columns = docs.columns
    plain = [f.name for f in docs.schema.fields if not _holds_map(f.dataType)]
    packed = docs.select(F.struct(*columns).alias("_row"), F.xxhash64("doc_id", "text").alias("_at"), F.xxhash64(*plain).alias("_hash"))
    return packed.join(kept, "_at", "left_semi").groupBy("_at").agg(F.min_by("_row", "_hash").alias("_row")).select("_row.*")


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))
