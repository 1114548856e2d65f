"""Approximate nearest neighbours by a hash-prefix forest.

The rows are dealt into index shards. A shard holds, per tree, the sorted array of its vectors' hash
strings (signs of random projections). A query descends every tree to its longest matching prefix; then all
trees ascend together, one bit at a time, until the prefix ranges hold enough candidates. Candidates are
scored with their true inner product in double precision, and Spark merges the shards' best.

Largest inner product becomes smallest angle by one more component, which fills every indexed vector up to
the shard's greatest norm and is zero for queries. Equal vectors are one entry of a shard, with the rows that
can be among the nearest: one more than the number of neighbours. The ascent stops at ``effort`` times the
shard's entries, counted with repeats over trees; in a shard of up to ``least`` entries it goes on to the root, where
every entry is a candidate. Nothing found is cut off.

Queries go out in waves of ``wave`` rows, a broadcast each; a wave's results are written before the next one goes out,
so the query set may grow with the table.

Cases: vectors that are null, empty, all zero or hold null or non-finite components take no part, nor do
rows without an id. A vector meets only vectors of its own length. Rows that repeat an id and a vector
count once; different vectors under one id are rows of their own, each a candidate for the others, and each a query with its
own ranks. Ties go to the smaller id. Fewer candidates than neighbours are all returned. Empty tables give no rows. Further columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import map_arrow, stage, union_all


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and row, its key: one row per id and vector."""
    sound = F.exists("embedding", lambda x: x != 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & sound).distinct().withColumn("row", F.xxhash64("vec_id", "embedding"))


class Forest:
    """Sorted hash strings of the entries ``x``, a row per tree."""

    BITS = 30

    def __init__(self, x: np.ndarray, trees: int, seed: int):
        self.trees = trees
        norms = np.sqrt((x * x).sum(axis=1))
        filled = np.concatenate([x, np.sqrt(np.maximum(norms.max() ** 2 - norms**2, 0))[:, None]], axis=1)
        self.planes = np.random.default_rng(seed).standard_normal((filled.shape[1], trees * self.BITS)).astype(np.float32)
        keys = self._keys(filled)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def _keys(self, x: np.ndarray) -> np.ndarray:
        powers = 1 << np.arange(self.BITS - 1, -1, -1, dtype=np.int64)
        out = np.empty((self.trees, len(x)), dtype=np.int64)
        for first in range(0, len(x), 2048):
            part = x[first : first + 2048].astype(np.float32) @ self.planes > 0
            out[:, first : first + len(part)] = (part.reshape(len(part), self.trees, self.BITS) @ powers).T
        return out

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """Entries per query, without repeats."""
        keys = self._keys(np.concatenate([queries, np.zeros((len(queries), 1))], axis=1))
        shape = (len(queries), self.trees)
        low, high = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
        waiting = np.arange(len(queries))
        for depth in range(self.BITS, -1, -1):
            shift = self.BITS - depth
            prefix = keys[:, waiting] >> shift
            new_low, new_high = np.empty((len(waiting), self.trees), dtype=np.int64), np.empty((len(waiting), self.trees), dtype=np.int64)
            for t in range(self.trees):
                new_low[:, t] = np.searchsorted(self.keys[t], prefix[t] << shift)
                new_high[:, t] = np.searchsorted(self.keys[t], (prefix[t] + 1) << shift)
            held = (high - low)[waiting]
            total = held.sum(axis=1)[:, None] + np.cumsum(new_high - new_low - held, axis=1)
            done = total[:, -1] >= enough
            # The trees ascend in turn; those after the one that made it enough stay a bit deeper.
            risen = ~done[:, None] | (np.arange(self.trees) <= np.argmax(total >= enough, axis=1)[:, None])
            low[waiting] = np.where(risen, new_low, low[waiting])
            high[waiting] = np.where(risen, new_high, high[waiting])
            waiting = waiting[~done]
            if not len(waiting):
                break
        mask = np.zeros(self.order.shape[1], dtype=bool)
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            mask[:] = False
            for t in range(self.trees):
                if b[t] > a[t]:
                    mask[self.order[t, a[t] : b[t]]] = True
            yield np.flatnonzero(mask)


class Shard:
    """Vectors of one length in an index shard."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, neighbours: int, trees: int, seed: int, effort: float, least: int):
        order = np.lexsort((rows, ids))
        _, first, entry = np.unique(x[order], axis=0, return_index=True, return_inverse=True)
        self.x, self.neighbours = x[order][first], neighbours
        by_entry = np.argsort(entry, kind="stable")
        starts = np.searchsorted(entry[by_entry], np.arange(len(first) + 1))
        self.ids, self.rows = ids[order], rows[order]
        self.held = [by_entry[a : min(b, a + neighbours + 1)] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        self.single = np.array([h[0] for h in self.held]) if all(len(h) == 1 for h in self.held) else None
        self.enough = trees * len(self.x) if len(self.x) <= least else max(least, int(effort * len(self.x)))
        self.forest = Forest(self.x, trees, seed)

    def search(self, own: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query: ids and scores of the nearest found, its own row left out."""
        for me, q, entries in zip(own, queries, self.forest.candidates(queries, self.enough), strict=True):
            scores = (self.x[entries] * q).sum(axis=1)
            if len(scores) > self.neighbours + 1:  # ties at the border stay in
                border = np.partition(scores, -self.neighbours - 1)[-self.neighbours - 1]
                entries, scores = entries[scores >= border], scores[scores >= border]
            if self.single is not None:
                places = self.single[entries]
            else:
                held = [self.held[e] for e in entries]
                places = np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
                scores = np.repeat(scores, [len(h) for h in held])
            other = self.rows[places] != me
            ids, scores = self.ids[places[other]], scores[other]
            best = np.lexsort((ids, -scores))[: self.neighbours]
            yield ids[best], scores[best]


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list column."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def nearest(vectors: DataFrame, every: int = 20, neighbours: int = 20, shard_rows: int = 16_384, trees: int = 128, effort: float = 0.5, least: int = 1_024, wave: int = 100_000) -> DataFrame:
    """query_id, rank, vec_id, score: the ``neighbours`` nearest found of every row whose id ``every`` divides."""
    rows = stage(usable(vectors), "nearest-rows")
    asked = rows.where(F.col("vec_id") % every == 0)
    counts = rows.agg(F.count(F.lit(1)).alias("all"), F.sum((F.col("vec_id") % every == 0).cast("long")).alias("asked")).first()
    waves = max(1, -(-(counts["asked"] or 0) // wave))
    parts = []
    for k in range(waves):
        sent = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == k).collect()
        queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({len(r["embedding"]) for r in sent}):
            own = [r for r in sent if len(r["embedding"]) == size]
            queries[size] = tuple(np.array([r[c] for r in own]) for c in ("vec_id", "row", "embedding"))
        shared = rows.sparkSession.sparkContext.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if not held:
                return
            ids, keys = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("vec_id", "row"))
            sizes, flat = zip(*(_matrix(b.column("embedding")) for b in held), strict=True)
            sizes, flat = np.concatenate(sizes), np.concatenate(flat)
            starts = np.cumsum(sizes) - sizes
            for size, (own, own_rows, asked_for) in shared.value.items():
                mine = np.flatnonzero(sizes == size)
                if not len(mine):
                    continue
                x = flat[starts[mine][:, None] + np.arange(size)]
                shard = Shard(ids[mine], keys[mine], x, neighbours, trees, size, effort, least)
                for first in range(0, len(own), 2048):
                    block = slice(first, first + 2048)
                    found = list(shard.search(own_rows[block], asked_for[block]))
                    sizes_found = [len(f[0]) for f in found]
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(np.repeat(own[block], sizes_found), pa.int64()),
                        "query_row": pa.array(np.repeat(own_rows[block], sizes_found), pa.int64()),
                        "vec_id": pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                        "score": pa.array(np.concatenate([f[1] for f in found]), pa.float64()),
                    })

        dealt = rows.repartition(max(1, -(-counts["all"] // shard_rows)))
        found = map_arrow(dealt, run, "query_id long, query_row long, vec_id long, score double")
        parts.append(found if waves == 1 else stage(found, "nearest-wave"))
        if waves > 1:
            shared.unpersist()
    place = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return union_all(parts).withColumn("rank", place).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
