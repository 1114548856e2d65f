"""Periodic runs of words by a sparse diagonal scan.

A diagonal is a lag ``q``: it grows by one wherever a word equals the word ``q`` before it. A run of smallest period
``q`` and at least three periods is a stretch of its diagonal. Scanned word by word over all earlier occurrences, a
frequent word would touch very many lags, so a word meets only the nearest earlier occurrence of itself *with the
``g - 1`` words before it*, for ``g`` = 8, 16, 32 and so on, and at width ``g`` only lags in (g/2, g] (1 to 8 at first) count:

* a run of period ``q`` <= ``g`` is at least ``q + g`` words long, so its later words have such an occurrence ``q`` before them;
* a nearer one, ``d`` < ``q``, would give ``g + d`` words both periods, hence (Fine and Wilf) a common divisor as
  period, and ``q`` would not be the run's smallest.

So the words that meet lag ``q`` one after the other are the run's diagonal, whole; where the lag of a word differs, the
diagonal has ended and is emitted if it is long enough. Nothing else has to be verified: widths double by ranking
pairs of ranks, which is exact. Words, pairs and wider grams that occur once in a document leave the scan,
so ordinary prose costs little more than its cutting into words, and a text of one repeated word n log n.

A text is scanned whole, in memory bounded by its own words; texts of a batch are scanned together in blocks of
``BLOCK_WORDS``. Cases: null, empty and blank texts have no words and no runs. Repeated rows are scanned each.
Empty tables give no rows. Of further columns, ``with_runs`` keeps those named, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import map_arrow

LEAST, PERIODS = 24, 3  # words and periods of the shortest run
FIRST = 8  # LEAST - FIRST words at least are equal to the word a short period before
BLOCK_WORDS = 1 << 20

Run = tuple[int, int, int]  # start, length, period


def ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every value and, per rank, how often it occurs."""
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    return inverse.astype(np.int64), counts


def nearest_lags(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Distance to the nearest earlier place of the same rank, 0 without one; ``place`` grows."""
    order = np.argsort(rank, kind="stable")
    r, p = rank[order], place[order]
    out = np.zeros(len(rank), dtype=np.int64)
    same = np.flatnonzero(r[1:] == r[:-1])
    out[order[same + 1]] = p[same + 1] - p[same]
    return out


def diagonals(place: np.ndarray, lag: np.ndarray, width: int, shortest: int) -> Iterator[Run]:
    """Runs of the diagonals that words with one lag, place after place, make up; places are the last ones of their grams."""
    at = np.flatnonzero((lag >= shortest) & (lag <= width))
    if not len(at):
        return
    p, q = place[at], lag[at]
    first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1])]))
    last = np.append(first[1:], len(p)) - 1
    period = q[first]
    start = p[first] - width + 1 - period
    length = p[last] + 1 - start
    for k in np.flatnonzero(length >= np.maximum(LEAST, PERIODS * period)):
        yield int(start[k]), int(length[k]), int(period[k])


def scan(words: np.ndarray, owner: np.ndarray) -> list[Run]:
    """Runs of all texts in a row; ``words`` are codes, ``owner`` (growing) tells the texts apart, starts count through all of them."""
    out: list[Run] = []
    place = np.arange(len(words), dtype=np.int64)
    rank, counts = ranks((owner << np.int64(32)) | words)
    width, longest = 1, int(np.bincount(owner).max()) // PERIODS if len(owner) else 0
    while len(place):
        held = counts[rank] > 1
        place, rank = place[held], rank[held]
        if width >= FIRST:
            out += diagonals(place, nearest_lags(rank, place), width, 1 if width == FIRST else width // 2 + 1)
            if width >= longest:
                break
        # a gram of twice the width: this one and the one that ends before it, where both are still held
        before = np.searchsorted(place, place - width)
        wider = np.flatnonzero(place[np.minimum(before, len(place) - 1)] == place - width) if len(place) else before
        pairs = (rank[before[wider]] << np.int64(32)) | rank[wider]
        place, width = place[wider], 2 * width
        rank, counts = ranks(pairs)
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """Per text (a list of words) its runs, by start, then period."""
    codes: dict[bytes, int] = {}
    words = np.array([codes.setdefault(w, len(codes)) for t in texts for w in t], dtype=np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in texts]
    if len(words):
        for start, length, period in scan(words, np.repeat(np.arange(len(texts), dtype=np.int64), sizes)):
            t = int(np.searchsorted(starts, start, side="right")) - 1
            found[t].append((start - int(starts[t]), length, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside every run's part after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def blocks(texts: list[list[bytes]]) -> Iterator[slice]:
    first = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BLOCK_WORDS:
            yield slice(first, i)
            first, held = i, 0
        held += len(t)
    yield slice(first, len(texts))


def with_runs(docs: DataFrame, keep: list[str], rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """kept, runs (array of start, length, period by start, then period) and collapsed (kept words joined by one space).

    ``rewrite`` may change the words of a text first; it gets the first kept column's value and the words.
    """
    inner = docs.select(F.struct(*keep).alias("kept"), F.col("text").cast("binary").alias("text"))
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column("text").to_pylist()]
            if rewrite:
                texts = [rewrite(k, t) for k, t in zip(batch.column("kept").field(0).to_pylist(), texts, strict=True)]
            for part in blocks(texts):
                found = runs_of(texts[part])
                listed = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found], shape)
                left = pa.array([b" ".join(collapsed(t, f)) for t, f in zip(texts[part], found, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("kept")[part], listed, left], names=["kept", "runs", "collapsed"])

    one = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    out = inner.select("kept").schema.add("runs", T.ArrayType(one)).add("collapsed", "binary")
    return map_arrow(inner, run, out).withColumn("collapsed", F.col("collapsed").cast("string"))


def spiked(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts, by the checksum of their id, end in a repeated stretch; texts without an id stay."""
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digests(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    """The columns of the query for one text."""
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = b"".join(b"%d,%d,%d\n" % r for r in runs)
    return doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of most periods (start, length, period, exponent_milli), runs_sha256, collapsed_sha256."""
    found = with_runs(docs, ["doc_id"], spiked)
    # most periods first: a / b > c / d as exact products
    order = """(x, y) -> case when x.length * y.period <> y.length * x.period then if(x.length * y.period > y.length * x.period, -1, 1)
        when x.start <> y.start then if(x.start < y.start, -1, 1) when x.period < y.period then -1 when x.period > y.period then 1 else 0 end"""
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    told = found.selectExpr("kept.doc_id as doc_id", "runs", f"get(array_sort(runs, {order}), 0) as best", f"sha2({listed}, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256")
    return told.selectExpr(
        "doc_id", "cast(size(runs) as bigint) as n_runs", "best.start as start", "best.length as length", "best.period as period",
        "1000 * best.length div best.period as exponent_milli", "runs_sha256", "collapsed_sha256",
    )
