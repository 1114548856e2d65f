"""Benchmark decontamination: an FM-index per training shard.

The test phrases are the windows of 13 consecutive item words (an item with fewer words is one
window). Each shard of documents (part of an Arrow batch) is indexed once: suffix array, Burrows-Wheeler
transform, wavelet matrix for rank and access, and suffix positions sampled at every eighth place. All
windows search backwards together; surviving rows walk to a sampled position; the places become word
spans, merged per document.

A word that no item holds cannot lie in an occurrence, nor can a run of item words that is shorter than
the shortest window. Such words are left out before indexing and equal runs are indexed once; this loses
no occurrence.

Items are read in blocks of about ``block_bytes`` of text, each a broadcast of that size. Of several blocks one is held at a
time: its hits are written before the next one is read, so the size of the benchmark is not limited by memory.

Cases: null or wordless texts have no words and are never contaminated; null or wordless items have no
window. Null item ids are named by the empty string. Repeated items with one id count once in
``items_sha256`` and ``n_items``. Repeated documents are judged each; row identity never matters as
everything happens within the row. Empty tables give no rows, or no hits. Further columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import byte_table, map_arrow, stage, texts_of, union_all, with_kept

WINDOW = 13
SAMPLED = 8
SHARD_BYTES = 16 << 20
LOWER_WORDS = byte_table(gaps=True)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words; UTF-8 bytes of other letters are all above the separators."""
    return text.translate(LOWER_WORDS).split() if text else []


class Phrases:
    """Distinct windows of some items: ``codes`` rows padded with -1, their lengths and their items."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words_of(text)]
            if codes:
                size = min(window, len(codes))
                for k in range(len(codes) - size + 1):
                    owners[tuple(codes[k : k + size])].add(item)
        self.items = [sorted(owner) for owner in owners.values()]
        self.length = np.array([len(x) for x in owners], dtype=np.int64)
        self.codes = np.full((len(owners), window), -1, dtype=np.int64)
        for row, x in enumerate(owners):
            self.codes[row, : len(x)] = x
        self.shortest = int(self.length.min()) if len(owners) else 0


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol is smaller than all others."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank, step = rank.astype(np.int64), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Rank and access over integers, a bit level at a time, vectorised over many queries."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int64))))
            self.zeros.append(int(len(values) - self.ones[-1][-1]))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``end``."""
        start, end = np.zeros_like(end), end.copy()
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            ones = self.ones[i]
            s1, e1 = ones[start], ones[end]
            start = np.where(one, self.zeros[i] + s1, start - s1)
            end = np.where(one, self.zeros[i] + e1, end - e1)
        return end - start

    def access(self, place: np.ndarray) -> np.ndarray:
        out, place = np.zeros_like(place), place.copy()
        for i in range(self.bits):
            ones = self.ones[i]
            one = ones[place + 1] - ones[place]
            out = (out << 1) | one
            place = np.where(one == 1, self.zeros[i] + ones[place], place - ones[place])
        return out


class FMIndex:
    """Over ``symbols``, of which the last is 0 and occurs once."""

    def __init__(self, symbols: np.ndarray, sampled: int = SAMPLED):
        order = suffix_array(symbols)
        self.size = len(symbols)
        top = int(symbols.max()) + 1
        self.less = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top))))
        self.tree = WaveletMatrix(symbols[order - 1], max(1, top.bit_length()))
        self.marked = order % sampled == 0
        self.before = np.cumsum(self.marked) - 1
        self.places = order[self.marked]

    def search(self, codes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, end row) of the phrases that occur."""
        alive = np.arange(len(codes))
        low, high = np.zeros(len(codes), dtype=np.int64), np.full(len(codes), self.size, dtype=np.int64)
        done = []
        step = 0
        while len(alive):
            code = codes[alive, length[alive] - 1 - step]
            known = code < len(self.less) - 1
            alive, low, high, code = alive[known], low[known], high[known], code[known]
            low, high = self.less[code] + self.tree.rank(code, low), self.less[code] + self.tree.rank(code, high)
            step += 1
            found, over = low < high, length[alive] == step
            done.append((alive[found & over], low[found & over], high[found & over]))
            going = found & ~over
            alive, low, high = alive[going], low[going], high[going]
        return tuple(np.concatenate([d[k] for d in done]) if done else np.zeros(0, dtype=np.int64) for k in range(3))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows."""
        rows, out = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            here = self.marked[rows[walking]]
            at = walking[here]
            out[at] = self.places[self.before[rows[at]]] + steps
            walking = walking[~here]
            code = self.tree.access(rows[walking])
            rows[walking] = self.less[code] + self.tree.rank(code, rows[walking])
            steps += 1
        return out


def shard_hits(texts: list[bytes | None], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text: number of words, merged word spans [start, end) that lie in occurrences, and their items."""
    get = phrases.vocabulary.get
    codes: list[int] = []
    firsts, counts = [], []
    for text in texts:
        words = words_of(text)
        firsts.append(len(codes))
        counts.append(len(words))
        codes += [get(w, 0) for w in words]
        codes.append(0)
    out: list[tuple[int, list, list]] = [(n, [], []) for n in counts]
    if not phrases.shortest:
        return out
    line = np.array(codes, dtype=np.int32)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], line != 0, [0])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= phrases.shortest
    places: dict[bytes, list[int]] = defaultdict(list)
    for a, b in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
        places[line[a:b].tobytes()].append(a)
    if not places:
        return out
    runs = list(places)
    parts, run_first, at = [], [], 0
    for run in runs:
        part = np.frombuffer(run, dtype=np.int32)
        parts += [part, np.array([1], dtype=np.int32)]
        run_first.append(at)
        at += len(part) + 1
    index = FMIndex(np.concatenate([*parts, np.array([0], dtype=np.int32)]).astype(np.int64))
    phrase, low, high = index.search(phrases.codes, phrases.length)
    times = high - low
    rows = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    phrase = np.repeat(phrase, times)
    found = index.locate(rows)
    run_of = np.searchsorted(run_first, found, side="right") - 1
    inside: dict[int, list[tuple[int, int]]] = defaultdict(list)
    named: dict[int, set[int]] = defaultdict(set)
    doc_first = np.array(firsts)
    for p, r, at in zip(phrase.tolist(), run_of.tolist(), (found - np.array(run_first)[run_of]).tolist(), strict=True):
        for base in places[runs[r]]:
            doc = int(np.searchsorted(doc_first, base + at, side="right")) - 1
            start = base + at - firsts[doc]
            inside[doc].append((start, start + int(phrases.length[p])))
            named[doc].add(p)
    for doc, spans in inside.items():
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        out[doc] = (counts[doc], merged, sorted({i for p in named[doc] for i in phrases.items[p]}))
    return out


def blocks(benchmark: DataFrame, block_bytes: int) -> tuple[int, Iterator[Phrases]]:
    """The items, dealt by a hash into blocks of about ``block_bytes`` of text: their number, and one after the other."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1

    def each() -> Iterator[Phrases]:
        for k in range(count):
            own = items if count == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
            yield Phrases([(r["item"], bytes(r["text"]) if r["text"] is not None else None) for r in own.collect()])

    return count, each()


HITS = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def _pass(docs: DataFrame, phrases: Phrases, only_hits: bool = False) -> DataFrame:
    """``kept`` with the spans and items of a block; with ``only_hits`` only of rows that have any."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch).cast(pa.binary()).to_pylist()
            found: list[tuple[int, list[tuple[int, int]], list[str]]] = []
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (end == first or size < SHARD_BYTES):
                    size += len(texts[end] or b"")
                    end += 1
                found += shard_hits(texts[first:end], shared.value)
                first = end
            kept = batch.column("kept")
            if only_hits:
                rows = [i for i, (_, spans, _) in enumerate(found) if spans]
                found, kept = [found[i] for i in rows], kept.take(pa.array(rows, pa.int64()))
            spans = [[{"start": a, "end": b} for a, b in s] for _, s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [kept, pa.array([n for n, _, _ in found], pa.int64()), pa.array(spans, spans_type), pa.array([i for _, _, i in found], pa.list_(pa.string()))],
                names=["kept", "n_words", "spans", "items"],
            )

    fields = docs.sparkSession.createDataFrame([], HITS).schema.fields
    schema = docs.select("kept").schema
    for f in fields:
        schema = schema.add(f)
    return map_arrow(docs, run, schema)


def _by_blocks(docs: DataFrame, keep: list[str], each: Iterator[Phrases]) -> DataFrame:
    """Like ``_pass`` for any number of blocks: one is held at a time, its hits are written before the next one is read."""
    numbered = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("own"), "text"), "decontamination-texts")
    texts = numbered.select(F.struct("row").alias("kept"), "text")
    hits = [stage(_pass(texts, phrases, only_hits=True).select("kept.row", "spans", "items"), "decontamination-hits") for phrases in each]
    by_row = union_all(hits).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    words = _pass(texts, Phrases([])).select("kept.row", "n_words")
    spans, items = (f"coalesce({c}, cast(array() as {t})) as {c}" for c, t in (("spans", "array<struct<start: bigint, end: bigint>>"), ("items", "array<string>")))
    return numbered.select("row", "own").join(words, "row").join(by_row, "row", "left").selectExpr("own as kept", "n_words", spans, items)


def find_spans(docs: DataFrame, benchmark: DataFrame, keep: list[str], block_bytes: int = 8 << 20) -> DataFrame:
    """kept (struct of ``keep``), n_words, spans (merged, in words, end exclusive), items (sorted)."""
    count, each = blocks(benchmark, block_bytes)
    if count == 1:
        out = _pass(with_kept(docs, keep), next(each))
    else:
        out = _by_blocks(docs, keep, each)
    merged = F.expr("""
        aggregate(array_sort(spans), cast(array() as array<struct<start: bigint, end: bigint>>), (acc, s) ->
          if(size(acc) > 0 and s.start <= element_at(acc, -1).end,
             concat(slice(acc, 1, size(acc) - 1),
                    array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, s.end)))),
             concat(acc, array(s))))""")
    return out.select("kept", "n_words", merged.alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))


def judged(spans: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated: at least a twentieth of the words lie in occurrences."""
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return spans.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of every document: n_words, n_hit, n_items, items_sha256, contaminated."""
    return judged(find_spans(docs, benchmark, ["doc_id"])).select(
        F.col("kept.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    return judged(find_spans(docs, benchmark, docs.columns)).where(~F.col("contaminated")).select("kept.*")
