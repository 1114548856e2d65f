"""Sequence packing: minimum bin slack over the multiset of remaining lengths.

A document's ids are cut into whole windows of ``CAPACITY`` and a rest. The rests are packed: each window
takes the largest rest, then a bitset subset-sum over the multiset of remaining lengths finds the filling
closest to the capacity, and the counts per length are read back from the stored bitsets. The same filling
is repeated while the counts allow it. The multiset has fewer than ``CAPACITY`` lengths whatever the number
of documents, so the plan is small; documents take their places in it by their rank within their length,
which is computed in Spark.

Where the best filling leaves ``GRAIN`` ids or more and another rest remains, that rest is cut at a
multiple of ``GRAIN`` and its head fills the window, so every window but the last has less than ``GRAIN``
ids of padding. The CRC of any such piece follows from CRCs of prefixes taken when the text was tokenized.

Cases: null or empty text is the end id alone. Repeated rows are packed each. Very long documents become
many whole windows. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from vitrine.llm.common import map_arrow, numbered, stage

CAPACITY = 4096
GRAIN = 64
END_ID = 2
MARKS = ".,!?;:"
PIECES = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")
#: Texts with other characters go to the tokenizer whole: combining marks, letters whose lower case depends on
#: their neighbours, and separators on which str.split() cuts but the tokenizer doesn't.
SPACES = re.compile("[\x1c-\x1f]")
PLAIN = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u017f\u0400-\u0482\u048a-\u04ff\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3]")


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, with bounded memos of chunks and words.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its
    space-separated chunks. An ASCII chunk falls into runs of letters, single digits and runs of other
    characters, another one into its letters and a closing mark; chunks for which that doesn't hold go to the
    tokenizer whole. New words of a group of texts go there together and are told apart by their word-end ids.
    """

    CHUNKS, WORDS, TOGETHER = 250_000, 300_000, 500

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.closes[i] = token.endswith("</w>")

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that consist of letters."""
        out = {}
        parts = [words[k : k + self.TOGETHER] for k in range(0, len(words), self.TOGETHER)]
        for part, done in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
            ids = np.array(done.ids, dtype="<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                out |= {w: raw[4 * a : 4 * b] for w, a, b in zip(part, [0, *ends[:-1]], ends, strict=True)}
            else:
                out |= {w: self._plain(w) for w in part}
        return out

    def _pieces(self, chunk: str) -> list[str] | None:
        """The tokenizer's own pieces of a chunk in lower case, where simple rules tell them; None elsewhere."""
        if chunk.isascii():
            return PIECES.findall(chunk) if "'" not in chunk else None
        mark = chunk[-1] if chunk[-1] in MARKS else ""
        word = chunk[:-1] if mark else chunk
        return ([word, mark] if mark else [word]) if word.isalpha() else None

    def _new(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of chunks that the memo lacks."""
        known, split, out = self.words, {}, {}
        fresh: dict[str, bytes] = {}
        for chunk in missing:
            pieces = self._pieces(chunk)
            if pieces is None:
                out[chunk] = self._plain(chunk)
            else:
                split[chunk] = pieces
                for piece in pieces:
                    if piece not in known:
                        fresh[piece] = b""
        fresh |= self._words([w for w in fresh if w.isalpha()])
        fresh |= {w: self._plain(w) for w, ids in fresh.items() if not ids}
        for chunk, pieces in split.items():
            out[chunk] = b"".join([known.get(p) or fresh[p] for p in pieces])
        if len(known) < self.WORDS:
            known.update(fresh)
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; call it with a few megabytes at a time.

        Chunks are told apart by Arrow; only distinct ones are looked up here.
        """
        rows = texts.to_pylist()
        plain = [bool(t) and ("<|" in t or SPACES.search(t) is not None or not t.isascii() and PLAIN.search(t) is not None) for t in rows]
        chunks = pc.utf8_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(plain, pa.bool_()), "", pc.fill_null(texts, ""))))
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        get = self.chunks.get
        ids = [get(c) if c else b"" for c in distinct]
        missing = [c for c, i in zip(distinct, ids, strict=True) if i is None]
        new = self._new(missing)
        if len(self.chunks) < self.CHUNKS:
            self.chunks.update(new)
        ids = [new[c] if i is None else i for c, i in zip(distinct, ids, strict=True)]
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // 4
        first = np.cumsum(sizes, dtype=np.int32) - sizes
        code = coded.indices.to_numpy()
        size = sizes[code]
        after = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(size, dtype=np.int64)))
        at = np.repeat((first[code] - after[:-1]).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        line = flat[at].tobytes()
        cut = (4 * after[chunks.offsets.to_numpy()]).tolist()
        return [self._plain(t) if p else line[x:y] for t, p, x, y in zip(rows, plain, cut[:-1], cut[1:], strict=True)]


@lru_cache(maxsize=1)
def encoder_of(tokenizer_json: str) -> Encoder:
    """One encoder per Python worker: its memos serve all tasks of the worker. Spark deals out the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(tokenizer_json)


def encoded(texts: pa.Array, encoder: Encoder, together: int = 4 << 20) -> Iterator[bytes]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        held = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, held + together)))
        yield from encoder.encode(texts.slice(first, end - first))
        first = end
    pa.default_memory_pool().release_unused()


def and_fields(docs: DataFrame, ddl: str) -> StructType:
    return StructType([docs.schema["doc_id"], *StructType.fromDDL(ddl).fields])


def tokenized(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, doc_tokens, rest (its length), whole (CRCs of whole windows), heads (CRCs of the rest's prefixes)."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            tokens, rests, wholes, heads = [], [], [], []
            for own in encoded(batch.column("text"), encoder):
                ids = memoryview(own + end)
                n = len(ids) // 4
                cut = n - n % CAPACITY
                wholes.append([zlib.crc32(ids[4 * a : 4 * (a + CAPACITY)]) for a in range(0, cut, CAPACITY)])
                crc, prefixes = 0, []
                for a in range(cut, n, GRAIN):
                    crc = zlib.crc32(ids[4 * a : 4 * (a + GRAIN)], crc)
                    prefixes.append(crc)
                tokens.append(n)
                rests.append(n - cut)
                heads.append(prefixes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(rests, pa.int32()), pa.array(wholes, pa.list_(pa.int64())), pa.array(heads, pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "rest", "whole", "heads"],
            )

    schema = and_fields(docs, "doc_tokens long, rest int, whole array<long>, heads array<long>")
    return map_arrow(docs.select("doc_id", "text"), run, schema)


class Share(NamedTuple):
    """Members of a length class with ranks from ``rank``, ``count`` of them, give their ids [start, end)."""

    length: int
    rank: int
    count: int
    start: int
    end: int


class Place(NamedTuple):
    """Where a share goes: its member j lies in window first + (skip + j) // each, slot (skip + j) % each."""

    share: Share
    first: int
    skip: int
    each: int
    offset: int


def closest(counts: dict[int, int], order: list[int], target: int) -> dict[int, int]:
    """Counts per length of a sub-multiset whose sum is the closest to ``target`` from below."""
    reach, layers, mask, goal = 1, [], (1 << (target + 1)) - 1, 1 << target
    for length in order:
        left = min(counts[length], target // length) if length <= target else 0
        k = 1
        while left and not reach & goal:
            k = min(k, left)
            layers.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left -= k
            k *= 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, defaultdict(int)
    for length, k, before in reversed(layers):
        if not before >> at & 1:
            used[length] += k
            at -= length * k
    return dict(used)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN) -> tuple[list[Place], int]:
    """Places of all shares of the lengths in ``histogram``, and the number of windows."""
    counts = {n: c for n, c in histogram.items() if c and n}
    stock: dict[int, list[Share]] = {n: [Share(n, 0, c, 0, n)] for n, c in counts.items()}
    places: list[Place] = []
    windows = 0

    def take(length: int, count: int) -> list[Share]:
        out = []
        counts[length] -= count
        while count:
            share = stock[length].pop()
            if share.count > count:
                stock[length].append(share._replace(rank=share.rank + count, count=share.count - count))
                share = share._replace(count=count)
            out.append(share)
            count -= share.count
        if not counts[length]:
            del counts[length], stock[length]
        return out

    def put(shares: list[Share], each: int, offset: int) -> None:
        skip = 0
        for share in shares:
            places.append(Place(share, windows, skip, each, offset))
            skip += share.count

    order = sorted(counts, reverse=True)
    while counts:
        order = [n for n in order if n in counts]
        largest = order[0]
        counts[largest] -= 1
        used = closest(counts, order, capacity - largest)
        counts[largest] += 1
        used[largest] = used.get(largest, 0) + 1
        slack = capacity - sum(n * c for n, c in used.items())
        filler = next((n for n in order if n > slack and counts[n] > used.get(n, 0)), 0) if slack >= grain else 0
        need = dict(used)
        if filler:
            need[filler] = need.get(filler, 0) + 1
        times = min(counts[n] // c for n, c in need.items())
        offset = 0
        for length, each in sorted(used.items(), reverse=True):
            put(take(length, times * each), each, offset)
            offset += length * each
        if filler:
            head = slack // grain * grain
            cut = take(filler, times)
            put([s._replace(end=s.start + head) for s in cut], 1, offset)
            rest = filler - head
            stock.setdefault(rest, []).extend(s._replace(start=s.start + head) for s in cut)
            counts[rest] = counts.get(rest, 0) + times
            order = sorted(counts, reverse=True)
        windows += times
    return places, windows


class Ledger:
    """Looks up the pieces of a rest by its length and rank."""

    def __init__(self, places: list[Place]):
        own: dict[int, list[Place]] = defaultdict(list)
        for p in places:
            own[p.share.length].append(p)
        self.cuts: dict[int, list[int]] = {}
        self.at: dict[int, list[list[Place]]] = {}
        for length, rows in own.items():
            opens: dict[int, list[Place]] = defaultdict(list)
            closes: dict[int, list[Place]] = defaultdict(list)
            for p in rows:
                opens[p.share.rank].append(p)
                closes[p.share.rank + p.share.count].append(p)
            active: set[Place] = set()
            self.cuts[length], self.at[length] = sorted({*opens, *closes}), []
            for cut in self.cuts[length]:
                active -= set(closes[cut])
                active |= set(opens[cut])
                self.at[length].append(sorted(active, key=lambda p: p.share.start))

    def pieces(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """start, end, window, offset of each piece."""
        for p in self.at[length][bisect_right(self.cuts[length], rank) - 1] if length else ():
            j = p.skip + rank - p.share.rank
            yield p.share.start, p.share.end, p.first + j // p.each, p.offset + j % p.each * (p.share.end - p.share.start)


def piece_crc(heads: list[int], start: int, end: int) -> int:
    """CRC of ids [start, end) of a rest, from the CRCs of its prefixes; start is a multiple of GRAIN."""
    whole = heads[-(-end // GRAIN) - 1]
    if not start:
        return whole
    zeros = bytes(4 * (end - start))
    return whole ^ zlib.crc32(zeros, heads[start // GRAIN - 1]) ^ zlib.crc32(zeros)


def packing(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    tokens = stage(tokenized(docs, tokenizer_path), "packing-tokens")
    lengths = tokens.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("whole")).alias("most")).collect()
    histogram = {r["rest"]: r["n"] for r in lengths}
    places, windows = plan(histogram)
    first_doc, seen = {}, 0
    for rest in sorted(histogram):
        first_doc[rest] = seen
        seen += histogram[rest]
    most = max((r["most"] for r in lengths), default=0)
    shared = spark.sparkContext.broadcast((Ledger(places), first_doc))
    ranked = numbered(tokens, "rest", ["doc_id", "doc_tokens", "whole", "heads"], "rank", seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ledger, first = shared.value
        for batch in batches:
            row: list[int] = []
            out: list[tuple[int, ...]] = []
            for i, (n, rest, whole, heads, rank) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_tokens", "rest", "whole", "heads", "rank")), strict=True)):
                own = windows + (first[rest] + rank) * most
                out += [(k * CAPACITY, CAPACITY, crc, n, own + k, 0) for k, crc in enumerate(whole)]
                out += [(n - rest + a, b - a, piece_crc(heads, a, b), n, window, offset) for a, b, window, offset in ledger.pieces(rest, rank)]
                row += [i] * (len(out) - len(row))
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return map_arrow(ranked.select("doc_id", "doc_tokens", "rest", "whole", "heads", "rank"), run, and_fields(docs, pieces))
