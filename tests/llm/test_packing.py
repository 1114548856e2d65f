import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, docs, empty, hard_rows

from vitrine.llm.packing import CAPACITY, GRAIN, Encoder, closest, encoded, packing, plan

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def ids_of(text):
    tok = ids_of.__dict__.setdefault("t", tokenizers.Tokenizer.from_file(PATH))
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def check(rows, texts):
    """Every id in one piece, CRCs right, sequences gapless and within capacity; returns the padding."""
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    padding = 0
    for own in sequences.values():
        end = 0
        for at, n in sorted(own):
            assert at == end
            end += n
        assert end <= CAPACITY
        padding += 0 if end & (end - 1) == 0 else CAPACITY - end
    for doc, want in texts.items():
        have = Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[doc])
        for ids in want:
            at = 0
            while at < len(ids):
                hit = next(k for k, n in have.items() if n and k[0] == at and k[3] == len(ids) and zlib.crc32(ids[at : at + k[1]].tobytes()) == k[2])
                have[hit] -= 1
                at += hit[1]
        assert not +have
    return padding


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: [ids_of(r["text"])] for r in table.collect()}
    padding = check(packing(table, PATH).collect(), texts)
    assert padding < CAPACITY + 0.02 * sum(len(t[0]) for t in texts.values())


def test_hard_rows_and_cut_rests(spark):
    table = hard_rows(spark)
    texts = defaultdict(list)
    for r in table.collect():
        texts[r["doc_id"]].append(ids_of(r["text"]))
    check(packing(table, PATH).collect(), texts)
    assert packing(empty(spark), PATH).count() == 0
    same = docs(spark, ["the cat " * 1500] * 9)  # equal lengths leave slack that only cutting fills
    padding = check(packing(same, PATH).collect(), {i: [ids_of("the cat " * 1500)] for i in range(9)})
    assert padding < CAPACITY + 9 * GRAIN


@pytest.mark.parametrize("histogram", [{3000: 1000, 10: 3}, {1: 5000}, {4095: 7, 1: 3}, {2049: 50, 2050: 50}, {n: n % 7 + 1 for n in range(1, 4096, 13)}])
def test_plan_places_everything_once(histogram):
    places, windows = plan(dict(histogram))
    fill, members = Counter(), defaultdict(Counter)
    for p in places:
        for j in range(p.share.count):
            fill[p.first + (p.skip + j) // p.each] += p.share.end - p.share.start
            members[p.share.length][p.share.rank + j] += p.share.end - p.share.start
    assert all(members[n] == Counter({r: n for r in range(c)}) for n, c in histogram.items())
    assert max(fill.values()) <= CAPACITY and len(fill) == windows
    assert sum(CAPACITY - v >= GRAIN for v in fill.values()) <= 1


def test_closest_is_the_best_subset():
    import itertools

    counts = {7: 2, 5: 1, 3: 3, 11: 1}
    items = [n for n, c in counts.items() for _ in range(c)]
    for target in range(45):
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k) if (s := sum(c)) <= target)
        used = closest(counts, sorted(counts, reverse=True), target)
        assert sum(n * c for n, c in used.items()) == best and all(counts[n] >= c for n, c in used.items())


def test_encoder_equals_the_tokenizer():
    texts = ["It's THE end, isn't it? <|endoftext|> x1y22 a.b,c", "Straße naïve İstanbul ΣΑΣ é \x1c x\x85y\xa0z", "", None, "a" * 300, "!!??## 😀😀 世界 ไทย"]
    got = list(encoded(pa.array(texts), Encoder(open(PATH).read())))
    assert got == [ids_of(t)[:-1].tobytes() for t in texts]
