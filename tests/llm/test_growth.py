"""Scanners whose time follows the text, however many matches it holds; what contexts find; increments of the ledger."""

import random
import time

from helpers import docs

from vitrine.llm.licenses import licenses
from vitrine.llm.pii import masked, pii
from vitrine.llm.secret_ledger import RULES, scan, secrets, with_blob


def seconds(action):
    begun = time.time()
    action()
    return time.time() - begun


def doubled(run, piece, times):
    run(piece * 10)  # plans and code
    half, whole = (min(seconds(lambda n=n: run(piece * n)) for _ in range(2)) for n in (times, 2 * times))
    return whole / half


def test_licenses_in_very_long_texts(spark):
    def run(text):
        r = licenses(docs(spark, [text])).first()
        n = text.count("mit license")
        assert (r["n_base"], r["n_words"], r["first_word"], r["last_word"]) == (2 * n, 9 * n, 1, 9 * (n - 1) + 5)

    assert doubled(run, "The mit license, or the apache license v2 here.\n", 5_000) < 3


def test_personal_data_in_very_long_texts(spark):
    def run(text):
        n = text.count("@")
        r = pii(docs(spark, [text])).first()
        assert r["n_email"] == n and r["n_phone"] == n
        out = masked(docs(spark, [text])).first()["text"]
        assert out.count("<EMAIL>") == n and out.startswith("Write to <EMAIL> or call <PHONE> now, é😀. ") and "@" not in out

    assert doubled(run, "Write to some.body@mail.example.org or call +359 2 123 4567 now, é😀. ", 4_000) < 3


def test_recall_and_precision_of_contexts(spark):
    """Identifiers that no base pattern knows, before or behind words that stand by known ones, and numbers elsewhere."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))
    number = lambda: f"{rng.choice('ABCDEFG')}{rng.choice('XYZ')}-{rng.randint(10**5, 10**6)}"
    around = lambda x: " ".join(word() for _ in range(30)) + f" {x} " + " ".join(word() for _ in range(30))
    left, right = "reach customer desk {}", "{} owns account today"
    texts = [around(left.format(f"{word()}@mail.example.com")) for _ in range(30)] + [around(right.format(f"{word()}@mail.example.com")) for _ in range(30)]
    planted, decoys = {}, set()
    for k in range(60):
        x = number()
        form = (left, right, "{}")[k % 3]
        texts.append(around(form.format(x)))
        if k % 3 < 2:
            planted[len(texts) - 1] = x
        else:
            decoys.add(len(texts) - 1)
    found = {}
    for r in pii(docs(spark, texts)).collect():
        for span in filter(None, r["spans"].split(",")):
            kind, a, b = span.split(":")
            if kind == "context":
                found.setdefault(r["doc_id"], []).append(texts[r["doc_id"]][int(a) : int(b)])
    right_ones = sum(found.get(i) == [x] for i, x in planted.items())
    assert right_ones / len(planted) >= 0.9
    assert right_ones / max(1, sum(map(len, found.values()))) >= 0.95 and not decoys & set(found)


def test_increments_find_what_one_scan_finds(spark):
    texts = [f"token=abcdefgh{i % 7} and {'AKIA' + 'B' * 16 if i % 5 == 0 else 'nothing'}" for i in range(60)] + [None, ""]
    frame = docs(spark, texts)
    order = lambda f: sorted(map(tuple, f.collect()), key=str)
    assert order(secrets(frame)) == order(secrets(frame, increments=1)) == order(secrets(frame, increments=5))
    blobs = with_blob(frame, ["doc_id"])
    assert "text" not in blobs.columns
    first = scan(frame.where("doc_id < 30"))
    more = scan(frame, RULES, first)
    known = {r["blob"] for r in first.collect()}
    assert not known & {r["blob"] for r in more.collect()} and first.count() + more.count() == len(RULES) * len(set(t or "" for t in texts))
    plan = scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
