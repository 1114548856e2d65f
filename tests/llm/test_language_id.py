import math
import re
import zlib
from collections import Counter

from helpers import SF, docs, empty, hard_rows
from pyspark.sql import functions as F

from vitrine.llm.language_id import Model, Scorer, keep_identified, language_id


def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    right = out.where("lang = lang_pred").count()
    assert right / out.count() >= 0.97


def plain(rows, learn, langs):
    """Scores by the definition, a word at a time: known words, else the longest known n-grams."""
    counts = {lang: Counter() for lang in langs}
    for text, lang in learn:
        counts[lang].update(re.findall(r"[^\W\d_]+", text.lower()))
    tables = []
    for size in range(6):
        seen = {lang: Counter() for lang in langs}
        for lang in langs:
            for w, n in counts[lang].items():
                padded = f"^{w}$" if size > 1 else w
                for g in [w] if not size else [padded[k : k + size] for k in range(len(padded) - size + 1)]:
                    seen[lang][g] += n
        sums = Counter()
        for lang in langs:
            sums.update(seen[lang])
        known = sorted(sums, key=lambda g: (-sums[g], g))[: 40_000 if size else None]
        total = {lang: sum(seen[lang][g] for g in known) for lang in langs}
        tables.append({g: [math.log((seen[lang][g] + 0.5) / (total[lang] + 0.5 * len(known))) for lang in langs] for g in known})
    out = {}
    for d, text in rows:
        score = [0.0] * len(langs)
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            found = [tables[0][w]] if w in tables[0] else []
            for size in range(5, 0, -1):
                padded = f"^{w}$" if size > 1 else w
                found = found or [tables[size][g] for k in range(len(padded) - size + 1) if (g := padded[k : k + size]) in tables[size]]
            for j in range(len(langs)):
                score[j] += sum(f[j] for f in found) / len(found) if found else 0.0
        best = max(range(len(langs)), key=lambda j: (score[j], -j))
        out[d] = (langs[best], 1 / sum(math.exp(s - score[best]) for s in score))
    return out


def test_table_against_the_definition(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    learn = [(r["text"], r["lang"]) for r in table.collect() if r["text"] and r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    langs = sorted({lang for _, lang in learn})
    want = plain(rows, learn, langs)
    for r in language_id(table).collect():
        if r["lang_pred"] != "und":
            assert r["lang_pred"] == want[r["doc_id"]][0] and abs(r["score"] - want[r["doc_id"]][1]) < 1e-6


def test_backoff_goes_to_the_longest_known_grams():
    model = Model([("de", "straße", 5), ("en", "street", 5), ("de", "und", 9), ("en", "and", 9)])
    scorer = Scorer(model)
    assert scorer.predict("straßen und")[0] == "de"
    assert scorer.predict("streets and")[0] == "en"
    assert (model.unseen("zzzq") == 0).all() and len(model.unseen("street")) == 2
    assert scorer.predict("世界") == ("de", 0.5)
    assert scorer.predict("12 ½ !") == ("und", 0.0) and scorer.predict(None) == ("und", 0.0)


def test_labels_and_sources_are_not_read_when_predicting(spark):
    a = docs(spark, ["the and of the"] * 30 + ["le la de un"] * 30).withColumn("lang", F.expr("if(doc_id < 30, 'en', 'fr')"))
    want = {r["doc_id"]: r["lang_pred"] for r in language_id(a).collect()}
    assert set(want.values()) == {"en", "fr"} and all((want[i] == "en") == (i < 30) for i in want)


def test_hard_rows(spark):
    out = language_id(hard_rows(spark)).collect()
    assert len(out) == 13 and {r["lang_pred"] for r in out} == {"und"} and all(r["score"] == 0 for r in out)
    assert language_id(empty(spark)).count() == 0
    assert keep_identified(hard_rows(spark)).columns == hard_rows(spark).columns


def test_clean_rows_stay(spark):
    a = docs(spark, ["the cat and the dog", "le chat et le chien", "...", None] * 10).withColumn("lang", F.expr("if(doc_id % 4 = 0, 'en', 'fr')"))
    kept = keep_identified(a)
    assert kept.columns == a.columns and {r["doc_id"] % 4 for r in kept.collect()} == {0, 1}
