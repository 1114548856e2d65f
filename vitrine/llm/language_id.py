"""Language identification: word-first backoff.

A known word scores its log frequency in each language. An unseen word falls back to its known
character n-grams of the greatest length that has any, then to shorter ones.

Training reads a bounded sample of labelled rows (``train_rows`` per language, picked by a hash of the
row), counts words per language in Spark and keeps the ``max_words`` most frequent of each, so the
broadcast model has a fixed greatest size. Prediction is a narrow pass over whole texts.

Cases: null text, text without a letter or no learned language give ``und`` and score 0. A text whose
words give no evidence at all gets the first language by name and an even score. Ties go to the first
language by name. A null ``doc_id`` counts as held out. Repeated rows are predicted each; an empty table
gives no rows. Further columns, whatever their names, are never read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import map_arrow, texts_of, with_kept

UNDETERMINED = "und"
WORDS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Remainder 0 of the CRC of the id's text; null ids are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            seen[lang].update(WORDS.findall(text.lower()))
        for lang, words in seen.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(list(words), pa.string()), "n": pa.array(list(words.values()), pa.int64())})


def word_counts(docs: DataFrame, train_rows: int) -> DataFrame:
    """(lang, word, n) over about ``train_rows`` learnable rows of each language (all, if fewer)."""
    learn = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    share = {r["lang"]: min(1.0, train_rows / r["n"]) for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return docs.sparkSession.createDataFrame([], "lang string, word string, n bigint")
    parts = F.create_map(*[F.lit(x) for pair in sorted(share.items()) for x in pair])
    picked = learn.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < parts[F.col("lang")] * (1 << 20))
    return map_arrow(picked.select("lang", "text"), _counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def grams_of(word: str, size: int) -> list[str]:
    """Character n-grams; those of two or more characters see the word's ends."""
    padded = f"^{word}$" if size > 1 else word
    return [padded[k : k + size] for k in range(len(padded) - size + 1)]


class Model:
    """Log frequencies: one row of ``table`` (a column per language) per known word and n-gram."""

    def __init__(self, counts: list[tuple[str, str, int]], max_n: int = 5, max_grams: int = 40_000):
        self.langs = sorted({lang for lang, _, _ in counts})
        self.max_n = max_n
        column = {lang: i for i, lang in enumerate(self.langs)}
        words: dict[str, list[float]] = {}
        grams: list[dict[str, list[float]]] = [{} for _ in range(max_n + 1)]
        for lang, word, n in counts:
            j = column[lang]
            words.setdefault(word, [0.0] * len(self.langs))[j] += n
            for size in range(1, max_n + 1):
                for gram in grams_of(word, size):
                    grams[size].setdefault(gram, [0.0] * len(self.langs))[j] += n
        self.index: dict[str, int] = {}
        self.gram_index: list[dict[str, int]] = [{} for _ in range(max_n + 1)]
        rows = []
        for size, entries in enumerate([words, *grams[1:]]):
            kept = sorted(entries.items(), key=lambda e: (-sum(e[1]), e[0]))
            kept = kept[:max_grams] if size else kept
            total = np.sum([v for _, v in kept], axis=0) if kept else np.zeros(len(self.langs))
            target = self.gram_index[size] if size else self.index
            for text, v in kept:
                target[text] = len(rows)
                rows.append(np.log((np.array(v) + 0.5) / (total + 0.5 * len(kept))))
        self.table = np.array(rows, dtype=np.float64).reshape(len(rows), len(self.langs))

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the known n-grams of the greatest length that has any; zeros without any."""
        for size in range(self.max_n, 0, -1):
            known = self.gram_index[size]
            rows = [known[g] for g in grams_of(word, size) if g in known]
            if rows:
                return self.table[rows].mean(axis=0)
        return np.zeros(len(self.langs))


class Scorer:
    """Sums word scores of whole texts; a bounded memo holds the scores of unseen words."""

    MEMO = 50_000

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def predict(self, text: str | None) -> tuple[str, float]:
        words = WORDS.findall(text.lower()) if text else []
        model = self.model
        if not model.langs or not any(c.isalpha() for w in words for c in w):
            return UNDETERMINED, 0.0
        get, memo = model.index.get, self.memo
        rows = [get(w, -1) for w in words]
        known = np.array(rows, dtype=np.int64)
        total = model.table[known[known >= 0]].sum(axis=0)
        if (known < 0).any():
            for word, n in Counter(w for w, r in zip(words, rows, strict=True) if r < 0).items():
                score = memo.get(word)
                if score is None:
                    score = model.unseen(word)
                    if len(memo) < self.MEMO:
                        memo[word] = score
                total = total + n * score
        best = int(np.argmax(total))
        return model.langs[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, train_rows: int = 4_000, max_words: int = 30_000) -> Model:
    """Fit on about ``train_rows`` rows per language; keeps ``max_words`` words of each."""
    counts = word_counts(docs, train_rows)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    kept = counts.withColumn("place", place).where(F.col("place") <= max_words)
    return Model([(r["lang"], r["word"], r["n"]) for r in kept.select("lang", "word", "n").collect()])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred and score, from ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = with_kept(docs, keep)
    schema = inner.select("kept").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            out = [scorer.predict(t.as_py()) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                names=["kept", "lang_pred", "score"],
            )

    return map_arrow(inner, run, schema)


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    model = train(docs)
    return predict(docs, model, ["doc_id"]).select(
        F.col("kept.doc_id").alias("doc_id"), held_out(F.col("kept.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told with a score of ``least`` or more."""
    model = train(docs)
    scored = predict(docs, model, docs.columns)
    return scored.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("kept.*")
