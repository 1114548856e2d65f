"""Queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm.common import LOWER, UPPER, WORD, table
from vitrine.llm.decontamination import decontamination
from vitrine.llm.importance_resampling import BUCKETS, LEAST_WORDS, SCALE, SEED, SHARE, resampled
from vitrine.llm.kd_shards import shards
from vitrine.llm.language_id import language_id
from vitrine.llm.licenses import licenses
from vitrine.llm.nearest import nearest
from vitrine.llm.packing import packing
from vitrine.llm.paragraph_dedup import repeats
from vitrine.llm.periodic_runs import LEAST, PERIODS, periodic_runs
from vitrine.llm.pii import pii
from vitrine.llm.secret_ledger import secrets
from vitrine.llm.simhash import simhash
from vitrine.llm.url_filters import url_filter, url_filter_sql

#: A vocabulary file of the installed package ``public_tokenizers``.
TOKENIZER = "word_bpe_49k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_packing, op3_pii, op4_paragraph_dedup, op5_kd_shards, op6_decontamination, op7_secrets, op8_nearest, op9_licenses, op10_simhash, op11_url_filter, op12_importance_resampling, op13_periodic_runs)
}
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}+')"
# CRC-32 in SQL: its byte table, and the checksum of a string's UTF-8 bytes
_CRC_TABLE = """crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def _crc(text: str) -> str:
    raw = f"list_transform(range(0, length(hex({text})) // 2), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {raw}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLES: dict[str, str] = {
    "op6_decontamination": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
        places AS (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS a FROM i WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item, k, array_to_string(w[a : a + k - 1], ' ') AS win FROM places),
        sizes AS (SELECT DISTINCT k FROM windows),
        starts AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM d JOIN sizes ON len(w) >= k),
        hits AS (SELECT r, a, k, item FROM (SELECT r, a, k, array_to_string(w[a : a + k - 1], ' ') AS win FROM starts) JOIN windows USING (k, win)),
        covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(a, a + k)) AS p FROM (SELECT DISTINCT r, a, k FROM hits)) GROUP BY r),
        named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
          coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""",
    "op11_url_filter": url_filter_sql(),
    "op12_importance_resampling": f"""WITH {_CRC_TABLE},
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        dw AS (SELECT r, unnest(w) AS word FROM d), bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
        code AS (SELECT word, {_crc('word')} % {BUCKETS} AS b FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc),
        s AS (SELECT b, count(*) AS s FROM dw JOIN code USING (word) GROUP BY b), t AS (SELECT b, count(*) AS t FROM bw JOIN code USING (word) GROUP BY b),
        sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS big_s, (SELECT coalesce(sum(t), 0) FROM t) AS big_t),
        gain AS (SELECT b, CAST(floor({SCALE} * ln((coalesce(t, 0) + 1.0::DOUBLE) * (big_s + {BUCKETS}) / ((coalesce(s, 0) + 1.0::DOUBLE) * (big_t + {BUCKETS})))) AS BIGINT) AS g
            FROM s FULL JOIN t USING (b), sums),
        weights AS (SELECT r, CAST(sum(g) AS BIGINT) AS weight FROM dw JOIN code USING (word) JOIN gain USING (b) GROUP BY r),
        noisy AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
            CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN weights USING (r)),
        scored AS (SELECT *, weight + CAST(floor(-{SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM noisy),
        fit AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS rank, count(*) OVER () AS n
            FROM scored WHERE n_features >= {LEAST_WORDS} AND doc_id IS NOT NULL)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {SHARE} * n // 100 THEN rank END AS rank FROM scored LEFT JOIN fit USING (r)""",
    # all pairs of equal words, which only a database of the smaller tables can hold
    "op13_periodic_runs": f"""WITH {_CRC_TABLE},
        raw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_crc('CAST(doc_id AS VARCHAR)')} AS h FROM documents, crc),
        sized AS (SELECT *, len(w) AS n, h // 10 AS g FROM raw),
        cut AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN g % n ELSE n END AS a FROM sized),
        due AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
        word AS (SELECT r, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS v FROM (SELECT *, unnest(range(n)) AS i FROM due)),
        met AS (SELECT x.r, x.i, x.i - y.i AS q FROM word x JOIN word y ON x.r = y.r AND x.v = y.v AND y.i < x.i),
        placed AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM met),
        stretch AS (SELECT r, q, min(i) - q AS a, max(i) + 1 AS e FROM placed GROUP BY r, q, island HAVING count(*) + q >= greatest({LEAST}, {PERIODS} * q)),
        run AS (SELECT r, a, e - a AS n, q FROM stretch s WHERE NOT EXISTS (SELECT 1 FROM stretch z WHERE z.r = s.r AND z.q < s.q AND z.a <= s.a AND z.e >= s.e)),
        listed AS (SELECT r, count(*) AS n_runs, string_agg(a || ',' || n || ',' || q || chr(10), '' ORDER BY a, q) AS runs FROM run GROUP BY r),
        best AS (SELECT * FROM run WHERE NOT EXISTS (SELECT 1 FROM run z WHERE z.r = run.r AND (z.n * run.q > run.n * z.q OR z.n * run.q = run.n * z.q AND (z.a, z.q) < (run.a, run.q)))),
        gone AS (SELECT DISTINCT r, unnest(range(a + q, a + n)) AS i FROM run),
        kept AS (SELECT r, string_agg(v, ' ' ORDER BY i) AS words FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.a AS start, best.n AS length, best.q AS period, 1000 * best.n // best.q AS exponent_milli,
          sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
        FROM due LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)""",
}
