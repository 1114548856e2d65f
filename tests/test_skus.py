"""The distributed SKU rule against the rule told row by row."""

import random

import pytest
from pyspark.errors import AnalysisException

from vitrine.operators.skus import resolve_skus
from vitrine.session import clear_scratch, scratch_path

SCHEMA = "url_ord long, var_idx int, seller_sku string, listing_id string, product_url string, " \
         "variation_variant_1 string, item_name string"


def told_row_by_row(rows):
    taken, count, out = set(), {}, []
    for base, variant in rows:
        count[base] = count.get(base, 0) + 1
        name = base
        if name in taken:
            root = f"{base}-{variant or count[base]}"
            name, i = root, 2
            while name in taken:
                name, i = f"{root}-{i}", i + 1
        taken.add(name)
        out.append(name)
    return out


def run(spark, cases, rows_per_bucket):
    """Many independent cases in one job: the case number is part of every base."""
    data, expected, at = [], [], 0
    for c, rows in enumerate(cases):
        named = [(f"q{c}" + ("-" + b if b else ""), v) for b, v in rows]
        expected += told_row_by_row(named)
        for b, v in named:
            data.append((at, 1, b, "", "", v, ""))
            at += 1
    got = resolve_skus(spark.createDataFrame(data, SCHEMA), rows_per_bucket).collect()
    return [r.unique_sku for r in sorted(got)], expected


def test_plain_repeats_and_cross_meeting(spark):
    cases = [
        [("a", "x"), ("a", "x"), ("a", "x"), ("a-x", "y")],
        [("a-x-2", "z"), ("a", "x"), ("a", "x"), ("a", "x"), ("a", "x")],
        [("a", "x"), ("a", ""), ("a", ""), ("a", "x")],
        [("a", "x-2"), ("a", "x"), ("a", "x"), ("a", "x"), ("a", "x-2"), ("a", "x-2")],
        [("a", "x"), ("a", "x"), ("a-x", "x"), ("a-x", "x"), ("a", "x-x"), ("a-x-x", "x")],
    ]
    got, expected = run(spark, cases, 2)
    assert got == expected


def test_random_cases(spark):
    rng = random.Random(7)
    bases = ["", "a", "a-x", "a-x-2", "a-2", "a-x-x", "a-x-3", "x"]
    suffixes = ["x", "2", "x-2", "", "x-x", "3"]
    cases = [
        [(rng.choice(bases), rng.choice(suffixes)) for _ in range(rng.randint(1, 14))] for _ in range(400)
    ]
    got, expected = run(spark, cases, 5)
    assert got == expected


def test_one_hot_base(spark):
    cases = [[("h-x-7", "q"), ("h-x-8", "q")] + [("h", "x")] * 300 + [("h-x", "q")] * 3]
    got, expected = run(spark, cases, 16)
    assert got == expected


def test_scratch_is_cleared_on_request(spark):
    path = scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) >= 1 and clear_scratch(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
