from helpers import SF, empty, hard_rows

import corpus_pipeline
from vitrine.llm.pii import masked as redacted
from vitrine.llm.queries import ORACLES, QUERIES
from vitrine.operators.lookup import maybe_listed, surely_unlisted
from vitrine.session import _written


def test_stages_in_order_keep_the_columns(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs, counts = table, [table.count()]
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF).cache()
        assert docs.columns == table.columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] > counts[3] == counts[4]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == counts[4]
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == last.columns and whole.agg({"length": "sum"}).first() == last.agg({"length": "sum"}).first()


def test_stages_take_an_empty_table(spark):
    docs = empty(spark)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0


def test_stages_in_a_row_take_hard_rows(spark):
    docs = hard_rows(spark)
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    stay = docs.where("text is not null and length(trim(text)) > 0")
    for name, step in corpus_pipeline.STAGES[1:-1]:  # no language can be learnt from these rows
        stay = step(spark, stay, SF).cache()
        assert stay.columns == docs.columns, name
    got = {(r["doc_id"], r["text"]) for r in stay.collect()}
    assert got <= texts and {(5, "one text"), (5, "another text"), (None, "no id at all")} <= got
    assert corpus_pipeline.STAGES[-1][1](spark, stay, SF).count() > 0


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_rows_of_a_stage_go_when_the_next_are_written(spark, monkeypatch):
    steps = [(name, lambda spark, docs, sf: docs.limit(40)) for name, _ in corpus_pipeline.STAGES[:2]]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*steps, ("pii", corpus_pipeline.redact), ("last", lambda spark, docs, sf: docs)])
    since = len(_written)
    assert corpus_pipeline.run(spark, SF).count() == 40
    assert [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in _written[since:]] == ["pipeline-pii"]


def test_personal_data_leaves_its_rows_and_added_spans_alone(spark):
    since = len(_written)
    assert redacted(hard_rows(spark)).count() == hard_rows(spark).count()
    assert [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in _written[since:]] == ["pii-seen", "pii-added"]


def test_rows_of_a_list_and_all_others_are_told_apart(spark):
    frame = spark.createDataFrame([(i if i % 7 else None, f"t{i}") for i in range(400)], "row_key bigint, `a.b` string")
    for listed in (frame.where("row_key % 5 = 0"), frame.where("false")):
        near, far = (f(frame, listed, "row_key", 1024).collect() for f in (maybe_listed, surely_unlisted))
        assert sorted(r[1] for r in near + far) == sorted(f"t{i}" for i in range(400))
        assert {r[0] for r in listed.collect()} - {None} <= {r[0] for r in near} and not {r[0] for r in far} & {r[0] for r in listed.collect()} - {None}
