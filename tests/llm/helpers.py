"""A small table with the cases that every operator must handle, and the real one."""

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, row_key int, spans string"
SF = "/root/testdata/sf0.001"


def docs(spark, texts, lang="en"):
    """Rows with ids from 0; the further columns have names that operators use inside."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "k", 1, "x") for i, t in enumerate(texts)], DOC)


def hard_rows(spark):
    """Null id, null text, empty, blank, repeated row, repeated id, long text, other planes, all columns null."""
    long_text = ("Ein langer Text ohne Ende und mit vielen Worten " * 3000) + "x" * 20_000
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "plain words here and there"), (4, "plain words here and there"), (5, "one text"),
        (5, "another text"), (None, "no id at all"), (None, "no id at all"), (6, long_text), (7, "emoji 😀 ünï 世界 \u0000 end"), (None, None), (8, "!!! ??? 123"),
    ]
    return spark.createDataFrame([(i, t, None, None, None, "k", 1, "x") for i, t in rows], DOC)


def empty(spark):
    return spark.createDataFrame([], DOC)
