"""Personal data by bootstrapped contextual extraction.

Four base kinds (mail addresses, IPv4 addresses, payment cards, phone numbers) are found by patterns and
checks. They seed a graph of contexts (the two letter words before an identifier, and the two behind it) and identifiers: a context
is as sure as the share of its documents in which an accepted identifier stands there, an identifier is as
sure as its contexts make it, and both are rescored for a few rounds. Unseen identifiers (tokens with four
or more digits) in contexts that end up sure become spans of kind ``context``. Base spans always stay.

Everything is DataFrame and SQL. Contexts are counted over whole texts in one pass: the distinct word pairs of a text meet
the written contexts, after a bitmap of these of fixed size has left out nearly all other pairs. Texts are cut into
pieces once, so contexts and replacements cost the same anywhere in a long text.

Cases: null text is empty. A span that overlaps a base span is never added. Repeated rows and documents
that share or lack a ``doc_id`` are judged each: a row is known by a key that is written with it. Empty
tables give no rows. Further columns are not read by ``pii``; ``masked`` returns them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.sqltext import let
from vitrine.llm.common import release, stage
from vitrine.llm.spans import PIECE, cut, joined, literal, matches, meets, merged, of_kind, pieces
from vitrine.operators.lookup import maybe_listed, surely_unlisted
from vitrine.session import clear_scratch, scratch_mark

#: The base kinds in their order. The patterns find the same matches as the stated ones, without
#: trying the inside of a run again: a match begins at a run's start or where the last match ended.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9 -]{15,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
ADDED = "context"
#: Separators that don't stand between two digits become another character, so that a card is a plain run.
LONE_SEPARATOR = r"(?<![0-9])[ -]|[ -](?![0-9])"
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TOKEN_PART = "A-Za-z0-9._%+@/-"
TOKEN = (
    rf"(?<![{TOKEN_PART}])(?=(?:[A-Za-z._%+@/-]*+[0-9]){{4}})[{TOKEN_PART}]{{5,63}}(?<=[A-Za-z0-9])(?![A-Za-z0-9_%+@-]|[./]++[A-Za-z0-9])"
)
NEAR = 100
PART = 64


def _luhn(value: str) -> str:
    """SQL: 16 to 19 digits whose Luhn sum ends in 0."""
    digits = f"lpad(regexp_replace({value}, '[ -]', ''), 20, '0')"
    doubled = "cast(substring(d, i, 1) as int) * if(i % 2 = 1, 2, 1)"
    total = f"aggregate(sequence(1, 20), 0, (n, i) -> n + transform(array({doubled}), x -> if(x > 9, x - 9, x))[0])"
    count = f"length(regexp_replace({value}, '[ -]', '')) between 16 and 19"
    return f"({count} and transform(array({digits}), d -> {total} % 10 = 0)[0])"


def base_spans(text: str) -> dict[str, str]:
    """SQL per base kind: array<struct<start, end, value>> of the matches that pass."""
    card_text = f"if({text} rlike '[0-9][0-9 -]{{15}}', regexp_replace({text}, {literal(LONE_SEPARATOR)}, '\\u0001'), '')"
    card = f"transform(array({card_text}), c -> {matches('c', CARD)})[0]"
    return {
        "email": matches(text, EMAIL, f"@[A-Za-z0-9-]+[.]"),
        "ip": f"filter({matches(text, IP)}, s -> s.value rlike {literal(f'^{BYTE}(?:[.]{BYTE}){{3}}$')})",
        "card": f"filter({card}, s -> {_luhn('s.value')})",
        "phone": f"filter({matches(text, PHONE)}, s -> length(regexp_replace(s.value, '[^0-9]', '')) between 8 and 15)",
    }


def words(text: str) -> str:
    return f"split(lower({text}), {literal(r'[^\p{L}]+')})"


def contexts(parts: str, start: str, end: str) -> str:
    """SQL for array<string>: the last two letter words in the ``NEAR`` characters before ``start``, and the first two behind ``end``."""

    def pair(piece: str, side: str, at: str) -> str:
        return let(f"filter({words(piece)}, w -> w <> '')", lambda w: f"if(size({w}) >= 2, concat('{side} ', {at.format(w=w)}), null)")

    left = pair(cut(parts, f"greatest({start} - {NEAR}, 0L)", start), "<", "{w}[size({w}) - 2], ' ', {w}[size({w}) - 1]")
    right = pair(cut(parts, end, f"{end} + {NEAR}"), ">", "{w}[0], ' ', {w}[1]")
    return f"filter(array({left}, {right}), c -> c is not null)"


def occurrences(docs: DataFrame, keep: list[str]) -> DataFrame:
    """kept, row_key, base (kind, start, end) and seen: seeds and candidates with value and contexts."""
    text = docs.select(F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    found = text.selectExpr("kept", "text", *(f"{sql} as {kind}" for kind, sql in base_spans("text").items()))
    based = found.selectExpr("kept", "text", *KINDS, "concat(" + ", ".join(of_kind(k, k) for k in KINDS) + ") as base")
    free = " or ".join(meets(k, "c.start", "c.end") for k in KINDS)
    tokens = f"filter({matches('text', TOKEN, '[0-9][^ ]*[0-9]')}, c -> not ({free}))"
    tokened = based.selectExpr("kept", "text", *KINDS, "base", f"{tokens} as tokens")
    cutting = tokened.selectExpr("kept", *KINDS, "base", "tokens", f"if(size(base) + size(tokens) > 0, {pieces('text')}, cast(array() as array<string>)) as parts")
    seen = lambda spans, seed: f"transform({spans}, s -> named_struct('start', s.start, 'end', s.end, 'value', s.value, 'contexts', {contexts('parts', 's.start', 's.end')}, 'seed', {seed}))"
    return cutting.selectExpr(
        "kept", "monotonically_increasing_id() as row_key", "base",
        f"concat({', '.join(seen(k, 'true') for k in KINDS)}, {seen('tokens', 'false')}) as seen",
    )


def _pair_documents(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """(pair, n): documents that hold the words one after the other, for the pairs of ``listed``."""
    distinct = stage(listed.select("pair").distinct(), "pii-pairs")
    pairs = let(f"filter({words('text')}, w -> w <> '')", lambda w: f"zip_with(slice({w}, 1, greatest(size({w}) - 1, 0)), slice({w}, 2, greatest(size({w}) - 1, 0)), (a, b) -> concat(a, ' ', b))")
    held = docs.selectExpr(f"explode(array_distinct({pairs})) as pair").withColumn("_hash", F.xxhash64("pair"))
    near = maybe_listed(held, distinct.select(F.xxhash64("pair").alias("_hash")), "_hash")
    return near.join(distinct, "pair", "left_semi").groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _context_documents(docs: DataFrame, many: DataFrame) -> DataFrame:
    """(context, n): documents that hold the words of the context at all, for every context of ``many`` (context, most).

    Words that already more than ``most`` documents of a ``PART``-th hold are too frequent whatever the others hold: their count
    stops there. All other contexts are counted over all documents.
    """
    listed = many.selectExpr("context", "most", "substring(context, 3) as pair")
    some = listed.join(_pair_documents(docs.where(F.pmod(F.xxhash64("text"), F.lit(PART)) == 0), listed), "pair", "left")
    first = stage(some.select("context", "pair", "most", F.coalesce("n", F.lit(0)).alias("n")), "pii-frequent")
    rare = first.where("n <= most").select("context", "pair")
    counted = rare.join(_pair_documents(docs, rare), "pair").select("context", "n")
    return first.where("n > most").select("context", "n").unionByName(counted)


def sure_contexts(docs: DataFrame, seen: DataFrame, support: int = 3, least: float = 0.5, rounds: int = 3) -> DataFrame:
    """Contexts that end up with a score of ``least`` or more and ``support`` accepted identifiers."""
    each = seen.select("row_key", F.inline("seen")).select("row_key", "value", "seed", F.explode("contexts").alias("context"))
    edges = stage(
        each.groupBy("context", "value", "row_key").agg(F.max("seed").alias("seed"))
        .groupBy("context", "value").agg(F.count(F.lit(1)).alias("docs"), F.max("seed").alias("seed")), "pii-edges",
    )
    trust = edges.groupBy("value").agg(F.max("seed").cast("double").alias("trust"))
    # no more documents than these may hold the words, if half of them (``least``) are to hold identifiers there
    reach = edges.groupBy("context").agg((F.sum("docs") / least).alias("most"))
    held = scores = None
    for _ in range(rounds):
        # only contexts with so many accepted identifiers can be sure; what they stand among is counted once
        open_ones = edges.join(trust, "value").groupBy("context").agg(F.sum((F.col("trust") >= least).cast("int")).alias("accepted")).where(F.col("accepted") >= support).select("context")
        open_ones = open_ones.join(reach, "context")
        fresh = stage(open_ones if held is None else open_ones.join(held, "context", "left_anti"), "pii-open")
        if held is None or not fresh.isEmpty():
            more = stage(_context_documents(docs, fresh), "pii-contexts")
            held = more if held is None else held.unionByName(more)
        graph = edges.join(held, "context")
        scores = stage(
            graph.join(trust, "value").groupBy("context")
            .agg((F.sum(F.col("trust") * F.col("docs")) / F.greatest(F.max("n"), F.sum("docs"))).alias("score"), F.sum((F.col("trust") >= least).cast("int")).alias("accepted"))
            .where((F.col("score") >= least) & (F.col("accepted") >= support)), "pii-scores",
        )
        trust = edges.join(scores, "context", "left").groupBy("value").agg(
            F.greatest(F.max("seed").cast("double"), 1 - F.exp(F.sum(F.log(F.greatest(1 - F.coalesce("score", F.lit(0.0)), F.lit(1e-9)))))).alias("trust")
        )
    return scores.select("context")


def identified(docs: DataFrame, keep: list[str]) -> DataFrame:
    """kept, base and added (kind, start, end), each ordered, of every row."""
    seen = stage(occurrences(docs, keep), "pii-seen")
    mark = scratch_mark()
    sure = sure_contexts(docs.select(F.coalesce("text", F.lit("")).alias("text")), seen)
    added = stage(
        seen.select("row_key", F.inline("seen")).where("not seed").select("row_key", "start", "end", F.explode("contexts").alias("context")).join(sure, "context")
        .groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct(F.lit(ADDED).alias("kind"), "start", "end"))).alias("added")), "pii-added",
    )
    clear_scratch(docs.sparkSession, mark, kept=1)
    release(docs.sparkSession)
    # few rows gain spans: only those that may be among them are moved, all others stay where they are read
    rows, none = seen.select("row_key", "kept", "base"), "cast(array() as array<struct<kind: string, start: bigint, end: bigint>>)"
    gained = maybe_listed(rows, added, "row_key").join(added, "row_key", "left").selectExpr("kept", "base", f"coalesce(added, {none}) as added")
    return gained.unionByName(surely_unlisted(rows, added, "row_key").selectExpr("kept", "base", f"{none} as added"))


def pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    counts = [f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint) as n_{k}" for k in KINDS]
    return identified(docs, ["doc_id"]).selectExpr(
        "kept.doc_id as doc_id", *counts, f"sha2({joined('base')}, 256) as base_sha256", f"{joined('concat(base, added)')} as spans"
    )


def masked(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans are replaced together, under the first one's kind; ``n_chars`` follows the text.
    """
    columns = docs.columns
    found = identified(docs, columns).selectExpr("kept", f"{merged('concat(base, added)')} as spans")
    cutting = found.selectExpr("kept", "spans", f"if(size(spans) > 0, {pieces('kept.text')}, null) as parts")
    shown = f"flatten(transform(spans, (s, i) -> array({cut('parts', 'if(i = 0, 0L, spans[i - 1].end)', 's.start')}, concat('<', upper(s.kind), '>'))))"
    tail = cut("parts", "spans[size(spans) - 1].end", f"cast(size(parts) as bigint) * {PIECE}")
    out = cutting.selectExpr("kept", f"if(size(spans) = 0, kept.text, array_join(concat({shown}, array({tail})), '')) as masked")
    changed = {"text": "masked", "n_chars": "if(masked = kept.text, kept.n_chars, length(masked))"}
    return out.selectExpr(*(f"{changed.get(c, f'kept.`{c}`')} as `{c}`" for c in columns))
