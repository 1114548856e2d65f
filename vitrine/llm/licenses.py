"""License scans with ordered signature rules.

Each license has name patterns over normalised words, keywords of which every text with the name holds one, and a
rank. From them come the rules, in order: identifier tags, "licensed under" phrases, names with a version,
bare names. A rule runs only on texts that hold one of its keywords. A detection whose interval lies inside that of
an earlier rule's detection (or of a longer one by the same rule) is suppressed. The labels that remain are
added to those of the base phrases, which always stay.

Everything is DataFrame and SQL. Cases: null text is empty and has no words. Texts without a keyword are
only counted. Repeated rows are scanned each. Empty tables give no rows. Further columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.sqltext import bind
from vitrine.llm.common import GAP, LOWER, UPPER
from vitrine.llm.spans import holds, literal, matches

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


class License(NamedTuple):
    """``names``: patterns over words joined by single spaces; ``tag``: words of the identifier; ``keyword``: alternatives joined by ``|``, each name holds one."""

    label: str
    keyword: str
    names: tuple[str, ...]
    tag: str
    versions: str = ""


#: Hand-written signatures, in order of rank. More exact names come before the ones that they contain.
LICENSES = (
    License("agpl-3.0", "affero", ("gnu affero general public license", "affero general public license", "affero gpl"), "agpl 3 0(?: only| or later)?", "3(?: 0)?"),
    License("lgpl-2.1", "lesser", ("gnu lesser general public license", "lesser general public license"), "lgpl 2 1(?: only| or later)?", "2 1"),
    License("lgpl-3.0", "lesser", ("gnu lesser general public license", "lesser gpl"), "lgpl 3 0(?: only| or later)?", "3(?: 0)?"),
    License("lgpl-2.0", "library general", ("gnu library general public license", "library general public license"), "lgpl 2 0(?: only| or later)?", "2(?: 0)?"),
    License("lgpl", "lgpl", ("gnu lgpl", "lgpl"), "lgpl", "v?[23](?: [01])?"),
    License("gfdl", "free documentation", ("gnu free documentation license", "free documentation license"), "gfdl 1 [1-3]", "1 [1-3]"),
    License("gpl-3.0", "gpl", ("gnu gpl v3", "gpl v ?3", "gplv3", "gpl 3 0"), "gpl 3 0(?: only| or later)?", "3(?: 0)?"),
    License("gpl-2.0", "gpl", ("gnu gpl v2", "gpl v ?2", "gplv2", "gpl 2 0"), "gpl 2 0(?: only| or later)?", "2(?: 0)?"),
    License("gpl", "general public", ("gnu general public license", "gnu general public licence", "general public license"), "gpl", "v?[123](?: 0)?(?: or later)?"),
    License("apache-2.0", "apache", ("apache license version 2 0", "apache license 2 0", "apache software license 2 0", "apache 2 0 license", "apache licence version 2 0"), "apache 2 0", ""),
    License("apache-1.1", "apache", ("apache license version 1 1", "apache software license version 1 1", "apache software license 1 1"), "apache 1 1", ""),
    License("apache", "apache", ("apache license", "apache software license", "apache licence"), "apache", "1 0"),
    License("cc-by-nc-nd", "cc by nc nd", ("cc by nc nd",), "cc by nc nd [1-4] [05]", "[1-4] [05]"),
    License("cc-by-nc-sa", "cc by nc sa", ("cc by nc sa",), "cc by nc sa [1-4] [05]", "[1-4] [05]"),
    License("cc-by-nc", "cc by nc", ("cc by nc",), "cc by nc [1-4] [05]", "[1-4] [05]"),
    License("cc-by-nd", "cc by nd", ("cc by nd",), "cc by nd [1-4] [05]", "[1-4] [05]"),
    License("cc-by-sa", "cc by sa", ("cc by sa",), "cc by sa [1-4] [05]", "[1-4] [05]"),
    License("cc-by-nc-nd", "noncommercial", ("creative commons attribution noncommercial noderiv(?:ative)?s(?: works)?",), "creative commons by nc nd", "[1-4] [05]"),
    License("cc-by-nc-sa", "noncommercial", ("creative commons attribution noncommercial share ?alike",), "creative commons by nc sa", "[1-4] [05]"),
    License("cc-by-nc", "noncommercial", ("creative commons attribution noncommercial",), "creative commons by nc", "[1-4] [05]"),
    License("cc-by-nd", "creative commons", ("creative commons attribution noderiv(?:ative)?s(?: works)?",), "creative commons by nd", "[1-4] [05]"),
    License("cc-by-sa", "creative commons", ("creative commons attribution share ?alike",), "creative commons by sa", "[1-4] [05]"),
    License("cc-by", "creative commons", ("creative commons attribution",), "creative commons by", "[1-4] [05]"),
    License("cc-by", "cc by", ("cc by",), "cc by [1-4] [05]", "[1-4] [05]"),
    License("cc0-1.0", "cc0", ("cc0(?: 1 0)?(?: universal)?",), "cc0 1 0", ""),
    License("mit-0", "mit no attribution", ("mit no attribution",), "mit 0", ""),
    License("mit", "mit", ("mit license", "mit licence", "the mit expat license"), "mit", ""),
    License("x11", "x11", ("x11 license", "mit x11 license", "x11 mit license"), "x11", ""),
    License("isc", "isc|internet systems", ("isc license", "internet systems consortium license"), "isc", ""),
    License("bsd-4-clause", "bsd", ("bsd 4 clause(?: license)?", "4 clause bsd(?: license)?", "original bsd license"), "bsd 4 clause", ""),
    License("bsd-3-clause", "bsd", ("bsd 3 clause(?: license)?", "3 clause bsd(?: license)?", "new bsd license", "revised bsd license", "modified bsd license"), "bsd 3 clause", ""),
    License("bsd-2-clause", "bsd", ("bsd 2 clause(?: license)?", "2 clause bsd(?: license)?", "simplified bsd license", "freebsd license"), "bsd 2 clause", ""),
    License("0bsd", "bsd", ("zero clause bsd(?: license)?", "bsd zero clause(?: license)?", "0bsd"), "0bsd", ""),
    License("bsd", "bsd", ("bsd license", "bsd style license", "bsd licence"), "bsd", ""),
    License("mpl-2.0", "mozilla|mpl", ("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"), "mpl 2 0", ""),
    License("mpl-1.1", "mozilla|mpl", ("mozilla public license version 1 1", "mozilla public license 1 1", "mpl 1 1"), "mpl 1 1", ""),
    License("mpl", "mozilla|mpl", ("mozilla public license",), "mpl", "1 0"),
    License("epl-2.0", "eclipse", ("eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v 2 0"), "epl 2 0", ""),
    License("epl-1.0", "eclipse", ("eclipse public license version 1 0", "eclipse public license 1 0", "eclipse public license v 1 0"), "epl 1 0", ""),
    License("epl", "eclipse", ("eclipse public license",), "epl", ""),
    License("cddl-1.1", "distribution license|cddl", ("common development and distribution license version 1 1", "cddl 1 1"), "cddl 1 1", ""),
    License("cddl-1.0", "distribution license|cddl", ("common development and distribution license", "cddl 1 0"), "cddl 1 0", "1 0"),
    License("cpl-1.0", "common public", ("common public license",), "cpl 1 0", "1 0"),
    License("eupl-1.2", "european union", ("european union public licen[cs]e",), "eupl 1 2", "1 [12]"),
    License("artistic-2.0", "artistic", ("artistic license 2 0", "artistic license version 2 0"), "artistic 2 0", ""),
    License("artistic-1.0", "artistic", ("artistic license 1 0", "artistic license", "perl artistic license"), "artistic 1 0", ""),
    License("bsl-1.0", "boost", ("boost software license",), "bsl 1 0", "1 0"),
    License("busl-1.1", "business source", ("business source license",), "busl 1 1", "1 1"),
    License("zlib", "zlib", ("zlib license", "zlib libpng license"), "zlib", ""),
    License("unlicense", "unlicense", ("the unlicense", "unlicense"), "unlicense", ""),
    License("wtfpl", "wtfpl", ("wtfpl",), "wtfpl", "2(?: 0)?"),
    License("ofl-1.1", "open font", ("sil open font license", "open font license"), "ofl 1 1", "1 [01]"),
    License("odbl-1.0", "open database", ("open database license", "open data commons open database license"), "odbl 1 0", "v?1 0"),
    License("odc-by", "open data commons", ("open data commons attribution license",), "odc by 1 0", "v?1 0"),
    License("pddl-1.0", "public domain dedication", ("public domain dedication and license", "open data commons public domain dedication"), "pddl 1 0", "1 0"),
    License("psf-2.0", "python software|psf", ("python software foundation license", "psf license"), "psf 2 0", "2(?: 0)?"),
    License("ms-pl", "microsoft public", ("microsoft public license",), "ms pl", ""),
    License("ms-rl", "microsoft reciprocal", ("microsoft reciprocal license",), "ms rl", ""),
    License("ncsa", "ncsa", ("university of illinois ncsa open source license", "ncsa open source license"), "ncsa", ""),
    License("openssl", "openssl", ("openssl license",), "openssl", ""),
    License("php-3.01", "php license", ("php license",), "php 3 01", "3 01"),
    License("postgresql", "postgresql", ("postgresql license",), "postgresql", ""),
    License("ruby", "ruby", ("ruby license", "ruby s license"), "ruby", ""),
    License("vim", "vim", ("vim license",), "vim", ""),
    License("w3c", "w3c", ("w3c software(?: notice and)? license",), "w3c", ""),
    License("blueoak-1.0.0", "blue oak", ("blue oak model license",), "blueoak 1 0 0", "1 0 0"),
    License("public-domain", "public domain", ("dedicated to the public domain", "released into the public domain", "in the public domain"), "public domain", ""),
    License("proprietary", "all rights", ("all rights reserved",), "all rights reserved", ""),
)
TAGGED = "spdx license identifier"
#: Every name and tag above holds one of these, so texts without any are not normalised.
STEMS = ("licen", "gpl", "cc by", "creative commons", "cc0", "no attribution", "bsd", "mpl", "cddl", "wtfpl", "public domain", "rights reserved")
#: Separators in texts as they are: A-Z are letters too, patterns ignore the case of ASCII letters only.
RAW_GAP, RAW_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    score: float


def rules(licenses: tuple[License, ...] = LICENSES) -> list[Rule]:
    """All rules in order of priority: by form, then by the license's rank."""
    before, out = "(?<= )", []
    out += [Rule(x.label, "spdx", f"{before}{TAGGED} {x.tag}(?= )", 1.0) for x in licenses]
    for form, score in (("licensed", 0.95), ("versioned", 0.9), ("bare", 0.8)):
        for x in licenses:
            names = f"(?:{'|'.join(x.names)})"
            version = f"(?: version| v)? v?{x.versions}" if x.versions else ""
            if form == "licensed":
                out.append(Rule(x.label, x.keyword, f"{before}(?:licen[sc]ed|released|distributed|available|published|made available) under (?:the |an? )?(?:terms of the )?{names}(?:{version})?(?= )", score))
            elif form == "versioned" and version:
                out.append(Rule(x.label, x.keyword, f"{before}{names}{version}(?= )", score))
            elif form == "bare":
                out.append(Rule(x.label, x.keyword, f"{before}{names}(?= )", score))
    return out


def _spaced(phrase: str) -> str:
    return f"{RAW_GAP}++".join(phrase.split(" "))


BASE_PATTERN = f"(?i)(?:{'|'.join(f'{p[0]}(?<!{RAW_WORD}.){_spaced(p)[1:]}' for p in BASE)})(?!{RAW_WORD})"


def word_count(text: str) -> str:
    """SQL: pieces between separators, less the empty ones at the ends."""
    pieces = f"size(split({text}, {literal(f'{RAW_GAP}++')}, -1))"
    return f"if({text} = '', 0, {pieces} - cast(left({text}, 1) rlike {literal(RAW_GAP)} as int) - cast(right({text}, 1) rlike {literal(RAW_GAP)} as int))"


def scanned(docs: DataFrame, keep: list[str], licenses: tuple[License, ...] = LICENSES) -> DataFrame:
    """kept, n_words, places (word start and label of every base phrase) and kept detections of the rules."""
    ordered = rules(licenses)
    gate = f"(?i){'|'.join(_spaced(s) for s in STEMS)}"
    table = "array(" + ", ".join(f"named_struct('rank', {i}, 'label', '{r.label}', 'keywords', array({', '.join(map(literal, r.keyword.split('|')))}), 'pattern', {literal(r.pattern)}, 'score', {r.score}D)" for i, r in enumerate(ordered)) + ")"
    label = "case " + " ".join(f"when {literal(p)} = lower(regexp_replace(m.value, {literal(f'{RAW_GAP}++')}, ' ')) then '{k}'" for p, k in BASE.items()) + " end"
    # A place's word start: words before it, counted gap by gap, as a match never cuts a word.
    places = f"transform({matches('text', BASE_PATTERN, count=word_count)}, m -> named_struct('start', m.before, 'label', {label}))"
    norm = f"concat(' ', array_join(array_remove(split(translate(text, '{UPPER}', '{LOWER}'), {literal(f'{GAP}++')}, -1), ''), ' '), ' ')"
    one = matches("norm", "r.pattern").replace(literal("r.pattern"), "r.pattern")
    by_rule = f"""filter(transform(filter({table}, r -> exists(r.keywords, k -> contains(norm, concat(' ', k)) or contains(norm, concat(k, ' ')))),
        r -> named_struct('rank', r.rank, 'label', r.label, 'score', r.score, 'spans', {one})), r -> size(r.spans) > 0)"""
    none = "array<struct<rank: int, from: bigint, to: bigint, label: string, score: double>>"

    # Whatever lies in a suppressed detection lies in the one that suppressed it, so all earlier rules' detections count alike.
    def kept(found: str) -> str:
        inside = f"exists(slice({found}, 1, i), q -> {holds('q.spans', 'h.start', 'h.end')})"
        shown = "named_struct('rank', r.rank, 'from', h.start, 'to', h.end, 'label', r.label, 'score', r.score)"
        return f"flatten(transform({found}, (r, i) -> transform(filter(r.spans, h -> not {inside}), h -> {shown})))"

    text = docs.select(F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    counted = text.selectExpr("kept", f"cast({word_count('text')} as bigint) as n_words", f"{places} as places", f"if(text rlike {literal(gate)}, {norm}, null) as norm")
    return counted.selectExpr("kept", "n_words", "places", f"if(norm is null, cast(array() as {none}), {bind(by_rule, kept)}) as detections")


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    found = scanned(docs, ["doc_id"])
    base = "array_distinct(transform(places, p -> p.label))"
    return found.selectExpr(
        "kept.doc_id as doc_id", "n_words", "cast(size(places) as bigint) as n_base",
        "array_min(transform(places, p -> p.start)) as first_word", "array_max(transform(places, p -> p.start)) as last_word",
        f"array_join(array_sort({base}), ',') as base_labels",
        f"array_join(array_sort(array_union({base}, transform(detections, d -> d.label))), ',') as labels",
        "greatest(coalesce(array_max(transform(detections, d -> d.score)), 0D), if(size(places) > 0, 0.8D, 0D)) as score",
    )
