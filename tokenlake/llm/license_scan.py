"""License scan: ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z) and cut into words. A few base phrases are always reported. The
method's rules are regular expressions over the words joined by single spaces. Each rule has
keywords; an Aho-Corasick automaton over all keywords finds where rules may match, and only the
rules of that keyword are tried near it. Detections are then ordered by priority and length; one
that lies inside a stronger detection is suppressed.

Works row by row, without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache
from itertools import accumulate, groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.llm.common import per_text, table, without

# Base phrases and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, keywords of which the name contains one, and the name as an expression
# over words joined by single spaces.
LICENSES = (
    ("agpl-3.0", ("affero general", " agpl",), r"(?:gnu )?affero general public licen[cs]e(?: version| v)?(?: 3(?: 0)?)?|agpl(?: ?v?3(?: 0)?)?"),
    ("lgpl-2.1", ("lesser general", "library general", " lgpl",), r"(?:gnu )?(?:lesser|library) general public licen[cs]e(?: version| v)? ?2(?: [01])?|lgpl ?v?2(?: [01])?"),
    ("lgpl-3.0", ("lesser general", " lgpl",), r"(?:gnu )?lesser general public licen[cs]e(?: version| v)?(?: 3(?: 0)?)?|lgpl ?v?3(?: 0)?"),
    ("gpl-1.0", ("general public licen", " gpl",), r"(?:gnu )?general public licen[cs]e(?: version| v) ?1(?: 0)?|gpl ?v?1(?: 0)?"),
    ("gpl-2.0", ("general public licen", " gpl",), r"(?:gnu )?general public licen[cs]e(?: version| v) ?2(?: 0)?|gpl ?v?2(?: 0)?"),
    ("gpl-3.0", ("general public licen", " gpl",), r"(?:gnu )?general public licen[cs]e(?: version| v) ?3(?: 0)?|gpl ?v?3(?: 0)?"),
    ("apache-1.1", (" apache ",), r"apache(?: software)? licen[cs]e(?: version| v)? ?1 1|apache 1 1"),
    ("apache-2.0", (" apache ",), r"apache(?: software)? licen[cs]e(?: version| v)? ?2(?: 0)?|apache 2 0"),
    ("cc-by-nc-nd", (" cc by ", " creative commons ",), r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv(?:ative)?s?)"),
    ("cc-by-nc-sa", (" cc by ", " creative commons ",), r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)"),
    ("cc-by-nc", (" cc by ", " creative commons ",), r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)(?: [1-4] [05])?"),
    ("cc-by-nd", (" cc by ", " creative commons ",), r"(?:cc|creative commons) (?:by|attribution) (?:nd|no ?deriv(?:ative)?s?)(?: [1-4] [05])?"),
    ("cc-by-sa", (" cc by ", " creative commons ",), r"(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)(?: [1-4] [05])?"),
    ("cc-by-4.0", (" cc by ", " creative commons ",), r"(?:cc|creative commons) (?:by|attribution)(?: international)? 4 0"),
    ("cc0-1.0", (" cc0", "commons zero",), r"cc0(?: 1 0)?|creative commons zero(?: v?1 0)?"),
    ("bsd-2-clause", (" bsd ",), r"(?:simplified|freebsd) bsd(?: licen[cs]e)?|bsd 2 clause(?: licen[cs]e)?"),
    ("bsd-3-clause", (" bsd ",), r"(?:new|modified|revised) bsd(?: licen[cs]e)?|bsd 3 clause(?: licen[cs]e)?"),
    ("bsd-4-clause", (" bsd ",), r"original bsd(?: licen[cs]e)?|bsd 4 clause(?: licen[cs]e)?"),
    ("0bsd", (" 0bsd", " bsd ",), r"0bsd|zero clause bsd(?: licen[cs]e)?"),
    ("bsd", (" bsd licen",), r"bsd licen[cs]e"),
    ("mit-0", (" mit no attribution", " mit 0 ",), r"mit no attribution|mit 0"),
    ("mit", (" mit licen", " mit x11", " expat licen",), r"mit(?: x11)? licen[cs]e|expat licen[cs]e"),
    ("x11", (" x11 licen",), r"x11 licen[cs]e"),
    ("isc", (" isc licen",), r"isc licen[cs]e"),
    ("mpl-1.1", (" mozilla public", " mpl",), r"mozilla public licen[cs]e(?: version| v)? ?1 1|mpl ?1 1"),
    ("mpl-2.0", (" mozilla public", " mpl",), r"mozilla public licen[cs]e(?: version| v)?(?: 2 0)?|mpl ?2 0"),
    ("epl-1.0", (" eclipse public", " epl",), r"eclipse public licen[cs]e(?: version| v)? ?1 0|epl ?1 0"),
    ("epl-2.0", (" eclipse public", " epl",), r"eclipse public licen[cs]e(?: version| v)?(?: 2 0)?|epl ?2 0"),
    ("eupl-1.2", (" european union public", " eupl",), r"european union public licen[cs]e(?: version| v)?(?: 1 2)?|eupl(?: 1 2)?"),
    ("cddl-1.0", ("development and distribution licen", " cddl",), r"common development and distribution licen[cs]e(?: 1 [01])?|cddl(?: 1 [01])?"),
    ("artistic-2.0", (" artistic licen",), r"artistic licen[cs]e(?: 2 0)?"),
    ("artistic-perl", (" terms as perl",), r"same terms as perl(?: itself)?"),
    ("zlib", (" zlib ",), r"zlib(?: libpng)? licen[cs]e"),
    ("libpng", (" libpng licen",), r"libpng licen[cs]e"),
    ("bsl-1.0", (" boost software",), r"boost software licen[cs]e(?: version)?(?: 1 0)?"),
    ("unlicense", (" unlicense", " unencumbered",), r"unlicense|free and unencumbered software released into the public domain"),
    ("wtfpl", (" you want to public", " wtfpl",), r"do what the fuck you want to public licen[cs]e|wtfpl"),
    ("postgresql", (" postgresql licen",), r"postgresql licen[cs]e"),
    ("python-2.0", (" python software", " psf licen",), r"python software foundation licen[cs]e(?: 2 0)?|psf licen[cs]e"),
    ("ofl-1.1", (" open font", " ofl",), r"(?:sil )?open font licen[cs]e(?: 1 1)?|ofl ?1 1"),
    ("odbl-1.0", (" database licen", " odbl",), r"open (?:data commons )?database licen[cs]e|odbl(?: 1 0)?"),
    ("gfdl", (" free documentation", " gfdl",), r"(?:gnu )?free documentation licen[cs]e(?: version 1 [1-3])?|gfdl"),
    ("ms-pl", (" microsoft public", " ms pl ",), r"microsoft public licen[cs]e|ms pl"),
    ("ncsa", (" ncsa ",), r"university of illinois ncsa open source licen[cs]e|ncsa licen[cs]e"),
    ("osl-3.0", (" open software licen",), r"open software licen[cs]e(?: 3 0)?"),
    ("afl-3.0", (" academic free",), r"academic free licen[cs]e(?: 3 0)?"),
    ("openrail", ("openrail", " open rail", "openrail m",), r"(?:creative ?ml )?open ?rail(?: m)?"),
    ("busl-1.1", (" business source",), r"business source licen[cs]e(?: 1 1)?"),
    ("sspl-1.0", (" server side public",), r"server side public licen[cs]e"),
    ("elastic-2.0", (" elastic licen",), r"elastic licen[cs]e(?: 2 0)?"),
)

# Forms of a notice: priority, confidence, words before the name, words after it.
FORMS = (
    (5, 1.0, r"spdx licen[cs]e identifier", r""),
    (4, 0.95, r"licen[cs]ed under(?: the)?(?: terms of)?(?: the)?", r""),
    (4, 0.95, r"(?:released|distributed|published|available|provided) under(?: the)?(?: terms of)?(?: the)?", r""),
    (3, 0.9, r"(?:see|read|subject to|governed by|under the terms of)(?: the)?", r" for details"),
    (2, 0.8, r"", r""),
)

# Notices that name no particular license.
NOTICES = (
    ("all-rights-reserved", (" all rights reserved",), 1, 0.6, r"all rights reserved"),
    ("copyright", (" copyright ",), 1, 0.4, r"copyright(?: c)? [12][0-9]{3}"),
    ("public-domain", (" public domain",), 1, 0.7, r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("proprietary", (" proprietary and", " unauthorized copying"), 1, 0.6, r"(?:proprietary and confidential|unauthorized copying of this file)"),
    ("mit", (" permission is hereby",), 3, 0.9, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", (" permission to use",), 3, 0.9, r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", (" redistribution and use",), 3, 0.9, r"redistribution and use in source and binary forms with or without modification are permitted"),
)

DETECTION = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("base", T.BooleanType()),
    ]
)
SCAN = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("found", T.ArrayType(DETECTION))])

BASE_SCORE = 0.5
# Bytes on either side of a keyword in which its signatures are tried.
NEAR = 256
_LOWER_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def signature_rules() -> list[tuple[str, tuple[str, ...], int, float, str]]:
    """(label, keywords, priority, confidence, expression): every license in every form, then the notices."""
    rules = []
    for label, keywords, name in LICENSES:
        for priority, confidence, before, after in FORMS:
            lead = f"{before} " if before else ""
            rules.append((label, keywords, priority, confidence, f"{lead}(?:{name}){after}"))
    return [*rules, *NOTICES]


@cache
def _automata():
    import ahocorasick

    by_keyword: dict[str, list] = {}
    for order, (label, keywords, priority, confidence, pattern) in enumerate(signature_rules()):
        rule = (order, label, priority, confidence, re.compile(rf"(?<= ){pattern}(?= )".encode()))
        for keyword in keywords:
            by_keyword.setdefault(keyword, []).append(rule)
    signatures, base = ahocorasick.Automaton(), ahocorasick.Automaton()
    for keyword, rules in by_keyword.items():
        signatures.add_word(keyword, rules)
    for phrase, label in BASE_PHRASES:
        base.add_word(f" {phrase} ", (len(phrase) + 2, len(phrase.split()), label))
    signatures.make_automaton()
    base.make_automaton()
    return signatures, base


def _unsuppressed(hits: set[tuple]) -> list[tuple]:
    """Hits (-priority, start, -end, order, ...) that lie in no stronger hit.

    Of two equal intervals at one priority the earlier rule stays. A suppressed hit's container
    also contains what the hit contains, so comparing with kept hits is enough.
    """
    kept: list[tuple] = []
    for _, level in groupby(sorted(hits), key=lambda h: h[0]):
        stronger = sorted((h[1], -h[2]) for h in kept)
        starts = [s for s, _ in stronger]
        reach = list(accumulate((e for _, e in stronger), max))
        furthest = -1
        for hit in level:
            start, end = hit[1], -hit[2]
            before = bisect_right(starts, start)
            if end <= furthest or before and reach[before - 1] >= end:
                continue
            furthest = end
            kept.append(hit)
    return kept


def _signature_hits(joined: bytes, text: str) -> list[tuple]:
    """(start, end, label, confidence) in bytes, after suppression."""
    hits = set()
    for last, rules in _automata()[0].iter(text):
        # No signature is longer than NEAR, so it lies within this distance of its keyword.
        low, high = max(0, last - NEAR), last + NEAR
        for order, label, priority, confidence, compiled in rules:
            for match in compiled.finditer(joined, low, high):
                hits.add((-priority, match.start(), -match.end(), order, label, confidence))
    return [(h[1], -h[2], h[4], h[5]) for h in _unsuppressed(hits)]


def scan(data: bytes | None) -> tuple[int, list[tuple]]:
    """(number of words, detections by start) of one text."""
    words = (data or b"").translate(_LOWER_WORDS).split()
    if not words:
        return 0, []
    joined = b" " + b" ".join(words) + b" "
    text = joined.decode("latin-1")
    base = _automata()[1]
    found = []
    for last, (length, n_words, label) in base.iter(text):
        found.append((last - length + 1, n_words, label, BASE_SCORE, True))
    for start, end, label, confidence in _signature_hits(joined, text):
        found.append((start - 1, joined.count(b" ", start, end) + 1, label, confidence, False))
    # A blank stands before every word, so blanks before a place count the words before it.
    out, at, before = [], 0, 0
    for place, n_words, label, score, is_base in sorted(found):
        before += joined.count(b" ", at, place)
        at = place
        out.append((label, before, before + n_words, score, is_base))
    return len(words), out


def find_licenses(docs: DataFrame, text_col: str = "text", out: str = "licenses") -> DataFrame:
    """``docs`` with (n_words, found): words of the text, and its detections as (label, start, end,
    score, base) with word positions from 0, ends exclusive.

    NULL, empty and wordless texts have no words and no detections. Every input
    row gives one row, repeated rows too; a column named ``out`` is replaced.
    """

    def make():
        def one(data):
            n_words, found = scan(data)
            names = ("label", "start", "end", "score", "base")
            return {"n_words": n_words, "found": [dict(zip(names, f)) for f in found]}

        return one

    udf = per_text(docs.sparkSession, SCAN, make, as_bytes=True)
    return without(docs, [out] if out != text_col else []).withColumn(out, udf(F.col(text_col)))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, base phrases with their first and last place, labels, the best score."""
    found = find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    scored = found.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.filter("licenses.found", lambda d: d["base"]).alias("_base"),
        F.col("licenses.found").alias("_all"),
    )
    return scored.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min("_base.start").alias("first_word"),
        F.array_max("_base.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("_base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct("_all.label")), ",").alias("labels"),
        F.coalesce(F.array_max("_all.score"), F.lit(0.0)).alias("score"),
    )
