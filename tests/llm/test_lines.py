"""Passages removed by runs of units, against a plain walk over all texts."""

import random
import re

import pytest

from tokenlake.llm import line_dedup
from tokenlake.llm.line_dedup import dedup_units

UNITS = {"line": "[^\n]*\n|[^\n]+", "sentence": "[^.!?\n]*[.!?\n]+|[^.!?\n]+"}


def plain(rows, unit, least, chars):
    """{(id, text): (units, removed, spans, kept)} with rows in order of id, then as given."""
    seen, out = set(), {}
    for key, text in rows:
        if (key, text) in out:
            continue
        units = []
        for m in re.finditer(UNITS[unit], text or ""):
            form = re.sub("[ \t\n\x0b\x0c\r]+", " ", m[0]).strip(" ").lower()
            if form:
                bare = m[0].strip(" \t\n\x0b\x0c\r")
                units.append((form, m.start() + m[0].index(bare), m.start() + m[0].index(bare) + len(bare)))
        later = [f in seen or f in {u[0] for u in units[:i]} for i, (f, _, _) in enumerate(units)]
        seen |= {u[0] for u in units}
        spans, removed, i = [], 0, 0
        while i < len(units):
            j = i
            while j < len(units) and later[j]:
                j += 1
            if j > i and (sum(len(u[0].split(" ")) for u in units[i:j]) >= least or units[j - 1][2] - units[i][1] >= chars):
                spans.append((units[i][1], units[j - 1][2]))
                removed += j - i
            i = max(j, i + 1)
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at:a], b
        out[key, text] = (len(units), removed, spans, None if text is None else kept + text[at:])
    return out


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice("alpha beta Gamma delta  eps\u00e9 zeta eta theta iota kappa".split(" "))
    sentence = lambda n: " ".join(word() for _ in range(n)) + rng.choice([".", "!", "?!", "...", "\n"])
    passage = " ".join(sentence(9) for _ in range(6))
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "Common line.\n" + passage), (5, "in a line " + passage + " and on"), (6, "Common line.\nCommon line.")]
    rows += [(10 + i, " ".join(sentence(rng.randrange(1, 8)) for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    rows += [(80, "\u6587" * 500 + "\n" + "x."), (81, "\u6587" * 500 + "\n" + "x."), (82, passage.upper().replace(" ", "\t ")), (83, passage), (83, passage)]
    rows += [(90, " ".join(sentence(9) for _ in range(20000)))]
    return rows


@pytest.mark.parametrize("unit,least,chars", [("sentence", 30, 400), ("sentence", 8, None), ("line", 1, None)])
def test_runs_go_as_by_a_plain_walk(spark, unit, least, chars, monkeypatch):
    if least == 8:
        monkeypatch.setattr(line_dedup, "ROWS_PER_SALT", 3)
    rows = corpus()
    schema = "doc_id long, text string, key string, u string, row string, r string, at int, high string, n_units string"
    df = spark.createDataFrame([(*r, "k", "u", "w", "r", 1, "h", "gone") for r in rows], schema).repartition(4)
    assert max(len(t or "") for _, t in rows) > 900_000
    got = dedup_units(df, unit=unit, min_words=least, min_chars=chars)
    assert got.columns == ["doc_id", "text", "key", "u", "row", "r", "at", "high", "n_units", "n_removed", "removed_spans", "kept_text"]
    want = plain(rows, unit, least, 1 << 60 if chars is None else chars)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["n_units"], r["n_removed"], [tuple(s) for s in r["removed_spans"]], r["kept_text"]) == want[r["doc_id"], r["text"]]
        assert (r["key"], r["u"], r["row"], r["r"], r["at"], r["high"]) == ("k", "u", "w", "r", 1, "h")
    if chars:
        by_id = {r["doc_id"]: r for r in found}
        assert by_id[5]["n_removed"] >= 4 and by_id[6]["n_removed"] == 0 and by_id[81]["n_removed"] == 2 and by_id[82]["kept_text"].strip() == ""
    assert dedup_units(df.limit(0), unit=unit).count() == 0


def test_rows_without_a_rank_or_with_equal_ranks(spark):
    text = "one two three four. five six seven."
    df = spark.createDataFrame([(None, text), (1, text), (1, text + " more"), (1, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"], r["n_removed"]) for r in dedup_units(df, unit="sentence").collect())
    assert got == [(0, text, 0), (1, text, 2), (1, text, 2), (1, text + " more", 2)]


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, "a b\nc\n\nd"), (2, "x\n\nA  b\nc\n\n\nd")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in dedup_units(df, unit="paragraph").collect()}
    assert got[1]["n_units"] == 2 and got[2]["n_units"] == 3 and got[2]["kept_text"] == "x\n\n"
