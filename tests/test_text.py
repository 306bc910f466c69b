import pytest
from plain import PATTERN
from pyspark.sql import functions as F

from tokenlake.functions import chars
from tokenlake.functions.text import END_OF_TEXT
from tokenlake.operators import pretoken

EDGE_TEXTS = [
    ("I'll don't  x", ["I", "'ll", " don", "'t", " ", " x"]),
    ("it'S we've", ["it", "'", "S", " we", "'ve"]),
    ("a   b", ["a", "  ", " b"]),
    ("a\r\n\r\nb", ["a", "\r\n\r", "\n", "b"]),
    ("a\u00a0\u00a0b", ["a", "\u00a0", "\u00a0", "b"]),
    ("x\u2028y \u0085z", ["x", "\u2028", "y", " ", "\u0085", "z"]),
    ("q\x1c\x1dr", ["q", "\x1c\x1d", "r"]),
    ("  ", ["  "]),
    ("é x\u00b2\u00bd \u0663", ["é", " x", "\u00b2\u00bd", " \u0663"]),
    ("emoji \U0001f600\u0301!", ["emoji", " \U0001f600\u0301!"]),
    ("", []),
]


def test_pretokens_of_edge_texts(spark):
    rows = [(i, t) for i, (t, _) in enumerate(EDGE_TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {i: [] for i, _ in rows}
    for r in pretoken.pretokenize(df).orderBy("doc_id", "pos").collect():
        found[r["doc_id"]].append(r["pretoken"])
    for i, (text, wanted) in enumerate(EDGE_TEXTS):
        assert found[i] == wanted == PATTERN.findall(text)


def test_pretokens_spell_the_text_and_match_the_plain_form(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    pages = spark.read.parquet(f"{data}/pages.parquet").selectExpr("page_id + 1000000 as doc_id", "html as text")
    both = docs.union(pages)
    texts = {r["doc_id"]: r["text"] for r in both.collect()}
    pieces = {i: [] for i in texts}
    for r in pretoken.pretokenize(both).orderBy("doc_id", "pos").collect():
        pieces[r["doc_id"]].append(r["pretoken"])
    for i, text in texts.items():
        assert "".join(pieces[i]) == text
        assert pieces[i] == PATTERN.findall(text)


def test_specials_longest_wins_and_order_of_removal(spark):
    rows = [(1, "x<a><b>y"), (2, "<a><a>"), (3, ""), (4, "plain"), (5, f"{END_OF_TEXT} hi")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    specials = ["<a>", "<a><b>", END_OF_TEXT]
    parts = {}
    for r in pretoken.split_specials(df, specials).orderBy("doc_id", "part").collect():
        parts.setdefault(r["doc_id"], []).append((r["is_special"], r["text"]))
    assert parts == {
        1: [(False, "x"), (True, "<a><b>"), (False, "y")],
        2: [(True, "<a>"), (True, "<a>")],
        4: [(False, "plain")],
        5: [(True, END_OF_TEXT), (False, " hi")],
    }
    stripped = {r["doc_id"]: r["text"] for r in pretoken.strip_specials(df, specials).collect()}
    assert stripped == {1: "x<b>y", 2: "", 3: "", 4: "plain", 5: " hi"}


def test_byte_ids(spark):
    rows = [(1, "aé€\U0001f600"), (2, ""), (3, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in pretoken.utf8_byte_ids(df).collect()}
    assert got == {i: list(t.encode()) for i, t in rows}


@pytest.mark.parametrize("token_id", [0, 255, 256, 0xD7FF, 0xD800, 0xDFFF, 0xF7FF, 0xF800, 70000, chars.MAX_TOKEN_ID])
def test_symbols_of_all_ranges(spark, token_id):
    word = "a" + chars.symbol(token_id) + "b"
    assert chars.id_of(chars.symbol(token_id)) == token_id
    row = spark.createDataFrame([(word,)], "w string").select(chars.ids(F.col("w")).alias("ids")).first()
    assert row["ids"] == [97, token_id, 98]


def test_symbol_order_is_id_order():
    ids = [0, 300, 0xD7FF, 0xD800, 0xF800, 70000, chars.MAX_TOKEN_ID]
    spelled = [chars.symbol(i).encode() for i in ids]
    assert spelled == sorted(spelled)


def test_word_counts_sum_to_the_number_of_pretokens(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    total = pretoken.pretoken_freq(docs).agg(F.sum("freq")).first()[0]
    assert total == pretoken.pretokenize(docs).count()
