"""The secret scan against plain searches for the base kinds, and a good and a bad example of every added kind."""

import base64
import json
import random
import re
import time
from collections import Counter

import pytest

from tokenlake.llm.secret_scan import crc_base62, find_secrets, redact, scan

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    """Base spans as plain searches give them."""
    text, out = text or "", []
    out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def generated(n):
    rng = random.Random(3)
    pieces = ["password", "Passwd", "SECRET", "token", "apikey", "api_key", "API_KEY", ":", "=", " = ", " : ", '"', "'", "é", "文", "\n", " ",
              "AKIA", "akia", "0123456789abcdef", "deadbeef", "ABCDEFGH01234567", "x1/+_.=-", "abc", "iban", "eyJ", "card", "ſecret", "toKen"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_base_spans_as_by_plain_searches(spark):
    texts = generated(3000) + [None, "", " ", "password=" + "x" * 300_000, "ab" * 100_000]
    rows = [(i, t, "kept", "s") for i, t in enumerate(texts)] + [(0, texts[0], "kept", "s")] * 2
    found = find_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string")).collect()
    assert len(found) == len(rows) and {(r["spans"], r["kind"]) for r in found} == {("kept", "s")}
    hits = 0
    for row in found:
        base = [(s["kind"], s["start"], s["end"]) for s in row["secrets"] if s["kind"] in ("assign", "access", "hex")]
        assert base == plain(row["text"]), row["text"]
        hits += len(base)
    assert hits > 500


def b64(value):
    return base64.urlsafe_b64encode(value if isinstance(value, bytes) else json.dumps(value).encode()).rstrip(b"=").decode()


BODY = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
GOOD = {
    "github": "ghp_" + BODY + crc_base62(BODY.encode()).decode(),
    "npm": "npm_" + BODY + crc_base62(BODY.encode()).decode(),
    "jwt": f"{b64({'alg': 'HS256'})}.{b64({'sub': 1})}.c2lnbmF0dXJl",
    "card": "Card number: 4111 1111 1111 1111",
    "iban": "IBAN: DE89 3704 0044 0532 0130 00",
    "private_key": "-----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY-----",
}
BAD = {
    "github": "ghp_" + BODY + "000000",
    "npm": "npm_" + BODY + "000000",
    "jwt": f"{b64({'typ': 'none'})}.{b64({'sub': 1})}.c2lnbmF0dXJl",
    "card": "card 4111 1111 1111 1112",
    "iban": "IBAN DE88 3704 0044 0532 0130 00",
    "private_key": "-----BEGIN RSA PRIVATE KEY-----\nMI_IB\n-----END RSA PRIVATE KEY-----",
}


@pytest.mark.parametrize("kind", GOOD)
def test_added_kinds_with_and_without_their_checksum(kind):
    text = f"é see {GOOD[kind]}, ok"
    assert (kind, 6, 6 + len(GOOD[kind])) in scan(text.encode())
    assert kind not in {s[0] for s in scan(f"é see {BAD[kind]}, ok".encode())}


def kinds(text):
    return [s[0] for s in scan(text.encode())]


def test_account_numbers_end_where_their_country_says():
    number = "IBAN: DE89 3704 0044 0532 0130 00"
    assert scan((number + " BIC COBADEFF").encode()) == [("iban", 0, len(number))]
    assert kinds(number + " " + number + " IBAN GB82WEST12345698765432") == ["iban"] * 3
    assert kinds("iban=DE89370400440532013000") == ["iban"] and kinds("IBAN DE89370400440532013000X") == []
    assert kinds("iban=DE") == [] and kinds("iban=" + "A" * 40) == [] and kinds("IBAN DE89") == []


def test_odd_headers_are_no_secret():
    for header in ([1], "alg", 7, None, b"\xff\xfe", b"[" * 100_000):
        assert "jwt" not in kinds(f"{b64(header)}.aaa.bbb")


def test_long_texts_take_time_in_proportion():
    started = time.perf_counter()
    for text in ("eyJ" * 350_000, "eyJ." * 250_000, "iban " * 200_000, "card " * 200_000, "akia" * 250_000, "-----begin " * 100_000, "IBAN DE" * 150_000):
        scan(text.encode())
    assert time.perf_counter() - started < 20
    started = time.perf_counter()
    scan(b"eyJ" * 350_000)
    assert time.perf_counter() - started < 4


def test_redaction_through_spark(spark):
    number = "IBAN: DE89 3704 0044 0532 0130 00"
    rows = [(1, "iban=DE89370400440532013000"), (2, number + " BIC X"), (3, None), (4, ""), (5, "clean é"), (5, "clean é"), (6, "password=abcdef token=ghijkl")]
    df = spark.createDataFrame([(*r, "m") for r in rows], "doc_id long, text string, secrets string")
    got = Counter((r["doc_id"], r["text"], r["secrets"]) for r in redact(df).collect())
    want = [(1, "[SECRET]"), (2, "[SECRET] BIC X"), (3, None), (4, ""), (5, "clean é"), (5, "clean é"), (6, "[SECRET] [SECRET]")]
    assert got == Counter((*r, "m") for r in want)
    assert redact(df.limit(0)).count() == 0 and find_secrets(df.limit(0)).count() == 0
