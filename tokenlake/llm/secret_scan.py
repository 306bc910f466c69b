"""Secret scan: keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton over a few dozen keywords finds the places where a secret
may begin; an expression is tried only there. Candidates whose format embeds a checksum or
a self-describing header are kept only if it holds. Runs of hexadecimal digits have no keyword
and are found by one scan. Works row by row, without a shuffle.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.llm.common import per_text, table, without

# Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "card", "iban", "private_key")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(payload: bytes) -> bytes:
    """Six base-62 digits of the CRC-32 of a token's random part."""
    value, digits = zlib.crc32(payload), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits.encode()


def crc_token(token: bytes) -> bool:
    """prefix_ + random part + CRC-32 of the random part in base 62."""
    body = token.partition(b"_")[2]
    return crc_base62(body[:-6]) == body[-6:]


def luhn(text: bytes) -> bool:
    digits = [c - 48 for c in text if 48 <= c <= 57]
    doubled = [d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(reversed(digits))]
    return 13 <= len(digits) <= 19 and len(set(digits)) > 1 and sum(doubled) % 10 == 0


# Published lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
_IBAN_START = re.compile(rb"(?i:iban)[:=]?\x20*")


def iban_end(text: bytes) -> int:
    """The end of the account number in a match, 0 if none holds its checksum.

    Words after the number may be part of the match, so the number ends where its country says; without a known country the
    longest end that holds is taken. A number goes on to no letter or digit.
    """
    start = _IBAN_START.match(text).end()
    ends = [at + 1 for at in range(start, len(text)) if text[at] != 0x20]
    code = text[start:].replace(b" ", b"").decode()
    known = IBAN_LENGTHS.get(code[:2])
    for n in [known] if known else range(min(34, len(code)), 14, -1):
        if n <= len(code) and (n == len(code) or ends[n] > ends[n - 1] + 1):
            if int("".join(str(int(c, 36)) for c in code[4:n] + code[:4])) % 97 == 1:
                return ends[n - 1]
    return 0


def jwt(token: bytes) -> bool:
    """The header must decode to an object that names an algorithm."""
    head = token.split(b".")[0]
    try:
        header = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


def _whole(check: Callable[[bytes], bool]) -> Callable[[bytes], int]:
    """The end of a match that holds its check, else 0."""
    return lambda text: len(text) if check(text) else 0


# Kind, keywords that start a match (lower case), the expression that must match there, the end that its check leaves.
RULES: tuple[tuple[str, tuple[str, ...], bytes, Callable], ...] = (
    (
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        len,
    ),
    ("access", ("akia",), rb"AKIA[A-Z0-9]+", len),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", _whole(crc_token)),
    ("npm", ("npm_",), rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", _whole(crc_token)),
    ("jwt", ("eyj",), rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", _whole(jwt)),
    ("card", ("card",), rb"(?i:card)(?:\x20?(?i:number|no\.?))?[:=#]?\x20*[0-9](?:[ -]?[0-9]){12,18}(?![0-9])", _whole(luhn)),
    ("iban", ("iban",), rb"(?i:iban)[:=]?\x20*[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", iban_end),
    (
        "private_key",
        ("-----begin",),
        rb"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----",
        len,
    ),
)
# Kinds whose match begins with a run of these bytes. Where it fails, it fails at every start in the run.
_RUNS = {"jwt": re.compile(rb"[A-Za-z0-9_-]+")}


@cache
def _scanner():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for at, (_, keywords, _, _) in enumerate(RULES):
        for word in keywords:
            automaton.add_word(word, (at, len(word)))
    automaton.make_automaton()
    compiled = [(kind, re.compile(pattern), check) for kind, _, pattern, check in RULES]
    return automaton, compiled, re.compile(rb"[0-9a-f]{%d,}" % MIN_HEX)


def _char_positions(data: bytes, offsets: list[int]) -> dict[int, int]:
    """Code points before each byte offset."""
    found, at, count = {}, 0, 0
    for offset in sorted(set(offsets)):
        count += len(data[at:offset].decode("utf-8", "replace"))
        found[offset], at = count, offset
    return found


def scan(data: bytes | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind."""
    if not data:
        return []
    automaton, rules, hexes = _scanner()
    spans = [("hex", m.start(), m.end()) for m in hexes.finditer(data)]
    done = [0] * len(rules)
    # Latin-1 gives one character per byte; only ASCII letters may change case.
    for last, (rule, length) in automaton.iter(data.lower().decode("latin-1")):
        start = last - length + 1
        if start < done[rule]:
            continue
        kind, pattern, check = rules[rule]
        match = pattern.match(data, start)
        if match is None:
            if kind in _RUNS:
                done[rule] = _RUNS[kind].match(data, start).end() if data[start : start + 3] == b"eyJ" else start
            continue
        if kind == "assign" and len(match[1]) < MIN_VALUE or kind == "access" and len(match[0]) < MIN_ACCESS:
            done[rule] = match.end()
            continue
        end = start + check(match[0])
        # A match may hold words behind the number, the keyword of the next one among them.
        done[rule] = end if kind == "iban" else match.end()
        if end > start:
            spans.append((kind, start, end))
    if not spans:
        return spans
    if not data.isascii():
        place = _char_positions(data, [x for s in spans for x in s[1:]])
        spans = [(kind, place[a], place[b]) for kind, a, b in spans]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with an array of (kind, start, end) per text.

    Positions are code points, ends exclusive. NULL and empty texts have an empty array.
    Every input row gives one row, repeated rows too, an empty table none; a column named ``out`` is replaced, others keep
    their values. Texts of any length are scanned whole, in time that grows with their length. A candidate that fails its
    check for any reason is no secret.
    """
    udf = per_text(docs.sparkSession, T.ArrayType(SPAN), lambda: scan, as_bytes=True)
    return without(docs, [out] if out != text_col else []).withColumn(out, udf(F.col(text_col)))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans become one mark.

    Texts without a secret, NULLs among them, stay as they are. Columns keep their names and order.
    """

    def make():
        def clean(text: str | None) -> str | None:
            parts, at = [], 0
            for _, start, end in sorted(scan(text.encode()), key=lambda s: s[1]) if text else []:
                if start >= at:
                    parts += [text[at:start], mark]
                at = max(at, end)
            return text if not parts else "".join([*parts, text[at:]])

        return clean

    udf = per_text(docs.sparkSession, T.StringType(), make)
    return docs.withColumn(text_col, udf(F.col(text_col)))


def op5_secret_scan(spark, sf_dir):
    """Per document: counts of the base kinds, a digest of their spans, all spans."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.col("secrets.kind")

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )
