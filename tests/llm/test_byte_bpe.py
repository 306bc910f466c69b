"""Encoding of whole texts by a rank file: the ids of merging by rank, and their bytes back."""

import base64

import pytest

from tokenlake.llm import byte_bpe


def ranks(tmp_path):
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"abc", b"bc", b" a", b"aa"]
    (tmp_path / "r").write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)))
    return byte_bpe.load_ranks(str(tmp_path / "r"), r" ?\p{L}+|\s+|[^\s\p{L}]+")


def test_words_are_encoded_when_first_met_and_long_ones_are_not_kept(tmp_path):
    import regex

    found = ranks(tmp_path)

    class Shared:
        value = ("test", byte_bpe.PrefixEncoder(found.tokens), found.pattern)

    encode, decode = byte_bpe._text_encoder(Shared), byte_bpe._ids_decoder(Shared)
    long = "abc" * byte_bpe.REMEMBERED_CHARS
    for text in ("abcabc aab ab", f"{long} x {long}", "né \U0001f600  1", "", None):
        want = []
        for word in regex.findall(found.pattern, text or ""):
            parts = byte_bpe.merge_parts(word.encode(), found.tokens, len(found.tokens))
            want += [found.tokens[p] for p in parts]
        assert encode(text) == byte_bpe.pack(want)
        assert decode(encode(text)) == (text or "").encode()
    words = byte_bpe._WORKER["test"]
    assert isinstance(words, byte_bpe._Words) and "abcabc" in words and long not in words and words.long == []
    with pytest.raises((IndexError, TypeError)):
        decode(byte_bpe.pack([len(found.tokens)]))
