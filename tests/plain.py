"""Small single-process forms of the definitions, written for the tests."""

from collections import Counter

import regex

PATTERN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def words_of(texts, specials=()):
    counts = Counter()
    for text in texts:
        for special in specials:
            text = text.replace(special, "")
        counts.update(tuple(p.encode()) for p in PATTERN.findall(text))
    return counts


def recount(words):
    pairs = Counter()
    for word, n in words.items():
        for pair in zip(word, word[1:]):
            pairs[pair] += n
    return pairs


def merged(word, pair, new_id):
    out, i = [], 0
    while i < len(word):
        if word[i : i + 2] == pair:
            out.append(new_id)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return tuple(out)


def learn(words, n_merges, first_id):
    """(a, b, count) per merge, recounting everything each time."""
    out = []
    for i in range(n_merges):
        pairs = recount(words)
        if not pairs:
            break
        pair = max(pairs, key=lambda p: (pairs[p], p))
        out.append((*pair, pairs[pair]))
        renamed = Counter()
        for word, n in words.items():
            renamed[merged(word, pair, first_id + i)] += n
        words = renamed
    return out


def encode_word(word, rules):
    """One merge at a time: lowest rank, leftmost."""
    ranks = {(a, b): (i, c) for i, (a, b, c) in enumerate(rules)}
    ids = list(word)
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        if not found:
            return ids
        _, i = min(found)
        ids[i : i + 2] = [ranks[tuple(ids[i : i + 2])][1]]


def encode_text(text, rules, specials):
    parts = [text]
    if specials:
        alternation = "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))
        parts = regex.split(f"({alternation})", text)
    ids = []
    for part in parts:
        if part in specials:
            ids.append(specials[part])
        else:
            for p in PATTERN.findall(part):
                ids += encode_word(tuple(p.encode()), rules)
    return ids
