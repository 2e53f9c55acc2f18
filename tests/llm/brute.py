"""Plain versions of the operators, one row at a time, for comparison on small tables."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, ids, bits=4):
    """Smallest id linked to each row."""
    codes = np.array(fingerprints, dtype=np.uint64)
    least = list(range(len(ids)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= bits):
            a, b = find(i), find(int(j))
            least[max(a, b)] = min(a, b)
    group = {}
    for i, row in enumerate(ids):
        root = find(i)
        group[root] = min(group.get(root, row), row)
    return [group[find(i)] for i in range(len(ids))]


def near_copies(rows, words=5, least=0.8):
    """{id: smallest id of its group} by exact Jaccard similarity of the shingle sets of all pairs."""
    sets = {}
    for i, text in rows:
        own = WORD.findall(lower(text))
        sets[i] = frozenset(" ".join(own[j : j + words]) for j in range(max(1, len(own) - words + 1))) if own else frozenset()
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (a == b or len(a & b) >= least * len(a | b) > 0):
                one, two = find(i), find(j)
                group[max(one, two)] = min(one, two)
    return {i: find(i) for i in sets}


def secrets(text):
    """Spans of the base kinds."""
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    rank = {"assign": 0, "access": 1, "hex": 2}
    return sorted(found, key=lambda s: (s[1], rank[s[0]]))


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def licenses(text):
    """Number of words, and (begin, label) of every base place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(places)


def notices(texts, table, top=8, votes=2):
    """(labels, score) of every text: all begins of all notices are counted one by one."""
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) for t in texts]
    known = {w for _, text, _ in table for w in text.split()}
    weight = {w: np.log((1 + len(split)) / (1 + sum(w in own for own in map(set, split)))) for w in known}
    out = []
    for words in split:
        looked = set()
        for _, text, phrases in table:
            stand = [p for p in phrases if set(p.split()) <= set(words)]
            if stand:
                for part in [*stand, " ".join(w for w in text.split() if w in words)]:
                    looked |= set(sorted(set(part.split()), key=lambda w: (-weight[w], w))[:top])
        labels, score = set(), 0.0
        for label, text, phrases in table:
            own = text.split()
            most = sum(weight[w] for w in set(own) & looked)
            for begin in range(-len(own), len(words)):
                hit = [w for i, w in enumerate(own) if 0 <= begin + i < len(words) and words[begin + i] == w and w in looked]
                keys = [(begin + text[: text.index(p)].count(" "), p.split()) for p in phrases]
                if len(hit) >= votes and any(k >= 0 and words[k : k + len(p)] == p for k, p in keys):
                    labels.add(label)
                    score = max(score, sum(weight[w] for w in hit) / max(most, 1e-9))
        out.append((sorted(labels), min(1.0, score)))
    return out


def top(vectors, queries, k):
    """{query: [(vec_id, score)]} by exact products; rows are (vec_id, vector)."""
    out = {}
    for query in queries:
        own = next(v for i, v in vectors if i == query)
        scored = [(-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in vectors if i != query]
        out[query] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def quotients(shares, seats, limits):
    """Seats by taking the highest quotient one seat at a time."""
    got = [0] * len(shares)
    for _ in range(seats):
        open_ = [i for i in range(len(shares)) if got[i] < limits[i] and shares[i] > 0]
        if not open_:
            break
        i = max(open_, key=lambda i: (shares[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got
