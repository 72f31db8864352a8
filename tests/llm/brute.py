"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import xxhash

BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().lower().split()


def leaks(docs, items, k=5, threshold=0.8):
    """{(doc_id, item_id): shared}"""
    out = {}
    for item, text in items:
        w = words(text)
        if not w:
            continue
        n = min(k, len(w))
        want = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for doc, t in docs:
            d = words(t)
            shared = len(want & {tuple(d[i : i + n]) for i in range(len(d) - n + 1)})
            if shared >= threshold * len(want) - 1e-9 and shared:
                out[doc, item] = (len(want), shared)
    return out


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, sha) by text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} by resharing the excess until no source is above its bound."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] >= most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in full else share[s] for s in names}
        full |= over


def fingerprint(text, k=3):
    w = words(text)
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def near_components(docs, distance=2):
    """{doc_id: smallest id of its component}; docs: (id, text)."""
    fps = [(i, fingerprint(t)) for i, t in docs]
    root = {i: i for i, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(fps):
        for j, b in fps[:n]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in fps}


def normal(text):
    return "".join(c for c in text or "" if c not in BLANKS)


def exact(docs):
    """{doc_id: (keep_id, size, kept, sha)} for distinct ids."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[normal(t)].append((-len(t or ""), i))
    out = {}
    for key, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(key.encode()).hexdigest())
    return out


class Ppm:
    """Prediction by partial matching with dictionaries, one symbol at a time."""

    def __init__(self, order=5):
        self.order, self.count = order, defaultdict(Counter)

    @staticmethod
    def symbols(text):
        return [*(text or "").encode().lower(), 256]

    def learn(self, text):
        s = [257] * self.order + self.symbols(text)
        for i in range(self.order, len(s)):
            for k in range(self.order + 1):
                self.count[tuple(s[i - k : i])][s[i]] += 1

    def log10(self, context, symbol):
        out, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.count.get(tuple(context[len(context) - k :]))
            if not seen:
                continue
            live = {x: n for x, n in seen.items() if x not in excluded}
            if not live:
                continue
            total = sum(live.values())
            if symbol in live:
                return out + math.log10((live[symbol] - 0.5) / total)
            out += math.log10(0.5 * len(live) / total)
            excluded |= set(seen)
        return out - math.log10(257 - len(excluded))

    def score(self, text):
        s = [257] * self.order + self.symbols(text)
        return sum(self.log10(s[i - self.order : i], s[i]) for i in range(self.order, len(s)))
