"""Suffix arrays of byte strings in numpy: Larsson-Sadakane refinement, Kasai common prefixes, merging by binary search."""

from __future__ import annotations

import numpy as np

MARK = 0xFF   # ends a piece of a shard's text; never a byte of UTF-8
WORD = 8
LANE = 128


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, beyond the end MARK, as big-endian integers."""
    padded = np.concatenate((text, np.full(WORD, MARK, dtype=np.uint8)))
    out = np.zeros(len(text), dtype=np.uint64)
    for j in range(WORD):
        out = (out << np.uint64(8)) | padded[j : j + len(text)]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, to the last byte: Kasai's walk rests on it.

    Suffixes are first sorted by eight bytes.  Each round doubles the sorted length h: the order of a suffix within its
    group is that of the group of the suffix h further on, and only groups with more than one suffix are sorted again."""
    n = len(text)
    words = _words(text)
    sa = np.argsort(words)
    key = words[sa]
    start = np.ones(n, dtype=bool)
    start[1:] = key[1:] != key[:-1]
    group = np.zeros(n + 1, dtype=np.int64)   # of a suffix: the first place of its group; beyond the end: after all
    group[sa] = np.flatnonzero(start)[np.cumsum(start) - 1]
    group[n] = n
    h = WORD
    while True:
        size = np.diff(np.append(np.flatnonzero(start), n))
        places = np.flatnonzero(np.repeat(size > 1, size))
        if not len(places):
            break
        suffixes = sa[places]
        first, then = group[suffixes], group[np.minimum(suffixes + h, n)]
        order = np.argsort(first * (n + 1) + then)
        suffixes, first, then = suffixes[order], first[order], then[order]
        sa[places] = suffixes
        start[places[1:]] = (first[1:] != first[:-1]) | (then[1:] != then[:-1])
        start[places[0]] = True
        own = start[places]
        group[suffixes] = places[own][np.cumsum(own) - 1]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """By place in ``sa``: the common prefix with the suffix before, up to ``cap``.

    Kasai's walk takes suffixes in text order; one step on, at least one byte less is shared.  The text is cut into
    stretches of LANE suffixes which walk side by side, each from a fresh start, and compare eight bytes at a time."""
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    words = _words(np.concatenate((text, np.full(cap + WORD, MARK, dtype=np.uint8))))
    prefix = np.zeros(n, dtype=np.int64)
    lane = np.arange(0, n, LANE)
    shared = np.zeros(len(lane), dtype=np.int64)
    for t in range(min(LANE, n)):
        i = lane + t
        live = i < n
        i = i[live]
        j, s = before[i], np.maximum(shared[live] - 1, 0)
        s[j < 0] = 0
        go = np.flatnonzero((j >= 0) & (s < cap))
        while len(go):
            # a comparison stops at the text's end, which only one of the two can have reached
            diff = words[i[go] + s[go]] ^ words[j[go] + s[go]]
            same = diff == 0
            part = np.zeros(len(go), dtype=np.int64)
            some = diff[~same]
            high = np.zeros(len(some), dtype=np.int64)   # leading equal bytes
            for b in range(WORD - 1):
                high += (some >> np.uint64(8 * (WORD - 1 - b))) == 0
            part[~same] = high
            part[same] = WORD
            s[go] += part
            go = go[same & (s[go] < cap)]
        s = np.minimum(s, cap)
        prefix[i] = s
        shared[live] = s
    out = prefix[sa]
    out[0] = 0
    return out


def windows_at(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    return np.ascontiguousarray(view[starts]).view(f"S{length}").ravel()


def also_in(text: np.ndarray, starts: np.ndarray, other: np.ndarray, ordered: np.ndarray, length: int, step: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of the ``length`` bytes at every start among those at ``ordered``, sorted starts of another shard.
    Whether each was found, and the flags of the ordered ones that were."""
    found, hit = np.zeros(len(starts), dtype=bool), np.zeros(len(ordered), dtype=bool)
    if not len(ordered):
        return found, hit
    for a in range(0, len(starts), step):
        own = windows_at(text, starts[a : a + step], length)
        low, high = np.zeros(len(own), dtype=np.int64), np.full(len(own), len(ordered), dtype=np.int64)
        while (low < high).any():
            mid = np.minimum((low + high) // 2, len(ordered) - 1)
            less = windows_at(other, ordered[mid], length) < own
            open_ = low < high
            low = np.where(open_ & less, mid + 1, low)
            high = np.where(open_ & ~less, mid, high)
        at = np.minimum(low, len(ordered) - 1)
        same = (low < len(ordered)) & (windows_at(other, ordered[at], length) == own)
        found[a : a + step] = same
        hit[at[same]] = True
        # equal windows of the other shard lie side by side; its own common prefixes have flagged all but a lone one
    return found, hit
