"""Byte-pair encoding with word ends by forced boundaries, and its inverse.

A *unit* is a byte, or a byte that ends a word.  Every merge joins the last unit of one token to the first unit of another;
a pair of units at no merge's joint occurs inside no token of the vocabulary, so wherever a text holds such a pair every
encoding has a boundary.  The units of many words are laid out in one array, one table lookup marks all these certain cuts
(word ends among them), and the fragments between them are encoded independently, lowest rank first and leftmost of equals;
their ids are concatenated.  Fragments and words recur, so each is encoded once per task while a bounded table holds it.

Normalisation and word splitting are those of the tokenizer's file.  They never reach over ``[\\x20\\x09-\\x0D]``, so texts
are cut there first.  The file's special strings are single tokens wherever they occur in a text.

The vocabulary (a few MB, whatever the input) is read once by the driver and broadcast.  Texts are independent rows of one
scan: no shuffle.  Memory in a task: the word table (``TABLE_WORDS`` words of up to ``TABLE_BYTES`` bytes), one Arrow
batch, and about 60 bytes per byte of the longest fragment.

Defined cases: null and empty texts, and texts of white space alone, have no ids and decode to an empty text; bytes that are
no UTF-8 count as U+FFFD; repeated rows give equal results; an empty table gives an empty result; other columns of the
input are left out, or kept by name with ``keep``."""

from __future__ import annotations

import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

WORD_END = "</w>"
TABLE_WORDS = 200_000
TABLE_BYTES = 48
BATCH_BYTES = 1 << 20   # texts are taken together up to this size; one longer text is taken by itself
LONG = 64               # units from which a fragment is merged by a heap of its own
NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merges, unit ids and the table of joints."""

    def __init__(self, spec: dict):
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or model.get("end_of_word_suffix") != WORD_END or odd or spec.get("post_processor") or spec.get("decoder"):
            raise ValueError(f"not a plain byte-pair vocabulary with word ends {odd}")
        self.ids: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.unit_ids = [self.ids[c] for c in letters] + [self.ids[c + WORD_END] for c in letters]
        first, last = [-1] * (max(self.ids.values()) + 1), [-1] * (max(self.ids.values()) + 1)
        for u, i in enumerate(self.unit_ids):
            first[i] = last[i] = u
        self.joint = np.zeros((512, 512), dtype=bool)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if not isinstance(pair, str) else pair.split(" ")
            i, j, new = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges.setdefault((i, j), (rank, new))
            first[new], last[new] = first[i], last[j]
            self.joint[last[i], first[j]] = True
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that depend on their neighbourhood")
        self.special = added
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in added.items()}
        made = {new: rank for rank, new in self.merges.values()}
        #: Every token has one rule, made before any rule that uses it: equal pairs of a fragment can then merge at once.
        self.ordered = len(made) == len(self.merges) and all(rank > made.get(i, -1) and rank > made.get(j, -1) for (i, j), (rank, _) in self.merges.items())
        self.units = np.array(self.unit_ids, dtype=np.int64)
        self._hashed()

    def _hashed(self) -> None:
        """Ranks and new ids by pair, in arrays with open addressing."""
        self.wide = np.int64(len(self.tokens) + 1)
        keys = np.array([i * int(self.wide) + j for i, j in self.merges], dtype=np.int64)
        bits = max(int(len(keys) * 4).bit_length(), 4)
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.ranks, self.made = np.full(size + 64, -1, dtype=np.int64), np.full(size + 64, NONE), np.zeros(size + 64, dtype=np.int64)
        for k, at, (rank, new) in zip(keys.tolist(), self._slot(keys).tolist(), self.merges.values(), strict=True):
            while self.keys[at] != -1:
                at += 1
            self.keys[at], self.ranks[at], self.made[at] = k, rank, new

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rules(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of the rule of every pair; a pair without rule gets a slot of rank NONE."""
        key = left * self.wide + right
        at = self._slot(key)
        held = self.keys[at]
        todo = np.flatnonzero((held != key) & (held != -1))
        while len(todo):
            at[todo] += 1
            held = self.keys[at[todo]]
            todo = todo[(held != key[todo]) & (held != -1)]
        return at

    def merged_all(self, units: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments in order, and the fragment of each."""
        ids = self.units[units]
        sizes = np.diff(np.append(starts, len(ids)))
        of = np.repeat(np.arange(len(starts)), sizes)
        done_ids, done_of = [], []
        long = sizes >= LONG if self.ordered else np.ones(len(sizes), dtype=bool)
        for f in np.flatnonzero(long).tolist():
            out = self.merged(units[starts[f] : starts[f] + sizes[f]].tolist())
            done_ids.append(np.array(out, dtype=np.int64))
            done_of.append(np.full(len(out), f))
        if long.any():
            rest = ~long[of]
            ids, of = ids[rest], of[rest]
        while len(ids):
            head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            at = self.rules(ids[:-1], ids[1:])
            rank = np.append(np.where(of[1:] == of[:-1], self.ranks[at], NONE), NONE)
            least = np.repeat(np.minimum.reduceat(rank, head), np.diff(np.append(head, len(ids))))
            ended = least == NONE
            if ended.any():
                done_ids.append(ids[ended])
                done_of.append(of[ended])
            first = np.flatnonzero((rank == least) & ~ended)
            if not len(first):
                break
            run = np.append(True, np.diff(first) != 1)   # overlapping equal pairs: every other one from the left
            nth = np.arange(len(first)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            first = first[nth % 2 == 0]
            ids[first] = self.made[at[first]]
            ended[first + 1] = True
            ids, of = ids[~ended], of[~ended]
        if not done_ids:
            return ids, of
        ids, of = np.concatenate(done_ids), np.concatenate(done_of)
        order = np.argsort(of, kind="stable")
        return ids[order], of[order]

    def merged(self, units: list[int]) -> list[int]:
        """Ids of one fragment."""
        ids = [self.unit_ids[u] for u in units]
        if len(ids) == 1:
            return ids
        merges = self.merges
        n = len(ids)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        heap = [(m[0] << 40) | i for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 40, top & ((1 << 40) - 1)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            m = merges.get((ids[i], ids[j]))
            if not m or m[0] != rank:
                continue
            ids[i], ids[j] = m[1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((ids[i], ids[k])):
                    heapq.heappush(heap, (m[0] << 40) | i)
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], ids[i]))):
                heapq.heappush(heap, (m[0] << 40) | h)
        return [i for i in ids if i >= 0]

    def fragments(self, units: np.ndarray) -> np.ndarray:
        """Where fragments begin: 0 and every unit that no joint binds to the one before it."""
        if not len(units):
            return np.zeros(0, dtype=np.int64)
        return np.concatenate(([0], np.flatnonzero(~self.joint[units[:-1], units[1:]]) + 1))


class Encoder:
    """Encodes words; remembers short ones."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        self.vocabulary = Vocabulary(spec)
        rules = Tokenizer.from_str(text)
        self.normalise, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.special = self.vocabulary.special
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.byte_of = {ord(c): b for b, c in enumerate(byte_letters())}
        self.odd = re.compile("|".join([r"[^\S ]", *map(re.escape, self.special)]))   # white space beyond ASCII, special strings
        self.words: dict[bytes, bytes] = {}

    def _pieces(self, words: list[str]) -> tuple[str, list[int], np.ndarray] | None:
        """Letters, sizes and words of the pieces of plain words, all normalised and split at once."""
        text = self.normalise(" ".join(words))
        starts = np.cumsum([0, *(len(w) + 1 for w in text.split(" "))])[:-1]
        if len(starts) != len(words):
            return None
        found = self.split(text)
        return "".join([p for p, _ in found]), [len(p) for p, _ in found], np.searchsorted(starts, [at for _, (at, _) in found], side="right") - 1

    def _odd_pieces(self, word: str):
        """Letters of every piece of any word, or the id of a special string."""
        for part in self.special_cut.split(word) if self.special_cut else [word]:
            if part in self.special:
                yield self.special[part]
            elif part:
                yield from (letters for letters, _ in self.split(self.normalise(part)))

    def new_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian ids of words, all of whose units are cut by one lookup."""
        texts = [w.decode("utf-8", "replace") for w in words]
        odd = [i for i, t in enumerate(texts) if self.odd.search(t)] if self.odd.search(" ".join(texts)) else []
        strange = set(odd)
        plain = [i for i in range(len(texts)) if i not in strange]
        got = self._pieces([texts[i] for i in plain]) if plain else ("", [], np.zeros(0, dtype=np.int64))
        if got is None:   # a normaliser that makes or removes blanks
            odd, plain, got = list(range(len(texts))), [], ("", [], np.zeros(0, dtype=np.int64))
        letters, sizes, word = [got[0]], got[1], [np.array(plain, dtype=np.int64)[got[2]]]
        marks: dict[int, list] = {}
        for i in odd:
            for piece in self._odd_pieces(texts[i]):
                if isinstance(piece, int):
                    marks.setdefault(i, []).append((len(sizes), piece))
                else:
                    letters.append(piece)
                    sizes.append(len(piece))
                    word.append(np.array([i]))
        units = np.frombuffer("".join(letters).translate(self.byte_of).encode("latin-1"), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum(sizes, dtype=np.int64)
        units[ends - 1] += 256
        starts = self.vocabulary.fragments(units)   # a unit that ends a word is first in no joint: pieces are cut too
        ids, of = self.vocabulary.merged_all(units, starts)
        piece = np.searchsorted(ends, starts, side="right")[of] if len(of) else of
        owner = np.concatenate(word)[piece] if len(of) else piece
        if len(owner) and (np.diff(owner) < 0).any():   # odd words come after the plain ones
            order = np.argsort(owner, kind="stable")
            ids, owner, piece = ids[order], owner[order], piece[order]
        raw = ids.astype("<u4").tobytes()
        cut = (np.searchsorted(owner, np.arange(len(words) + 1)) * 4).tolist()
        out = [raw[a:b] for a, b in zip(cut, cut[1:])]
        for i, special in marks.items():   # special strings go between the pieces they stood between
            at = piece[cut[i] // 4 : cut[i + 1] // 4]
            parts, last = [], 0
            for place, token in special:
                k = int(np.searchsorted(at, place))
                parts += [out[i][4 * last : 4 * k], token.to_bytes(4, "little")]
                last = k
            out[i] = b"".join([*parts, out[i][4 * last :]])
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        return [ids for a, b in runs([len(t) for t in texts]) for ids in self._encode(texts[a:b])]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]   # of bytes: at exactly [\x20\x09-\x0D]
        known = self.words
        if len(known) > TABLE_WORDS:
            known.clear()
        new = list({w for words in split for w in words if w not in known})
        known.update(zip(new, self.new_words(new), strict=True))
        out = [b"".join([known[w] for w in words]) for words in split]
        for w in new:
            if len(w) > TABLE_BYTES:
                del known[w]
        return out


def runs(sizes: list[int]):
    """Bounds of runs of rows of up to BATCH_BYTES together."""
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > BATCH_BYTES:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(batch: pa.RecordBatch, column: int):
    """A batch in runs of rows whose values in ``column`` are small together."""
    sizes = batch.column(column).cast(pa.binary()).fill_null(b"")
    for a, b in runs(pc.binary_length(sizes).to_pylist()):
        yield batch.slice(a, b - a)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _kept(df: DataFrame, keep: list[str]) -> list[S.StructField]:
    return [df.schema[c] for c in keep]


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers, as token shards hold them)."""
    text = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))   # the file alone: its size doesn't grow with the input
    keep = list(keep)

    def run(batches):
        coder = Encoder(text.value)
        for b in (s for batch in batches for s in slices(batch, len(keep))):
            ids = coder._encode([t or b"" for t in b.column(len(keep)).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array([len(i) // 4 for i in ids], type=pa.int64()), pa.array(ids, type=pa.binary())], names=[*keep, "n_tokens", "ids"])

    schema = S.StructType([*_kept(docs, keep), S.StructField("n_tokens", S.LongType()), S.StructField("ids", S.BinaryType())])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for: the tokens, one space between them, as a file without decoder has it."""
    text = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    at = encoded.columns.index(ids_col)

    def run(batches):
        spec = json.loads(text.value)
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        table = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        del spec, tokens
        for b in (s for batch in batches for s in slices(batch, at)):
            rows = [b" ".join([table[i] for i in np.frombuffer(x, dtype="<u4").tolist()]) if x else b"" for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, type=pa.binary()).cast(pa.string())], names=[*b.schema.names, out])

    return encoded.mapInArrow(run, S.StructType([*encoded.schema.fields, S.StructField(out, S.StringType())]))
