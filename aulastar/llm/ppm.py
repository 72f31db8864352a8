"""Language-model scoring by prediction by partial matching over bytes.

Texts are read as UTF-8 bytes with A-Z in lower case, ended by an end symbol and preceded by ``ORDER`` start symbols.  The
model is the trie of all byte contexts up to ``ORDER`` in the training texts.  A symbol's probability is taken at the
longest context that was seen; with T occurrences there, U distinct symbols and n of this one it is (n - 1/2) / T, and if
it was never seen there, U / 2T is spent on an escape to the next shorter context, where the symbols of the longer one
are excluded from T and U.  Below the empty context the remaining symbols are equally likely.  The model is pretrained:
counts come from every training text, and the symbols of all texts are then charged their code length.

Contexts nest - what follows a context also follows its suffixes - so the symbols excluded at a node are those of the one
child on the way, and a symbol's probability depends on its last ``ORDER`` bytes alone.  A text's score is a sum over its
(context, symbol) strings, *grams*, packed 9 bits a symbol into one integer.

How it is distributed: texts go to blocks of about ``BLOCK_BYTES``.  A block sends each owner - a bucket of the trie, by the
last two bytes of the context, so a node and its descendants are together - its distinct grams with their training
counts, and each owner of words its distinct words.  A byte pair that precedes more than 1/``HOT_PAIRS`` of all symbols would
make a bucket that outgrows the others; there are fewer than ``HOT_PAIRS`` of them whatever the data, so their counts of order 2
are counted beforehand and broadcast, and their buckets go by the last three bytes.  Owners add up the counts of all blocks, compute every gram's log
probability on their part of the trie, and answer each block with just the values it asked for.  What moves is the
distinct grams per block; the trie is never whole in one place.  The nodes of orders 0 and 1, at most 257 x 258 counts
by the alphabet, are counted beforehand and broadcast.

Rows are dealt to blocks by a hash of their content and their place in ``docs``, so that no set of equal rows shares a block;
``docs`` has to be a stored table or a projection of one, whose places stay when a lost task is repeated.

The base score is a unigram model over words with additive smoothing, from the same exchange.

Defined cases: a null text is empty, has one token and is charged its end symbol; a null id counts as the empty string
for the split and is kept; repeated rows are counted as often as they are there; without training texts every symbol costs
log10(257); an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm import textops as T
from aulastar.llm.store import stored

ORDER = 5
END, START, SYMBOLS = 256, 257, 257
WIDTH = 9
BLOCK_BYTES = 16 << 20
END_WORD = np.int64(0)
ALPHA = 0.1
HOT_PAIRS = 1000
GRAMS, WORDS = 0, 1


def grams(data: np.ndarray, off: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Gram and row of every symbol, the end symbol included.  ``data`` in lower case."""
    n = len(off) - 1
    sizes = np.diff(off)
    per = sizes + 1 + order
    base = np.cumsum(per) - per
    flat = np.full(int(per.sum()), START, dtype=np.int64)
    row = np.repeat(np.arange(n), sizes)
    flat[np.arange(len(data)) + (base + order - off[:-1])[row]] = data
    flat[base + order + sizes] = END
    g = np.zeros(len(flat) - order, dtype=np.int64)
    for j in range(order + 1):
        g |= flat[j : len(flat) - order + j] << (WIDTH * (order - j))
    keep = np.ones(len(g), dtype=bool)      # windows that run from one text into the next
    for j in range(order):
        keep[base[1:] - order + j] = False
    return g[keep], np.repeat(np.arange(n), sizes + 1)


def order1(g: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Counts by (previous symbol, symbol)."""
    pair = ((g >> WIDTH) & 511) * SYMBOLS + (g & 511)
    return np.bincount(pair, weight, minlength=(START + 1) * SYMBOLS).reshape(START + 1, SYMBOLS)


class HotPairs:
    """The byte pairs that precede very many symbols, and the counts of the symbols after each."""

    def __init__(self, codes: np.ndarray, after: np.ndarray):
        self.codes, self.after = codes, after   # sorted pairs of 18 bits; a row of counts by symbol for each

    @classmethod
    def none(cls) -> HotPairs:
        return cls(np.zeros(0, np.int64), np.zeros((0, SYMBOLS)))

    def find(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are hot, and the row of each that is."""
        if not len(self.codes):
            return np.zeros(len(pair), dtype=bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.codes, pair), len(self.codes) - 1)
        hot = self.codes[at] == pair
        return hot, at[hot]


def log_probabilities(g: np.ndarray, n: np.ndarray, pairs: np.ndarray, order: int = ORDER, hot: HotPairs | None = None) -> np.ndarray:
    """log10 probability of each distinct gram.  ``n``: training counts; all grams of a two-byte context are here, and of a
    hot one all grams of a three-byte context.  ``pairs``: the order-1 counts of all training texts."""
    hot = hot or HotPairs.none()
    g, n = g.astype(np.int64), n.astype(np.float64)
    levels = []   # by order: count of the symbol, T and U of the context, and what the next longer context excludes here
    single = pairs.sum(axis=0)
    t1, u1 = pairs.sum(axis=1), (pairs > 0).sum(axis=1)
    c1, s = (g >> WIDTH) & 511, g & 511
    zero = np.zeros(len(g))
    ex1 = ((pairs > 0) * single[None, :]).sum(axis=1)   # at order 0, after an order-1 context
    levels.append([single[s], zero + single.sum(), zero + (single > 0).sum(), ex1[c1], u1[c1].astype(float)])
    levels.append([pairs[c1, s], t1[c1].astype(float), u1[c1].astype(float), None, None])
    below_n = None
    for j in range(2, order + 1):
        codes, uniq = pd.factorize(g & ((1 << (WIDTH * (j + 1))) - 1))
        count = np.bincount(codes, n, minlength=len(uniq))
        ctx_codes, ctx = pd.factorize(uniq >> WIDTH)
        total = np.bincount(ctx_codes, count, minlength=len(ctx))
        kinds = np.bincount(ctx_codes, count > 0, minlength=len(ctx))
        if j == 2:
            lower = pairs[(uniq >> WIDTH) & 511, uniq & 511]
            mine, at = hot.find(uniq >> WIDTH)
            count[mine] = hot.after[at, uniq[mine] & 511]
        else:
            first = np.empty(len(uniq), dtype=np.int64)
            first[codes] = np.arange(len(g))
            lower = below_n[first]
        excluded = np.bincount(ctx_codes, lower * (count > 0), minlength=len(ctx))
        if j == 2:   # a hot pair's other symbols are with other owners
            mine, at = hot.find(ctx)
            seen = hot.after[at] > 0
            total[mine], kinds[mine], excluded[mine] = hot.after[at].sum(axis=1), seen.sum(axis=1), (seen * pairs[ctx[mine] & 511]).sum(axis=1)
        own = ctx_codes[codes]
        levels[j - 1][3], levels[j - 1][4] = excluded[own], kinds[own]
        below_n = count[codes]
        levels.append([below_n, total[own], kinds[own], None, None])
    levels[order][3] = levels[order][4] = zero
    out, open_ = zero.copy(), np.ones(len(g), dtype=bool)
    for count, total, kinds, ex_n, ex_u in reversed(levels):
        t, u = total - ex_n, kinds - ex_u
        here = open_ & (u > 0)
        hit = here & (count > 0)
        miss = here & ~hit
        out[hit] += np.log10((count[hit] - 0.5) / t[hit])
        out[miss] += np.log10(0.5 * u[miss] / t[miss])
        open_ &= ~hit
    left = SYMBOLS - int((single > 0).sum())
    out[open_] -= np.log10(max(left, 1))
    return out


def word_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key and row of every word; keys are never END_WORD."""
    starts, ends, row = T.word_bounds(data, off)
    return T.word_hashes(data, starts, ends).view(np.int64) | np.int64(1), row


def bucket_of(keys: np.ndarray, kind: int, buckets: int, hot: HotPairs) -> np.ndarray:
    by = keys
    if kind == GRAMS:
        by = (keys >> WIDTH) & ((1 << (2 * WIDTH)) - 1)
        split, _ = hot.find(by)
        by[split] = (keys[split] >> WIDTH) & ((1 << (3 * WIDTH)) - 1) | np.int64(1 << (3 * WIDTH))
    return (T.mix64(by.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


class Tally:
    """Distinct keys of a block with their training counts."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, training: np.ndarray) -> None:
        codes, uniq = pd.factorize(keys)
        n = np.bincount(codes, training, minlength=len(uniq)).astype(np.int64)
        codes, self.keys = pd.factorize(np.concatenate((self.keys, uniq)))
        self.n = np.bincount(codes, np.concatenate((self.n, n)), minlength=len(self.keys)).astype(np.int64)


def _requests(buckets: int, order: int, hot: HotPairs):
    def run(key, table):
        tallies = (Tally(), Tally())
        for part in table.select(["text", "train"]).to_batches(max_chunksize=4096):
            train = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, e, data, off in T.chunks(part.column(0)):
                data = T.LOWER[data]
                g, row = grams(data, off, order)
                tallies[GRAMS].add(g, train[a:e][row])
                w, row = word_keys(data, off)
                tallies[WORDS].add(np.append(w, END_WORD), np.append(train[a:e][row], train[a:e].sum()))
        kinds, owners, ks, ns = [], [], [], []
        for kind, tally in enumerate(tallies):
            of = bucket_of(tally.keys, kind, buckets, hot)
            arrange = np.lexsort((tally.keys, of))
            cuts = np.searchsorted(of[arrange], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = arrange[cuts[b] : cuts[b + 1]]
                kinds.append(kind)
                owners.append(b)
                ks.append(tally.keys[own])
                ns.append(tally.n[own])
        return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(owners, pa.int32()), "block": pa.array([key[0].as_py()] * len(ks), pa.int32()),
                         "keys": pa.array(ks, pa.list_(pa.int64())), "n": pa.array(ns, pa.list_(pa.int64()))})

    return run


REQUEST = "kind int, bucket int, block int, keys array<long>, n array<long>"
ANSWER = "block int, kind int, keys array<long>, value array<double>, words long, kinds long"
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double, words long, kinds long"


def _owner(pairs: np.ndarray, order: int, hot: HotPairs):
    def run(key, table):
        kind = key[0].as_py()
        keys = [np.asarray(x.values) for x in table.column("keys")]
        codes, uniq = pd.factorize(np.concatenate(keys))
        n = np.bincount(codes, np.concatenate([np.asarray(x.values) for x in table.column("n")]), minlength=len(uniq))
        value = n if kind == WORDS else log_probabilities(uniq, n, pairs, order, hot)
        answer = value[codes]
        cuts = np.cumsum([0, *map(len, keys)])
        blocks, asked = table.column("block").to_pylist(), [np.asarray(x.values) for x in table.column("keys")]
        values = [answer[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        words, kinds = [None] * len(blocks), [None] * len(blocks)
        if kind == WORDS:   # one more row, to no block: this owner's share of the totals
            blocks, asked, values, words, kinds = [*blocks, -1], [*asked, []], [*values, []], [*words, int(n.sum())], [*kinds, int((n > 0).sum())]
        return pa.table({"block": pa.array(blocks, pa.int32()), "kind": pa.array([kind] * len(blocks), pa.int32()), "keys": pa.array(asked, pa.list_(pa.int64())),
                         "value": pa.array(values, pa.list_(pa.float64())), "words": pa.array(words, pa.int64()), "kinds": pa.array(kinds, pa.int64())})

    return run


def _scores(order: int):
    out_type = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_counts", pa.float64()), ("score", pa.float64()), ("words", pa.int64()), ("kinds", pa.int64())])

    def run(docs, answers):
        if not docs.num_rows:
            none = [None] * answers.num_rows
            return pa.table([none, none, none, none, none, none, answers.column("words"), answers.column("kinds")], schema=out_type)
        kind = answers.column("kind").to_numpy()
        index, values = [], []
        for k in (GRAMS, WORDS):
            own = answers.filter(pa.array(kind == k))
            index.append(pd.Index(np.concatenate([np.asarray(x.values) for x in own.column("keys")])))
            values.append(np.concatenate([np.asarray(x.values) for x in own.column("value")]))
        cols = {"tokens": [], "known": [], "log_counts": [], "score": []}
        for part in docs.select(["text"]).to_batches(max_chunksize=4096):
            for _, _, data, off in T.chunks(part.column(0)):
                data, n = T.LOWER[data], len(off) - 1
                g, row = grams(data, off, order)
                at = index[GRAMS].get_indexer(g)
                if (at < 0).any():
                    raise RuntimeError("a text is not in the block that asked for its grams: the rows of docs have no stable place")
                cols["score"].append(np.bincount(row, values[GRAMS][at], minlength=n))
                w, row = word_keys(data, off)
                c = values[WORDS][index[WORDS].get_indexer(np.append(w, END_WORD))]
                cols["tokens"].append(np.bincount(row, minlength=n) + 1)
                cols["known"].append(np.bincount(row, c[:-1] > 0, minlength=n).astype(np.int64) + int(c[-1] > 0))
                cols["log_counts"].append(np.bincount(row, np.log10(c[:-1] + ALPHA), minlength=n) + np.log10(c[-1] + ALPHA))
        out = {k: np.concatenate(v) if v else np.zeros(0) for k, v in cols.items()}
        none = [None] * docs.num_rows
        held = pa.array(~docs.column("train").to_numpy().astype(bool))
        return pa.table([docs.column("doc_id"), held, pa.array(out["tokens"], pa.int64()), pa.array(out["known"], pa.int64()), pa.array(out["log_counts"], pa.float64()), pa.array(out["score"], pa.float64()), none, none], schema=out_type)

    return run


def _order1_counts(docs: DataFrame, order: int) -> np.ndarray:
    """Order-1 counts of the training texts; at most 257 x 258 rows reach the driver."""
    def run(batches):
        total = np.zeros((START + 1, SYMBOLS), dtype=np.int64)
        for b in batches:
            train = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            for a, e, data, off in T.chunks(b.column(0)):
                g, row = grams(T.LOWER[data], off, 1)
                total += order1(g, train[a:e][row]).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], names=["pair", "n"])

    out = np.zeros((START + 1) * SYMBOLS)
    for r in docs.select("text", "train").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(START + 1, SYMBOLS)


def hot_pairs(docs: DataFrame, pairs: np.ndarray, part: int = HOT_PAIRS) -> HotPairs:
    """The pairs that precede over 1/part of all training symbols: fewer than ``part``, with 257 counts each."""
    first, second = np.nonzero(pairs[:, :END] * part > pairs.sum())
    codes = np.sort((first << WIDTH) | second)
    if not len(codes):
        return HotPairs.none()
    shape = (len(codes), SYMBOLS)

    def run(batches):
        finder, total = HotPairs(codes, np.zeros(shape)), np.zeros(shape[0] * SYMBOLS, dtype=np.int64)
        for b in batches:
            train = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            for a, e, data, off in T.chunks(b.column(0)):
                g, row = grams(T.LOWER[data], off, 2)
                own, at = finder.find(g >> WIDTH)
                total += np.bincount(at * SYMBOLS + (g[own] & 511), train[a:e][row[own]], minlength=len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["gram", "n"])

    after = np.zeros(shape[0] * SYMBOLS)
    for r in docs.select("text", "train").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():   # bounded by shape
        after[r["gram"]] = r["n"]
    return HotPairs(codes, after.reshape(shape))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, train): nulls as empty, and whether the model may learn from the text."""
    split = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 != 0
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), split.alias("train"))


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with their ``block``, shuffled by it."""
    block = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    return rows.withColumn("block", block).repartition("block")


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES,
                 hot_part: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    if not 2 <= order <= 6:
        raise ValueError("a gram of order + 1 symbols of 9 bits fits 64 bits for orders 2 to 6")
    rows = texts(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    pairs = _order1_counts(rows, order)
    hot = hot_pairs(rows, pairs, hot_part)
    own = dealt(rows, blocks)   # read twice, shuffled once
    asked = own.groupBy("block").applyInArrow(_requests(blocks, order, hot), REQUEST)
    answers = asked.groupBy("kind", "bucket").applyInArrow(_owner(pairs, order, hot), ANSWER)
    both = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores(order), SCORE)
    done = stored(both, "ppm-scores")
    totals = done.filter("words IS NOT NULL").agg(F.sum("words").alias("n"), F.sum("kinds").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"] or 0
    base = F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(n + ALPHA * (v + 1))))
    return done.filter("words IS NULL").select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
