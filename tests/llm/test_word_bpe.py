"""Forced-boundary encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aulastar.llm import queries, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODER = word_bpe.Encoder(word_bpe.read_vocabulary(PATH))
LETTERS = "abcXYZ 019'’.,-_<|>/éèÀß中文字한글́̈\xa0 \t\n\x0b\x1c\x85 　İıſΣςσ👍🏽👨‍👩‍👧ﬁⅧ²\x00'S'll's﻿‍"


def by_library(texts):
    return [x.ids for x in LIBRARY.encode_batch(list(texts), add_special_tokens=False)]


def by_operator(texts):
    return [np.frombuffer(x, dtype="<u4").tolist() for x in CODER.encode([t.encode() for t in texts])]


def test_odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", " \n", "<|startoftext|>a<|endoftext|> <|ENDOFTEXT|>x<|endoftext|><|endoftext|>", "ab<|endoftext|>cd<|startoftext|>", "</w>", "a</w>b", "é ́a", "it's I'LL 'tis ''s"]
    assert by_operator(texts) == by_library(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert by_operator(texts) == by_library(texts)


@pytest.mark.parametrize("text", ["x" * 5000, "ab" * 4000, "".join(random.Random(1).choice("abcdefghij") for _ in range(8000)), "中" * 2000, "9" * 3000, "aaab" * 50 + " " + "a" * 63 + " " + "a" * 64 + " " + "a" * 65])
def test_long_words(text):
    assert by_operator([text]) == by_library([text])


def test_every_token_is_found_again():
    words = [t for t in LIBRARY.get_vocab() if t.endswith("</w>")][::7]
    texts = [bytes(CODER.byte_of[ord(c)] for c in w[:-4]).decode("utf-8", "replace") for w in words]
    assert by_operator(texts) == by_library(texts)


def test_cuts_are_forced():
    """A cut pair lies inside no token; the whole text merged without cuts gives the same ids."""
    v = CODER.vocabulary
    inside = set()
    for t in v.ids:
        units = [CODER.byte_of[ord(c)] for c in t.removesuffix("</w>")] if t != "</w>" else []
        if units and t.endswith("</w>"):
            units[-1] += 256
        inside |= set(zip(units, units[1:]))
    assert inside == set(zip(*(x.tolist() for x in np.nonzero(v.joint)), strict=True))
    rng = np.random.default_rng(5)
    for _ in range(300):
        units = rng.choice(np.frombuffer(b"etaoinshr.,'1-", dtype=np.uint8), rng.integers(1, 90)).astype(np.int64)
        units[-1] += 256
        ids, _ = v.merged_all(units, v.fragments(units))
        assert ids.tolist() == v.merged(units.tolist())


def test_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(word_bpe, "TABLE_WORDS", 50)
    coder = word_bpe.Encoder(word_bpe.read_vocabulary(PATH))
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 70))) for _ in range(40)) for _ in range(30)]
    got = [coder.encode([t.encode()])[0] for t in texts]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == by_library(texts)
    assert len(coder.words) <= 50 + 80


def test_round_trip_and_odd_rows(spark):
    texts = [(1, "Some words, of text."), (1, "Some words, of text."), (2, None), (3, ""), (None, "no id"), (4, " \t\n"), (5, "long " * 40_000), (6, "y" * 30_000), (7, "\x00 é")]
    docs = spark.createDataFrame([(i, t, "w", 3) for i, t in texts], "doc_id long, text string, ids string, n_tokens int")
    got = word_bpe.decode(word_bpe.encode(docs, PATH), PATH).collect()
    want = by_library([t or "" for _, t in texts])
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), r.decoded) for r in got) == sorted(
        (str(i), len(w), np.array(w, dtype="<u4").tobytes(), LIBRARY.decode(w, skip_special_tokens=False)) for (i, _), w in zip(texts, want, strict=True))
    assert word_bpe.encode(docs.limit(0), PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        word_bpe.Vocabulary({"model": {"type": "BPE", "end_of_word_suffix": None, "vocab": {}, "merges": []}})


def test_documents_table(spark):
    root = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    got = queries.op11_bpe(spark, root).collect()
    want = dict(zip(texts, by_library(texts.values()), strict=True))
    assert len(got) == len(texts)
    for r in got:
        ids = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
