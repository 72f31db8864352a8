"""Conversation repair against every edit of small conversations, and over segments."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from aulastar.llm import conversations as C
from aulastar.llm import queries

LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """(initial, fault) by the rules, and the first fault of each row."""
    seen, out = set(), []
    for role, text in rows:
        ink = text.rstrip(" \t\n\x0b\x0c\r")
        fault = C.BLANK if not ink else C.DUPLICATE if (role, text) in seen else C.CUT if ink[-1] not in ".!?" else C.GOOD
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) of the best of all edits with at most two inserts in a gap."""
    fault, best = faults(rows), None
    choices = [["D"] if f in (C.BLANK, C.DUPLICATE) else [*(["K"] if r else []), "Ru", "Ra", "D"] for f, (r, _) in zip(fault, rows)]   # an empty role has no initial to keep
    gaps = ["", "u", "a", "ua", "au"]
    for picks in itertools.product(*choices):
        base = sum({"K": 0, "R": 1, "D": 2}[p[0]] + (5 if f == C.CUT and p != "D" else 0) for p, f in zip(picks, fault))
        if best is not None and base > best[0]:
            continue
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            cost = base + 5 * sum(map(len, ins))
            if best is not None and cost > best[0]:
                continue
            initials, audit, out = "", "", []
            for k in range(len(rows) + 1):
                for s in ins[k]:
                    initials, audit = initials + s, audit + "I"
                    out.append((C.NAMES[s], ""))
                if k < len(rows):
                    audit += picks[k][0]
                    if picks[k] != "D":
                        role = rows[k][0] if picks[k] == "K" else C.NAMES[picks[k][1]]
                        initials += role[:1]
                        out.append((role, rows[k][1]))
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


def parsed(rows, cuts=()):
    """The operator's own parse of one conversation, cut into segments before the given rows."""
    segments, fault = [], faults(rows)
    for k, (role, _) in enumerate(rows):
        if k == 0 or k in cuts:
            segments.append(C.Segment(("v", len(segments)), (None, None, None), C.ENTRIES if k else [C.ROOT]))
        segments[-1].add(k, role[:1], fault[k], 1)
    names = C.SEGMENT.names
    rows_ = [dict(zip(names, g.row(), strict=True)) for g in segments]
    got = dict(zip(C.RESULT.names, C.chained(rows_), strict=True))
    return got["cost"], "".join(got["audits"])


TEXTS = ["Yes.", "No", "What?", " ", "", "Go on!", "and"]
ROLES = ["user", "user", "assistant", "assistant", "system", " ", "usher", "tool", ""]


@pytest.mark.parametrize("seed", range(60))
def test_cheapest_edits_as_brute_force(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(ROLES), rng.choice(TEXTS) + ("" if rng.random() < 0.3 else f" {k}.")) for k in range(rng.randint(1, 4))]
    assert parsed(rows) == cheapest(rows)[:2], rows


@pytest.mark.parametrize("seed", range(25))
def test_segments_chain_to_the_same_edits(seed):
    rng = random.Random(1000 + seed)
    rows = [(rng.choice(ROLES), rng.choice(TEXTS) + f" {rng.randint(0, 40)}" + rng.choice(["", ".", "."])) for _ in range(rng.randint(5, 900 if seed % 5 == 0 else 40))]
    whole = parsed(rows)
    for n in (1, 2, 7):
        assert parsed(rows, set(rng.sample(range(1, len(rows)), min(n, len(rows) - 1)))) == whole


def test_the_grammar():
    for n in range(7):
        for word in map("".join, itertools.product("sua", repeat=n)):
            node = C.ROOT
            for symbol in word:
                node = node and C.shift(node, symbol)
            assert (node is not None and C.accepts(node)) == bool(LEGAL.fullmatch(word)), word


def plain_report(rows):
    """The contract, row by row in Python."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, None)
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub(r"[.!?]", "", text) if lot == 2 else text
        role = "user" if lot == 4 else role
        by.setdefault(conv, []).extend([(turn, role, text)] * (2 if lot == 3 else 1))
    for conv in out:
        here = sorted(by.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = [r[0] for r in here if r[0] is not None]
        fault = faults([(r, t) for _, r, t in here])
        initials = [r[:1] for _, r, _ in here]
        illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(initials, initials[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count(C.BLANK), fault.count(C.DUPLICATE), fault.count(C.CUT), illegal, [(r, t) for _, r, t in here])
    return out


def check(spark, rows, partitions=8, deep=5):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, ck string, part int")
    got = {r.conv_id: r for r in C.report(df.repartition(3)).collect()}
    want = plain_report(rows)
    assert set(got) == set(want)
    for conv, (gaps, blank, duplicate, cut, illegal, here) in want.items():
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == (gaps, blank, duplicate, cut, illegal), conv
        if len(here) <= deep:
            cost, audit, repaired = cheapest(here) if here else (0, "", [])
            assert (r.cost, r.audit) == (cost, audit), here
        else:
            assert (r.cost, r.audit) == parsed(here)
            repaired = applied(here, r.audit)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()


def applied(rows, audit):
    """Repaired rows by the letters of an audit."""
    out, k = [], 0
    for letter in audit:
        want = "a" if out and out[-1][0][:1] == "u" else "u"
        if letter == "I":
            out.append((C.NAMES[want], ""))
            continue
        if letter != "D":
            out.append(rows[k] if letter == "K" else (C.NAMES[want], rows[k][1]))
        k += 1
    assert k == len(rows) and LEGAL.fullmatch("".join(r[:1] for r, _ in out))
    return out


def test_report_as_brute_force(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS) + rng.choice(["", f" {t}.", f" {t}!"])) for c in range(120) for t in range(rng.randint(1, 4))]
    rows += [(c, rng.choice([None, 0, 3, 3, 9]), rng.choice([None, "user", "assistant"]), rng.choice([None, "Same.", "é" * 5000])) for c in (None, 500, 501, 502) for _ in range(3)]
    check(spark, rows + rows[:20])


@pytest.mark.parametrize("name, rows", [
    ("long", [(7, t, ("user", "assistant")[t % 2], f"Word {t}." if t % 11 else "Same.") for t in range(6000)]),
    ("equal", [(7, 3, "user", "Same.")] * 3000 + [(7, 4, "assistant", "Same.")] * 3000), ("one text", [(7, t, "user", "Same.") for t in range(3000)]), ("no turns", [(7, None, ("user", "assistant")[t % 2], f"{t}.") for t in range(2000)])])
def test_one_conversation_of_most_rows_is_many_segments(spark, name, rows):
    rows = rows + [(c, t, ("user", "assistant")[t % 2], f"Text {c} {t}.") for c in range(100, 140) for t in range(4)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows)
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        made = C.Repair(C.damaged(df))
        parts = {r.ck: len(r.parts) for r in made.results.collect()}
        assert made.cut == sum(n > 1 for n in parts.values()) and (parts["v7"] > 1) == (name != "equal")
        assert sum(r["rows"] for r in made.segments.collect()) == sum(r.copies for r in C.damaged(df).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "Why?"), (2, 0, "assistant", "Hello.")], "conv_id long, turn long, role string, text string")
    got = sorted((r.ck, r.place, r.edit, r.role, r.text) for r in C.Repair(C.plain_rows(df)).repaired().collect())
    assert got == [("v1", 0, "K", "system", "Be kind."), ("v1", 1, "K", "user", "Hi."), ("v1", 2, "R", "assistant", "Why?")]


def test_empty(spark):
    assert C.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_given_table(spark):
    root = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{root}/conversations.parquet'").fetchall()
    got = {r.conv_id: r for r in queries.op13_conversation_repair(spark, root).collect()}
    want = plain_report(rows)
    assert set(got) == set(want) and any(r.cost for r in got.values())
    for conv, (gaps, blank, duplicate, cut, illegal, here) in want.items():
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == (gaps, blank, duplicate, cut, illegal)
        assert (r.cost, r.audit) == (cheapest(here)[:2] if 0 < len(here) < 5 else parsed(here) if here else (0, ""))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in applied(here, r.audit)).encode()).hexdigest()
