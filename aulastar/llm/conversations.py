"""Repair of conversations' role structure by generalised LR parsing with edits.

The roles of a conversation, by their initials, should read ``(s?(ua)+)?``.  RULES is that grammar; its LR(0) automaton is built
below.  The parser reads a conversation's rows in order and keeps a graph-structured stack: tops are nodes that share what lies below
them.  Before every row each top may take inserted rows; at the row each top splits into delete, keep (shift of the row's own initial)
and rerole (shift of ``u`` or ``a``), reductions follow at once, and tops of equal state are merged: the one of least (cost, audit)
stays, as what can follow depends on the state alone.  Two audits of equal cost at one row are never prefixes of each other
(an insert costs something), so the least prefix gives the least whole.  A top that is dearer than another by more than
``SLACK`` is dropped: the other reaches whatever it can reach for less.

The work is spread by ranges, not by conversation:

1. A scan turns rows into narrow ones: initial, blank, truncated, SHA-256 of the text.  Equal rows collapse to one with a count before
   they move, and a row's first occurrence is found by an aggregate.
2. The narrow rows are sorted by ranges of (conversation, turn, role, digest), so a conversation with a third of all rows is many
   *segments*.  A task parses its segments as a stream.  The first one of a task may go on from another task, so it is parsed from
   every node the stack can have there; its result is a table from entry node to exit node.
3. Segments of one conversation are chained by the same rule of the least (cost, audit).
4. ``repaired`` sends each text once to its (conversation, segment), where it meets the segment's edits, and gives the repaired rows.

Rows are ordered by turn (null first), then role, then the SHA-256 of the text; nulls in role and text count as one space.  Defined
cases: an empty role has no initial and can't be kept; a null conversation id is a conversation; empty and very long texts are texts like any other; repeated rows are duplicates;
an empty table gives an empty result; other columns are left out.  The audit of a conversation is one string with a letter a row,
and its digest reads its rows one after the other, in one task, as a stream."""

from __future__ import annotations

import hashlib
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulastar.llm.joins import join_groups
from aulastar.llm.store import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5   # what edits cost; the last is for a truncated row that stays
SLACK = 2 * INSERT
BLOCK = 256             # letters of an audit that are kept together
SPACES = " \t\n\x0b\x0c\r"
GOOD, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
NAMES = {"u": "user", "a": "assistant"}
ORDERLY = {("s", "u"), ("u", "a"), ("a", "u")}

#: C: a conversation, P: pairs of question and answer.
RULES = [("C", ()), ("C", ("P",)), ("C", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a"))]


# --- the automaton ----------------------------------------------------------

def _closure(items: frozenset) -> frozenset:
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        body = RULES[rule][1]
        if dot < len(body):
            for i, (head, _) in enumerate(RULES):
                if head == body[dot] and (i, 0) not in found:
                    found.add((i, 0))
                    todo.append((i, 0))
    return frozenset(found)


def _automaton() -> tuple[list[frozenset], dict[tuple[int, str], int]]:
    states = [_closure(frozenset((i, 0) for i, (head, _) in enumerate(RULES) if head == "C"))]
    moves: dict[tuple[int, str], int] = {}
    for n, items in enumerate(states):
        for symbol in sorted({RULES[r][1][d] for r, d in items if d < len(RULES[r][1])}):
            after = _closure(frozenset((r, d + 1) for r, d in items if RULES[r][1][d : d + 1] == (symbol,)))
            if after not in states:
                states.append(after)
            moves[n, symbol] = states.index(after)
    return states, moves


STATES, MOVES = _automaton()


class Node(NamedTuple):
    """A stack: its top state and the node below."""

    state: int
    below: Node | None


ROOT = Node(0, None)


@cache
def shift(node: Node, symbol: str) -> Node | None:
    """The stack after one more initial, reductions of pairs included; None where the grammar has no place for it."""
    to = MOVES.get((node.state, symbol))
    if to is None:
        return None
    node = Node(to, node)
    while True:
        done = [r for r, d in STATES[node.state] if RULES[r][0] == "P" and d == len(RULES[r][1])]
        if not done:
            return node
        for _ in RULES[done[0]][1]:
            node = node.below
        node = Node(MOVES[node.state, "P"], node)


@cache
def accepts(node: Node) -> bool:
    """Whether the conversation may end here."""
    return any(RULES[r][0] == "C" and d == len(RULES[r][1]) for r, d in STATES[node.state])


def _stacks() -> dict[int, Node]:
    """One stack for every top state that a row can leave."""
    found, todo = [ROOT], [ROOT]
    while todo:
        n = todo.pop()
        for m in (shift(n, s) for s in "sua"):
            if m is not None and m not in found:
                found.append(m)
                todo.append(m)
    return {n.state: n for n in reversed(found)}


BY_STATE = _stacks()
ENTRIES = list(BY_STATE.values())


# --- tops of the stack and their audits ----------------------------------------

class Top(NamedTuple):
    node: Node
    cost: int
    block: tuple | None   # (earlier block, letters)
    tail: str


def _letters(top: Top, until=None) -> str:
    parts, block = [top.tail], top.block
    while block is not until:
        parts.append(block[1])
        block = block[0]
    return "".join(reversed(parts))


def _less(a: Top, b: Top) -> bool:
    if a.cost != b.cost:
        return a.cost < b.cost
    if a.block is b.block:
        return a.tail < b.tail
    seen, block = set(), a.block
    while block is not None:
        seen.add(id(block))
        block = block[0]
    common = b.block
    while common is not None and id(common) not in seen:
        common = common[0]
    return _letters(a, common) < _letters(b, common)


def _offer(tops: dict[int, Top], top: Top) -> bool:
    old = tops.get(top.node.state)
    if old is None or _less(top, old):
        tops[top.node.state] = top
        return True
    return False


def _inserted(tops: dict[int, Top]) -> None:
    """Let every top take inserted rows."""
    todo = sorted(tops.values(), key=lambda t: t.cost)
    while todo:
        t = todo.pop(0)
        if tops.get(t.node.state) is not t:
            continue
        for symbol in "ua":
            node = shift(t.node, symbol)
            if node is not None:
                new = Top(node, t.cost + INSERT, t.block, t.tail + "I")
                if _offer(tops, new):
                    todo.append(new)


def _pruned(tops: dict[int, Top]) -> dict[int, Top]:
    least = min(t.cost for t in tops.values()) + SLACK
    return {s: t for s, t in tops.items() if t.cost <= least}


def read_row(tops: dict[int, Top], initial: str, fault: int) -> dict[int, Top]:
    """The tops after one row."""
    if fault in (BLANK, DUPLICATE):   # inserts can wait for a row that may stay
        return {s: t._replace(cost=t.cost + DELETE, tail=t.tail + "D") for s, t in tops.items()}
    tops = dict(tops)
    _inserted(tops)
    stays = TRUNCATED if fault == CUT else 0
    after: dict[int, Top] = {}
    for t in tops.values():
        _offer(after, Top(t.node, t.cost + DELETE, t.block, t.tail + "D"))
        for symbol, cost, letter in ((initial, KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
            node = shift(t.node, symbol)
            if node is not None:
                _offer(after, Top(node, t.cost + cost + stays, t.block, t.tail + letter))
    return _pruned(after)


def delete_copies(tops: dict[int, Top], n: int) -> dict[int, Top]:
    return {s: t._replace(cost=t.cost + n * DELETE, tail=t.tail + "D" * n) for s, t in tops.items()} if n else tops


def blocked(tops: dict[int, Top]) -> dict[int, Top]:
    """Move full tails into blocks, which tops that part later share."""
    made: dict[tuple, tuple] = {}
    return {s: t if len(t.tail) < BLOCK else t._replace(block=made.setdefault((id(t.block), t.tail), (t.block, t.tail)), tail="") for s, t in tops.items()}


# --- segments -----------------------------------------------------------------

class Segment:
    """A run of a conversation's rows as they are read."""

    def __init__(self, key, at, entries: list[Node]):
        self.key, self.at, self.rows = key, at, 0
        self.tops = {e.state: {e.state: Top(e, 0, None, "")} for e in entries}
        self.counts = [0, 0, 0, 0]
        self.illegal, self.first, self.last = 0, None, None
        self.low = self.high = self.turn_first = self.turn_last = None
        self.turns = 0

    def add(self, turn, initial: str, fault: int, n: int) -> None:
        if self.rows == 0:
            self.first, self.turn_first = initial, turn
        elif (self.last, initial) not in ORDERLY:
            self.illegal += 1
        if n > 1 and (initial, initial) not in ORDERLY:
            self.illegal += n - 1
        if turn is not None and (self.turns == 0 or turn != self.high):
            self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        self.last, self.turn_last = initial, turn
        self.rows += n
        whole = n if fault in (BLANK, DUPLICATE) else 1
        self.counts[fault] += whole
        self.counts[DUPLICATE] += n - whole
        for e, tops in self.tops.items():
            tops = delete_copies(tops, n) if whole == n and fault in (BLANK, DUPLICATE) else delete_copies(read_row(tops, initial, fault), n - 1)
            self.tops[e] = blocked(tops)

    def row(self) -> tuple:
        ways = [(e, s, t.cost, _letters(t)) for e, tops in self.tops.items() for s, t in tops.items()]
        return (*self.key, *self.at, self.rows, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, self.first, self.last, self.low, self.high, self.turns,
                [{"entry": e, "exit": s, "cost": c, "audit": a} for e, s, c, a in ways])


SEGMENT_SCHEMA = ("ck string, part int, turn0 long, role0 string, digest0 binary, rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
                  "low long, high long, turns long, ways array<struct<entry:int, exit:int, cost:long, audit:string>>")
WAY = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
SEGMENT = pa.schema([("ck", pa.string()), ("part", pa.int32()), ("turn0", pa.int64()), ("role0", pa.string()), ("digest0", pa.binary()), ("rows", pa.int64()), ("blank", pa.int64()),
                     ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
                     ("turns", pa.int64()), ("ways", pa.list_(WAY))])
OUT_ROWS = 2048


def _batches(rows, schema: pa.Schema, limit: int = OUT_ROWS):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def parse_segments(batches):
    """Rows sorted by conversation and place -> one row per segment."""
    def segments():
        now = None
        for b in batches:
            ck, part, turn, role, digest, initial, fault, n = (c.to_pylist() for c in b.columns)
            for i in range(len(ck)):
                if now is None or now.key[0] != ck[i]:
                    fresh = [ROOT] if now is not None else ENTRIES   # a task's first segment may go on from another task
                    if now is not None:
                        yield now.row()
                    now = Segment((ck[i], part[i]), (turn[i], role[i], digest[i]), fresh)
                now.add(turn[i], initial[i], fault[i], n[i])
        if now is not None:
            yield now.row()
    yield from _batches(segments(), SEGMENT)


# --- chaining segments -----------------------------------------------------------

RESULT_SCHEMA = ("ck string, parts array<int>, bounds array<struct<turn0:long, role0:string, digest0:binary>>, entries array<int>, audits array<string>, rows long, blank long, duplicate long, "
                 "truncated long, illegal long, gaps long, cost long")
RESULT = pa.schema([("ck", pa.string()), ("parts", pa.list_(pa.int32())), ("bounds", pa.list_(pa.struct([("turn0", pa.int64()), ("role0", pa.string()), ("digest0", pa.binary())]))), ("entries", pa.list_(pa.int32())),
                    ("audits", pa.list_(pa.string())), ("rows", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("gaps", pa.int64()), ("cost", pa.int64())])


def chained(segments: list[dict]) -> tuple:
    """The result of one conversation from its segments in order."""
    tops = {ROOT.state: (0, "", ())}   # state -> cost, audit, (entry, letters) of every segment
    for g in segments:
        after: dict[int, tuple] = {}
        for w in g["ways"]:
            t = tops.get(w["entry"])
            if t is not None:
                new = (t[0] + w["cost"], t[1] + w["audit"], (*t[2], (w["entry"], w["audit"])))
                if w["exit"] not in after or new[:2] < after[w["exit"]][:2]:
                    after[w["exit"]] = new
        tops = after
    ends = {s: Top(BY_STATE[s], cost, None, audit) for s, (cost, audit, _) in tops.items()}
    paths = {s: path for s, (_, _, path) in tops.items()}
    closing = dict(ends)
    came = {s: s for s in ends}
    todo = sorted(ends.values(), key=lambda t: t.cost)
    while todo:   # rows inserted after the last
        t = todo.pop(0)
        if closing.get(t.node.state) is not t:
            continue
        for symbol in "ua":
            node = shift(t.node, symbol)
            if node is not None:
                new = Top(node, t.cost + INSERT, None, t.tail + "I")
                if _offer(closing, new):
                    came[node.state] = came[t.node.state]
                    todo.append(new)
    best = None
    for t in closing.values():
        if accepts(t.node) and (best is None or _less(t, best)):
            best = t
    path = list(paths[came[best.node.state]])
    used = sum(len(a) for _, a in path)
    path[-1] = (path[-1][0], path[-1][1] + best.tail[used:])
    illegal, turns, low, high, last = 0, 0, None, None, None
    for k, g in enumerate(segments):
        illegal += g["illegal"] + (k > 0 and (last, g["first"]) not in ORDERLY)
        turns += g["turns"] - (high is not None and g["low"] is not None and g["low"] == high)
        low, high, last = (g["low"] if low is None else low), (g["high"] if g["high"] is not None else high), g["last"]
    total = {f: sum(g[f] for g in segments) for f in ("rows", "blank", "duplicate", "truncated")}
    return (segments[0]["ck"], [g["part"] for g in segments], [{f: g[f] for f in ("turn0", "role0", "digest0")} for g in segments], [e for e, _ in path], [a for _, a in path],
            total["rows"], total["blank"], total["duplicate"], total["truncated"], int(illegal), high - low + 1 - turns if low is not None else 0, best.cost)


def chain(batches):
    def results():
        held: list[dict] = []
        for b in batches:
            for g in b.to_pylist():
                if held and held[0]["ck"] != g["ck"]:
                    yield chained(held)
                    held = []
                held.append(g)
        if held:
            yield chained(held)
    yield from _batches(results(), RESULT, 512)


# --- DataFrames -------------------------------------------------------------------

def conversation_key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("v"), conv.cast("string")), F.lit("n"))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with known faults put in, by crc32(``conv:turn``) % 20: 0 dropped, 1 emptied, 2 without ``[.!?]``, 3 twice, 4 said by the
    user.  Column ``copies`` tells how often a row stands there."""
    c, t, r, x = (F.col(f"`{n}`") for n in (conv, turn, role, text))
    space = F.lit(" ")
    lot = (F.crc32(F.concat(F.coalesce(c.cast("string"), space), F.lit(":"), F.coalesce(t.cast("string"), space)).cast("binary")) % 20).alias("lot")
    out = rows.select(c.alias("conv"), t.cast("long").alias("turn"), F.coalesce(r, space).alias("role"), F.coalesce(x, space).alias("text"), lot).filter("lot <> 0")
    text_now = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return out.select("conv", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"), text_now.alias("text"), F.when(F.col("lot") == 3, 2).otherwise(1).alias("copies"))


def plain_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The columns that ``Repair`` reads, rows as they are."""
    c, t, r, x = (F.col(f"`{n}`") for n in (conv, turn, role, text))
    return rows.select(c.alias("conv"), t.cast("long").alias("turn"), F.coalesce(r, F.lit(" ")).alias("role"), F.coalesce(x, F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


ORDER = ["ck", "turn", "role", "digest"]


class Repair:
    """The repair of ``rows`` (conv, turn, role, text, copies): ``results`` has a row per conversation, ``repaired()`` the rows that stay."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.withColumns({"ck": conversation_key(F.col("conv")), "digest": F.unhex(F.sha2("text", 256))})
        ink = F.rtrim(F.col("text"), F.lit(SPACES))
        fault = F.when(ink == "", BLANK).when(~F.right(ink, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(GOOD)
        distinct = self.rows.withColumn("fault", fault).groupBy(*ORDER).agg(F.sum("copies").alias("n"), F.first("fault").alias("fault"))
        distinct = stored(distinct, "conversation-rows")
        self.segments = stored(self._parsed(self._first_seen(distinct)), "conversation-segments")
        cut = self.segments.groupBy("ck").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").count()
        self.results = stored(self.segments.repartition("ck").sortWithinPartitions("ck", "part").mapInArrow(chain, RESULT_SCHEMA), "conversation-results")
        self.cut = cut

    @staticmethod
    def _first_seen(distinct: DataFrame) -> DataFrame:
        """Later occurrences of a role and text in a conversation become duplicates."""
        key = ["ck", "role", "digest"]
        turn = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
        again = distinct.groupBy(*key).agg(F.min(turn).alias("seen"), F.count(F.lit(1)).alias("m")).filter("m > 1")
        marked = join_groups(distinct, again, key, "m", distinct.count())
        later = F.col("seen").isNotNull() & (F.col("seen") != turn) & (F.col("fault") != BLANK)
        return marked.withColumn("fault", F.when(later, DUPLICATE).otherwise(F.col("fault")))

    @staticmethod
    def _parsed(rows: DataFrame) -> DataFrame:
        initial = F.substring("role", 1, 1).alias("initial")
        dealt = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id())
        return dealt.select("ck", "part", "turn", "role", "digest", initial, "fault", "n").mapInArrow(parse_segments, SEGMENT_SCHEMA)

    def _edits(self, cut: bool) -> DataFrame:
        """Of every segment its number in the conversation, the stack's top at its beginning and its letters."""
        some = self.results.filter((F.size("parts") > 1) if cut else (F.size("parts") == 1))
        return some.select("ck", F.posexplode(F.arrays_zip("entries", "audits")).alias("segment", "e")).select("ck", "segment", F.col("e.entries").alias("entry"), F.col("e.audits").alias("audit"))

    def _turns(self, cut: bool) -> DataFrame:
        edits, rows = self._edits(cut), self.rows
        if self.cut:   # a conversation that goes on from task to task: no more of them than tasks
            bounds = F.broadcast(self.results.filter(F.size("parts") > 1).select("ck", "bounds"))
            if cut:
                key = F.struct(F.col("turn").alias("turn0"), F.col("role").alias("role0"), F.col("digest").alias("digest0"))
                rows = rows.join(bounds, "ck").withColumn("__key", key)
                rows = rows.withColumn("segment", F.size(F.filter("bounds", lambda b: ~_before(F.col("__key"), b))) - 1)
            else:
                rows = rows.join(bounds, "ck", "left_anti").withColumn("segment", F.lit(0))
        else:
            rows = rows.withColumn("segment", F.lit(0))
        none = F.lit(None)
        head = edits.select("ck", "segment", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("digest"), F.col("audit").alias("text"), F.col("entry").alias("copies"))
        both = head.unionByName(rows.select("ck", "segment", F.lit(1).alias("kind"), "turn", "role", "digest", "text", F.col("copies").cast("int")))
        order = ["ck", "segment", "kind", "turn", "role", "digest"]
        dealt = both.repartition("ck", "segment").sortWithinPartitions(*order)
        return dealt.select("ck", "segment", "kind", "turn", "role", "digest", "text", "copies").mapInArrow(edited, TURN_SCHEMA)

    def repaired(self) -> DataFrame:
        """(ck, segment, place, edit, turn, role, text) of every row that stays or is inserted."""
        whole = self._turns(False)
        return whole.unionByName(self._turns(True)) if self.cut else whole

    def digests(self) -> DataFrame:
        """(ck, repaired_sha256) of conversations with repaired rows."""
        out = self._turns(False).mapInArrow(digest, DIGEST_SCHEMA)   # the rows of a conversation lie together, in order
        if not self.cut:
            return out
        return out.unionByName(self._turns(True).repartition("ck").sortWithinPartitions("ck", "segment", "place").mapInArrow(digest, DIGEST_SCHEMA))


def _before(a: Column, b: Column) -> Column:
    """Whether place ``a`` lies before place ``b``; a null turn comes first."""
    def rank(x):
        return F.struct(x["turn0"].isNotNull(), F.coalesce(x["turn0"], F.lit(0).cast("long")), x["role0"], x["digest0"])

    return rank(a) < rank(b)


TURN_SCHEMA = "ck string, segment int, place long, edit string, turn long, role string, text string"
TURN = pa.schema([("ck", pa.string()), ("segment", pa.int32()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
DIGEST_SCHEMA = "ck string, repaired_sha256 string"
DIGEST = pa.schema([("ck", pa.string()), ("repaired_sha256", pa.string())])


def edited(batches):
    """Rows of segments, each after the letters of its edits -> repaired rows."""
    def rows():
        key = node = letters = None
        at = place = 0

        def put(edit, symbol, turn, role, text):
            nonlocal node, place
            after = shift(node, symbol)
            if after is None:
                raise ValueError(f"conversation {key}: edit {edit} at letter {at} doesn't fit")
            node, place = after, place + 1
            return (*key, place - 1, edit, turn, role, text)

        def inserts():
            nonlocal at
            while at < len(letters) and letters[at] == "I":
                at += 1
                symbol = _wanted(node)
                yield put("I", symbol, None, NAMES[symbol], "")

        for b in batches:
            for ck, segment, kind, turn, role, _, text, copies in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 0:
                    if letters is not None:
                        yield from inserts()
                    key, node, letters, at, place = (ck, segment), BY_STATE[copies], text, 0, 0
                    continue
                yield from inserts()
                edit = letters[at]
                at += copies   # a second copy is always deleted
                if edit == "K":
                    yield put("K", role[:1], turn, role, text)
                elif edit == "R":
                    symbol = _wanted(node)
                    yield put("R", symbol, turn, NAMES[symbol], text)
        if letters is not None:
            yield from inserts()
    yield from _by_bytes(rows(), TURN)


def _wanted(node: Node) -> str:
    return "a" if shift(node, "a") is not None else "u"


def _by_bytes(rows, schema: pa.Schema, limit: int = 1 << 22):
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + len(r[-1])
        if size >= limit:
            yield from _batches(held, schema, len(held))
            held, size = [], 0
    yield from _batches(held, schema)


def digest(batches):
    """Repaired rows in order -> the digest of each conversation's ``role:text`` lines."""
    def results():
        key, h = None, None
        for b in batches:
            for ck, role, text in zip(b.column(0).to_pylist(), b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True):
                line = f"{role}:{text}".encode()
                if ck == key:
                    h.update(b"\n" + line)
                else:
                    if h is not None:
                        yield key, h.hexdigest()
                    key, h = ck, hashlib.sha256(line)
        if h is not None:
            yield key, h.hexdigest()
    yield from _batches(results(), DIGEST)


def report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``, whose damaged form is repaired."""
    made = Repair(damaged(rows, conv, turn, role, text))
    every = rows.select(F.col(f"`{conv}`").alias("conv_id")).groupBy("conv_id").agg(F.lit(1).alias("one")).withColumn("ck", conversation_key(F.col("conv_id")))
    found = made.results.withColumn("audit", F.concat_ws("", "audits"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = every.join(found, "ck", "left").join(made.digests(), "ck", "left")
    return out.select("conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
