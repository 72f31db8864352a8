"""Records of delimited files by a parallel finite-state scan.

Within a cell the scan is in one of four states: field start, plain, quoted, quote in quoted.  A quote opens a cell at its start only;
elsewhere it is text, and so is what follows a closing quote.  At a line break only one question is left: is a quoted cell open?  So a line is
a function from {no, yes} to {no, yes}: two patterns tell, per line and on the JVM, what it makes of either.

1. ``split_summaries``: a scan of every split composes its lines' functions: for either entry, whether the split ends in an open cell, how
   many records begin in it and where the last one does.  One row per split.
2. ``split_facts``: per file, in the order of its splits, the functions are applied to "no": entry and first record number of every split.
   A quote still open when its file ends opened nothing: from that record on each line is a record and quotes are text.
3. ``cut_records``: every split, knowing its entry, cuts its own records in file order.  A record that crosses into another split
   leaves a fragment in each; fragments, two a split at most, are the only rows that meet in a shuffle.

No line is sorted, windowed or moved.  The facts of up to ``BROADCAST_SPLITS`` splits are broadcast; more of them are joined by shuffle and
the lines of each split put back in order.  Splits must be the same in both scans; a split without facts is an error, not a loss.

Defined cases: an empty file has no records, a blank line is a record without cells, a byte order mark is left out, ``\\r\\n`` and ``\\r`` inside a
quoted cell become ``\\n``."""

from __future__ import annotations

import re
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulastar.config import READER_NULLS
from aulastar.session import remove_at_exit, shared_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no installed copy

BROADCAST_SPLITS = 100_000
SUMMARY = "file string, block long, lines long, s_open boolean, s_records long, s_last long, q_open boolean, q_records long, q_last long"
FACTS = "file string, block long, entry boolean, first long, plain_from long, crosses boolean"
RECORDS = "source_file string, __file string, row_idx long, value string, plain boolean, part long"


def _quoted() -> str:
    return '"[^"]*+(?:""[^"]*+)*+'   # a quoted cell up to its closing quote, or to the end


def leaves_open(line: Column, sep: str) -> Column:
    """Whether a line read from a field start ends in an open quoted cell."""
    s = re.escape(sep)
    return line.rlike(rf'\A(?:(?:{_quoted()}"[^{s}]*+|[^"{s}][^{s}]*+)?+{s})*+{_quoted()}\z')


def with_functions(lines: DataFrame, sep: str) -> DataFrame:
    """Add what a line makes of a closed (``__s``) and of an open cell (``__q``) before it."""
    # lines without a quote, the most, need no pattern: a closed cell stays closed, an open one open
    has = F.contains(F.col("value"), F.lit('"'))
    opened = leaves_open(F.concat(F.lit('"'), F.col("value")), sep)
    return lines.withColumns({"__s": has & leaves_open(F.col("value"), sep), "__q": ~has | opened})


def states(s: np.ndarray, q: np.ndarray, entry: bool) -> tuple[np.ndarray, bool]:
    """Whether a cell is open before each line, and after the last."""
    n = len(s)
    if not n:
        return np.zeros(0, dtype=bool), entry
    last = np.maximum.accumulate(np.where(s == q, np.arange(n), -1))   # the last line whose outcome hangs on nothing before it
    swaps = np.cumsum(s & ~q)
    known = last >= 0
    base = np.where(known, s[last], entry)
    after = base ^ ((swaps - np.where(known, swaps[last], 0)) % 2 == 1)
    return np.concatenate(([entry], after[:-1])), bool(after[-1])


def _runs(file: list, block: list):
    """Bounds of runs of lines of one split."""
    a = 0
    for i in range(1, len(file) + 1):
        if i == len(file) or block[i] != block[a] or file[i] != file[a]:
            yield a, i
            a = i


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def summarise(batches):
    key, lines, ends = None, 0, {}

    def row():
        (a, b) = ends[False], ends[True]
        return [*key, lines, *a, *b]

    def out(rows):
        names = [c.split()[0] for c in SUMMARY.split(", ")]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for b in batches:
        file, block = _column(b, "__file").to_pylist(), _column(b, "__block").to_pylist()
        s, q = (_column(b, c).to_numpy(zero_copy_only=False).astype(bool) for c in ("__s", "__q"))
        done = []
        for a, z in _runs(file, block):
            if key != (file[a], block[a]):
                if key is not None:
                    done.append(row())
                key, lines, ends = (file[a], block[a]), 0, {False: (False, 0, -1), True: (True, 0, -1)}
            for entry, (open_, records, last) in list(ends.items()):
                before, open_ = states(s[a:z], q[a:z], open_)
                begins = np.flatnonzero(~before)
                ends[entry] = (open_, records + len(begins), lines + int(begins[-1]) if len(begins) else last)
            lines += z - a
        if done:
            yield out(done)
    if key is not None:
        yield out([row()])


def split_summaries(lines: DataFrame) -> DataFrame:
    """One row per split (see SUMMARY) of lines with ``__file``, ``__block``, ``__s`` and ``__q`` in scan order."""
    return lines.select("__file", "__block", "__s", "__q").mapInArrow(summarise, SUMMARY)


def file_facts(splits: list[dict]) -> list[tuple]:
    """Facts of the splits of one file, in order."""
    entry, first, known = False, 0, []
    for p in splits:
        open_, records, last = (p["q_open"], p["q_records"], p["q_last"]) if entry else (p["s_open"], p["s_records"], p["s_last"])
        known.append([p, entry, first, None, open_, records, last])
        entry, first = open_, first + records
    if entry:   # the last quote never closes
        at = max(i for i, k in enumerate(known) if k[5])
        p, before, first, _, _, records, last = known[at]
        known[at] = [p, before, first, last, False, records + p["lines"] - 1 - last, last]
        first += known[at][5]
        for i in range(at + 1, len(known)):
            p = known[i][0]
            known[i] = [p, False, first, 0, False, p["lines"], 0]
            first += p["lines"]
    return [(p["file"], p["block"], before, first, plain, bool(before or open_)) for p, before, first, plain, open_, _, _ in known]


def fold(batches):
    held: list[dict] = []

    def out(rows):
        types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[c.split()[0] for c in FACTS.split(", ")])

    for b in batches:
        for p in b.to_pylist():
            if held and held[0]["file"] != p["file"]:
                yield out(file_facts(held))
                held = []
            held.append(p)
    if held:
        yield out(file_facts(held))


def split_facts(summaries: DataFrame) -> DataFrame:
    """Entry, first record and way of reading of every split (see FACTS)."""
    return summaries.repartition("file").sortWithinPartitions("file", "block").mapInArrow(fold, FACTS)


def cut(batches):
    key, now, open_, line, first, plain_from = None, None, False, 0, 0, None
    begun = 0
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def closed(whole):
        """The record that has been read: (source_file, file, number, text, plain, part)."""
        number, parts, plain, continued = now
        return (key[2], key[0], number, "\n".join(parts), plain, key[1] if continued or not whole else None)

    for b in batches:
        file, block, source = (_column(b, c).to_pylist() for c in ("__file", "__block", "source_file"))
        s, q = (_column(b, c).to_numpy(zero_copy_only=False).astype(bool) for c in ("__s", "__q"))
        entry, value = _column(b, "entry"), _column(b, "value")
        rows: list[tuple] = []
        for a, z in _runs(file, block):
            if key is None or key[:2] != (file[a], block[a]):
                if now is not None:
                    rows.append(closed(not open_))
                if not entry[a].is_valid:
                    raise RuntimeError(f"the splits of {file[a]} have changed since they were first scanned; read it again")
                key, now, line, begun = (file[a], block[a], source[a]), None, 0, 0
                open_, first, plain_from = entry[a].as_py(), _column(b, "first")[a].as_py(), _column(b, "plain_from")[a].as_py()
                if open_:
                    now = (first - 1, [], False, True)
            n = z - a
            plain = n if plain_from is None else min(max(plain_from - line, 0), n)
            before, open_ = states(s[a : a + plain], q[a : a + plain], open_)
            if plain < n:
                before, open_ = np.concatenate([before, np.zeros(n - plain, dtype=bool)]), False
            texts = value.slice(a, n).to_pylist()
            starts = np.flatnonzero(~before).tolist()
            if starts and starts[0] == 0 and now is not None or starts and now is not None:
                now[1].extend(texts[: starts[0]])
                rows.append(closed(True))
                now = None
            elif now is not None:
                now[1].extend(texts)
            for i, at in enumerate(starts):
                end = starts[i + 1] if i + 1 < len(starts) else n
                record = (first + begun, texts[at:end], at >= plain, False)
                begun += 1
                if i + 1 < len(starts):
                    now = record
                    rows.append(closed(True))
                    now = None
                else:
                    now = record
            line += n
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(closed(not open_), strict=True), types, strict=True)], names=names)


def with_facts(lines: DataFrame, facts: DataFrame, splits: int) -> DataFrame:
    """Every line with the facts of its split, the lines of a split in order."""
    known = facts.select(F.col("file").alias("__file"), F.col("block").alias("__block"), "entry", "first", "plain_from", "crosses")
    if splits <= BROADCAST_SPLITS:
        return lines.join(F.broadcast(known), ["__file", "__block"], "left")
    return lines.join(known, ["__file", "__block"], "left").sortWithinPartitions("__file", "__block", "__id")


def cut_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``(source_file, __file, row_idx, value, plain)`` of every record of lines with ``source_file``, ``__file`` (path), ``__block``
    (split), ``__id`` (order in the split) and ``value``.  Runs the first scan at once; its rows, one a split, go to the shared folder."""
    spark = lines.sparkSession
    coded = with_functions(lines, sep)
    path = shared_path(spark, "aulastar-splits", uuid.uuid4().hex)
    split_facts(split_summaries(coded)).write.parquet(path)
    remove_at_exit(spark, path)
    facts = spark.read.schema(FACTS).parquet(path)
    counted = facts.agg(F.count(F.lit(1)).alias("n"), F.count_if("crosses").alias("open")).first()

    def cuts(rows):
        return with_facts(rows, facts, counted["n"]).select("source_file", "__file", "__block", "value", "__s", "__q", "entry", "first", "plain_from").mapInArrow(cut, RECORDS)

    whole = cuts(coded).filter(F.col("part").isNull())
    columns = ["source_file", "__file", "row_idx", "value", "plain"]
    if not counted["open"]:
        return whole.select(*columns)
    some = facts.filter("crosses").select(F.col("file").alias("__file"), F.col("block").alias("__block"))
    across = F.broadcast(some) if counted["open"] <= BROADCAST_SPLITS else some
    parts = cuts(coded.join(across, ["__file", "__block"], "left_semi")).filter(F.col("part").isNotNull())
    pieces = parts.groupBy("source_file", "__file", "row_idx").agg(F.array_sort(F.collect_list(F.struct("part", "value"))).alias("pieces"))
    joined = pieces.select("source_file", "__file", "row_idx", F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"), F.lit(False).alias("plain"))
    return whole.select(*columns).unionByName(joined)


def cut_heads(rows: int):
    """The first ``rows`` records of every file, from lines of files that are each one partition: nothing is read beyond them."""
    def run(batches):
        for b in cut(_until(batches, rows)):
            keep = (_column(b, "row_idx").to_numpy() < rows) & ~_column(b, "part").is_valid().to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(keep))

    def _until(batches, rows):
        """Lines up to the one that closes the last record wanted."""
        key, open_, begun = None, False, 0
        for b in batches:
            file, block = _column(b, "__file").to_pylist(), _column(b, "__block").to_pylist()
            s, q = (_column(b, c).to_numpy(zero_copy_only=False).astype(bool) for c in ("__s", "__q"))
            for a, z in _runs(file, block):
                if key != file[a]:
                    key, open_, begun = file[a], False, 0
                before, open_ = states(s[a:z], q[a:z], open_)
                begun += int((~before).sum())
            n = b.num_rows
            yield b.append_column("entry", pa.array(np.zeros(n, dtype=bool))).append_column("first", pa.array(np.zeros(n, dtype=np.int64))).append_column("plain_from", pa.nulls(n, pa.int64()))
            if begun > rows:
                return
    return run


def split_cells(record: Column, sep: str = ",", plain: Column | None = None) -> Column:
    """The cells of a record: what quotes enclose, doubled quotes as one, then what follows the closing quote; quotes elsewhere are text, as
    all are in a ``plain`` record.  The reader's missing-value tokens are null."""
    s = re.escape(sep)
    raw = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(rf'{s}({_quoted()}"[^{s}]*+|[^{s}]*+)'), F.lit(1))
    inside = lambda x: F.regexp_extract(x, rf'\A"([^"]*+(?:""[^"]*+)*+)"', 1)
    closes = lambda x: x.rlike(rf'\A{_quoted()}"')
    cell = lambda x: F.when(x.startswith('"') & closes(x), F.concat(
        F.replace(inside(x), F.lit('""'), F.lit('"')), F.substring(x, F.length(inside(x)) + 3, F.length(x)))).otherwise(x)
    cells = F.transform(raw, cell)
    if plain is not None:
        cells = F.when(plain, F.split(record, s, -1)).otherwise(cells)
    return F.transform(cells, lambda x: F.when(x.isin(list(READER_NULLS)), F.lit(None).cast("string")).otherwise(x))
