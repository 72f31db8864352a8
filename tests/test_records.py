"""Delimited records against a plain state machine, over splits of any size."""

import os
import random
import time

import pytest

from aulastar.sources import records as R
from aulastar.sources.grid import read_csv_grid


def machine(lines, sep=","):
    """The four states, character by character: a list of records, each a list of cells."""
    def read(lines, quotes=True):
        out, cells, cell, state, begun = [], [], "", "start", 0
        for i, line in enumerate(lines):
            if state != "quoted":
                cells, cell, state, begun = [], "", "start", i
            for c in line:
                if state == "start" and c == '"' and quotes:
                    state = "quoted"
                elif state == "quoted":
                    if c == '"':
                        state = "quote"
                    else:
                        cell += c
                elif state == "quote" and c == '"':
                    cell, state = cell + '"', "quoted"
                elif c == sep:
                    cells, cell, state = [*cells, cell], "", "start"
                else:
                    cell, state = cell + c, "plain"
            if state == "quoted":
                cell += "\n"
            else:
                out.append([*cells, cell])
                state = "end"
        return out, begun if state == "quoted" else None

    out, lost = read(lines)
    return out if lost is None else [*out, *read(lines[lost:], quotes=False)[0]]


def trimmed(cells):
    cells = [None if c in R.READER_NULLS else c for c in cells]
    while cells and cells[-1] is None:
        cells.pop()
    return cells


ODD = ['a,b', '5" pipe,x', '"abc"def,1', '"a, ""b""",2', '"two', 'lines",3', '""', '"""",q', '', ',,', 'x,"y"z"w,4', '"no"', '"open ""', 'still,"', 'a,"b', '",c', 'x"y"', '"","",""', "'single', \"q\"", '"a"b"c",d', ' "lead",e']


@pytest.mark.parametrize("seed", range(200))
def test_functions_compose_as_the_machine(seed):
    rng = random.Random(seed)
    lines = ["".join(rng.choice('ab,""') for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(1, 12))]
    import re
    pattern = re.compile(r'\A(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+\Z')
    s = [bool(pattern.match(x)) for x in lines]
    q = [bool(pattern.match('"' + x)) for x in lines]
    import numpy as np
    for entry in (False, True):
        before, after = R.states(np.array(s), np.array(q), entry)
        state, want = entry, []
        for a, b in zip(s, q):
            want.append(state)
            state = b if state else a
        assert before.tolist() == want and after == state
    cut = rng.randint(0, len(lines))
    whole, parts = R.states(np.array(s), np.array(q), False), R.states(np.array(s[:cut], dtype=bool), np.array(q[:cut], dtype=bool), False)
    assert R.states(np.array(s[cut:], dtype=bool), np.array(q[cut:], dtype=bool), parts[1])[1] == whole[1]


@pytest.fixture(params=["64m", "150", "700"])
def split_bytes(spark, request):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_records_as_the_machine(spark, tmp_root, split_bytes):
    rng, files = random.Random(split_bytes), {}
    for k in range(6):
        files[f"f{k}.csv"] = [rng.choice(ODD) for _ in range(rng.randint(1, 70))]
    files["calm.csv"] = [f"{i},x{i}" for i in range(40)]
    files["never.csv"] = ["a,b", '"c,d', "e,f", 'g,"h', "i,j"] * 1 + [f"{i},5\" pipe" for i in range(40)]
    files["wide.csv"] = ['"' + "\n".join(f"line {i}" for i in range(60)) + '",end', "1,2"]
    files["bom.csv"] = ["﻿a,b", "1,2"]
    files["blank.csv"] = ["", "", '"', '"', ""]
    src = os.path.join(tmp_root, "odd")
    os.makedirs(src)
    for name, lines in files.items():
        with open(os.path.join(src, name), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    open(os.path.join(src, "empty.csv"), "w").close()
    got = {}
    for r in read_csv_grid(spark, src).collect():
        got.setdefault(r.source_file, {})[r.row_idx] = r.cells
    assert set(got) == set(files)
    for name, lines in files.items():
        flat = "\n".join(lines).removeprefix("﻿").split("\n")
        assert [got[name][i] for i in range(len(got[name]))] == [trimmed(c) for c in machine(flat)], name


def test_many_splits_take_the_other_join(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_SPLITS", 0)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "120")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        src = os.path.join(tmp_root, "many")
        os.makedirs(src)
        lines = [random.Random(i).choice(ODD) for i in range(300)]
        with open(os.path.join(src, "m.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
        got = {r.row_idx: r.cells for r in read_csv_grid(spark, src).collect()}
        assert [got[i] for i in range(len(got))] == [trimmed(c) for c in machine(lines)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_line_is_sorted_or_shuffled(spark, tmp_root):
    src = os.path.join(tmp_root, "plan")
    os.makedirs(src)
    with open(os.path.join(src, "p.csv"), "w") as f:
        f.write('a,"b\nc",5" pipe\n' * 50)
    plan = read_csv_grid(spark, src)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("text", ['"' * 200_001, 'x,"' + "a" * 300_000, ",".join(['"a""b"c'] * 40_000), ',"' * 100_000, '"a"b' * 80_000])
def test_long_lines_take_linear_time(spark, tmp_root, text):
    src = os.path.join(tmp_root, "long")
    os.makedirs(src)
    with open(os.path.join(src, "l.csv"), "w") as f:
        f.write(text + "\n1,2\n")
    t = time.time()
    got = [r.cells for r in read_csv_grid(spark, src).orderBy("row_idx").collect()]
    assert got == [trimmed(c) for c in machine(text.split("\n") + ["1,2"])] and time.time() - t < 30


def test_heads_are_read_without_the_rest(spark, tmp_root):
    from aulastar.sources.grid import read_csv_head
    rng, src = random.Random(4), os.path.join(tmp_root, "heads")
    os.makedirs(src)
    files = {f"h{k}.csv": [rng.choice(ODD) for _ in range(rng.randint(1, 60))] for k in range(5)} | {"big.csv": [f"{i},x,{i}" for i in range(400_000)], "none.csv": []}
    for name, lines in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
    head = read_csv_head(spark, src, 20)
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Aggregate", "Join", "Window", "Sort", "Exchange"))
    got = {}
    for r in head.collect():
        got.setdefault(r.source_file, {})[r.row_idx] = r.cells
    whole = {}
    for r in read_csv_grid(spark, src).filter("row_idx < 20").collect():
        whole.setdefault(r.source_file, {})[r.row_idx] = r.cells
    assert set(got) == set(whole) and got["big.csv"] == whole["big.csv"]
    for name in whole:   # a head may end before a record that never closes
        assert all(whole[name][i] == c for i, c in got[name].items()) and len(got[name]) >= len(whole[name]) - 12, name
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 40)
