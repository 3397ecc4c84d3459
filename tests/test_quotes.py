"""Quoted line ends: states of lines, files read in many splits, quotes that are never closed."""

import gzip
import io
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.functions.contract import Contract
from sluice.operators import rowindex
from sluice.sources import quotes
from sluice.sources.delimited import ROW, read_delimited

KV = Contract.of({"k": "bigint", "v": "string", "w": "string"})


def walked(line, inside):
    """The state behind a line, character by character."""
    at_start, i = True, 0
    while i < len(line):
        c = line[i]
        if inside:
            if c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    inside = False
        elif c == '"' and at_start:
            inside, at_start = True, False
        else:
            at_start = c == ","
        i += 1
    return inside


def test_states_of_lines(spark):
    rng = random.Random(1)
    lines = ["", '"', '""', '"""', 'a,"b', 'a",b', 'x,""', '"a"b,"c', '"a""', ',"', '" ,"'] + ["".join(rng.choice('a,""') for _ in range(rng.randrange(9))) for _ in range(600)]
    # a cell that goes on behind its closing quote ends at the next comma, whatever quotes it holds
    frame = spark.createDataFrame([(x,) for x in lines], "t string")
    found = frame.select("t", quotes.ends_inside(F.col("t"), False), quotes.ends_inside(F.col("t"), True), quotes.effect(F.col("t"))).collect()
    odd = [(t, a, b) for t, a, b, _ in found if '""' not in t.replace('"""', "") and (a, b) != (walked(t, False), walked(t, True))]
    assert odd == []
    assert all(e == a + 2 * b for _, a, b, e in found)


def test_composition_is_that_of_one_line_after_the_other():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30):
        for _ in range(50):
            effects = rng.integers(0, 4, n).astype(np.int8)
            for state in (0, 1):
                want, now = [], state
                for e in effects:
                    now = int(e) >> now & 1
                    want.append(now)
                assert quotes.states_after(effects, state).tolist() == want


def text_of(n, seed, wide=3):
    pick = random.Random(seed)
    words = lambda: "".join(pick.choice('ab "\n,é\n') for _ in range(pick.randint(0, pick.choice([3, 40 * wide]))))
    out = ["k,v,w"]
    for k in range(n):
        cells = [str(k), *[words() for _ in range(pick.choice([1, 2, 2, 2]))]]
        out.append(",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in '"\n, ') else c for c in cells))
        if pick.random() < 0.05:
            out.append(pick.choice(["", "  "]))
    return "\n".join(out) + "\n"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("split", [2_000, 9_000, 10_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_rows_however_the_file_is_split(spark, put, setting, split, seed):
    text = text_of(2500, seed)
    expected = pd.read_csv(io.StringIO(text), dtype={"v": str, "w": str}, keep_default_na=False)
    packed = put("one.csv.gz", text)
    whole = rows(read_delimited(spark, packed, KV))
    assert [r[0] for r in whole] == list(expected.k)
    path = put("many.csv", text)
    setting("spark.sql.files.maxPartitionBytes", str(split))
    df = read_delimited(spark, path, KV)
    assert rows(df) == whole
    if split < 10_000_000:
        assert df.rdd.getNumPartitions() > 1
    numbered = rowindex.read_indexed(spark, path, KV)
    assert numbered.count() == 2500 and numbered.where("index <> k").count() == 0
    assert rows(numbered.drop("index")) == whole


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_cell_longer_than_many_splits(spark, put, setting, end):
    setting("spark.sql.files.maxPartitionBytes", "500")
    cell = "\n".join(f"line {i}" for i in range(2000))
    text = end.join(["k,v,w", "0,a,b", f'1,"{cell}",c', '2,"x ""y""",', f'3,"{cell}"', "4,d,e"]) + end
    want = [(0, "a", "b"), (1, cell, "c"), (2, 'x "y"', None), (3, cell, None), (4, "d", "e")]
    assert rows(read_delimited(spark, put("l.csv", text), KV)) == want
    assert rows(rowindex.read_indexed(spark, put("l.csv", text), KV)) == [(r[0], *r) for r in want]


def test_a_heading_longer_than_a_split(spark, put, setting):
    setting("spark.sql.files.maxPartitionBytes", "300")
    names = [f"n{i}\nof {i}" for i in range(100)]
    text = ",".join(f'"{n}"' for n in names) + "\n" + "".join(",".join(f"{i}" for _ in names) + "\n" for i in range(20))
    df = read_delimited(spark, put("h.csv", text), Contract.of({}))
    assert df.columns == names and sorted(int(r[0]) for r in df.collect()) == list(range(20))


@pytest.mark.parametrize("text", ['a,b\n1,"x\n2,y\n3,z\n', 'a,b\n1,x\n2,"y"\n"', 'a,b\n1,"x\ny"\n2,"\n'])
@pytest.mark.parametrize("pack", [False, True])
def test_a_quote_that_is_never_closed_fails(spark, tmp_path, text, pack):
    path = tmp_path / ("u.csv.gz" if pack else "u.csv")
    path.write_bytes(gzip.compress(text.encode()) if pack else text.encode())
    for multi_line in (None, True, False):
        with pytest.raises(ValueError, match="never closed"):
            read_delimited(spark, str(path), Contract.of({}), multi_line=multi_line)


def test_quotes_within_cells_are_text(spark, put, setting):
    text = 'k,v,w\n1,5" pipe,6" pipe\n2,a"b,c\n3,"x"y,z\n'
    want = [(1, '5" pipe', '6" pipe'), (2, 'a"b', "c"), (3, '"x"y', "z")]
    assert rows(read_delimited(spark, put("s.csv", text), KV)) == want == rows(read_delimited(spark, put("s.csv.gz", text), KV))


def test_carriage_returns_within_lines(spark, put):
    assert rows(read_delimited(spark, put("r.csv", 'k,v,w\n1,"a\rb",c\n2,d,e\n'), KV)) == [(1, "a\rb", "c"), (2, "d", "e")]
    assert rows(read_delimited(spark, put("m.csv", "k,v,w\r1,a,b\r2,c,d\r"), KV)) == [(1, "a", "b"), (2, "c", "d")]


def test_files_of_every_kind_together(spark, put, setting):
    setting("spark.sql.files.maxPartitionBytes", "2000")
    put("d/1.csv", text_of(300, 1))
    put("d/2.csv.gz", text_of(200, 2))
    put("d/3.csv", "w,v,k\n" + "".join(f"x,y,{i}\n" for i in range(50)))
    folder = put("d/4.csv", "k,v,w\n1,plain,x\n").rsplit("/", 1)[0]
    df = read_delimited(spark, folder, KV)
    assert sorted(r.k for r in df.collect()) == sorted([*range(300), *range(200), *range(50), 1])
    numbered = rowindex.read_indexed(spark, folder, KV, {})
    assert sorted(r["index"] for r in numbered.collect()) == list(range(551))


def test_other_splits_than_surveyed_give_the_same_records(spark, put, setting):
    """States are looked up by place in the file, so a reading may be split otherwise than the survey was."""
    path = put("o.csv", text_of(400, 5))
    setting("spark.sql.files.maxPartitionBytes", "3000")
    known = quotes.survey(spark, [path])
    one = quotes.records(spark, [path], known).select("record").collect()
    assert len(one) == 400


def test_no_job_for_each_file(spark, put):
    for i in range(40):
        folder = put(f"n/{i:03d}.csv", f"k,v,w\n{i},a,b\n").rsplit("/", 1)[0]
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    sc.setJobGroup("count jobs", "")
    assert read_delimited(spark, folder, KV).count() == 40
    jobs = len(tracker.getJobIdsForGroup("count jobs"))
    sc.setJobGroup("", "")
    assert 0 < jobs < 12


def test_settings_are_put_back(spark, put):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes", None)
    read_delimited(spark, put("b.csv", "k,v,w\n1,a,b\n"), KV).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes", None) == before
    assert ROW == "__row"
