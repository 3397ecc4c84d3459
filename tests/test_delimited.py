"""Reading delimited files: headers, widths, quotes, blanks, gzip; checked against pandas."""

import io
import math
import random

import pandas as pd
import pytest

from sluice.functions.contract import Contract
from sluice.functions.parsing import NULL_TOKENS
from sluice.sources.delimited import read_delimited, read_header

AB = Contract.of({"a": "bigint", "b": "string"})


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", ["f.csv", "f.csv.gz"])
def test_types_and_blank_lines(spark, put, name):
    df = read_delimited(spark, put(name, "a,b\n1,x\n\n   \n2,y\n\t\n"), AB)
    assert df.dtypes == [("a", "bigint"), ("b", "string")]
    assert rows(df) == [(1, "x"), (2, "y")]


def test_quotes(spark, put):
    text = 'a,b\n1,"x, ""y"""\n2,"line\nbreak"\n'
    assert rows(read_delimited(spark, put("q.csv.gz", text), AB)) == [(1, 'x, "y"'), (2, "line\nbreak")]
    assert rows(read_delimited(spark, put("q.csv", text), AB, multi_line=True)) == [(1, 'x, "y"'), (2, "line\nbreak")]


def test_columns_bind_by_name_in_every_file(spark, put):
    one, two = put("d/1.csv", "a,b\n1,x\n"), put("d/2.csv", "b,a\ny,2\n")
    assert sorted(rows(read_delimited(spark, [one, two], AB))) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("gz", ["", ".gz"])
def test_another_header_fails_when_only_the_first_is_read(spark, put, gz):
    put(f"d/1.csv{gz}", "a,b\n1,x\n")
    put(f"d/2.csv{gz}", "b,a\ny,2\n")
    folder = put("d/_note", "").rsplit("/", 1)[0]
    with pytest.raises(Exception, match="(?s)header does not conform|FAILED_READ_FILE"):
        read_delimited(spark, folder, AB, headers="first").collect()
    assert sorted(rows(read_delimited(spark, folder, AB))) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("name", ["w.csv", "w.csv.gz"])
def test_short_rows_are_padded(spark, put, name):
    df = read_delimited(spark, put(name, "a,b,c\n1\n2,x\n3,x,y\n"), AB)
    assert rows(df) == [(1, None, None), (2, "x", None), (3, "x", "y")]


@pytest.mark.parametrize("name", ["w.csv", "w.csv.gz"])
@pytest.mark.parametrize("line", ["1,x,y", "1,x,", '1,"x,y",z', "1,x,,,"])
def test_long_rows_fail(spark, put, name, line):
    with pytest.raises(Exception, match="expected 2 fields, saw"):
        read_delimited(spark, put(name, f"a,b\n1,x\n{line}\n"), AB).collect()


def test_width_of_records_that_are_read_in_part(spark, put):
    path = put("w.csv", "a,b\n1,x,y\n")
    narrow = read_delimited(spark, path, AB, multi_line=False, whole_records=False)
    assert rows(narrow.select("a")) == [(1,)]
    with pytest.raises(Exception, match="expected 2 fields"):
        read_delimited(spark, path, AB).select("a").collect()


def test_quoted_commas_do_not_count_as_fields(spark, put):
    df = read_delimited(spark, put("w.csv", 'a,b,c\n1,"p,q,r,s"\n'), AB)
    assert rows(df) == [(1, "p,q,r,s", None)]


def test_undeclared_columns_are_text_and_missing_ones_left_out(spark, put):
    df = read_delimited(spark, put("u.csv", "a,z\n1,007\n"), AB)
    assert df.dtypes == [("a", "bigint"), ("z", "string")] and rows(df) == [(1, "007")]


def test_missing_timestamp_column_is_an_error(spark, put):
    with pytest.raises(ValueError, match="t"):
        read_delimited(spark, put("m.csv", "a,b\n1,x\n"), Contract.of({}, ["t"]))


def test_header_only_file_has_columns_and_no_rows(spark, put):
    df = read_delimited(spark, put("h.csv.gz", "a,b\n"), AB)
    assert df.columns == ["a", "b"] and df.count() == 0


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_delimited(spark, str(tmp_path / "none.csv"), AB)


def test_header_names(spark, put):
    assert read_header(spark, put("n.csv", '\ufeffa,"b, c",,a\n')) == ["a", "b, c", "Unnamed: 2", "a.1"]
    df = read_delimited(spark, put("n2.csv", "a,a.b,a\n1,2,3\n"), AB)
    assert df.columns == ["a", "a.b", "a.1"] and rows(df) == [(1, "2", "3")]


def test_paths_with_spaces_and_glob_characters(spark, put):
    one, two = put("a b/x [1].csv", "a,b\n1,x\n"), put("a b/y{2}.csv", "b,a\ny,2\n")
    folder = one.rsplit("/", 1)[0]
    assert sorted(rows(read_delimited(spark, folder, AB))) == [(1, "x"), (2, "y")]
    assert two


def test_error_names_the_file_that_holds_the_cell(spark, put):
    put("e/good.csv", "a,b\n1,x\n")
    folder = put("e/bad.csv", "a,b\noops,x\n").rsplit("/", 1)[0]
    with pytest.raises(Exception, match="column a: 'oops' is not a 64-bit integer .*bad.csv"):
        read_delimited(spark, folder, AB).collect()


def random_csv(seed: int, n: int) -> str:
    """Rows of ints, doubles, text, timestamps, with tokens, odd number forms, short rows and quotes."""
    pick = random.Random(seed)
    ints = lambda: pick.choice([str(pick.randint(-(10**6), 10**6)), f"{pick.randint(0, 99)}.0", f"+{pick.randint(0, 9)}", " 7 ", "1e3"])
    doubles = lambda: pick.choice([repr(pick.uniform(-1e6, 1e6)), f"{pick.random():.3e}", "inf", "-Infinity", "+.5", str(pick.randint(0, 9))])
    words = lambda: "".join(pick.choice('ab "\n,é ') for _ in range(pick.randint(1, 6)))
    times = lambda: f"20{pick.randint(10, 29)}-{pick.randint(1, 12):02d}-{pick.randint(1, 28):02d} {pick.randint(0, 23):02d}:{pick.randint(0, 59):02d}:07"
    lines = ["i,d,s,t,e"]
    for k in range(n):
        cells = [ints(), doubles(), words(), times(), str(k)]
        cells = [pick.choice(NULL_TOKENS) if pick.random() < 0.1 else c for c in cells[:4]] + cells[4:]
        cells = ['"' + c.replace('"', '""') + '"' if any(x in c for x in '"\n,') else c for c in cells]
        lines.append(",".join(cells[:4] if pick.random() < 0.1 else cells))
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("name", ["r.csv", "r.csv.gz"])
def test_same_cells_as_pandas(spark, put, seed, name):
    text = random_csv(seed, 2000)
    contract = Contract.of({"i": "Int64", "d": "float64", "s": "string", "e": "Int64"}, ["t"])
    expected = pd.read_csv(io.StringIO(text), dtype={"i": "Int64", "d": "float64", "s": "string", "e": "Int64"}, parse_dates=["t"])
    got = read_delimited(spark, put(name, text), contract, multi_line=True).collect()
    assert len(got) == len(expected) == 2000

    def same(ours, theirs):
        if ours is None or pd.isna(theirs):
            return ours is None and pd.isna(theirs)
        if isinstance(ours, float):
            return ours == theirs or math.isclose(ours, theirs, rel_tol=1e-9)
        return ours == theirs

    wrong = [
        (k, c, r[c], expected[c].iloc[k]) for k, r in enumerate(got) for c in "idste" if not same(r[c], expected[c].iloc[k])
    ]
    assert wrong == []
