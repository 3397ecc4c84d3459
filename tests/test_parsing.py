"""Cell parsing: null tokens, whole numbers, doubles, timestamps."""

import math
import re
from datetime import datetime

import pytest

from sluice.functions.contract import TRIPS, Contract
from sluice.functions.parsing import ISO_FORMS, NULL_TOKENS
from sluice.sources.delimited import read_delimited


def one_cell(spark, put, kind, text, pattern=None):
    path = put("cell.csv.gz", f'k,x\n1,"{text}"\n')
    contract = Contract.of({"k": "bigint"}, {"x": pattern}) if kind == "timestamp" else Contract.of({"k": "bigint", "x": kind})
    return read_delimited(spark, path, contract).first().x


@pytest.mark.parametrize("kind", ["Int64", "float64", "string", "timestamp"])
def test_all_null_tokens_in_every_type(spark, put, kind):
    assert len(NULL_TOKENS) == 19
    path = put("tokens.csv", "k,x\n" + "".join(f"{i},{t}\n" for i, t in enumerate(NULL_TOKENS)))
    contract = Contract.of({"k": "bigint"}, ["x"]) if kind == "timestamp" else Contract.of({"k": "bigint", "x": kind})
    rows = read_delimited(spark, path, contract).collect()
    assert [r.k for r in rows] == list(range(19))
    assert all(r.x is None for r in rows)


def test_text_is_not_trimmed_before_the_token_test(spark, put):
    path = put("t.csv", "x,y\n NA,1\nNA ,2\n NULL,3\n")
    rows = read_delimited(spark, path, Contract.of({"x": "string"})).collect()
    assert [r.x for r in rows] == [" NA", "NA ", " NULL"]


@pytest.mark.parametrize(
    "text,value",
    [
        ("1.0", 1), ("1.", 1), ("1e3", 1000), ("+1", 1), ("-0", 0), (" 7 ", 7), ("-12.000", -12), ("1.5e1", 15),
        ("9223372036854775807", 2**63 - 1), ("-9223372036854775808", -(2**63)), ("9223372036854775807.0", 2**63 - 1),
    ],
)
def test_whole_number_forms(spark, put, text, value):
    assert one_cell(spark, put, "Int64", text) == value


@pytest.mark.parametrize("text", ["1.5", "x", "true", "0x10", "1_000", "1e25", "9223372036854775808", "1d", "1 2", "inf", "٣.0"])
def test_not_a_whole_number_fails_and_names_the_cell(spark, put, text):
    with pytest.raises(Exception, match="column x") as failure:
        one_cell(spark, put, "Int64", text)
    assert text in str(failure.value) and "cell.csv" in str(failure.value)


@pytest.mark.parametrize(
    "text,value",
    [
        ("inf", math.inf), ("-Infinity", -math.inf), ("+INF", math.inf), ("1e3", 1000.0), ("+.5", 0.5),
        (" 2 ", 2.0), ("1.", 1.0), ("-0.25", -0.25), ("1E-2", 0.01), (" 2", 2.0), ("12.5e2", 1250.0),
        ("9" * 308, float("9" * 308)), ("0" * 400 + "1", 1.0),
    ],
)
def test_double_forms(spark, put, text, value):
    assert one_cell(spark, put, "float64", text) == value


@pytest.mark.parametrize("text", ["1d", "1f", "1D", "0x1p3", "1e400", "-1e400", "true", "x", "NAN", "Nan", "1,5", "1d ", "0X1P3", "9" * 310, "1 2", "1_0", "--1", "٣"])
def test_not_a_double_fails(spark, put, text):
    with pytest.raises(Exception, match="column x: .* is not a number"):
        one_cell(spark, put, "float64", text)


@pytest.mark.parametrize(
    "text,value",
    [
        ("2021-01-01 00:30:10", datetime(2021, 1, 1, 0, 30, 10)),
        ("2021-01-01 00:30:10.5", datetime(2021, 1, 1, 0, 30, 10, 500000)),
        ("2021-01-01 00:30:10.000001", datetime(2021, 1, 1, 0, 30, 10, 1)),
    ],
)
def test_timestamps(spark, put, text, value):
    assert one_cell(spark, put, "timestamp", text) == value


@pytest.mark.parametrize(
    "text",
    ["2021-01-01T00:00:00Z", "2021-01-01T", "2021-01-01 00:00", "2021-01-01 00:00:00+02:00", "2021-02-30T00:00:00", "2021-02-30", "01/02/2021 03:04", "2021-13-01 00:00:00", "2021-02-30 00:00:00", "1", "2021-01-01 00:00:0 ", "2021-1-1 0:0:00 UTC", " 2021-01-01 00:00:00", "2021-01-01 00:00:00\n"],
)
def test_other_timestamp_forms_fail(spark, put, text):
    with pytest.raises(Exception, match="(?s)column x: .* is not a timestamp"):
        one_cell(spark, put, "timestamp", text)


FORMS = {
    "2021-03-04 05:06:07": datetime(2021, 3, 4, 5, 6, 7), "2021-03-04 05:06:07.25": datetime(2021, 3, 4, 5, 6, 7, 250_000),
    "2021-03-04T05:06:07": datetime(2021, 3, 4, 5, 6, 7), "2021-03-04T05:06:07.000001": datetime(2021, 3, 4, 5, 6, 7, 1),
    "2021-03-04": datetime(2021, 3, 4),
}


@pytest.mark.parametrize("mode", ["raise", "text"])
def test_each_column_has_a_form_of_its_own(spark, put, mode):
    a, b = put("f/a.csv", "n,s,t,d,none\n0,NA,,,\n1,,NA,2021-03-04,\n"), put("f/b.csv", "d,t,s,n,none\n2021-03-04,2021-03-04T05:06:07,2021-03-04 05:06:07,2,NA\n")
    df = read_delimited(spark, [a, b], Contract.of({"n": "bigint"}, ["s", "t", "d", "none"]), bad_timestamp=mode)
    assert set(dict(df.drop("n").dtypes).values()) == {"timestamp_ntz"}
    day, time = FORMS["2021-03-04"], FORMS["2021-03-04T05:06:07"]
    assert sorted(tuple(r) for r in df.select("n", "s", "t", "d", "none").collect()) == [(0, None, None, None, None), (1, None, None, day, None), (2, time, time, day, None)]


@pytest.mark.parametrize("text", FORMS)
@pytest.mark.parametrize("other", FORMS)
def test_a_column_of_two_forms_fails_or_stays_text(spark, put, text, other):
    path = put("m.csv", f"k,t\n1,\n2,{text}\n3,{other}\n")
    kept = read_delimited(spark, path, Contract.of({}, ["t"]), bad_timestamp="text")
    alike = [f for f in ISO_FORMS.values() if re.match(f.replace(r"\z", r"\Z"), text) and re.match(f.replace(r"\z", r"\Z"), other)]
    read = read_delimited(spark, path, Contract.of({}, ["t"])).select("t")
    if alike:
        assert [r.t for r in read.collect()] == [None, FORMS[text], FORMS[other]] == [r.t for r in kept.collect()]
    else:
        assert dict(kept.dtypes)["t"] == "string"
        with pytest.raises(Exception, match="is not a timestamp of the form"):
            read.collect()


def test_declared_timestamp_pattern(spark, put):
    assert one_cell(spark, put, "timestamp", "01/02/2021 03:04", "dd/MM/yyyy HH:mm") == datetime(2021, 2, 1, 3, 4)
    with pytest.raises(Exception, match="dd/MM/yyyy"):
        one_cell(spark, put, "timestamp", "2021-02-01 03:04:00", "dd/MM/yyyy HH:mm")


def test_local_times_do_not_depend_on_the_session_zone(spark, put, setting):
    setting("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there on this day
    assert one_cell(spark, put, "timestamp", "2021-03-14 02:30:00") == datetime(2021, 3, 14, 2, 30)
    assert one_cell(spark, put, "timestamp", "14/03/2021 02:30", "dd/MM/yyyy HH:mm") == datetime(2021, 3, 14, 2, 30)


def test_bad_timestamps_can_be_kept_as_text_for_the_whole_source(spark, put):
    a = put("d/a.csv", "t,u\n2021-01-01 00:00:00,2021-01-01 00:00:00\n")
    b = put("d/b.csv", "t,u\n2021-01-01,2021-01-02 00:00:00\nNA,NA\n")
    df = read_delimited(spark, [a, b], Contract.of({}, ["t", "u"]), bad_timestamp="text")
    assert dict(df.dtypes) == {"t": "string", "u": "timestamp_ntz"}
    assert sorted(str(r.t) for r in df.collect()) == ["2021-01-01", "2021-01-01 00:00:00", "None"]


@pytest.mark.parametrize("kind,text", [("Int64", "1.5"), ("Int64", "9223372036854775808"), ("float64", "1e400"), ("timestamp", "2021-13-01 00:00:00")])
def test_rules_hold_without_ansi_mode(spark, put, setting, kind, text):
    setting("spark.sql.ansi.enabled", "false")
    with pytest.raises(Exception, match="column x"):
        one_cell(spark, put, kind, text)
    assert one_cell(spark, put, "Int64", "1e3") == 1000 and one_cell(spark, put, "float64", "NA") is None


def test_trip_contract_has_the_declared_columns():
    assert len(TRIPS.types) == 16 and len(TRIPS.timestamps) == 2
    assert sorted(TRIPS.types.values()) == ["bigint"] * 6 + ["double"] * 9 + ["string"]


def test_unknown_type_name_is_refused():
    with pytest.raises(ValueError, match="decimal"):
        Contract.of({"x": "decimal"})
