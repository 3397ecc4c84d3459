"""Profiles against numpy and pandas."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.operators import profile
from sluice.operators.quantiles import summarize


def numbers(kind, n, seed):
    pick = random.Random(seed)
    if kind == "uniform":
        return [pick.uniform(-1e6, 1e6) for _ in range(n)]
    if kind == "hot":  # one value holds most rows, the rest is spread over many orders of magnitude
        return [7.0 if pick.random() < 0.6 else pick.choice([-1, 1]) * 10 ** pick.uniform(-300, 300) for _ in range(n)]
    if kind == "few":
        return [float(pick.randint(0, 3)) for _ in range(n)]
    return [5.0] * n


@pytest.mark.parametrize(
    "kind,accuracy,few_rows",
    [("uniform", 10_000, 20_000), ("uniform", 20, 0), ("hot", 10_000, 20_000), ("hot", 50, 10), ("few", 20, 0), ("same", 3, 0)],
)
def test_exact_whatever_the_approximation_proposes(spark, kind, accuracy, few_rows):
    data = numbers(kind, 601, seed=accuracy)
    df = spark.createDataFrame([(x,) for x in data], "x double").repartition(5)
    probabilities = (0.0, 0.25, 0.5, 0.993, 1.0)
    got = summarize(df, {"x": F.col("x")}, probabilities, accuracy=accuracy, few_rows=few_rows)["x"]
    assert got.n == 601 and got.min == min(data) and got.max == max(data)
    assert got.quantiles == pytest.approx(np.quantile(data, probabilities), rel=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_few_rows(spark, n):
    df = spark.range(n).select((F.col("id") * 3).alias("x"))
    row = profile.describe_numeric(df).first()
    expected = pd.Series(range(0, 3 * n, 3)).describe()
    assert (row.n, row.min, row.p25, row.p50, row.p75, row.max) == tuple(expected[["count", "min", "25%", "50%", "75%", "max"]])
    assert row["mean"] == expected["mean"] and (row["std"] is None if n == 1 else row["std"] == pytest.approx(expected["std"]))


def test_like_pandas_with_nulls_nan_and_text(spark):
    pdf = pd.DataFrame({"a": [1.5, None, 3.0, float("nan"), -2.0], "b": [1, 2, 3, 4, 1000], "s": list("vwxyz")})
    df = spark.createDataFrame(
        [(1.5, 1, "v"), (None, 2, "w"), (3.0, 3, "x"), (float("nan"), 4, "y"), (-2.0, 1000, "z")], "a double, b int, s string"
    )
    expected = pdf.describe()
    got = {r.column_name: r for r in profile.describe_numeric(df).collect()}
    assert sorted(got) == list(expected.columns)
    for c, r in got.items():
        ours = [r.n, r["mean"], r["std"], r.min, r.p25, r.p50, r.p75, r.max]
        assert ours == pytest.approx(list(expected[c]))


def test_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert tuple(profile.describe_numeric(df).first()) == ("x", 0, *[None] * 7)
    assert profile.describe_numeric(df.select(F.lit("t").alias("s"))).count() == 0


def test_big_whole_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([(2**62 + k,) for k in (0, 1, 2)], "x bigint")
    got = summarize(df, {"x": F.col("x")}, (0.0, 0.5, 1.0))["x"]
    assert got.quantiles == (2**62, 2**62 + 1, 2**62 + 2)


def test_timestamps_like_pandas(spark, setting):
    pick = random.Random(5)
    base = datetime(1969, 12, 1)
    times = [base + timedelta(microseconds=pick.randint(0, 10**14)) for _ in range(1001)] + [None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    expected = pd.Series(times, dtype="datetime64[ns]").describe()
    for zone in ("UTC", "America/New_York"):
        setting("spark.sql.session.timeZone", zone)
        row = profile.describe_timestamp(df).first()
        assert row.n == 1001
        for ours, theirs in zip((row["mean"], row.min, row.p25, row.p50, row.p75, row.max), list(expected)[1:]):
            assert abs(pd.Timestamp(ours) - theirs) <= pd.Timedelta(microseconds=1)


def test_approximate_form_is_one_pass_and_close(spark):
    df = spark.range(100_000).select(F.col("id").alias("x"))
    row = profile.describe_numeric(df, approx=True).first()
    assert abs(row.p50 - 50_000) <= 20 and row.n == 100_000


def test_row_count_and_types(spark):
    df = spark.range(12).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    assert profile.row_count(df).first().n == 12
    assert [tuple(r) for r in profile.column_types(df).collect()] == [("a", "bigint"), ("b", "string")]


def test_table_ddl(spark):
    df = spark.createDataFrame([], "VendorID bigint, ts timestamp_ntz, total double, flag string, order bigint")
    assert profile.table_ddl(df, "trips") == (
        '\nCREATE TABLE trips (\n\t"VendorID" BIGINT, \n\tts TIMESTAMP WITHOUT TIME ZONE, '
        '\n\ttotal FLOAT(53), \n\tflag TEXT, \n\t"order" BIGINT\n)\n\n'
    )
    with pytest.raises(ValueError, match="a"):
        profile.table_ddl(spark.createDataFrame([], "a array<int>"), "t")


def test_one_describe_over_numbers_and_timestamps(spark, tmp_path):
    """Nine columns need the scans that one needs, and give what each gives alone."""
    from sluice.operators import profile

    path = str(tmp_path / "rows")
    ts = F.timestamp_seconds(F.col("id") * 977 % 100_000).cast("timestamp_ntz")
    spark.range(50_000).select(*[((F.col("id") * p) % 30_011).alias(f"n{p}") for p in (3, 5, 7, 11)], *[(F.col("id") * p % 977 / 7).alias(f"d{p}") for p in (3, 5, 7, 11)], ts.alias("t")).write.parquet(path)
    df = spark.read.parquet(path)

    def jobs(action):
        group = f"describe {action}"
        spark.sparkContext.setJobGroup(group, "")
        found = action()
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("", "")
        return n, found

    n_all, whole = jobs(lambda: profile.describe(df))
    n_one = max(jobs(lambda c=c: profile.describe(df, [c]))[0] for c in ("n7", "d7", "t"))
    assert n_all <= n_one + 2
    assert sorted(map(tuple, whole.numbers.collect())) == sorted(map(tuple, profile.describe_numeric(df).collect()))
    assert whole.timestamps.collect() == profile.describe_timestamp(df).collect()
    assert whole.numbers.count() == 8 and whole.timestamps.count() == 1


def test_a_source_that_changes_between_scans_fails(spark):
    changing = spark.range(60_000).select(F.col("id").alias("x")).where("x < 9999 + unix_micros(current_timestamp()) % 50000")
    with pytest.raises(RuntimeError, match="changed between two scans"):
        summarize(changing, {"x": F.col("x")}, (0.5,), accuracy=50, few_rows=10)
