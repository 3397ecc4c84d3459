"""The ingest job end to end on synthetic trips, and its command line."""

import random

import pytest

from sluice.functions.contract import TRIPS
from sluice.plans import cli
from sluice.plans.jobs import IngestConfig, ingest, read_source, show_progress
from sluice.sinks import jdbc
from sluice.sources.delimited import read_delimited
from sluice.sources.months import TRIPS_FILE


def trips(n, seed=0):
    """A month file with the columns in another order than declared, and one more."""
    pick = random.Random(seed)
    names = [*TRIPS.timestamps, *TRIPS.types, "airport"]
    pick.shuffle(names)
    lines = [",".join(names)]
    for k in range(n):
        stamp = f"2021-01-{1 + k % 28:02d} {k % 24:02d}:00:{k % 60:02d}"
        cells = {"bigint": str(pick.randint(0, 300)), "double": f"{pick.uniform(-5, 90):.2f}", "string": pick.choice("YN")}
        row = ["7.5" if c == "airport" else stamp if TRIPS.kind(c) == "timestamp_ntz" else cells[TRIPS.kind(c)] for c in names]
        if pick.random() < 0.05:
            row[names.index("passenger_count")] = ""
        lines.append(",".join(row))
    return names, "\n".join(lines) + "\n"


@pytest.fixture
def month(put, tmp_path):
    names, text = trips(1234)
    put(TRIPS_FILE.format(year=2021, month=1), text)
    return names, str(tmp_path / TRIPS_FILE)


def test_month_load(spark, month, tmp_path, capsys):
    names, source = month
    cfg = IngestConfig(source=source, target_table="trips", target_dir=str(tmp_path / "t"), chunk_size=500)
    for _ in range(2):
        report = ingest(spark, cfg)
    assert report.rows == 1234 and spark.table("trips").count() == 1234
    assert spark.table("trips").columns == ["index", *names]
    assert dict(spark.table("trips").dtypes)["airport"] == "string"
    assert [r["index"] for r in spark.table("trips").orderBy("index").collect()] == list(range(1234))
    assert sorted(tuple(r) for r in report.chunks.collect()) == [(0, 500), (1, 500), (2, 234)]
    show_progress(report)
    assert capsys.readouterr().out.splitlines() == ["Table created", "Inserted: 500", "Inserted: 500", "Inserted: 234"]


def test_records_can_be_spread_before_they_are_typed(spark, month, tmp_path, capsys):
    cfg = IngestConfig(source=month[1], target_table="spread", target_dir=str(tmp_path / "t"), chunk_size=1000, writers=4)
    assert sorted(tuple(r) for r in ingest(spark, cfg).chunks.collect()) == [(0, 1000), (1, 234)]
    read_source(spark, cfg).explain()
    plan = capsys.readouterr().out
    exchange = plan.index("rangepartitioning")
    assert "transform" in plan[:exchange] and "transform" not in plan[exchange:].split("FileScan")[0]


def test_progress_is_told_while_the_load_runs(spark, month, tmp_path):
    told = []
    cfg = IngestConfig(source=month[1], target_table="watched", target_dir=str(tmp_path / "t"))
    ingest(spark, cfg, tell=lambda done, of: told.append((done, of)), every=0.01)
    assert told and all(0 <= done <= of for done, of in told)


def test_no_generated_code_of_trips_is_too_large(spark, month):
    """Spark logs and runs without generated code where a method or class would be too large."""
    import re

    for df in (read_delimited(spark, month[1].format(year=2021, month=1), TRIPS), read_source(spark, IngestConfig(source=month[1]))):
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert sizes and 0 < max(sizes) < 65535, sizes


def test_database_target_is_replaced_and_counted(spark, month, tmp_path, monkeypatch):
    """With a Parquet folder in place of the database, which may not be started here."""
    place, sent = str(tmp_path / "db"), []

    def write(df, connection, table, *, replace):
        sent.append((connection.url, table, replace))
        df.write.mode("overwrite").parquet(place)
        return df.count()

    monkeypatch.setattr(jdbc, "write_jdbc", write)
    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, connection, table, index, rows: spark.read.parquet(place))
    cfg = IngestConfig(source=month[1], target_table="trips", chunk_size=1000, connection=jdbc.Connection("u", "p"))
    report = ingest(spark, cfg)
    assert sent == [("jdbc:postgresql://localhost:5432/ny_taxi", "trips", True)]
    assert report.rows == 1234 and sorted(tuple(r) for r in report.chunks.collect()) == [(0, 1000), (1, 234)]

    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, connection, table, index, rows: spark.read.parquet(place, place))
    with pytest.raises(RuntimeError, match="grew by 2468"):
        ingest(spark, cfg)


def test_bad_cell_fails_the_load_and_keeps_the_table(spark, month, put, tmp_path):
    cfg = IngestConfig(source=month[1], target_table="guarded", target_dir=str(tmp_path / "t"))
    ingest(spark, cfg)
    header, *rows = trips(50)[1].splitlines()
    put(TRIPS_FILE.format(year=2021, month=1), "\n".join([header, *rows, "," * 30]) + "\n")
    with pytest.raises(Exception, match="expected 19 fields, saw 31"):
        ingest(spark, cfg)
    assert spark.table("guarded").count() == 1234


def test_header_only_month_leaves_an_empty_table(spark, put, tmp_path):
    put(TRIPS_FILE.format(year=2021, month=1), trips(0)[1])
    cfg = IngestConfig(source=str(tmp_path / TRIPS_FILE), target_table="hollow", target_dir=str(tmp_path / "t"))
    report = ingest(spark, cfg)
    assert report.rows == 0 and report.chunks.count() == 0 and len(spark.table("hollow").columns) == 20


def test_command_line_defaults_and_options(monkeypatch):
    cfg = cli.config(cli.parser().parse_args(["ingest"]))
    assert (cfg.year, cfg.month, cfg.target_table, cfg.chunk_size, cfg.connection) == (2021, 1, "yellow_taxi_data", 100_000, None)
    args = ["ingest", "--year", "2022", "--month", "11", "--pg-user", "u", "--pg-host", "h", "--pg-port", "1", "--pg-db", "d"]
    monkeypatch.setenv("PGPASSWORD", "p")
    assert cli.config(cli.parser().parse_args(args)).connection.url == "jdbc:postgresql://h:1/d"
    monkeypatch.delenv("PGPASSWORD")
    with pytest.raises(SystemExit):
        cli.config(cli.parser().parse_args(args))
    assert cli.parser().parse_args(["month", "01"]).month == "01"
