"""Delimited text against a declared contract, bound by header name.

Cells are read as text and typed in one projection. Spark's CSV reader keeps
the raw line of every record whose width differs from the header; short records
are padded with nulls and long ones fail.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import session
from sluice.functions import parsing
from sluice.functions.contract import Contract
from sluice.sources import quotes

# Where a row came from: file, split of the file, and position among the rows of its task.
PATH, START, LENGTH, ROW = "__path", "__start", "__length", "__row"
ORIGIN = (PATH, START, LENGTH, ROW)
MALFORMED = "__malformed"
TOO_LONG = "__too_long"
EXTRA = "__extra"
MARK = "\x01end of record\x01"
REPLACEMENT = "\ufffd"  # what the CSV reader puts for bytes that are not UTF-8


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def decoded(uri: str) -> str:
    """A path as Spark takes it, from a file URI as Spark reports it."""
    return unquote(uri) if urlsplit(uri).scheme else uri


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """All files below the paths, sorted; a listing only, no data is read."""
    return sorted(decoded(f) for f in spark.read.text(list(paths)).inputFiles())


def given_paths(paths: str | Sequence[str]) -> list[str]:
    """The paths; a file that two of them give is refused."""
    given = [paths] if isinstance(paths, str) else list(paths)
    places = [urlsplit(p).path if urlsplit(p).scheme else p for p in given]
    places = [p.rstrip("/") for p in places]
    if len(set(places)) < len(places) or any(above in set(places) for p in places for above in parents(p)):
        raise ValueError("a file is given more than once")
    return given


def parents(path: str) -> list[str]:
    parts = path.split("/")
    return ["/".join(parts[:i]) for i in range(1, len(parts))]


def literal_path(path: str) -> str:
    """Spark expands glob characters in paths; a listed file must not be expanded again."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def first_record(lines: Iterable[str]) -> list[str] | None:
    """The fields of the first record that is not blank, from as few lines as it has."""

    def unread() -> Iterable[str]:
        begun = False
        for line in lines:
            begun = begun or bool(line.strip())
            if begun:
                yield line + "\n"

    return next(csv.reader(unread()), None)


def column_names(record: Sequence[str]) -> list[str]:
    """Names of a heading. Repeated ones get .1, .2; empty ones their position."""
    names: list[str] = []
    seen: dict[str, int] = defaultdict(int)
    for position, name in enumerate(record):
        name = name or f"Unnamed: {position}"
        repeats = seen[name]
        seen[name] += 1
        names.append(f"{name}.{repeats}" if repeats else name)
    return names


def closed(lines: Sequence[str]) -> bool:
    """Whether the first record ends within the lines: one more line does not change it."""
    return first_record(lines) == first_record([*lines, 'x"'])


LAYOUTS = 10_000  # different headings that one source may have
FILE_BYTES = 1 << 42  # of a file that is looked at by one task; larger ones have more tasks, which find no heading
HEADING = "path string, heading array<string>"


def headings(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(path, heading) of each file, null where there is none. One task for each file reads its first lines and stops there."""
    lines = quotes.located(spark.read.text(list(files)))  # whatever ends a line

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        path = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column(2)[0].as_py():
                return
            path = batch.column(1)[0].as_py()
            held += [line.decode("utf-8", "replace") for line in batch.column(0).to_pylist()]
            if first_record(held) is not None and closed(held):
                break
        if path is not None:
            held[0] = held[0].removeprefix("\ufeff")
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([first_record(held)], pa.list_(pa.string()))], names=["path", "heading"])

    return lines.select(F.col("value").cast("binary"), "path", "start").mapInArrow(first, HEADING)


def one_task_each(spark: SparkSession):
    """Settings under which every file is a task of its own, which is given a few lines at a time."""
    return session.settings(
        spark,
        spark__sql__files__maxPartitionBytes=str(FILE_BYTES),
        spark__sql__files__openCostInBytes=str(FILE_BYTES),
        spark__sql__execution__arrow__maxRecordsPerBatch="64",
    )


def layouts(spark: SparkSession, files: Sequence[str]) -> list[list[str]]:
    """The different headings of all files, found by one job; files themselves are not listed here."""
    with one_task_each(spark):
        found = headings(spark, files)
        rows = found.groupBy("heading").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).limit(LAYOUTS + 1).collect()
    if len(rows) > LAYOUTS:
        raise ValueError(f"the files have more than {LAYOUTS} different headings")
    for row in rows:
        if row["heading"] is None:
            raise ValueError(f"no header in {decoded(row['path'])}")
    if sum(row["n"] for row in rows) < len(spark.read.text(list(files)).inputFiles()):
        raise ValueError("no header in an empty file")
    return sorted(row["heading"] for row in rows)


def files_by_layout(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each layout: for sources with more than one, or with files that are read in different ways."""
    with one_task_each(spark):
        rows = headings(spark, files).collect()
    out: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in sorted(rows, key=lambda r: r["path"]):
        out[tuple(column_names(row["heading"]))].append(decoded(row["path"]))
    return out


def read_header(spark: SparkSession, file: str) -> list[str]:
    """Column names of one file, from its first lines."""
    return first_records(spark, file)[0]


def first_records(spark: SparkSession, file: str) -> tuple[list[str], list[list[str]]]:
    """Column names of one file, and the records in the few lines behind them; no more lines are read."""
    text = quotes.located(spark.read.text(literal_path(file))).select(F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"))
    taken = 64
    while True:
        lines = [r.value.encode("latin-1").decode("utf-8", "replace") for r in text.take(taken)]
        whole = len(lines) < taken
        if lines:
            lines[0] = lines[0].removeprefix("\ufeff")
        record = first_record(lines)
        if whole or (record is not None and closed(lines)):
            break
        taken *= 8
    if record is None:
        raise ValueError(f"no header in {file}")
    heading, *rest = [r for r in csv.reader([line + "\n" for line in lines]) if any(c.strip() for c in r)]
    return column_names(heading), rest


def raw_schema(names: Sequence[str]) -> T.StructType:
    more = [EXTRA] if len(names) == 1 else []
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, *more, MALFORMED]])


def csv_options(multi_line: bool, verify_header: bool) -> dict[str, object]:
    return {
        "header": True,
        "enforceSchema": not verify_header,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
    }


def located(raw: DataFrame) -> DataFrame:
    return raw.withColumns({PATH: F.input_file_name(), START: F.input_file_block_start(), LENGTH: F.input_file_block_length()})


def with_origin(raw: DataFrame, multi_line: bool) -> DataFrame:
    """Drop blank records; note the file and split of each record and what is wrong with its width."""
    cells = [c for c in raw.columns if c not in (MALFORMED, EXTRA)]
    if multi_line:  # the line-by-line reader has skipped blank lines already
        blank = F.coalesce(quoted(cells[0]), F.lit("")).rlike(r"\A\s*\z") & F.col(MALFORMED).rlike(r"\A\s*\z")
        raw = raw.where(~F.coalesce(blank, F.lit(False)))
    return measured(located(raw), cells)


def measured(raw: DataFrame, cells: Sequence[str]) -> DataFrame:
    """What is wrong with the width of each record.

    A record of another width than the header's keeps its raw text. It is too
    long if, read again with a mark behind it, the mark is not among the first
    fields. The reader of one column asks for two, so that every record keeps
    its raw text and a quoted blank can be told from a blank line.
    """
    again = F.concat(F.regexp_replace(MALFORMED, r"[\r\n]+\z", ""), F.lit("," + MARK))
    schema = ", ".join(f"f{i} string" for i in range(len(cells) + 1))
    read_again = F.from_csv(again, schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    # within a function of an array of one, so that the second reading is mentioned once and stays out of generated code
    short = F.exists(F.array(read_again), lambda r: F.array_contains(F.array(*[F.coalesce(r[f"f{i}"], F.lit("")) for i in range(len(cells) + 1)]), MARK))
    outside = F.regexp_replace(MALFORMED, r'"[^"]*"', "")  # for the message only: stray quotes make it an estimate
    seen = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    complaint = F.concat(F.lit(f"expected {len(cells)} fields, saw "), F.greatest(seen, F.lit(len(cells) + 1)), F.lit(": "), MALFORMED)
    where = [c for c in (*ORIGIN,) if c in raw.columns]
    return raw.select(*[quoted(c) for c in cells], F.when(F.col(MALFORMED).isNotNull() & ~short, complaint).alias(TOO_LONG), *where)


def numbered(raw: DataFrame) -> DataFrame:
    return raw if ROW in raw.columns else raw.withColumn(ROW, F.monotonically_increasing_id())


@dataclass(frozen=True)
class Part:
    """Files of one layout: their cells as text, the names of the cells, the names in the header; perhaps some first records."""

    raw: DataFrame
    cells: tuple[str, ...]
    header: tuple[str, ...]
    first: tuple[Sequence[str], ...] = ()


def conform(part: Part, contract: Contract, as_text: Sequence[str] = (), before: Sequence[str] = (), after: Sequence[str] = ()) -> DataFrame:
    """Type every cell of a part, between other columns of its frame that are kept."""
    where, too_long = F.col(PATH), F.col(TOO_LONG)
    first = F.coalesce(quoted(part.cells[0]), F.lit(""))  # named too since Spark refuses to read the raw text alone
    complaint = F.raise_error(F.concat(too_long, F.lit(" (first cell '"), first, F.lit("', file "), where, F.lit(")"))).cast("boolean")
    not_text = F.raise_error(F.concat(F.lit("bytes that are not UTF-8, or U+FFFD for such bytes (file "), where, F.lit(")")))

    def typed(cell: str, name: str) -> Column:
        text, kind = quoted(cell), contract.kind(name)
        if kind == "bigint":
            value = parsing.parse_bigint(name, text, where)
        elif kind == "double":
            value = parsing.parse_double(name, text, where)
        elif kind == "timestamp_ntz" and name not in as_text:
            value = parsing.parse_timestamp(name, text, where, contract.timestamps[name])
        else:
            value = F.when(text.contains(REPLACEMENT), not_text).otherwise(parsing.parse_string(text))
        return value.alias(name)

    rows = part.raw.where(F.when(too_long.isNotNull(), complaint).otherwise(True))
    return rows.select(*before, *[typed(c, n) for c, n in zip(part.cells, part.header)], *after)


def read_parts(
    spark: SparkSession,
    paths: str | Sequence[str],
    contract: Contract,
    *,
    headers: str = "each",
    multi_line: bool | None = None,
    whole_records: bool = True,
) -> list[Part]:
    """The files as text cells, one part per layout."""
    if headers not in ("each", "first"):
        raise ValueError(f"headers must be 'each' or 'first', not {headers!r}")
    session.ship(spark)
    session.prefer_compiled_methods(spark)
    given = given_paths(paths)
    known = quotes.survey(spark, given)
    if multi_line is False and known.spanning:
        raise ValueError(f"quoted cells hold line ends in {min(known.spanning)}, though multi_line=False says that none does")
    apart = {decoded(f) for f in known.spanning | known.returns}

    verify, seen = headers == "first", []
    if verify:
        files = list_files(spark, given)
        if not files:
            raise ValueError(f"no files below {given}")
        heading, seen = first_records(spark, files[0])
        groups: dict[tuple[str, ...], list[str] | None] = {tuple(heading): files if apart else None}
    else:
        found = layouts(spark, given)
        one = len(found) == 1 and not apart
        groups = {tuple(column_names(found[0])): None} if one else dict(files_by_layout(spark, given))
        # tasks compare headings with names as they stand there, unless folders give columns of the same name
        folders = {c.lower() for c in spark.read.text(given).columns[1:]}
        verify = one and column_names(found[0]) == found[0] and not folders & {c.lower() for c in found[0]}
    parts = []
    for header, members in groups.items():
        contract.require(header)
        cells = header if verify else tuple(f"c{i}" for i in range(len(header)))
        for how, some in by_reading(members, known).items():
            paths_read = given if some is None else [literal_path(f) for f in some]
            # a single column is read with one more, see `measured`, so its heading cannot be compared
            raw = READERS[how](spark, paths_read, cells, known, verify and len(header) > 1, whole_records)
            parts.append(Part(raw, cells, header, tuple(seen)))
    return parts


LINES, WHOLE_FILES, RECORDS = "lines", "whole files", "records"


def by_reading(files: Sequence[str] | None, known: quotes.Survey) -> dict[str, list[str] | None]:
    """Files by the way they are read: most line by line, those with line ends in quoted cells otherwise.

    A gzip file is one task in any case, and so is one that has carriage returns within lines.
    """
    if files is None:
        return {LINES: None}
    spanning, returns = ({decoded(f) for f in some} for some in (known.spanning, known.returns))
    out: dict[str, list[str] | None] = defaultdict(list)
    for file in files:
        if file in returns or (file in spanning and packed(file)):
            out[WHOLE_FILES].append(file)
        else:
            out[RECORDS if file in spanning else LINES].append(file)
    return out


def packed(file: str) -> bool:
    """Whether a file can only be read from its beginning, by its name, as Spark sees it."""
    return file.rsplit(".", 1)[-1].lower() in ("gz", "bz2", "lz4", "snappy", "deflate", "zst")


def read_cells(spark: SparkSession, files: Sequence[str], cells: Sequence[str], multi_line: bool, verify: bool, whole_records: bool) -> DataFrame:
    source = spark.read.schema(raw_schema(cells)).options(**csv_options(multi_line, verify))
    if whole_records:
        source = source.option("columnPruning", False)
    raw = source.csv(list(files))
    return with_origin(raw.select(*[quoted(c) for c in raw_schema(cells).names]), multi_line)


def read_records(spark: SparkSession, files: Sequence[str], cells: Sequence[str], known: quotes.Survey, verify: bool) -> DataFrame:
    options = {k: v for k, v in csv_options(False, verify).items() if k not in ("header", "enforceSchema")}
    fields = F.from_csv(F.rtrim(F.col("record"), F.lit("\r\n")), schema_text(cells), options)
    raw = quotes.records(spark, files, known, list(cells) if verify else None).select(
        fields.alias("fields"), F.col("path").alias(PATH), F.col("start").alias(START), F.col("length").alias(LENGTH), F.col("row").alias(ROW)
    )
    return measured(raw.select("fields.*", *ORIGIN), cells)


def schema_text(cells: Sequence[str]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in raw_schema(cells))


READERS = {
    LINES: lambda spark, files, cells, known, verify, whole: read_cells(spark, files, cells, False, verify, whole),
    WHOLE_FILES: lambda spark, files, cells, known, verify, whole: read_cells(spark, files, cells, True, verify, whole),
    RECORDS: lambda spark, files, cells, known, verify, whole: read_records(spark, files, cells, known, verify),
}


def open_forms(part: Part, contract: Contract) -> dict[str, str]:
    """Names of the timestamp columns without a pattern, and the cells they are in."""
    return {n: c for c, n in zip(part.cells, part.header) if n in contract.timestamps and contract.timestamps[n] is None}


def first_forms(parts: Sequence[Part], names: Sequence[str]) -> dict[str, int]:
    """The form of one cell of each column, from the first records that have any: the others must be like it."""
    found: dict[str, int] = {}
    for part in parts:  # records at hand cost no job
        for n in names:
            at = part.header.index(n) if n in part.header else len(part.header)
            cells = [r[at] for r in part.first if at < len(r) and r[at] not in parsing.NULL_TOKENS]
            if cells and n not in found:
                found[n] = parsing.iso_form_of(cells[0])
    for part in parts:
        cells = {n: c for c, n in zip(part.cells, part.header) if n in names}
        while missing := [n for n in cells if n not in found]:
            forms = [parsing.iso_forms(quoted(cells[n])).alias(f"f{i}") for i, n in enumerate(missing)]
            row = part.raw.select(*forms).where(reduce(lambda a, b: a | b, [F.col(f"f{i}") > 0 for i in range(len(forms))])).first()
            if row is None:
                break
            found |= {n: form for n, form in zip(missing, row) if form}
    return found


def all_forms(parts: Sequence[Part], names: Sequence[str]) -> dict[str, int]:
    """The forms of all cells of each column as bits, one aggregate for each part."""
    found = dict.fromkeys(names, 0)
    for part in parts:
        cells = {n: c for c, n in zip(part.cells, part.header) if n in names}
        if cells:
            row = part.raw.agg(*[F.bit_or(parsing.iso_forms(quoted(c))).alias(f"f{i}") for i, c in enumerate(cells.values())]).first()
            found |= {n: found[n] | (bits or 0) for n, bits in zip(cells, row)}
    return found


def patterned_as_text(parts: Sequence[Part], contract: Contract) -> set[str]:
    """Timestamp columns of a declared pattern with at least one cell that does not fit."""
    out: set[str] = set()
    for part in parts:
        bad = {
            name: parsing.is_bad_timestamp(quoted(cell), contract.timestamps[name])
            for cell, name in zip(part.cells, part.header)
            if contract.timestamps.get(name) is not None
        }
        if bad:
            found = part.raw.agg(*[F.bool_or(b).alias(f"b{i}") for i, b in enumerate(bad.values())]).first()
            out |= {name for name, hit in zip(bad, found) if hit}
    return out


def settled(parts: Sequence[Part], contract: Contract, bad_timestamp: str) -> tuple[Contract, tuple[str, ...]]:
    """The contract with a pattern for every timestamp column, and the timestamp columns to leave as text.

    A column without a declared pattern has one form of ISO 8601 throughout.
    With "raise", its first cell tells which, and a cell of another form fails.
    With "text", one pass over the source sees the forms of all cells, and
    a column of several forms, or of any other text, stays text.
    """
    if bad_timestamp not in ("raise", "text"):
        raise ValueError(f"bad_timestamp must be 'raise' or 'text', not {bad_timestamp!r}")
    names = sorted(set().union(*[open_forms(p, contract) for p in parts]))
    look = first_forms if bad_timestamp == "raise" else all_forms
    forms = look(parts, names) if names else {}
    single = {1 << bit: form for bit, form in enumerate(parsing.ISO_FORMS)}
    as_text: set[str] = set()
    if bad_timestamp == "text":
        as_text = patterned_as_text(parts, contract) | {n for n, bits in forms.items() if bits and bits not in single}
    patterns = {n: single.get(forms.get(n, 0), parsing.SPACED) if p is None else p for n, p in contract.timestamps.items()}
    return replace(contract, timestamps=patterns), tuple(sorted(as_text))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    contract: Contract,
    *,
    headers: str = "each",
    multi_line: bool | None = None,
    bad_timestamp: str = "raise",
    whole_records: bool = True,
) -> DataFrame:
    """Read plain or gzipped files into one typed frame.

    ``headers="each"`` looks at the header of every file and allows columns to
    come in a different order from file to file. ``headers="first"`` looks at
    one header only, for folders of many parts with one layout; the tasks
    compare the header of each file they read with it and fail on a difference.

    All lines are looked at once first, to see which line ends lie in quoted
    cells; a quoted cell that is never closed fails there. Plain files are then
    split among tasks whether they hold such line ends or not, and the same bytes
    give the same rows, gzipped or not. ``multi_line=False`` says that no quoted
    cell holds a line end: a file that does fails.

    Text with bytes that are not UTF-8 fails.

    A timestamp column without a declared pattern has one form of ISO 8601 in
    all its cells. ``bad_timestamp="text"`` leaves a timestamp column as text when
    any of its cells does not fit, decided once for the whole source by an extra pass.

    The width of every record is checked, whichever columns are selected; cells
    are checked in the columns that are. ``whole_records=False`` leaves out
    what no selected column needs, the widths too.
    """
    parts = read_parts(spark, paths, contract, headers=headers, multi_line=multi_line, whole_records=whole_records)
    contract, as_text = settled(parts, contract, bad_timestamp)
    return union_by_name([conform(p, contract, as_text) for p in parts])
