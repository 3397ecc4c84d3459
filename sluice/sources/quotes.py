"""Which line ends end a record: quoted cells that hold line ends, found in parallel over splits of files.

What a line does to the state "inside a quoted cell" does not need the lines
before it: it is one of four functions of the state. The lines of a file split
compose to one such function as well, whichever state the split begins in, and
composing the splits of a file in order gives the state each one begins in. So a
file is surveyed by all its splits at once, and then read from the true record
ends by all its splits at once.

A quote opens a cell only where a cell begins, and two quotes in a row change
nothing, as in Spark's CSV reader.
"""

from __future__ import annotations

import csv
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice import session

# Functions of the state, by what they make of "outside" (bit 0) and of "inside" (bit 1).
OUTSIDE, SWAP, SAME, INSIDE = 0, 1, 2, 3
STATES_LIMIT = 128 * 1024 * 1024  # bytes of split states that are sent to tasks
STATE_BYTES = 128


# --- lines -----------------------------------------------------------------------------------


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line ends inside a quoted cell, if it begins inside one or not."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    begun = single if inside else F.concat(F.lit(","), single)
    pieces = F.split(begun, '"')
    before_quotes = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.aggregate(before_quotes, F.lit(inside), lambda state, piece: ~state & piece.endswith(","))


def effect(line: Column) -> Column:
    """What a line does to the state, as one of the four functions."""
    both = ends_inside(line, False).cast("int") + 2 * ends_inside(line, True).cast("int")
    return F.when(line.contains('"'), both).otherwise(F.lit(SAME)).cast("byte")


def stray_return(line: Column) -> Column:
    """Whether a line holds a carriage return elsewhere than at its end."""
    at = F.instr(line, "\r")
    return (at > 0) & (at < F.char_length(line))


def read_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Lines as they end with a line feed; a carriage return before it stays."""
    return located(spark.read.option("lineSep", "\n").text(list(files)))


def located(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.input_file_name().alias("path"), F.input_file_block_start().alias("start"), F.input_file_block_length().alias("length"))


def states_after(effects: np.ndarray, state: int) -> np.ndarray:
    """The state after each line, from the one before the first."""
    settles = (effects == OUTSIDE) | (effects == INSIDE)
    last = np.maximum.accumulate(np.where(settles, np.arange(len(effects)), -1))
    swaps = np.cumsum(effects == SWAP)
    settled = np.where(last >= 0, effects[last] == INSIDE, bool(state))
    return (settled ^ ((swaps - np.where(last >= 0, swaps[last], 0)) % 2 == 1)).astype(np.int8)


def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int, int]]:
    """(path, start, length, first row, row after the last) of neighbouring rows of one split."""
    path, start = batch.column(batch.schema.get_field_index("path")), batch.column(batch.schema.get_field_index("start"))
    length = batch.column(batch.schema.get_field_index("length"))
    n, starts = batch.num_rows, start.to_numpy()
    changed = np.flatnonzero((starts[1:] != starts[:-1]) | pc.not_equal(path.slice(1), path.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1 if n else []
    edges = [0, *changed, n] if n else []
    for a, b in zip(edges, edges[1:]):
        yield path[a].as_py(), int(starts[a]), length[a].as_py(), a, b


# --- survey ----------------------------------------------------------------------------------


@dataclass
class Survey:
    """The files that cannot be read line by line, and the states their splits begin in."""

    spanning: set[str] = field(default_factory=set)  # quoted cells hold line ends
    returns: set[str] = field(default_factory=set)  # carriage returns within lines
    starts: dict[str, list[int]] = field(default_factory=dict)  # splits with quotes, by file, in order
    after: dict[str, list[int]] = field(default_factory=dict)  # the state behind each of them

    def before(self, path: str, start: int) -> int:
        """The state that a split begins in."""
        at = bisect_left(self.starts.get(path, []), start)
        return self.after[path][at - 1] if at else 0


def survey(spark: SparkSession, paths: Sequence[str]) -> Survey:
    """Look at all lines once. A file whose last quoted cell is never closed is refused.

    The look at every line stays inside the JVM and gives the files in which
    some line, begun outside a quoted cell, ends inside one, or has a stray
    carriage return. In all other files every line is a record. The few found, if
    any, are looked at again: one row for each split with quotes comes back.
    """
    lines = read_lines(spark, paths)
    odd_line = (F.col("value").contains('"') & ends_inside(F.col("value"), False)) | stray_return(F.col("value"))
    odd_files = [row["path"] for row in lines.where(odd_line).select("path").distinct().collect()]
    if not odd_files:
        return Survey()
    lines = read_lines(spark, [literal(f) for f in odd_files]).where(F.col("value").contains('"') | stray_return(F.col("value")))
    told = lines.select("path", "start", "length", effect(F.col("value")).alias("effect"), stray_return(F.col("value")).alias("stray"))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, found = None, []

        def close():
            path, start, outside, inside, spans, stray = here
            found.append((path, start, outside + 2 * inside, spans, stray))

        for batch in batches:
            effects = batch.column(batch.schema.get_field_index("effect")).to_numpy()
            strays = batch.column(batch.schema.get_field_index("stray")).to_numpy(zero_copy_only=False)
            for path, start, _, a, b in runs(batch):
                if here is None or here[:2] != [path, start]:
                    if here is not None:
                        close()
                    here = [path, start, 0, 1, False, False]
                here[2], here[3] = (int(states_after(effects[a:b], here[k])[-1]) for k in (2, 3))
                here[4] = here[4] or bool(((effects[a:b] == SWAP) | (effects[a:b] == INSIDE)).any())
                here[5] = here[5] or bool(strays[a:b].any())
        if here is not None:
            close()
        if found:
            columns = list(zip(*found, strict=True))
            kinds = (pa.string(), pa.int64(), pa.int8(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "start", "effect", "spans", "stray"])

    splits = told.mapInArrow(compose, "path string, start bigint, effect byte, spans boolean, stray boolean")
    of_file = Window.partitionBy("path")
    odd = splits.withColumn("spans", F.bool_or("spans").over(of_file)).withColumn("stray", F.bool_or("stray").over(of_file)).where("spans OR stray")
    out, rows = Survey(), odd.orderBy("path", "start").collect()
    if len(rows) * STATE_BYTES > STATES_LIMIT:
        raise ValueError("too many file splits with quoted line ends: raise spark.sql.files.maxPartitionBytes")
    for row in rows:
        if row["stray"]:
            out.returns.add(row["path"])
        if row["spans"]:
            before = out.after[row["path"]][-1] if row["path"] in out.after else 0
            out.starts.setdefault(row["path"], []).append(row["start"])
            out.after.setdefault(row["path"], []).append(row["effect"] >> before & 1)
    out.spanning = set(out.starts)
    open_files = sorted(path for path, after in out.after.items() if after[-1])
    if open_files:
        raise ValueError(f"a quoted cell is never closed in {open_files[0]}" + (f" and {len(open_files) - 1} other files" if open_files[1:] else ""))
    return out


def literal(uri: str) -> str:
    """A file as Spark reports it, as a path that it does not expand."""
    path = unquote(uri) if urlsplit(uri).scheme else uri
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


# --- records ---------------------------------------------------------------------------------

RECORDS = "record binary, path string, start bigint, length bigint, row bigint"
PIECES = "piece binary, path string, start bigint, length bigint, row bigint, part int, heading boolean"


def records(spark: SparkSession, files: Sequence[str], known: Survey, names: Sequence[str] | None = None) -> DataFrame:
    """The records of plain files as text, each with its split and its place among the records that begin there.

    A heading that is not `names`, if these are given, fails. Headings are left out, and so are blank records. Every split is read by the
    task that has it; a record that goes on in the next splits is put together
    from its pieces, of which a split has two at most, in a job of its own.
    """
    shared = spark.sparkContext.broadcast(known)
    lines = read_lines(spark, files).select(F.concat("value", F.lit("\n")).cast("binary").alias("text"), "path", "start", "length", effect(F.col("value")).alias("effect"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start, length, array, row, _ in regrouped(batches, shared.value, names):
            if array is not None:
                n = len(array)
                yield pa.RecordBatch.from_arrays(
                    [array, pa.array([path] * n, pa.string()), pa.array([start] * n, pa.int64()), pa.array([length] * n, pa.int64()), pa.array(np.arange(row, row + n))],
                    names=["record", "path", "start", "length", "row"],
                )

    def torn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start, length, array, row, piece in regrouped(batches, shared.value):
            if piece is not None:
                text, part, heading = piece
                yield pa.RecordBatch.from_pylist(
                    [{"piece": text, "path": path, "start": start, "length": length, "row": row, "part": part, "heading": heading}],
                    schema=pa.schema([("piece", pa.binary()), ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("row", pa.int64()), ("part", pa.int32()), ("heading", pa.bool_())]),
                )

    found = lines.mapInArrow(whole, RECORDS).withColumn("record", F.col("record").cast("string"))
    if not any(any(after[:-1]) for after in known.after.values()):
        return found
    place = session.fresh_dir(spark, "pieces")
    lines.mapInArrow(torn, PIECES).write.parquet(place)
    pieces = spark.read.schema(PIECES).parquet(place)
    in_file = Window.partitionBy("path").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.last(F.when(F.col("part") == TAIL, F.struct("start", "length", "row", "heading")), ignorenulls=True).over(in_file)
    joined = (
        pieces.withColumn("opened", opened)
        .groupBy("path", "opened")
        .agg(F.array_sort(F.collect_list(F.struct("start", "part", F.col("piece").cast("string").alias("piece")))).alias("pieces"))
        .where("NOT opened.heading")
        .select(F.array_join("pieces.piece", "").alias("record"), "path", "opened.start", "opened.length", "opened.row")
    )
    return found.unionByName(joined)


def check_heading(text: str, names: Sequence[str] | None, path: str) -> None:
    if names is None:
        return
    found = next(csv.reader([text.removeprefix("\ufeff").rstrip("\r\n")]))
    if len(found) != len(names) or any(f and f != n and not n.startswith(f + ".") for f, n in zip(found, names, strict=True)):
        raise ValueError(f"the header does not conform: {found} in {path}, {list(names)} in the first file")


HEAD, TAIL = 0, 1  # the end of a record that began in an earlier split, the beginning of one that ends in a later split


def regrouped(batches: Iterator[pa.RecordBatch], known: Survey, names: Sequence[str] | None = None) -> Iterator[tuple]:
    """(path, start, length, records, number of the first, None) and (…, None, number, piece) of the splits of a task.

    Lines lie in the batch one behind the other, so records are the same bytes
    with fewer ends: nothing is copied but records that go over batches.
    """
    at = None  # the split: path, start, length
    state = row = 0
    heading = head = False  # the next record is the heading; the split's first lines belong to an earlier record
    held: list[bytes] = []

    def finish():
        """What is left at the end of a split is a piece."""
        if held:
            yield (*at, None, row, (b"".join(held), HEAD if head else TAIL, heading and not head))

    for batch in batches:
        effects = batch.column(batch.schema.get_field_index("effect")).to_numpy()
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        for path, start, length, a, b in runs(batch):
            if at != (path, start, length):
                yield from finish()
                at, state, row, held = (path, start, length), known.before(path, start), 0, []
                heading, head = start == 0, bool(state)
            after = states_after(effects[a:b], state)
            state = int(after[-1])
            ends = np.flatnonzero(after == 0) + a + 1
            if not len(ends):
                held.append(data[offsets[a] : offsets[b]].to_pybytes())
                continue
            if held or head:  # the first record began in an earlier batch or split
                first = b"".join([*held, data[offsets[a] : offsets[ends[0]]].to_pybytes()])
                held = []
                if head:
                    yield (*at, None, row, (first, HEAD, False))
                    head = False
                elif first.strip():
                    if heading:
                        check_heading(first.decode("utf-8", "replace"), names, path)
                    else:
                        yield (*at, pa.array([first], pa.binary()), row, None)
                        row += 1
                    heading = False
                a, ends = int(ends[0]), ends[1:]
            if len(ends):
                places = np.concatenate(([offsets[a]], offsets[ends]))
                buffers = [None, pa.py_buffer(places.tobytes()), data]
                texts_of = pa.LargeStringArray.from_buffers(len(ends), buffers[1], data)
                filled = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(texts_of)), 0)
                array = pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).filter(filled).cast(pa.binary())
                if heading and len(array):
                    check_heading(array[0].as_py().decode("utf-8", "replace"), names, path)
                    array, heading = array.slice(1), False
                if len(array):
                    yield (*at, array, row, None)
                    row += len(array)
                a = int(ends[-1])
            if a < b:
                held = [data[offsets[a] : offsets[b]].to_pybytes()]
    yield from finish()
