"""Partner files as raw cells, whatever their number and size.

Every file of a folder counts, whatever its extension. Bytes are read by Spark's line reader, which
cuts large files into byte ranges (``spark.sql.files.maxPartitionBytes``) that begin and end at
line feeds; nothing ever holds more than a range. Output: one row per CSV row,

    file_name string, row_idx bigint, cells array<string>, read_error string

Row 0 is the header. A file that is one range is judged and parsed by the task that reads it. For a file
that is cut, two things are not known inside a range: its encoding and whether it begins inside
a quoted cell. So a first pass runs the CSV automaton over each range from both start states (outside or inside
quotes; behind a line feed there are no others) and keeps per state how it ends, how many records
begin and how wide they are. Folding these facts per file in order gives every
range its true state and first row number, the encoding (utf-8-sig, utf-8, cp1252, utf-8 with
replacement), the header's width and the first fault of the file. The second pass parses each range
from its true state. Records that cross a border are emitted as fragments and joined by (file, row).

The fold's result that tasks need is 17 bytes per range of a cut file, about 10**-7 of the bytes read.
With ``drop`` each row also carries ``keep array<boolean>``, which of the header's cells are not among the dropped names, so
that readers of the rows need no second look at the header.

A record (not a file) over ``MAX_RECORD`` bytes, as an unclosed quote makes one, is reported as the file's read error.
Compressed files are read as their content.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_NULL_TOKENS

RAW_CELLS_SCHEMA = "file_name string, row_idx bigint, cells array<string>, read_error string"
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252")
BATCH_ROWS = 10_000
MAX_RECORD = 1 << 28
MAX_HEADER = 1 << 20
BOM = b"\xef\xbb\xbf"
_NOT_CP1252 = re.compile(rb"[\x81\x8d\x8f\x90\x9d]")
KEEP_SCHEMA = RAW_CELLS_SCHEMA + ", keep array<boolean>"
_CELLS = pa.schema([("file_name", pa.string()), ("row_idx", pa.int64()), ("cells", pa.list_(pa.string())), ("read_error", pa.string()),
                    ("keep", pa.list_(pa.bool_()))])


def decode_bytes(data: bytes) -> str:
    for enc in ENCODINGS:
        try:
            return data.decode(enc)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", errors="replace")


def _csv_rows(text: str) -> Iterator[list[str]]:
    """CSV records in order; empty lines are not records."""
    csv.field_size_limit(2**31 - 1)
    return (r for r in csv.reader(io.StringIO(text, newline="")) if r)


def _too_wide(row: int, cells: int, width: int) -> str:
    return f"row {row} has {cells} cells, header has {width}"


def _finished(cells: list[str], width: int, tokens: frozenset[str]) -> list[str | None]:
    """A data row's cells: missing tokens null, short rows padded with null."""
    return [None if c in tokens else c for c in cells] + [None] * (width - len(cells))


def parse_csv_rows(name: str, data: bytes, null_tokens: Sequence[str]) -> Iterator[tuple]:
    """(file_name, row_idx, cells, read_error) of a whole file. A file that is empty, holds NUL
    bytes (a binary format), has no header or a row longer than its header yields one row with ``read_error``. The
    text is parsed twice, once to judge it and once to emit its rows, so that rows never pile up."""
    if not data:
        yield (name, 0, None, "empty file")
        return
    if b"\0" in data:
        yield (name, 0, None, "not a text file")
        return
    text = decode_bytes(data)
    tokens, width = frozenset(null_tokens), None
    for i, r in enumerate(_csv_rows(text)):
        width = len(r) if width is None else width
        if len(r) > width:
            yield (name, 0, None, _too_wide(i, len(r), width))
            return
    if width is None:
        yield (name, 0, None, "no header")
        return
    for i, r in enumerate(_csv_rows(text)):
        yield (name, i, _finished(r, width, tokens) if i else r, None)


def _kept(header: Sequence[str], drop: frozenset[str]) -> list[bool]:
    return [h.strip(" ").upper() not in drop for h in header]


def _batches(rows: Iterator[tuple], columns: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(list(_CELLS)[:columns])
    buf: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*buf), schema)], schema=schema)

    for row in rows:
        buf.append(row)
        if len(buf) >= BATCH_ROWS:
            yield batch()
            buf = []
    if buf:
        yield batch()


# --- ranges -----------------------------------------------------------------------------------

class Range(NamedTuple):
    """Consecutive lines of a file that one split holds; ``data`` ends with a line feed."""

    name: str
    start: int
    whole: bool
    size: int
    data: bytes

    def gap(self) -> int:
        return self.size - len(self.data)


# Bytes of the file that its lines do not show -> (starts with a byte order mark, ends with a line feed).
_ENDS = {-1: (False, False), 0: (False, True), 2: (True, False), 3: (True, True)}


def raw_lines(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Lines as bytes, with the split they come from. The line reader drops a leading byte order mark."""
    src = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(paths)
    return src.select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length"),
                      F.col("_metadata.file_size").alias("size"))


def _name_of(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[Range]:
    """The task's splits, in the order in which they are read."""
    key, lines = None, []

    def made() -> Range:
        path, start, length, size = key
        return Range(_name_of(path), start, start == 0 and length >= size, size, b"\n".join(lines) + b"\n")

    for b in batches:
        path, start = b.column("path").to_numpy(zero_copy_only=False), b.column("start").to_numpy()
        turn = np.flatnonzero((start[1:] != start[:-1]) | (path[1:] != path[:-1])) + 1
        for a, z in zip(np.r_[0, turn], np.r_[turn, len(start)]):
            if z > a:
                k = (path[a], int(start[a]), b.column("length")[a].as_py(), b.column("size")[a].as_py())
                if k != key:
                    if key is not None:
                        yield made()
                    key, lines = k, []
                lines += b.column("line").slice(a, z - a).to_pylist()
    if key is not None:
        yield made()


class Shape(NamedTuple):
    """What a range does from one start state. Widths count cells."""

    new: int  # records that begin here
    lead: int  # width of what is left of the record that was open, 0 if none was
    through: bool  # that record does not end here
    tail: int  # width so far of the record that is open at the end and began here, 0 if none
    peaks: list  # (number among the new, width) of closed records wider than all before them
    head: list | None  # cells of the first record that begins here
    rest: list | None  # cells of what is left of the record that was open; None over MAX_HEADER bytes


_END = "S\n"
_MARK = BOM.decode("latin-1")


def shape(text: str, inside: bool) -> Shape:
    """Run the CSV automaton over a range. A leading quote puts it inside a quoted cell; a last line of
    one cell shows whether it ends outside."""
    new, lead, through, tail, peaks, top, head, rest = 0, 0, False, 0, [], 0, None, None
    last, first = None, inside

    def left(cells: list) -> list | None:
        return cells if sum(map(len, cells)) <= MAX_HEADER else None

    for r in _csv_rows(('"' if inside else "") + text + _END):
        if last is not None:
            if first:
                lead, first, rest = len(last), False, left(last)
            else:
                head = left(last) if new == 0 else head
                if len(last) > top:
                    top = len(last)
                    peaks.append((new, top))
                new += 1
        last = r
    if last != ["S"]:  # still inside quotes: the last line went into the open cell
        last = last[:-1] + [last[-1].removesuffix(_END)]
        if first:
            lead, through, rest = len(last), True, left(last)
        else:
            head = left(last) if new == 0 else head
            tail, new = len(last), new + 1
    return Shape(new, lead, through, tail, peaks, head, rest)


_FACTS = "file_name string, start bigint, size bigint, bytes bigint, utf8 boolean, cp1252 boolean, nul boolean, shapes string"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of each range of a cut file: shapes from outside quotes, and from inside them; for a
    file's first range instead as it is when the byte order mark counts as text."""
    for r in _ranges(batches):
        if r.whole:
            continue
        try:
            r.data.decode("utf-8")
            utf8 = True
        except UnicodeDecodeError:
            utf8 = False
        text = r.data.decode("latin-1")
        out = shape(text, False)
        if r.start:
            other = shape(text, True) if '"' in text else Shape(0, 1, True, 0, [], None, [text] if len(text) <= MAX_HEADER else None)
        else:
            other = shape(_MARK + text, False)
        row = (r.name, r.start, r.size, len(r.data), utf8, not _NOT_CP1252.search(r.data), b"\0" in r.data, json.dumps([out, other]))
        yield pa.RecordBatch.from_pylist([dict(zip(("file_name", "start", "size", "bytes", "utf8", "cp1252", "nul", "shapes"), row))],
                                         schema=pa.schema([("file_name", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()),
                                                           ("utf8", pa.bool_()), ("cp1252", pa.bool_()), ("nul", pa.bool_()), ("shapes", pa.string())]))


_FOLDED = ("file_name string, starts binary, rows binary, inside binary, encoding string, mark string, newline boolean, "
           "width int, error string, header array<string>")


def _decoded(data: bytes, encoding: str) -> str:
    return data.decode("utf-8", "replace") if encoding == "replace" else data.decode(encoding)


def fold(facts: pd.DataFrame) -> pd.DataFrame:
    """One file's ranges in order -> true state and first row of each, and the file's facts."""
    facts = facts.sort_values("start")
    gap = int(facts["size"].iloc[0] - facts["bytes"].sum())
    bom, newline = _ENDS.get(gap, (False, True))
    encoding = "utf-8" if facts["utf8"].all() else "cp1252" if facts["cp1252"].all() else "replace"
    mark = "" if not bom or encoding == "utf-8" else BOM.decode("cp1252") if encoding == "cp1252" else "\ufeff"
    error = "not a text file" if facts["nul"].any() else None
    width, row, inside, wide, held = 0, 0, False, 0, 0
    starts, rows, states = [], [], []
    header: list[str] | None = None

    def check(i: int, cells: int) -> str | None:
        nonlocal width
        width = cells if i == 0 else width
        return error or (_too_wide(i, cells, width) if cells > width else None)

    for start, size, text in zip(facts["start"], facts["bytes"], facts["shapes"]):
        from_outside, other = (Shape(*x) for x in json.loads(text))
        s = other if inside or (start == 0 and mark) else from_outside
        starts.append(start)
        rows.append(row)
        states.append(inside)
        if inside:
            wide, held = wide + s.lead - 1, held + size
            if held > MAX_RECORD:
                error = error or f"row {row - 1} is longer than {MAX_RECORD} bytes"
            if row == 1:
                header = header and s.rest and header[:-1] + [header[-1] + s.rest[0]] + s.rest[1:]
            if s.through:
                continue
            error = check(row - 1, wide)
        for i, cells in s.peaks:
            error = check(row + i, cells)
        if row == 0 and s.new:
            header = s.head
        row += s.new
        inside, wide, held = s.tail > 0, s.tail, 0
    if inside:
        error = check(row - 1, wide)
    if not row:
        error = error or "no header"
    elif header is None:
        error = error or f"header is longer than {MAX_HEADER} bytes"
    else:  # the ranges were read as single bytes
        header = [_decoded(h.encode("latin-1"), encoding) for h in header]
    return pd.DataFrame([(facts["file_name"].iloc[0], np.array(starts, "<i8").tobytes(), np.array(rows, "<i8").tobytes(),
                          np.array(states, np.uint8).tobytes(), encoding, mark, newline, width, error, header)],
                        columns=["file_name", "starts", "rows", "inside", "encoding", "mark", "newline", "width", "error", "header"])


class CutFile(NamedTuple):
    starts: np.ndarray
    rows: np.ndarray
    inside: np.ndarray
    encoding: str
    mark: str
    newline: bool
    width: int
    error: str | None
    header: list[str] | None

    def pieces(self, r: Range) -> Iterator[tuple[int, list[str], bool]]:
        """(row, cells, whole) of the records that touch a range."""
        at = int(np.searchsorted(self.starts, r.start))
        if at == len(self.starts) or self.starts[at] != r.start:
            raise RuntimeError(f"{r.name}: byte ranges changed between the passes (spark.sql.files.* settings)")
        last = at + 1 == len(self.starts)
        data = r.data[:-1] if last and not self.newline else r.data
        text = _decoded(data, self.encoding)
        text = (self.mark if at == 0 else '"' if self.inside[at] else "") + text
        row, part, open_ = int(self.rows[at]) - int(self.inside[at]), bool(self.inside[at]), not last and bool(self.inside[at + 1])
        held = None
        for cells in _csv_rows(text):
            if held is not None:
                yield row, held, not part
                row, part = row + 1, False
            held = cells
        if held is not None:
            yield row, held, not (part or open_)


def _parse(cut: dict[str, CutFile], null_tokens: Sequence[str], drop: Sequence[str] | None, fragments: bool):
    """Ranges -> cells of whole records, or the fragments of records that cross borders."""
    tokens, dropped = frozenset(null_tokens), frozenset(c.upper() for c in drop or ())
    columns = 4 if fragments or drop is None else 5

    def masked(r: Range) -> Iterator[tuple]:
        rows = of(r)
        if columns == 4:
            yield from rows
            return
        keep = _kept(cut[r.name].header or (), dropped) if r.name in cut else None
        for row in rows:
            if r.whole and row[1] == 0:
                keep = _kept(row[2], dropped) if row[3] is None else None
            yield (*row, keep if row[3] is None else None)

    def of(r: Range) -> Iterator[tuple]:
        if r.whole:
            if not fragments:
                bom, newline = _ENDS.get(r.gap(), (False, True))
                yield from parse_csv_rows(r.name, (BOM if bom else b"") + (r.data if newline else r.data[:-1]), tokens)
            return
        if r.name not in cut:
            raise RuntimeError(f"{r.name}: byte ranges changed between the passes (spark.sql.files.* settings)")
        f = cut[r.name]
        if f.error:
            if r.start == 0 and not fragments:
                yield (r.name, 0, None, f.error)
            return
        for row, cells, whole in f.pieces(r):
            if fragments and not whole:
                yield (r.name, row, cells, f"{r.start:020d}")  # read_error carries the order of the fragments
            elif whole and not fragments:
                yield (r.name, row, _finished(cells, f.width, tokens) if row else cells, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((row for r in _ranges(batches) for row in masked(r)), columns)

    return run


def _join_fragments(cut: dict[str, CutFile], null_tokens: Sequence[str], drop: Sequence[str] | None):
    tokens, dropped = frozenset(null_tokens), frozenset(c.upper() for c in drop or ())
    schema = _CELLS if drop is not None else pa.schema(list(_CELLS)[:4])

    def run(key: tuple, t: pa.Table) -> pa.Table:
        name, row = key[0].as_py(), key[1].as_py()
        cells: list[str] = []
        for part in t.sort_by("read_error").column("cells").to_pylist():
            cells = cells[:-1] + [cells[-1] + part[0]] + part[1:] if cells else part
        done = _finished(cells, cut[name].width, tokens) if row else cells
        return pa.Table.from_pylist([{"file_name": name, "row_idx": row, "read_error": None, "cells": done, "keep": _kept(cut[name].header or (), dropped)}], schema=schema)
    return run


def cut_files(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> dict[str, CutFile]:
    """First pass: state, rows and faults of every file that Spark cuts into ranges. Files below
    the smallest possible split are not read."""
    conf = spark._jsparkSession.sessionState().conf()
    least = min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes())
    lines = raw_lines(spark, paths, glob).where(F.col("size") > least)
    folded = lines.mapInArrow(_survey, _FACTS).groupBy("file_name").applyInPandas(fold, _FOLDED)
    return {r.file_name: CutFile(np.frombuffer(r.starts, "<i8"), np.frombuffer(r.rows, "<i8"), np.frombuffer(r.inside, np.uint8), r.encoding, r.mark,
                                 r.newline, r.width, r.error, r.header) for r in folded.collect()}


def cells_of(spark: SparkSession, paths: str | Sequence[str], glob: str = "*", null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
             drop: Sequence[str] | None = None) -> DataFrame:
    """Raw cells of the files at ``paths`` (a folder or files); with ``drop``, header names, also the mask ``keep``."""
    cut = cut_files(spark, paths, glob)
    lines = raw_lines(spark, paths, glob)
    schema = RAW_CELLS_SCHEMA if drop is None else KEEP_SCHEMA
    cells = lines.mapInArrow(_parse(cut, null_tokens, drop, False), schema)
    crossed = {name: f for name, f in cut.items() if not f.error and f.inside.any()}
    if crossed:
        least = min(int(f.starts[1]) for f in crossed.values())
        parts = lines.where(F.col("size") > least).mapInArrow(_parse(cut, null_tokens, drop, True), RAW_CELLS_SCHEMA)
        cells = cells.unionByName(parts.groupBy("file_name", "row_idx").applyInArrow(_join_fragments(crossed, null_tokens, drop), schema))
    return cells


def file_listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Every file right below a folder (zero-byte ones too): file_name, lower-cased name_key, length,
    modified. Metadata of the file system, one row per file; no folder gives no rows."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + glob)
    statuses = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    rows = [(st.getPath().getName(), st.getLen(), st.getModificationTime() / 1000.0) for st in statuses if st.isFile()]
    df = spark.createDataFrame(rows, "file_name string, length bigint, modified double")
    return df.select("file_name", F.lower("file_name").alias("name_key"), "length", F.timestamp_seconds("modified").alias("modified"))


def read_raw_cells(spark: SparkSession, folder: str, glob: str = "*",
                   null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS, drop: Sequence[str] | None = None) -> DataFrame:
    """Raw cells of every file of the folder, whatever its extension and size. Zero-byte files,
    which the line reader skips, get their read error from the listing. ``drop``: see ``cells_of``."""
    empty = file_listing(spark, folder, glob).where("length = 0").select(
        "file_name", F.lit(0).cast("bigint").alias("row_idx"), F.lit(None).cast("array<string>").alias("cells"), F.lit("empty file").alias("read_error"))
    return cells_of(spark, folder, glob, null_tokens, drop).unionByName(empty, allowMissingColumns=True)


def template_columns(spark: SparkSession, path: str) -> list[str]:
    """Template header: names in order, upper-cased (schema only, no rows read)."""
    return [c.strip().upper() for c in spark.read.option("header", True).csv(path).columns]
