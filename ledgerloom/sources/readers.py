"""Scans and file loads."""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.filters import date_slice
from ledgerloom.session import stage

# Which files an inventory keeps, and which names it skips (matched at the start of the name).
KEPT_KINDS = (
    "application/vnd.google-apps.spreadsheet",
    "application/vnd.google-apps.document",
    "application/vnd.google-apps.presentation",
)
KEPT_ENDINGS = (".xlsx", ".drawio", ".docx", ".pptx", ".pdf", "ipynb")
SKIPPED_NAMES = r"results-\d+-\d+|Untitled spreadsheet|bq-results-\d+-\d+"


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with one header row. Types are inferred in an extra pass unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def load_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with one header row and every column as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line of CSV, given whether one is at its start.

    A quote opens a cell only as its first character, and closes it unless another one follows.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                comma = line.find(',"', at)
                if comma < 0:
                    return False
                at = comma + 1
            at, inside = at + 1, True
        quote = line.find('"', at)
        if quote < 0:
            return True
        at = quote + 2
        if line.startswith('"', quote + 1):
            continue
        comma = line.find(",", quote + 1)  # what stands between is text
        if comma < 0:
            return False
        at, inside = comma + 1, False


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines as they would stand in the sheet if their split began outside a quoted cell, and if it began inside one.

    For both: the row of the sheet within the split (0: one begun before it), and if a cell is open before and after.
    """
    here, line_no, held = None, 0, [(0, False), (0, True)]
    for batch in batches:
        made = []
        for value, file, start in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != here:
                here, line_no, held = (file, start), 0, [(0, False), (0, True)]
            line_no += 1
            ways = []
            for i, (row, inside) in enumerate(held):
                after = ends_inside(value, inside)
                row += not inside
                ways += [row, inside, after]
                held[i] = row, after
            made.append((file, start, line_no, value, *ways))
        names = ["file", "start", "line", "value", *(f"{n}{i}" for i in "01" for n in ("row", "before", "after"))]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64(), pa.bool_(), pa.bool_()] * 2]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*made)) or [[]] * 10, types)], names=names)


WALKED = "file string, start long, line long, value string, row0 long, before0 boolean, after0 boolean, row1 long, before1 boolean, after1 boolean"


def _begin(splits: pa.Table) -> pa.Table:
    """How each split of a file really begins: if inside a cell, and after how many rows. One line per split."""
    inside, before, out = False, 0, []
    for r in splits.sort_by("start").to_pylist():
        out.append((r["file"], r["start"], inside, before))
        before += r[f"row{int(inside)}"]
        inside = r[f"after{int(inside)}"]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("file", "start", "inside", "rows_before"), zip(*out), (pa.string(), pa.int64(), pa.bool_(), pa.int64()))})


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(1 << 30)
    for batch in batches:
        files, rows, values = (c.to_pylist() for c in batch.columns)
        cells = [next(csv.reader(io.StringIO(v, newline="")), []) for v in values]
        some = [i for i, c in enumerate(cells) if c]
        columns = [pa.array([files[i] for i in some], pa.string()), pa.array([rows[i] for i in some], pa.int64()), pa.array([cells[i] for i in some], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "row", "cells"])


def grid_rows(spark: SparkSession, path: str) -> DataFrame:
    """``file, row, cells`` of CSV files, rows counted from 1 in each; empty ones count but are left out.

    A file is read by as many tasks as it has splits. A task cannot know if its first line lies inside a quoted cell, so
    it notes both cases for each line, and what a split does to either; one line per split then tells how each really
    begins. Only rows of several lines meet in a shuffle. Lines end with a line feed, which a carriage return may
    precede; a quote that is never closed makes one row of the rest of its file, as in any reader.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    walked = stage(lines.mapInArrow(_walk, WALKED), "lines")
    last = F.max_by(F.struct("row0", "after0", "row1", "after1"), "line").alias("last")
    splits = walked.groupBy("file", "start").agg(last).select("file", "start", "last.*")
    begin = splits.groupBy("file").applyInArrow(_begin, "file string, start long, inside boolean, rows_before long")
    known = walked.join(stage(begin, "splits"), ["file", "start"])
    way = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    known = known.select("file", "start", "line", "value", (F.col("rows_before") + way("row")).alias("row"), (way("before") | way("after")).alias("part"))
    pieces = F.array_sort(F.collect_list(F.struct("start", "line", "value")))
    long = known.where("part").groupBy("file", "row").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"))
    return known.where("NOT part").select("file", "row", "value").unionByName(long).mapInArrow(_cells, "file string, row long, cells array<string>")


def load_grid(
    spark: SparkSession,
    path: str,
    header_row: int = 1,
    blank_to_null: bool = True,
    columns: tuple[int, int] | None = None,
    rows: tuple[int, int] | None = None,
) -> DataFrame:
    """Sheets stored as CSV text whose column names stand in row ``header_row``; rows above it are dropped.

    A folder may hold several files of the same layout. ``columns`` and ``rows`` (first and last, counted from 1) cut
    a range out of a single sheet first, and ``header_row`` then counts from the first row of the range. Every column
    is text. A quoted cell may hold line breaks; see :func:`grid_rows`.
    """
    placed = grid_rows(spark, path)
    if rows:
        placed = placed.where(F.col("row").between(*rows)).withColumn("row", F.col("row") - (rows[0] - 1))
    head = placed.where(F.col("row") == header_row).orderBy("file").select("cells").first()
    if head is None:
        raise ValueError(f"{path} has no row {header_row}")
    first, last = columns or (1, None)
    all_names = head.cells
    width = len(all_names)
    parsed = placed.where(F.col("row") > header_row)

    def cell(i: int) -> Column:
        text = F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
        return F.nullif(text, F.lit("")) if blank_to_null else text

    chosen = range(first - 1, last or width)
    return parsed.select(*[cell(i).alias(all_names[i]) for i in chosen])


def run_sql(
    spark: SparkSession, text: str | None = None, path: str | None = None, args: Mapping[str, object] | None = None
) -> DataFrame:
    """Result of a statement given as text or as a file; the file wins. Having neither is an error."""
    if path is not None:
        text = Path(path).read_text(encoding="utf-8")
    if not text or not text.strip():
        raise ValueError("give a statement or a file that holds one")
    return spark.sql(text, args=dict(args or {}))


def list_files(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """Path, name, size and time of the files below a folder; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.select("path", F.substring_index("path", "/", -1).alias("name"), "length", "modificationTime")
    return listed if prefix is None else listed.where(F.col("name").startswith(prefix))


def list_partitions(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The values of a partition column of the table stored below a folder, with the files and bytes of each.

    They come from the names of the files alone. Values are text, as in the folders' names; a missing one is null.
    """
    named = F.regexp_extract("path", rf"/{re.escape(column)}=([^/]*)/", 1)
    # folders are escaped like URLs, only that a plus is a plus; a listed path may be escaped once more
    plain = lambda text: F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    files = list_files(spark, path).where(F.col("path").contains(f"/{column}=")).select(plain(named).alias("value"), "length")
    value = F.when(F.col("value") != "__HIVE_DEFAULT_PARTITION__", F.col("value"))
    return files.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def file_inventory(df: DataFrame) -> DataFrame:
    """Wanted files of a listing (seq, file_id, name, mime_type, owned, trashed): the last file of each name."""
    kind = F.col("mime_type").isin(*KEPT_KINDS)
    for ending in KEPT_ENDINGS:
        kind = kind | F.contains("name", F.lit(ending))
    wanted = df.where(kind & F.col("owned") & ~F.col("trashed"))
    named = wanted.where(F.col("name").isNotNull() & (F.col("name") != "") & F.col("file_id").isNotNull())
    kept = named.where(~F.col("name").rlike(f"^(?:{SKIPPED_NAMES})"))
    return kept.groupBy("name").agg(F.max_by("file_id", "seq").alias("file_id"))


def require_slice(df: DataFrame, ts: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Read of a table that must not be scanned whole: both bounds are mandatory."""
    if start is None or end is None:
        raise ValueError(f"a range of {ts} is required")
    return date_slice(df, ts, start, end)


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
