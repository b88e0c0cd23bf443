"""CSV files with quoted line ends, read over many tasks.

Spark cuts a text file into ranges; where a range begins, a quoted field may be
open.  Each range is a map from the quote state it is entered in to the state it is
left in: it keeps the state, swaps it, or fixes it.  These maps compose, so a prefix
scan over the ranges of a file tells each the state it begins in, and ranges parse
alone.  The record a range leaves open and the pieces of it that follow are put
together from the ranges they lie in.

A line is one ended by a line feed.  The file is read three times: for the maps, for
the open records, for the rows.  What is sent about states is a row per range.
"""

import csv
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from terralist.session import cut_lineage

_closing = re.compile(rb'[^"]*+(?:""[^"]*+)*+"').match
BATCH_ROWS = 20_000


def quoted_after(line: bytes, inside: bool, separator: bytes) -> bool:
    """Whether a quoted field is open behind a line, given whether one was before it."""
    at = 0
    while True:
        if inside:
            closed = _closing(line, at)
            if closed is None:
                return True
            at, inside = closed.end(), False
        elif line[at:at + 1] == b'"':
            at, inside = at + 1, True
            continue
        # Quotes inside a field that does not begin with one are part of it.
        at = line.find(separator, at)
        if at < 0:
            return False
        at += 1


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """(path, start, value): raw lines with the file and the range they lie in, in order within a range."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )


def _stretches(batches):
    """(key, open, lines) for stretches of lines of one range, in order; ``open`` is None before it is known."""
    for batch in batches:
        n = batch.num_rows
        keys = list(zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True))
        given = batch.column("open").to_pylist() if "open" in batch.schema.names else [None] * n
        at = 0
        while at < n:
            end = at + 1
            while end < n and keys[end] == keys[at]:
                end += 1
            yield keys[at], given[at], batch.column("value").slice(at, end - at).to_pylist()
            at = end


def range_maps(lines: DataFrame, separator: str) -> DataFrame:
    """(path, start, outside, inside): whether quotes are open behind each range, entered outside or inside of them."""
    sep = separator.encode()

    def row(key, states):
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *states)], names=["path", "start", "outside", "inside"])

    def run(batches):
        key = None
        for now, _, values in _stretches(batches):
            if now != key:
                if key is not None:
                    yield row(key, states)
                key, states = now, (False, True)
            for line in values:
                if b'"' in line:
                    states = tuple(quoted_after(line, s, sep) for s in states)
        if key is not None:
            yield row(key, states)

    return lines.mapInArrow(run, "path string, start long, outside boolean, inside boolean")


def range_states(maps: DataFrame) -> DataFrame:
    """(path, start, open): whether a range begins inside of quotes.

    A prefix scan: of the maps before, the last that fixes the state counts, and the
    swaps since.
    """
    files = Window.partitionBy("path").orderBy("start")
    before = files.rowsBetween(Window.unboundedPreceding, -1)
    swaps = (F.col("outside") & ~F.col("inside")).cast("int")
    summed = maps.withColumn("_swaps", F.sum(swaps).over(files))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("state"), "_swaps"))
    last = F.last(fixed, ignorenulls=True).over(before)
    since = F.coalesce(F.lag("_swaps").over(files), F.lit(0)) - F.coalesce(last["_swaps"], F.lit(0))
    return summed.select("path", "start", ((F.coalesce(last["state"], F.lit(0)) + since) % 2 == 1).alias("open"))


def _pieces(batches, separator):
    """(key, kind, lines): ``rows`` are lines of whole records; ``head`` is what a range that
    begins in quotes has of an earlier record; ``tail`` is the record it leaves open, ``first``
    if it has no record before."""
    sep = separator.encode()
    key = None

    def ends():
        if head:
            yield key, "head", head
        if held:
            yield key, "tail" if seen else "first", held

    for now, opened, values in _stretches(batches):
        if now != key:
            if key is not None:
                yield from ends()
            key, inside, closed, seen, head, held = now, opened, not opened, opened, [], []
        rows = []
        for line in values:
            if b'"' in line:
                inside = quoted_after(line, inside, sep)
            if not closed:
                head.append(line)
                closed = not inside
            else:
                held.append(line)
                if not inside:
                    rows += held
                    held = []
        if rows:
            seen = True
            yield key, "rows", rows
    if key is not None:
        yield from ends()


def open_records(lines: DataFrame, separator: str) -> DataFrame:
    """(path, start, kind, piece): heads and tails of records that lie in more than one range."""
    def run(batches):
        for key, kind, held in _pieces(batches, separator):
            if kind != "rows":
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([kind]), pa.array([b"\n".join(held)], pa.binary())],
                    names=["path", "start", "kind", "piece"],
                )

    return lines.mapInArrow(run, "path string, start long, kind string, piece binary")


def joined_records(pieces: DataFrame) -> DataFrame:
    """(record, header): the records of ``open_records`` put together; ``header`` tells the first of a file."""
    files = Window.partitionBy("path").orderBy("start", F.col("kind") != "head")
    # The range where the record began: its own for a tail, that of the last tail for a head.
    is_tail = F.col("kind") != "head"
    begun = F.last(F.when(is_tail, F.col("start")), ignorenulls=True).over(files.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A record has as many pieces as it spans ranges.
    parts = F.sort_array(F.collect_list(F.struct("start", "piece")))
    whole = pieces.withColumn("_begun", begun).groupBy("path", "_begun").agg(parts.alias("_parts"), F.max((F.col("kind") == "first") & (F.col("start") == 0)).alias("header"))
    texts = F.transform("_parts", lambda p: p["piece"])
    record = F.reduce(F.slice(texts, 2, F.greatest(F.size(texts) - 1, F.lit(0))), texts[0], lambda a, b: F.concat(a, F.lit(b"\n"), b))
    return whole.select(record.alias("record"), "header")


def _fields(lines, separator, width, strict, header):
    csv.field_size_limit((1 << 31) - 1)
    text = (line.decode("utf-8", "replace") + "\n" for line in lines)
    for row in csv.reader(text, delimiter=separator):
        if not row:
            continue
        if header:
            header = False
            continue
        if strict and len(row) != width:
            raise ValueError(f"a row has {len(row)} fields, not {width}: {str(row)[:200]}")
        yield (row + [None] * (width - len(row)))[:width]


def _batches(rows, columns):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*held, strict=True)], names=columns)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*held, strict=True)], names=columns)


def csv_ranges(spark: SparkSession, paths, columns, *, separator=",", strict=False) -> DataFrame:
    """Rows of CSV files with a header, all columns as text, read range by range.

    Blank lines are skipped; short rows end in nulls and extra fields are dropped,
    unless ``strict``.  A field left open at the end of a file is closed there.
    """
    columns, lines = list(columns), text_lines(spark, paths)
    # One row of under 200 bytes for each range (128 MB by default) of the files.
    states = cut_lineage(range_states(range_maps(lines, separator)))
    known = lines.join(F.broadcast(states), ["path", "start"])
    schema = ", ".join(f"`{c}` string" for c in columns)

    def whole(batches):
        def rows():
            begun = set()
            for key, kind, records in _pieces(batches, separator):
                if kind == "rows":
                    yield from _fields(records, separator, len(columns), strict, key[1] == 0 and key not in begun)
                    begun.add(key)

        return _batches(rows(), columns)

    def single(batches):
        for batch in batches:
            pairs = zip(batch.column("record").to_pylist(), batch.column("header").to_pylist(), strict=True)
            yield from _batches((r for text, header in pairs for r in _fields(text.split(b"\n"), separator, len(columns), strict, header)), columns)

    joined = joined_records(open_records(known, separator))
    return known.mapInArrow(whole, schema).unionByName(joined.mapInArrow(single, schema))
