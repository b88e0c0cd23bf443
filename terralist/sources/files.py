"""File sources: wave folders, inventories, zipped and plain CSV, Parquet."""

import csv
import io
import zipfile
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from terralist import constants as K
from terralist.operators.shaping import align
from terralist.session import cut_lineage, spread
from terralist.sources.ranges import csv_ranges


#: At most so many tasks read the members of archives.
MEMBER_TASKS = 100_000

# --- discovery ------------------------------------------------------------------


def files(spark: SparkSession, folder: str, pattern=None) -> DataFrame:
    """(path, length) of every file under a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", "length")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    return files(spark, folder, "*.zip")


def wave_folders(spark: SparkSession, base: str) -> DataFrame:
    """(wave): child folders of ``base`` named by a date, newest first."""
    root = base.rstrip("/")
    below = F.element_at(F.split(F.col("path"), F.lit(_literal(root) + "/")), -1)
    name = F.split_part(below, F.lit("/"), F.lit(1))
    is_folder = below.contains("/") & name.rlike(r"^\d{4}-\d{2}-\d{2}$")
    day = F.try_to_date(name, "yyyy-MM-dd")
    return (
        files(spark, root).filter(is_folder & day.isNotNull())
        .select(name.alias("wave")).distinct().orderBy(F.desc("wave"))
    )


def _literal(path: str) -> str:
    # Paths come back with a scheme; matching the part after it is enough.
    tail = path.split("://", 1)[-1].removeprefix("file:")
    return r"\Q" + tail + r"\E"


def latest_waves(spark: SparkSession, base: str) -> dict:
    """Newest and previous wave folder; the previous is "" when there is one only."""
    found = [row["wave"] for row in wave_folders(spark, base).limit(2).collect()]
    if not found:
        raise RuntimeError(f"no date folders under {base}")
    root = base.rstrip("/")
    return {
        "latest": f"{root}/{found[0]}/",
        "lagged": f"{root}/{found[1]}/" if len(found) > 1 else "",
    }


def folder_of(path="path") -> Column:
    return F.regexp_extract(F.col(path), r"^(.*)/[^/]+$", 1)


def file_inventory(listing: DataFrame) -> DataFrame:
    """One row: files, folders, total size in GB and the first ten of each."""
    total = listing.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1e9, 2).alias("total_gb"),
    )
    first_files = listing.orderBy("path").limit(10).agg(F.sort_array(F.collect_list("path")))
    folders = listing.select(folder_of().alias("folder")).distinct()
    first_folders = folders.orderBy("folder").limit(10).agg(F.sort_array(F.collect_list("folder")))
    return total.select(
        "n_files", folders.agg(F.count(F.lit(1))).scalar().alias("n_folders"), "total_gb",
        first_folders.scalar().alias("sample_folders"), first_files.scalar().alias("sample_files"),
    )


def inventory_by_folder(listing: DataFrame) -> DataFrame:
    """(folder, n_files, gb)."""
    return listing.groupBy(folder_of().alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.round(F.sum("length") / 1e9, 2).alias("gb")
    ).orderBy("folder")


def source_and_operation(path="path"):
    """(source, operation) columns from a file name; the first rule that matches wins."""
    name = F.lower(F.element_at(F.split(F.col(path), "/"), -1))
    source, operation = F.lit("unknown"), F.lit(None).cast("string")
    for fragment, rule_source, rule_operation in reversed(K.SOURCE_RULES):
        hit = name.contains(fragment)
        source = F.when(hit, rule_source).otherwise(source)
        operation = F.when(hit, rule_operation).otherwise(operation)
    return [source.alias("source"), operation.alias("operation")]


# --- CSV --------------------------------------------------------------------------


def delimiter_of(sample: bytes) -> str:
    """``;`` when the first 50 lines hold more of them than commas, else ``,``."""
    lines = sample.splitlines()[:50]
    return ";" if sum(x.count(b";") for x in lines) > sum(x.count(b",") for x in lines) else ","


def sniff_delimiters(spark: SparkSession, paths) -> DataFrame:
    """(path, delimiter) of plain text files, counted on their first 50 lines."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value", F.monotonically_increasing_id().alias("position"),
    )
    # The rank limit is applied in every task before the shuffle, so at most
    # 50 lines per file and task travel.
    rank = F.row_number().over(Window.partitionBy("path").orderBy("position"))
    head = lines.filter("start = 0").withColumn("_rank", rank).filter("_rank <= 50")
    semicolons = F.sum(F.regexp_count("value", F.lit(";")))
    commas = F.sum(F.regexp_count("value", F.lit(",")))
    return head.groupBy("path").agg(
        F.when(semicolons > commas, ";").otherwise(",").alias("delimiter")
    )


def null_tokens(df: DataFrame, tokens=None, columns=None) -> DataFrame:
    """Text columns with every null token turned into null."""
    tokens = K.NULL_TOKENS if tokens is None else tokens
    columns = columns or [n for n, t in df.dtypes if t == "string"]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in columns}
    )


def typed(df: DataFrame, columns, types, tokens=None) -> DataFrame:
    """Null tokens, then lenient casts."""
    return align(null_tokens(df, tokens), columns, types)


def open_seekable(path):
    """A file as a stream that can seek; only what is read travels."""
    from pyarrow import fs

    if path.startswith("file:"):
        source, name = fs.LocalFileSystem(), unquote("/" + path.removeprefix("file:").lstrip("/"))
    elif "://" in path:
        source, name = fs.FileSystem.from_uri(path)
    else:
        source, name = fs.LocalFileSystem(), path
    return io.BufferedReader(source.open_input_file(name), 1 << 20)


def archive_members(spark: SparkSession, paths, suffix=".csv") -> DataFrame:
    """(path, place, member, size): the wanted members of zip archives, one row each.

    Read from the directory at the end of each archive; nothing else of it is.
    """
    found = spark.read.format("binaryFile").load(paths).select("path")
    fields = [("path", pa.string()), ("place", pa.int64()), ("member", pa.string()), ("size", pa.int64())]

    def listed(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_seekable(path) as raw, zipfile.ZipFile(raw) as archive:
                    kept = [(path, i, m.filename, m.file_size) for i, m in enumerate(archive.infolist()) if m.filename.lower().endswith(suffix)]
                for at in range(0, len(kept), 10_000):
                    columns = zip(*kept[at:at + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    return spread(found).mapInArrow(listed, "path string, place long, member string, size long")


def _member_rows(columns):
    """Task function: the CSV rows of each listed member, a bounded batch at a time."""
    def read(batches):
        for batch in batches:
            for path, place in zip(batch.column("path").to_pylist(), batch.column("place").to_pylist(), strict=True):
                with open_seekable(path) as raw, zipfile.ZipFile(raw) as archive:
                    yield from _csv_rows(archive, archive.infolist()[place], columns)

    return read


def _csv_rows(archive, name, columns, batch_rows=20_000):
    # Descriptions may be longer than the csv module takes by default.
    csv.field_size_limit((1 << 31) - 1)
    with archive.open(name) as raw:
        delimiter = delimiter_of(raw.read(256 * 1024))
    with archive.open(name) as raw:
        text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="")
        rows = csv.reader(text, delimiter=delimiter)
        place = {column: i for i, column in enumerate(next(rows, []))}
        picks = [place.get(c) for c in columns]
        batch = []
        for row in rows:
            if row:
                # Short rows end in nulls and extra fields are dropped.
                batch.append([row[i] if i is not None and i < len(row) else None for i in picks])
            if len(batch) >= batch_rows:
                yield _as_batch(batch, columns)
                batch = []
        if batch:
            yield _as_batch(batch, columns)


def _as_batch(rows, columns):
    arrays = [pa.array(values, pa.string()) for values in zip(*rows)]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def zipped_csv(spark: SparkSession, paths, columns, *, types=None, tokens=None) -> DataFrame:
    """Rows of every ``*.csv`` member of zip archives, in the named columns.

    The delimiter is sniffed per member, text is decoded leniently, ragged rows
    are cut or filled, null tokens and bad numbers become null.  Work is dealt by
    member: a task seeks to its member in the archive, of any size, and rows stream
    out in batches.
    """
    work, n = cut_lineage(archive_members(spark, paths), count=True)
    schema = ", ".join(f"`{c}` string" for c in columns)
    # Few bytes stand for much work, so the number of tasks is given.
    dealt = work.repartition(max(1, min(n, MEMBER_TASKS)))
    return typed(dealt.mapInArrow(_member_rows(list(columns)), schema), columns, types or {}, tokens)


def _header(batches):
    for batch in batches:
        for path, place in zip(batch.column("path").to_pylist(), batch.column("place").to_pylist(), strict=True):
            with open_seekable(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(archive.infolist()[place]) as member:
                sample = member.read(256 * 1024)
            text = io.StringIO(sample.decode("utf-8", "replace"), newline="")
            names = next(csv.reader(text, delimiter=delimiter_of(sample)), [])
            yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string()))], names=["names"])


def inferred(df: DataFrame) -> DataFrame:
    """Text columns in the narrowest type that takes all their values; one pass finds it."""
    kinds = ("bigint", "double", "boolean", "timestamp")
    fits = [
        F.bool_and(F.col(c).isNull() | F.col(c).try_cast(k).isNotNull()).alias(f"{i}_{k}")
        for i, c in enumerate(df.columns) for k in kinds
    ]
    some = [F.count(c).alias(f"{i}_n") for i, c in enumerate(df.columns)]
    row = df.agg(*fits, *some).first()
    choice = {
        c: next((k for k in kinds if row[f"{i}_{k}"]), "string") if row[f"{i}_n"] else "string"
        for i, c in enumerate(df.columns)
    }
    return df.select(*[F.col(c).try_cast(k).alias(c) if k != "string" else F.col(c) for c, k in choice.items()])


def first_member(spark: SparkSession, path) -> DataFrame:
    """First CSV member of an archive with inferred types; empty fields are null."""
    first = cut_lineage(archive_members(spark, path).orderBy("path", "place").limit(1))
    found = first.mapInArrow(_header, "names array<string>").first()
    if found is None:
        return spark.createDataFrame([], "value string")
    columns = list(found["names"])
    rows = first.mapInArrow(_member_rows(columns), ", ".join(f"`{c}` string" for c in columns))
    # Read once: the types are found on the rows that are returned.
    return inferred(cut_lineage(null_tokens(rows, [""])))


def plain_csv(spark: SparkSession, paths, schema, *, delimiter=None, strict=True, tokens=None, multiline=True) -> DataFrame:
    """Declared-schema CSV; the delimiter is sniffed per file unless given.

    Values are read as text, null tokens become null, then types are applied.
    ``strict`` raises on a row with another number of fields and on a value
    that does not fit; otherwise extra fields are dropped, short rows filled
    and bad values null.  Quoted fields may hold line ends: a large file is read in
    ranges over many tasks.  Where no field does, ``multiline=False`` saves the passes
    that find the quotes.
    """
    if delimiter is None:
        # One row per file.
        groups = {}
        for row in sniff_delimiters(spark, paths).collect():
            groups.setdefault(row["delimiter"], []).append(row["path"])
        parts = [
            plain_csv(spark, files, schema, delimiter=d, strict=strict, tokens=tokens, multiline=multiline)
            for d, files in sorted(groups.items())
        ]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    fields = spark.createDataFrame([], schema).schema.fields
    if multiline:
        rows = csv_ranges(spark, paths, [f.name for f in fields], separator=delimiter, strict=strict)
    else:
        text = ", ".join(f"`{f.name}` string" for f in fields)
        reader = spark.read.schema(text).option("header", "true").option("sep", delimiter).option("escape", '"')
        rows = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(paths)
    rows = null_tokens(rows, tokens)

    def value(f):
        cast = F.col(f.name).try_cast(f.dataType)
        if not strict:
            return cast.alias(f.name)
        wrong = F.raise_error(F.concat(F.lit(f"{f.name} does not take "), F.col(f.name))).cast(f.dataType)
        return F.when(F.col(f.name).isNotNull() & cast.isNull(), wrong).otherwise(cast).alias(f.name)

    return rows.select(*[value(f) for f in fields])


# --- Parquet -------------------------------------------------------------------------


def parquet(spark: SparkSession, *paths, columns=None):
    """Parquet files, optionally only the wanted columns that exist."""
    df = spark.read.parquet(*paths)
    return df if columns is None else df.select(*[c for c in columns if c in df.columns])


def missing_columns(df: DataFrame, wanted) -> list:
    return [c for c in wanted if c not in df.columns]
