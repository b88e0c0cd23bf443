"""Loading a wave: from zipped files of several portals to one typed table."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralist import constants as K
from terralist.operators.keys import union_relaxed
from terralist.plans.clean import aligned_raw, standardize_source
from terralist.sources.files import archives, source_and_operation, zipped_csv


def load_wave(spark: SparkSession, folder: str, *, columns=None) -> DataFrame:
    """Every ``*.zip`` in a wave folder, standardized, united and aligned.

    Only the file names reach the driver, to decide source and operation of
    each archive; the data is read where the tasks run.
    """
    columns = columns or K.RAW_COLUMNS
    names = archives(spark, folder).select("path", *source_and_operation("path")).collect()
    if not names:
        raise ValueError(f"no zip files under {folder}")
    by_source = {}
    for row in sorted(names, key=lambda r: r["path"]):
        by_source.setdefault((row["source"], row["operation"]), []).append(row["path"])
    frames = [
        standardize_source(
            zipped_csv(spark, paths, columns, types=K.RAW_TYPES), source, operation=operation,
            columns=columns,
        )
        for (source, operation), paths in by_source.items()
    ]
    return aligned_raw(reduce(union_relaxed, frames))


def write_wave(df: DataFrame, path: str, *, by="source") -> None:
    """One folder per source."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def read_wave(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("source", F.col("source").cast("string"))
