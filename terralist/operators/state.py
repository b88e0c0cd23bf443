"""The latest row of every key, kept as a table bucketed by key.

A log of waves answers "what was known of this key" by sorting all of its history.
The state answers it by holding one row per key in as many buckets as a join has
partitions: a wave is shuffled once, by itself, and meets the state bucket by bucket;
nothing of the history moves.  Each wave writes the next version of the table beside
the last one and is current when it is complete.
"""

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralist.operators.keys import one_per_key
from terralist.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class LatestState:
    """A version of the state; ``advance`` gives the next one and leaves this one as it is."""

    spark: SparkSession
    table: str
    path: str
    key: str
    date: str
    buckets: int

    def rows(self) -> DataFrame:
        """One row per key: the latest."""
        return self.spark.table(self.table)

    def latest(self) -> DataFrame:
        """The rows without their date, as a snapshot to compare a wave with."""
        return self.rows().drop(self.date)

    def advance(self, new: DataFrame) -> "LatestState":
        """The state after more dated rows: each key has the later of its row and the best new one.

        Rows without key or date are left out; of rows of one date the largest stays, as
        everywhere in ``latest_at``; a row of the same date as the state's takes its place.
        """
        known = self.rows()
        named = _latest(new, self.key, self.date).select(*known.columns)
        fields = [c for c in known.columns if c != self.key]
        incoming = named.select(self.key, F.struct(*[F.col(c).cast(known.schema[c].dataType).alias(c) for c in fields]).alias("_new"))
        held = known.select(self.key, F.struct(*fields).alias("_old"))
        joined = held.join(incoming, self.key, "full")
        newer = F.col("_old").isNull() | (F.col(f"_new.{self.date}") >= F.col(f"_old.{self.date}"))
        chosen = F.when(F.col("_new").isNotNull() & newer, F.col("_new")).otherwise(F.col("_old"))
        following = joined.select(self.key, chosen.alias("_row")).select(*[
            F.col(c) if c == self.key else F.col(f"_row.{c}").alias(c) for c in known.columns
        ])
        return _written(following, replace(self, table=f"{self.table.rsplit('__', 1)[0]}__{uuid.uuid4().hex}"))

    def drop(self) -> None:
        """Forget this version; those before and after stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.table}")
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def _latest(rows, key, date):
    dated = rows.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    return one_per_key(dated, key, order_by=date, last=True)


def _written(rows, state):
    (rows.write.format("parquet").bucketBy(state.buckets, state.key).sortBy(state.key)
     .option("path", f"{state.path}/{state.table}").saveAsTable(state.table))
    return state


def new_state(rows: DataFrame, name: str, *, key, date, cutoff=None, buckets=None, path=None) -> LatestState:
    """A state of the latest rows per key at or before ``cutoff`` (all, without one).

    ``buckets`` is the number of shuffle partitions of the session unless given: a join
    then keeps the buckets as they are.  Tables lie under ``path``, by default the shared
    checkpoint folder.
    """
    spark = rows.sparkSession
    if path is None:
        ensure_checkpoint_dir(spark)
        path = spark.sparkContext.getCheckpointDir()
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if cutoff is not None:
        rows = rows.filter(F.col(date) <= F.lit(cutoff).cast("date"))
    state = LatestState(spark, f"{name}__{uuid.uuid4().hex}", path, key, date, buckets)
    return _written(_latest(rows, key, date).select(*rows.columns), state)
