"""Tools that keep groups of any size from landing on one task.

``group_key``      one short key per distinct combination of columns, so copies
                   collapse into a weighted row before anything is joined.
``split_hot``      cuts the join keys that hold too many rows into shards.
``outer_join``     left join in which neither null keys nor hot ones meet in one task.
``match_counts``   counts per row from matches between groups.
"""

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 20_000


def group_key(*columns) -> Column:
    """128-bit key of a combination of columns, nulls included.

    ``to_json`` writes field names and leaves nulls out, so no two different
    combinations of values share a text.
    """
    return F.md5(F.to_json(F.struct(*columns)))


def hot_keys(df: DataFrame, keys, *, hot_rows=HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and how many shards each needs.

    Counted with map-side combine; at most rows / hot_rows keys come out.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_shards"))
    )


def split_hot(left: DataFrame, right: DataFrame, keys, *, spread_by, hot_rows=HOT_ROWS):
    """Both sides of an equi-join with a ``_shard`` column added to the key.

    Rows of ``right`` under a hot key are spread over its shards by the hash of
    ``spread_by``; rows of ``left`` meet every shard.  Each pair of rows still
    meets exactly once, so the join result is unchanged.  The hot keys, at most one
    in ``hot_rows`` rows, are broadcast: looking them up shuffles neither side.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(right, keys, hot_rows=hot_rows))
    count = F.coalesce(F.col("_shards"), F.lit(1))
    right = right.join(hot, keys, "left").withColumn(
        "_shard", F.pmod(F.hash(spread_by), count)
    ).drop("_shards")
    left = left.join(hot, keys, "left").withColumn(
        "_shard", F.explode(F.sequence(F.lit(0), count - 1))
    ).drop("_shards")
    return left, right


def outer_join(left: DataFrame, right: DataFrame, keys, *, hot_rows=HOT_ROWS) -> DataFrame:
    """Left join with a side of few rows per key, as of a mapping.

    Rows with a null key match nothing: they stay out of the join and come back by
    union.  Rows of a key with more than ``hot_rows`` are spread over shards, and the
    right rows of that key are repeated for each of them.
    """
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # Which shard a row goes to does not matter, as every shard has the right rows.
    right_rows, left_rows = split_hot(right, left.filter(known), keys, spread_by=F.monotonically_increasing_id(), hot_rows=hot_rows)
    joined = left_rows.join(right_rows, [*keys, "_shard"], "left").drop("_shard")
    kinds = dict(right.dtypes)
    added = [F.lit(None).cast(kinds[c]).alias(c) for c in right.columns if c not in keys]
    return joined.unionByName(left.filter(~known).select("*", *added))


def match_counts(matches: DataFrame) -> DataFrame:
    """(center, n_matches): rows that each member of a center group matches,
    the member itself not counted."""
    own = F.max(F.when(F.col("center") == F.col("neighbour"), 1).otherwise(0))
    return matches.groupBy("center").agg((F.sum("n_rows") - own).alias("n_matches"))
