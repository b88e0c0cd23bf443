"""Profiling: counts, distributions, comparisons of stages and results."""

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window, functions as F

from terralist.operators.shaping import schema_changes


def frequency(df: DataFrame, column, *, weight=None) -> DataFrame:
    """(value, count), most frequent first; null is a value."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(column).agg(size.alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(column))


def frequency_share(df: DataFrame, column, *, null_label=None) -> DataFrame:
    """(value, count, pct) with null under a label."""
    value = F.col(column).cast("string")
    if null_label is not None:
        value = F.coalesce(value, F.lit(null_label))
    counts = df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(column, "count", F.round(F.col("count") / total * 100, 2).alias("pct"))


def largest(df: DataFrame, *columns) -> DataFrame:
    """Maximum of each column, 0 when there is none."""
    return df.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in columns])


def distinct_counts(df: DataFrame, *columns) -> DataFrame:
    """(column, n_distinct) without nulls, each counted from partial aggregates."""
    one = [
        df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.lit(1).alias("_one"))
        .agg(F.count(F.lit(1)).alias("n_distinct"))
        .select(F.lit(c).alias("column"), "n_distinct")
        for c in columns
    ]
    return reduce(DataFrame.unionByName, one)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "n_null")


def any_all_nan(df: DataFrame, columns) -> DataFrame:
    """One row: is there a row in which every column is NaN?"""
    every = reduce(lambda a, b: a & b, [F.isnan(F.col(c)) for c in columns])
    return df.agg(F.coalesce(F.bool_or(F.coalesce(every, F.lit(False))), F.lit(False)).alias("any_all_nan"))


def row_counts(df: DataFrame, key) -> DataFrame:
    """One row: rows, distinct keys (null is one key), rows beyond one per key."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_unique")
    )
    return total.withColumn("n_duplicates", F.col("n_rows") - F.col("n_unique"))


def stage_counts(df: DataFrame, stages) -> DataFrame:
    """(stage, n_rows): rows left after each of a chain of filters, in one pass.

    ``stages`` are (name, condition) pairs; each applies on top of those before.
    """
    aggregates, names, passed = [], [], F.lit(True)
    for name, condition in stages:
        passed = passed & F.coalesce(condition, F.lit(False))
        aggregates.append(F.count_if(passed).alias(name))
        names.append(name)
    return df.agg(*aggregates).unpivot([], names, "stage", "n_rows")


def observed(df: DataFrame, name: str):
    """(frame, observation): the row count arrives with the next action on it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def stage_summary(stages) -> DataFrame:
    """Rows and columns of each named stage and what changed since the one before."""
    stages = list(stages)
    spark = stages[0][1].sparkSession
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("stage", F.lit(name))
         for name, df in stages],
    )
    # One row per stage.
    changes = spark.createDataFrame(
        [(i, c["stage"], c["columns"], c["column_change"], ", ".join(c["added"]),
          ", ".join(c["removed"])) for i, c in enumerate(schema_changes(stages))],
        "step int, stage string, n_columns int, column_change int, added string, removed string",
    )
    before = F.lag("n_rows").over(Window.orderBy("step"))
    return counts.join(F.broadcast(changes), "stage").select(
        "step", "stage", "n_rows", F.coalesce(F.col("n_rows") - before, F.lit(0)).alias("row_change"),
        "n_columns", "column_change", "added", "removed",
    )


def cleaning_report(df: DataFrame) -> DataFrame:
    """One row of text cleaning totals."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_texts"),
        F.count_if("is_empty").alias("n_empty"),
        F.round(F.try_divide(F.count_if("is_empty") * 100, n), 1).alias("pct_empty"),
        F.count_if("is_too_short").alias("n_too_short"),
        F.round(F.try_divide(F.count_if("is_too_short") * 100, n), 1).alias("pct_too_short"),
        F.avg("original_length").alias("avg_original"),
        F.avg("clean_length").alias("avg_clean"),
        (F.avg("reduction_ratio") * 100).alias("pct_reduction"),
    )


def cleaning_examples(df: DataFrame, n=3, *, key, original="description_clean",
                      cleaned="description_embeddings_clean", width=300) -> DataFrame:
    """First ``n`` texts by key before and after, shortened for display."""
    def shown(column):
        text = F.col(column)
        return F.when(
            F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
        ).otherwise(text)

    return df.orderBy(key).limit(n).select(
        key, shown(original).alias("original"), shown(cleaned).alias("cleaned"),
        "original_length", "clean_length", "reduction_ratio",
    )


def _ends(df, column, lo=None, hi=None):
    """(low, high) of a column as scalar subqueries, unless given."""
    low = df.agg(F.min(column).cast("double")).scalar() if lo is None else F.lit(float(lo))
    high = df.agg(F.max(column).cast("double")).scalar() if hi is None else F.lit(float(hi))
    return low, high


def _all_bins(spark, bins) -> DataFrame:
    return spark.range(bins).select(F.col("id").cast("int").alias("bin"))


def histogram(
    df: DataFrame, column="score", *, bins=50, lo=None, hi=None, weight=None
) -> DataFrame:
    """(bin, lower, upper, count): equal-width bins, the last one closed.

    Empty bins have count 0.  ``weight`` names a column of multiplicities.
    """
    size = F.lit(1) if weight is None else F.col(weight)
    low, high = _ends(df, column, lo, hi)
    width = (high - low) / F.lit(bins)
    value = F.col(column)
    place = F.coalesce(F.floor(F.try_divide(value - low, width)), F.lit(0))
    counts = (
        df.filter(value.between(low, high))
        .select(F.least(place.cast("int"), F.lit(bins - 1)).alias("bin"), size.alias("_w"))
        .groupBy("bin").agg(F.sum("_w").alias("count"))
    )
    # ``counts`` has at most ``bins`` rows.
    return _all_bins(df.sparkSession, bins).join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("lower"),
        (low + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def share_at_least(df: DataFrame, threshold, column="score", *, weight=None, total=None) -> DataFrame:
    """One row: percent of rows (or weights) with the column at the threshold.

    ``total`` is a one-row table with the size of the whole where ``df`` holds
    only a part of it.
    """
    size = F.lit(1) if weight is None else F.col(weight)
    hit = F.sum(F.when(F.col(column) >= threshold, size).otherwise(0))
    if total is None:
        return df.agg((F.try_divide(hit, F.sum(size)) * 100).alias("pct"))
    whole = total.toDF("_total")
    return df.agg(F.coalesce(hit, F.lit(0)).alias("_hit")).crossJoin(F.broadcast(whole)).select(
        (F.try_divide("_hit", "_total") * 100).alias("pct"))


def with_rest(bins: DataFrame, total: DataFrame, lowest: float) -> DataFrame:
    """Histogram bins and, as bin -1, what of the total lies under them."""
    rest = bins.agg(F.min("lower").alias("upper"), F.sum("count").alias("_seen")).crossJoin(F.broadcast(total.toDF("_total")))
    return bins.unionByName(rest.select(
        F.lit(-1).alias("bin"), F.lit(float(lowest)).alias("lower"), "upper", (F.col("_total") - F.col("_seen")).cast("bigint").alias("count")))


def binned_trend(
    df: DataFrame, score="score", attribute="s_price", *, bins=50, weight=None, include_max=False
) -> DataFrame:
    """(bin, center, mean_score): mean score per half-open bin of an attribute.

    The largest value falls in no bin unless ``include_max``; empty bins have
    a null mean.
    """
    size = F.lit(1) if weight is None else F.col(weight)
    known = df.filter(F.col(attribute).isNotNull() & F.col(score).isNotNull())
    low, high = _ends(known, attribute)
    width = (high - low) / F.lit(bins)
    place = F.floor(F.try_divide(F.col(attribute) - low, width)).cast("int")
    if include_max:
        place = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    means = (
        known.select(place.alias("bin"), (F.col(score) * size).alias("_s"), size.alias("_w"))
        .groupBy("bin").agg((F.sum("_s") / F.sum("_w")).alias("mean_score"))
    )
    # ``means`` has at most ``bins`` + 1 rows.
    return _all_bins(df.sparkSession, bins).join(F.broadcast(means), "bin", "left").select(
        "bin", (low + (F.col("bin") + 0.5) * width).alias("center"), "mean_score"
    )


def margin_line(df: DataFrame, score="score", attribute="s_price") -> DataFrame:
    """One row: slope and intercept of the line from the smallest to the largest."""
    ends = df.agg(
        F.min(score).alias("s0"), F.max(score).alias("s1"),
        F.min(attribute).alias("a0"), F.max(attribute).alias("a1"),
    )
    slope = F.coalesce(F.try_divide(F.col("s1") - F.col("s0"), F.col("a1") - F.col("a0")), F.lit(0.0))
    return ends.select(slope.alias("slope"), (F.col("s0") - slope * F.col("a0")).alias("intercept"))


def set_comparison(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """One row: sizes of two key sets, of their overlap and of what is left over."""
    sides = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = sides.groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    l, r = F.col("_l") == 1, F.col("_r") == 1
    return per_key.agg(
        F.count_if(l).alias("n_left"), F.count_if(r).alias("n_right"),
        F.count_if(l & r).alias("n_both"), F.count_if(l & ~r).alias("n_only_left"),
        F.count_if(r & ~l).alias("n_only_right"),
    )
