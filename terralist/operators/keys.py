"""De-duplication, numbering, top-k and set operators."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from terralist.session import cut_lineage


def _names(columns):
    return [columns] if isinstance(columns, str) else list(columns)


def one_per_key(df: DataFrame, keys, *, order_by=None, last=False) -> DataFrame:
    """One row per key, chosen by ``order_by`` and then by all columns.

    An aggregate rather than a ranked window: partial aggregation leaves one
    row per key and map task before the shuffle, so a key that holds a third of
    all rows costs no more than any other.
    """
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in _names(order_by or [])]
    if not rest:
        return df.distinct()
    # The rank ends with the row itself, so the best rank is the row: it travels once.
    rank = F.struct(
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(rest)],
    )
    chosen = df.groupBy(*keys).agg((F.max if last else F.min)(rank).alias("_row"))
    place = {c: F.col(f"_row._t{i}").alias(c) for i, c in enumerate(rest)}
    return chosen.select(*[place.get(c, F.col(c)) for c in df.columns])


def any_per_key(df: DataFrame, keys) -> DataFrame:
    """One arbitrary row per key, where the choice does not matter."""
    return df.dropDuplicates(_names(keys))


def latest_at(df: DataFrame, key, date, cutoff=None, *, keep_date=False) -> DataFrame:
    """Latest row per key dated at or before the cutoff; null dates drop out.

    No cutoff means no previous snapshot: the result is empty.
    """
    if cutoff is None:
        dated = df.filter(F.lit(False))
    else:
        dated = df.filter(F.col(date) <= F.lit(cutoff).cast("date"))
    latest = one_per_key(dated, key, order_by=date, last=True)
    return latest if keep_date else latest.drop(date)


def number_rows(df: DataFrame, order_by, *, output="id", start_at=1) -> DataFrame:
    """Consecutive ids in the given order; rows equal in it are told apart by where they stand.

    The input is evaluated once, as it is written.  Only its sort columns and a row
    number are range-sorted, and what they get joins back; offsets come from one count
    per partition, so no window ever pulls the whole table into one task.
    """
    order = list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
    names = [c for c in order if isinstance(c, str)]
    if len(names) < len(order) or set(df.columns) <= set(names):
        # Ordered by expressions, or no wider than what would be sorted.
        return _numbered(cut_lineage(df), [F.col(c) if isinstance(c, str) else c for c in order], output, start_at)
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    places = rows.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(names)], "_row")
    narrow = [F.col(f"_o{i}") for i in range(len(names))] + [F.col("_row")]
    numbers = _numbered(places, narrow, "_number", start_at).select("_row", "_number")
    return rows.drop(output).join(numbers, "_row").drop("_row").withColumnRenamed("_number", output)


def _numbered(df, order, output, start_at):
    """Range partitioning and a local sort fix the order, a checkpoint pins it."""
    position = "_position"
    sorted_rows = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(position, F.monotonically_increasing_id())
    )
    # The upper bits hold the partition, the lower 33 the row in the partition.
    partition = F.shiftright(F.col(position), 33)
    counts = sorted_rows.groupBy(partition.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: its size is bounded by the number of partitions.
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    row = F.col(position).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        sorted_rows.withColumn("_p", partition)
        .join(F.broadcast(offsets), "_p")
        .withColumn(output, F.col("_before") + row + F.lit(start_at))
        .drop("_p", "_before", position)
    )


def continue_ids(new: DataFrame, existing: DataFrame, order_by, *, output="id") -> DataFrame:
    """Number new rows on from the largest id in use."""
    last = existing.agg(F.coalesce(F.max(F.col(output).cast("bigint")), F.lit(0))).first()[0]
    return number_rows(new.drop(output), order_by, output=output, start_at=last + 1)


def dense_ids(df: DataFrame, value, rank: Column, *, output, start_at=1) -> DataFrame:
    """(value, id): ids of distinct values in order of first appearance."""
    first = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.min(rank).alias("_first"))
    )
    return number_rows(first, ["_first", value], output=output, start_at=start_at).drop("_first")


def repeated(df: DataFrame, keys, *, more_than=1) -> DataFrame:
    """Rows whose key occurs more than ``more_than`` times."""
    keys = _names(keys)
    often = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > more_than).select(*keys)
    )
    return df.join(often, keys, "left_semi")


def with_group_size(df: DataFrame, keys, *, output="n") -> DataFrame:
    """Each row with the size of its group, counted before the join."""
    keys = _names(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))
    renamed = sizes.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [df[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
    return df.join(renamed, same, "left").drop(*[f"_{k}" for k in keys])


def ordered(df: DataFrame, *order) -> DataFrame:
    """Sort by (column, direction) pairs; nulls go last either way."""
    terms = []
    for name, direction in order:
        column = F.col(name)
        terms.append(
            column.desc_nulls_last() if direction == "desc" else column.asc_nulls_last()
        )
    return df.orderBy(*terms)


def stable_slice(df: DataFrame, key, n) -> DataFrame:
    """First ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def top_k(df: DataFrame, score, k, *, tie) -> DataFrame:
    """The ``k`` highest scores with their rank; ties by ``tie``."""
    best = df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)
    # At most k rows reach this window.
    order = Window.orderBy(F.col(score).desc_nulls_last(), F.col(tie))
    return best.withColumn("rank", F.row_number().over(order))


def random_key(df: DataFrame, key, *, seed=0) -> DataFrame:
    """One distinct key picked by a seeded hash, the same on every run and in other engines."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.filter(F.col(key).isNotNull()).orderBy(order, key).select(key).limit(1)


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Union by name: missing columns are null, types widen to the common one."""
    ranks = ["boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "string"]
    types = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            seen = types.get(name, kind)
            if seen == kind:
                types[name] = kind
            elif "void" in (seen, kind):
                types[name] = kind if seen == "void" else seen
            elif seen in ranks and kind in ranks:
                types[name] = max(seen, kind, key=ranks.index)
            else:
                types[name] = "string"
    result = None
    for frame in frames:
        frame = frame.select(
            *[F.col(c).cast(types[c]).alias(c) if k != types[c] else F.col(c)
              for c, k in frame.dtypes]
        )
        result = frame if result is None else result.unionByName(frame, allowMissingColumns=True)
    return result


def union_all(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def key_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def key_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def key_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def empty_like(spark, schema) -> DataFrame:
    """Typed frame without rows, the identity of a union."""
    return spark.createDataFrame([], schema)
