"""Mixing sources to target weights, with exact budgets.

Sources share the total size by weight; a target stops at ``epochs`` times its
source's size and the excess is shared again.  Documents get hash-random keys
and are range-sorted by source and key; prefix sums of their sizes come from
local sums and one offset per partition and source.  A source is taken whole as
often as its budget allows, then up to the exact cut, which may fall inside a
document.

A source that holds most rows is spread over many ranges; the windows below see
one row per partition and source, never one per document.

Defined results: a null text has size 0; the null source is a source, last in
order; documents of size 0 take 0; equal keys are ordered by id and size, so
that repeated rows are interchangeable; no documents or no words give targets of
0; other columns pass through, those named as an added one are replaced.
"""

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window, functions as F, types as T

from terralist.llm.batches import sheltered
from terralist.operators.keys import number_rows
from terralist.session import cut_lineage

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"


def random_key(key, seed=SEED):
    """A key in hash-random order that reruns and other engines repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def running_sums(df, order, value, output, group=None):
    """``df`` with the sum of ``value`` over the rows before, within ``group``.

    ``order`` starts with the group, if any.  Sorted ranges are written once, so
    that their sums and their rows agree.
    """
    local, part = f"{output}_local", f"{output}_part"
    names = [c for c in df.columns if c not in (local, part, output)]
    df = df.select(names)
    schema = T.StructType([*df.schema.fields, T.StructField(local, T.LongType()), T.StructField(part, T.IntegerType())])

    def sums(batches):
        pid, last, total = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            values = batch.column(names.index(value)).to_pylist()
            groups = batch.column(names.index(group)).to_pylist() if group else [None] * len(values)
            out = []
            for g, v in zip(groups, values, strict=True):
                if g != last:
                    last, total = g, 0
                out.append(total)
                total += v
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.int64()), pa.array([pid] * len(out), pa.int32())],
                names=[*names, local, part],
            )

    sorted_rows = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sums, schema))
    keys = [part] + ([group] if group else [])
    totals = sorted_rows.groupBy(*keys).agg(F.sum(value).alias("_total"))
    window = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(part).alias("_part"), *([F.col(group).alias("_group")] if group else []),
        F.coalesce(F.sum("_total").over(window), F.lit(0)).alias("_before"),
    )
    same = F.col(part) == F.col("_part")
    if group:
        same = same & F.col(group).eqNullSafe(F.col("_group"))
    return sorted_rows.join(offsets, same).withColumn(output, F.col("_before") + F.col(local)).select(*names, output)


def source_targets(sizes, source="source", size="source_size", weights=WEIGHTS, epochs=EPOCHS):
    """(source, size, weight, target) from one row per source.

    Sources that cannot use their share are those with the smallest cap per
    weight: they are a prefix of that order, found by running sums.
    """
    ranked = number_rows(sizes, [F.col(source).asc_nulls_last()], output="_rank", start_at=0)
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    caps = ranked.select(
        source, size, F.get(cycle, F.pmod("_rank", F.lit(len(weights))).cast("int")).alias("weight"), (F.col(size) * epochs).alias("cap"),
    ).withColumn("_ratio", F.col("cap") / F.col("weight"))
    order = ["_ratio", F.col(source).asc_nulls_last()]
    running = running_sums(running_sums(caps, order, "cap", "_caps"), order, "weight", "_weights")
    sums = running.agg(F.sum(size).alias("_all"), F.sum("weight").alias("_weight"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    stopped = running.crossJoin(F.broadcast(sums)).withColumn(
        "_stops", wide("cap") * (wide("_weight") - wide("_weights")) <= wide("weight") * (wide("_all") - wide("_caps"))
    )
    free = stopped.agg(
        (F.max("_all") - F.coalesce(F.sum(F.when(F.col("_stops"), F.col("cap"))), F.lit(0))).alias("_left"),
        F.sum(F.when(~F.col("_stops"), F.col("weight"))).alias("_open"),
    )
    return stopped.crossJoin(F.broadcast(free)).select(
        source, size, "weight",
        F.when(F.col("_stops"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("_left").cast("double") / F.col("_open")).alias("target"),
    )


@sheltered("_key", "_before", "_before_local", "_before_part", "_part", "_group", "_source", "_budget", "_whole", "weight", "whole_epochs")
def mix(docs, size="size", source="source", key="doc_id", weights=WEIGHTS, epochs=EPOCHS, seed=SEED):
    """``docs`` with ``source_size``, ``target`` and ``taken``; sums are exact."""
    added = ("source_size", "target", "taken")
    docs = docs.select([c for c in docs.columns if c not in added])
    keyed = docs.withColumn("_key", random_key(key, seed))
    order = [F.col(source).asc_nulls_last(), "_key", key, size]
    placed = running_sums(keyed, order, size, "_before", group=source)
    sizes = placed.groupBy(source).agg(F.sum(size).alias("source_size"))
    targets = source_targets(sizes, source, weights=weights, epochs=epochs).withColumnRenamed(source, "_source")
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long")
    cut = F.greatest(F.lit(0), F.least(F.col(size), F.col("_budget") - F.col("_whole") * F.col("source_size") - F.col("_before")))
    return (
        placed.join(targets, F.col(source).eqNullSafe(F.col("_source")))
        .withColumns({"_budget": budget, "_whole": whole})
        .withColumn("taken", F.col("_whole") * F.col(size) + cut)
        .select(*docs.columns, *added, F.col("_whole").alias("whole_epochs"))
    )


def take(mixed, size="size", text="text"):
    """The rows the mix consists of: ``epoch`` numbers the copies of a document.

    A document is repeated for each whole epoch; the one at the cut follows with
    its first words only.  Documents without words are kept once, they cost no
    budget.
    """
    rest = F.col("taken") - F.col("whole_epochs") * F.col(size)
    copies = F.when(F.col(size) == 0, F.lit(1)).otherwise(F.col("whole_epochs") + F.when(rest > 0, 1).otherwise(0)).cast("int")
    rows = mixed.filter(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), copies)))
    partly = (F.col("epoch") > F.col("whole_epochs")) & (F.col(size) > 0) & (rest < F.col(size))
    words = F.split(F.trim(text, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    short = F.array_join(F.slice(words, F.lit(1), F.greatest(rest.cast("int"), F.lit(1))), " ")
    return rows.withColumn(text, F.when(partly, short).otherwise(F.col(text)))


def mix_sql(weights=WEIGHTS, epochs=EPOCHS, seed=SEED):
    cycle = ", ".join(map(str, weights))
    return rf"""
WITH d AS (SELECT doc_id, source, md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                  CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [{cycle}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} AS INTEGER) + 1] AS weight, source_size * {epochs} AS cap FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS caps, coalesce(sum(weight) OVER o, 0) AS weights,
             sum(source_size) OVER () AS total, sum(weight) OVER () AS total_weight FROM w
      WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * (total_weight - weights) <= weight * (total - caps) AS stops FROM r),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
             CASE WHEN stops THEN CAST(cap AS DOUBLE)
                  ELSE weight * CAST(total - coalesce(sum(cap) FILTER (WHERE stops) OVER (), 0) AS DOUBLE) / sum(weight) FILTER (WHERE NOT stops) OVER () END AS target FROM f),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM t)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, budget - whole * source_size - before)) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source"""
