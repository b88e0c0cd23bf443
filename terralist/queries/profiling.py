"""Profiling queries."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from terralist.operators import keys as O, profile as A
from terralist.queries.adapter import LISTINGS_SQL, OLD, OLD_SQL, listings, wave
from terralist.queries.registry import query, table
from terralist.sources.files import parquet


@query("frequency_tables", f"""WITH {LISTINGS_SQL}
SELECT property_type, count(*) AS count FROM listings GROUP BY 1""")
def frequency_tables(spark, folder):
    return A.frequency(listings(spark, folder), "property_type")


@query("frequency_share", f"""WITH {OLD_SQL}
SELECT coalesce(id_dev, '(none)') AS id_dev, count(*) AS count, round(count(*) * 1e2 / (SELECT count(*) FROM old_wave), 2) AS pct
FROM old_wave GROUP BY 1""")
def frequency_share(spark, folder):
    return A.frequency_share(wave(spark, folder, OLD), "id_dev", null_label="(none)")


PROFILED = ["id", "lat", "lon", "asking_price", "m2_built", "m2_terrain", "no_bedrooms", "id_dev"]


@query("null_counts", f"""WITH {LISTINGS_SQL}, c AS (SELECT {', '.join(f'count(*) - count({c}) AS {c}' for c in PROFILED)} FROM listings)
UNPIVOT c ON {', '.join(PROFILED)} INTO NAME "column" VALUE n_null""")
def null_counts(spark, folder):
    return A.null_counts(listings(spark, folder).select(*PROFILED))


NAN_COLUMNS = ["lat", "lon"], ["lat", "lon", "m2_terrain"], ["lat", "asking_price"]


def _nan_sql(columns):
    every = " AND ".join(f"isnan({c})" for c in columns)
    return f"SELECT '{'+'.join(columns)}' AS columns, coalesce(bool_or({every}), false) AS any_all_nan, count(*) FILTER ({every}) AS n FROM filled"


@query("any_all_nan", f"""WITH {LISTINGS_SQL},
filled AS (SELECT {', '.join(f"coalesce({c}, 'NaN'::DOUBLE) AS {c}" for c in ('lat', 'lon', 'm2_terrain', 'asking_price'))} FROM listings)
{' UNION ALL '.join(map(_nan_sql, NAN_COLUMNS))}""")
def any_all_nan(spark, folder):
    """Whether some row has no number in any of the columns, missing ones being NaN."""
    rows = listings(spark, folder).select(*[F.coalesce(c, F.lit(float("nan"))).alias(c) for c in ("lat", "lon", "m2_terrain", "asking_price")])
    parts = []
    for columns in NAN_COLUMNS:
        every = reduce(lambda a, b: a & b, [F.isnan(c) for c in columns])
        n = rows.agg(F.count_if(every)).scalar()
        parts.append(A.any_all_nan(rows, columns).select(F.lit("+".join(columns)).alias("columns"), "any_all_nan", n.alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query("typed_union", """SELECT n_nationkey, n_name, CAST(NULL AS DOUBLE) AS note FROM nation""")
def typed_union(spark, folder):
    """A union that starts from a typed frame without rows."""
    return O.union_relaxed(O.empty_like(spark, "n_nationkey bigint, note double"), table(spark, folder, "nation").select("n_nationkey", "n_name"))


@query("parquet_projection", "SELECT o_orderkey, o_orderdate FROM orders")
def parquet_projection(spark, folder):
    """Wanted columns of a Parquet file; those it lacks are left out."""
    return parquet(spark, f"{folder}/orders.parquet", columns=["o_orderkey", "absent", "o_orderdate"])


@query("distinct_counts", f"""WITH {LISTINGS_SQL}
SELECT 'id_ext' AS "column", count(DISTINCT id_ext) AS n_distinct FROM listings UNION ALL SELECT 'lat', count(DISTINCT lat) FROM listings
UNION ALL SELECT 'id_dev', count(DISTINCT id_dev) FROM listings""")
def distinct_counts(spark, folder):
    return A.distinct_counts(listings(spark, folder), "id_ext", "lat", "id_dev")


@query("row_counts", """SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_unique, count(*) - count(DISTINCT l_orderkey) AS n_duplicates FROM lineitem""")
def row_counts(spark, folder):
    return A.row_counts(table(spark, folder, "lineitem"), "l_orderkey")


@query("largest_ids", f"WITH {LISTINGS_SQL} SELECT max(id) AS id, max(year_built) AS year_built FROM listings")
def largest_ids(spark, folder):
    return A.largest(listings(spark, folder), "id", "year_built")


@query("price_histogram", """WITH e AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem),
bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(50) t(i)),
c AS (SELECT least(CAST(floor((l_extendedprice - lo) / w) AS INTEGER), 49) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1)
SELECT b.bin, lo + b.bin * w AS lower, lo + (b.bin + 1) * w AS upper, coalesce(n, 0) AS count FROM bins b, e LEFT JOIN c ON c.bin = b.bin""")
def price_histogram(spark, folder):
    return A.histogram(table(spark, folder, "lineitem"), "l_extendedprice", bins=50)


@query("dedupe_rows", """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey DESC, l_linenumber DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_rows(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return O.one_per_key(rows, "l_orderkey", order_by="l_extendedprice", last=True)


@query("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_keys(spark, folder):
    return O.any_per_key(table(spark, folder, "events").select("user_id", "event_type"), ["user_id", "event_type"])


@query("group_sizes", """SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem""")
def group_sizes(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return O.with_group_size(rows, "l_partkey")


@query("first_seen_ids", """WITH f AS (SELECT event_type, min(event_id) AS first FROM events GROUP BY event_type)
SELECT event_type, row_number() OVER (ORDER BY first) + 9 AS type_id FROM f""")
def first_seen_ids(spark, folder):
    return O.dense_ids(
        table(spark, folder, "events"), "event_type", F.col("event_id"), output="type_id", start_at=10
    )


@query("continued_ids", """SELECT row_number() OVER (ORDER BY c_name) + (SELECT max(s_suppkey) FROM supplier) AS id, c_name FROM customer""")
def continued_ids(spark, folder):
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"))
    return O.continue_ids(table(spark, folder, "customer").select("c_name"), suppliers, "c_name")


@query("semi_anti", """SELECT c_custkey, c_mktsegment, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders FROM customer""")
def semi_anti(spark, folder):
    from terralist.operators.filters import members_of

    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    keys = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    having = members_of(customers, keys, "c_custkey").withColumn("has_orders", F.lit(True))
    without = customers.join(keys, "c_custkey", "left_anti").withColumn("has_orders", F.lit(False))
    return having.unionByName(without)
