"""Change tracking queries."""

from pyspark.sql import functions as F

from terralist.operators import waves as W
from terralist.operators.keys import number_rows, union_all, union_relaxed
from terralist.operators.state import new_state
from terralist.queries.adapter import NEW, OLD, WAVES_SQL, wave
from terralist.queries.registry import query

FIELDS = [
    "asking_price", "currency", "m2_built", "m2_terrain", "lat", "lon",
    "no_bedrooms", "no_full_bathrooms", "year_built",
]
NUMERIC = [f for f in FIELDS if f != "currency"]

# The log holds three states of every old listing: an older price, the state
# of the old wave, and one dated after the cutoff that must not be used.
STATES = [("2023-12-25", 0.9), (OLD, 1.0), ("2024-02-01", 1.2)]

LOG_SQL = f"""{WAVES_SQL},
log AS (SELECT o.* REPLACE (o.asking_price * s.factor AS asking_price), s.wave_date
  FROM old_wave o, (VALUES ('2023-12-25', 9e-1), ('{OLD}', 1e0), ('2024-02-01', 1.2e0)) s(wave_date, factor)),
snapshot AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_ext ORDER BY wave_date DESC) AS rn
  FROM log WHERE CAST(wave_date AS DATE) <= DATE '{OLD}') WHERE rn = 1)"""

ROUNDED = ", ".join(
    f"round(n.{f}, 6) AS {f}" if f in NUMERIC else f"n.{f}" for f in FIELDS
)
DIFFERENT = " OR ".join(
    f"round(o.{f}, 6) IS DISTINCT FROM round(n.{f}, 6)" if f in NUMERIC
    else f"o.{f} IS DISTINCT FROM n.{f}" for f in FIELDS
)


def log_table(spark, folder):
    old = wave(spark, folder, OLD)
    states = [
        old.withColumns({
            "asking_price": F.col("asking_price") * F.lit(factor), "wave_date": F.lit(day),
        })
        for day, factor in STATES
    ]
    return union_all(*states)


CHANGE_LOG_SQL = f"""WITH {LOG_SQL}
SELECT n.id_ext, n.source_type, {ROUNDED}, '{NEW}' AS wave_date,
  CASE WHEN o.id_ext IS NULL THEN 'new' ELSE 'changed' END AS change_type
FROM new_wave n LEFT JOIN snapshot o ON o.id_ext = n.id_ext
WHERE o.id_ext IS NULL OR {DIFFERENT}"""


@query("wave_change_log", CHANGE_LOG_SQL)
def wave_change_log(spark, folder):
    return W.change_log(
        wave(spark, folder, NEW), log_table(spark, folder), NEW, OLD, fields=FIELDS
    )


@query("wave_change_log_state", CHANGE_LOG_SQL)
def wave_change_log_state(spark, folder):
    """The same log from the maintained state instead of the whole history."""
    state = new_state(log_table(spark, folder), "snapshot", key="id_ext", date="wave_date", cutoff=OLD)
    return W.log_against(wave(spark, folder, NEW), state.latest(), NEW, fields=FIELDS)


@query("latest_state", f"""WITH {LOG_SQL},
dated AS (SELECT id_ext, asking_price, CAST(wave_date AS DATE) AS day FROM log WHERE wave_date <= '{OLD}'
  UNION ALL SELECT id_ext, asking_price, DATE '{NEW}' FROM new_wave)
SELECT id_ext, asking_price, CAST(day AS VARCHAR) AS day FROM dated QUALIFY row_number() OVER (PARTITION BY id_ext ORDER BY day DESC) = 1""")
def latest_state(spark, folder):
    """Every key's latest row after two waves, the second taken into the state of the first."""
    columns = ["id_ext", "asking_price", F.col("wave_date").cast("date").alias("day")]
    state = new_state(log_table(spark, folder).select(*columns), "latest", key="id_ext", date="day", cutoff=OLD)
    after = state.advance(wave(spark, folder, NEW).withColumn("wave_date", F.lit(NEW)).select(*columns))
    return after.rows().withColumn("day", F.col("day").cast("string"))


@query("wave_change_log_first", f"""WITH {WAVES_SQL}
SELECT n.id_ext, n.source_type, {ROUNDED}, '{OLD}' AS wave_date, 'new' AS change_type FROM old_wave n""")
def wave_change_log_first(spark, folder):
    """The first wave ever has no cutoff: everything is new."""
    return W.change_log(
        wave(spark, folder, OLD), log_table(spark, folder), OLD, None, fields=FIELDS
    )


@query("log_append_guard", f"""WITH {LOG_SQL}
SELECT 'rerun' AS run, count(*) AS n_rows FROM new_wave WHERE false
UNION ALL SELECT 'first', count(*) FROM new_wave n LEFT JOIN snapshot o ON o.id_ext = n.id_ext
WHERE o.id_ext IS NULL OR {DIFFERENT}""")
def log_append_guard(spark, folder):
    """A second run of the same wave appends nothing."""
    log = log_table(spark, folder)
    rows = wave_change_log(spark, folder)
    n = F.count(F.lit(1)).alias("n_rows")
    first = W.append_new(log, rows).agg(n).select(F.lit("first").alias("run"), "n_rows")
    again = W.append_new(union_relaxed(log, rows), rows).agg(n)
    return first.union(again.select(F.lit("rerun").alias("run"), "n_rows"))


@query("wave_classify", f"""WITH {WAVES_SQL}
SELECT coalesce(n.id_ext, o.id_ext) AS id_ext,
  CASE WHEN o.id_ext IS NULL THEN 'new' WHEN n.id_ext IS NULL THEN 'removed' ELSE 'continuing' END AS status,
  CASE WHEN n.id_ext IS NULL THEN 0 ELSE 1 END AS n_new, CASE WHEN o.id_ext IS NULL THEN 0 ELSE 1 END AS n_old
FROM new_wave n FULL JOIN old_wave o ON o.id_ext = n.id_ext""")
def wave_classify(spark, folder):
    return W.classify(wave(spark, folder, NEW), wave(spark, folder, OLD))


@query("wave_new_and_removed", f"""WITH {WAVES_SQL}
SELECT id_ext, 'published' AS side, asking_price FROM new_wave WHERE id_ext NOT IN (SELECT id_ext FROM old_wave)
UNION ALL SELECT id_ext, 'kept', asking_price FROM new_wave WHERE id_ext IN (SELECT id_ext FROM old_wave)
UNION ALL SELECT id_ext, 'removed', asking_price FROM old_wave WHERE id_ext NOT IN (SELECT id_ext FROM new_wave)""")
def wave_new_and_removed(spark, folder):
    new, old = wave(spark, folder, NEW), wave(spark, folder, OLD)
    parts = [("published", W.published(new, old)), ("kept", W.continuing(new, old)),
             ("removed", W.removed(new, old))]
    return union_all(*[
        df.select("id_ext", F.lit(side).alias("side"), "asking_price") for side, df in parts
    ])


@query("wave_overlap_stats", f"""WITH {WAVES_SQL},
k AS (SELECT n.id_ext AS a, o.id_ext AS b FROM new_wave n FULL JOIN old_wave o ON o.id_ext = n.id_ext)
SELECT count(a) AS n_new_wave, count(b) AS n_old_wave,
  count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS n_common,
  count(*) FILTER (b IS NULL) AS n_published, count(*) FILTER (a IS NULL) AS n_removed,
  CAST(count(*) FILTER (b IS NULL) AS DOUBLE) / count(a) AS published_share,
  CAST(count(*) FILTER (a IS NULL) AS DOUBLE) / count(b) AS removed_share
FROM k""")
def wave_overlap_stats(spark, folder):
    return W.overlap_stats(wave(spark, folder, NEW), wave(spark, folder, OLD))


# --- historical table -------------------------------------------------------------

HISTORY_FIELDS = ["asking_price", "currency", "m2_built", "lat", "lon", "no_bedrooms",
                  "no_full_bathrooms"]

HISTORY_SQL = f"""{WAVES_SQL},
history AS (SELECT row_number() OVER (ORDER BY id_ext) AS id, id_ext, source_type, {', '.join(HISTORY_FIELDS)},
  '{OLD}' AS published_wave, CASE WHEN o.id % 41 = 0 THEN '2023-12-25' END AS unpublished_wave,
  o.id % 41 <> 0 AS is_active FROM old_wave o)"""


def history_table(spark, folder):
    old = wave(spark, folder, OLD)
    inactive = F.col("id") % 41 == 0
    rows = old.select(
        "id_ext", "source_type", *HISTORY_FIELDS, F.lit(OLD).alias("published_wave"),
        F.when(inactive, "2023-12-25").alias("unpublished_wave"), (~inactive).alias("is_active"),
    )
    return number_rows(rows, "id_ext", output="id")


def merged_history(spark, folder):
    new = wave(spark, folder, NEW).select("id_ext", "source_type", *HISTORY_FIELDS)
    return W.merge_history(history_table(spark, folder), new, NEW, tracked=HISTORY_FIELDS)


_CHG = {f: f"(n.{f} IS NOT NULL AND n.{f} IS DISTINCT FROM h.{f})" for f in HISTORY_FIELDS}
MERGE_SQL = f"""{HISTORY_SQL},
merged AS (SELECT h.id, h.id_ext, h.source_type,
  {', '.join(f'CASE WHEN {c} THEN n.{f} ELSE h.{f} END AS {f}' for f, c in _CHG.items())},
  h.published_wave,
  CASE WHEN n.id_ext IS NULL AND h.is_active THEN '{NEW}' ELSE h.unpublished_wave END AS unpublished_wave,
  h.is_active AND n.id_ext IS NOT NULL AS is_active,
  {', '.join(f"CASE WHEN {c} THEN '{NEW}' END AS {f}_last_updated_wave" for f, c in _CHG.items())}
FROM history h LEFT JOIN new_wave n ON n.id_ext = h.id_ext
UNION ALL BY NAME
SELECT (SELECT max(id) FROM history) + row_number() OVER (ORDER BY id_ext) AS id, id_ext, source_type,
  {', '.join(HISTORY_FIELDS)}, '{NEW}' AS published_wave, true AS is_active
FROM new_wave WHERE id_ext NOT IN (SELECT id_ext FROM history))"""


@query("historical_merge", f"WITH {MERGE_SQL} SELECT * FROM merged")
def historical_merge(spark, folder):
    return merged_history(spark, folder)


@query("unpublish_stats", f"""WITH {MERGE_SQL}
SELECT coalesce(unpublished_wave, '(no unpublish)') AS unpublished_wave, count(*) AS count,
  round(count(*) * 1e2 / (SELECT count(*) FROM merged), 2) AS pct FROM merged GROUP BY 1""")
def unpublish_stats(spark, folder):
    return W.unpublish_stats(merged_history(spark, folder))


# --- audits ----------------------------------------------------------------------------


@query("changes_per_field", f"""WITH {LOG_SQL}, c AS (SELECT
  {', '.join(f"count(*) FILTER (round(o.{f}, 6) IS DISTINCT FROM round(n.{f}, 6)) AS {f}" if f in NUMERIC
             else f"count(*) FILTER (o.{f} IS DISTINCT FROM n.{f}) AS {f}" for f in FIELDS)}
  FROM new_wave n JOIN snapshot o ON o.id_ext = n.id_ext)
UNPIVOT c ON {', '.join(FIELDS)} INTO NAME field VALUE n_changes""")
def changes_per_field(spark, folder):
    snapshot = W.latest_at(log_table(spark, folder), "id_ext", "wave_date", OLD)
    pairs = W.compared(wave(spark, folder, NEW), snapshot, fields=FIELDS)
    return W.changes_per_field(pairs)


@query("log_audit", f"""WITH {LOG_SQL}, same AS (SELECT id_ext FROM log GROUP BY id_ext
  HAVING count(DISTINCT wave_date) > 1 AND {' AND '.join(f"count(DISTINCT {f}) + max(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) = 1" for f in FIELDS if f != 'asking_price')})
SELECT count(*) AS n_rows, count(DISTINCT id_ext) AS n_keys, count(*) - count(DISTINCT id_ext) AS n_duplicate_rows,
  (SELECT count(*) FROM same) AS n_identical FROM log""")
def log_audit(spark, folder):
    fields = [f for f in FIELDS if f != "asking_price"]
    return W.log_audit(log_table(spark, folder), fields=fields)


@query("latest_event_at_cutoff", """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC, event_type DESC) AS rn
  FROM events WHERE CAST(ts AS DATE) <= (SELECT CAST(min(ts) + (max(ts) - min(ts)) / 2 AS DATE) FROM events)) WHERE rn = 1""")
def latest_event_at_cutoff(spark, folder):
    """Latest event per user at or before the middle of the recorded time."""
    from terralist.queries.registry import table

    events = table(spark, folder, "events")
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    middle = ends.select((F.col("a") + (F.col("b") - F.col("a")) / 2).cast("date").alias("m")).first()["m"]
    dated = events.select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type", "value")
    return W.latest_at(dated, "user_id", "day", middle)
