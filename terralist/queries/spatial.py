"""Radius search, cells, grouping and pair score queries."""

import math

from pyspark.sql import functions as F

from terralist import constants as K
from terralist.functions.geo import k_ring, ring_offsets
from terralist.functions.numbers import area_flag, fill_zero, normalize_price, with_repaired_areas
from terralist.operators import pairs as P, profile as A, spatial as S
from terralist.operators.cover import PART_ROWS
from terralist.queries.adapter import HISTORY_SQL, history
from terralist.operators.keys import top_k
from terralist.queries.registry import query
from terralist.session import cut_lineage, kept_partitions

# --- potential duplicates ------------------------------------------------------------


def distance_sql(a, b):
    return (f"2e0 * 6371e0 * asin(sqrt(least(1e0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2e0), 2)"
            f" + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2e0), 2))))")


def tolerance_sql(column, low, high):
    return f"(n.{column} BETWEEN c.{column} * {low} AND c.{column} * {high} OR c.{column} IS NULL OR n.{column} IS NULL)"


def same_sql(column):
    return f"(c.{column} = n.{column} OR c.{column} IS NULL OR n.{column} IS NULL)"


# Every pair is compared by its exact distance; the latitude test only saves time.
MATCHED_SQL = f"""matched AS (SELECT c.id, n.id AS other FROM points c JOIN points n
  ON c.lat IS NOT NULL AND n.lat BETWEEN c.lat - 3e-3 AND c.lat + 3e-3 AND c.id <> n.id
  WHERE c.is_active AND {distance_sql('c', 'n')} <= 2e-1
    AND {tolerance_sql('asking_price', '8.5e-1', '1.15e0')} AND {tolerance_sql('m2_built', '9.5e-1', '1.05e0')}
    AND {same_sql('no_bedrooms')} AND {same_sql('no_full_bathrooms')}
    AND (c.id_dev <> n.id_dev OR c.id_dev IS NULL OR n.id_dev IS NULL))"""
LOCATED_SQL = """located AS (SELECT id, min(id) OVER same AS group_id, count(*) OVER same AS n_rows FROM points WHERE lat IS NOT NULL AND lon IS NOT NULL
  WINDOW same AS (PARTITION BY lat, lon, asking_price, m2_built, no_bedrooms, no_full_bathrooms, id_dev))"""
DUPLICATES_SQL = f"""{HISTORY_SQL},
points AS (SELECT *, id % 41 <> 0 AS is_active FROM history),
{MATCHED_SQL}"""


def points(spark, folder):
    return history(spark, folder).withColumn("is_active", F.col("id") % 41 != 0)


@query("potential_duplicate_counts", f"""WITH {DUPLICATES_SQL}
SELECT p.id, count(m.other) AS n_duplicates FROM points p LEFT JOIN matched m ON m.id = p.id GROUP BY p.id""")
def potential_duplicate_counts(spark, folder):
    return S.count_potential_duplicates(points(spark, folder))


GROUPED_SQL = f"""{DUPLICATES_SQL},
{LOCATED_SQL}"""


def lists_sql(pairs, groups):
    """Partners by id, 10,000 a part. Parts are cut where those of the whole group are, which
    counts a row that meets its own group among them."""
    return f"""n AS (SELECT id, count(*) AS n FROM {pairs} GROUP BY id),
met AS (SELECT g.group_id, m.other FROM {pairs} m JOIN {groups} g ON g.id = m.id
  UNION SELECT g.group_id, m.id FROM {pairs} m JOIN {groups} g ON g.id = m.id JOIN {groups} o ON o.id = m.other AND o.group_id = g.group_id),
parts AS (SELECT group_id, other, (row_number() OVER (PARTITION BY group_id ORDER BY other) - 1) // {PART_ROWS} AS part FROM met),
lists AS (SELECT m.id, p.part, list(m.other ORDER BY m.other) AS others FROM {pairs} m JOIN {groups} g ON g.id = m.id
  JOIN parts p ON p.group_id = g.group_id AND p.other = m.other GROUP BY m.id, p.part)"""


@query("potential_duplicates", f"""WITH {GROUPED_SQL}, {lists_sql('matched', 'located')}
SELECT p.id, l.group_id, coalesce(n.n, 0) AS n_duplicates, CAST(coalesce(s.part, 0) AS BIGINT) AS part,
  CAST(to_json(coalesce(s.others, [])) AS VARCHAR) AS potential_duplicates
FROM points p LEFT JOIN located l ON l.id = p.id LEFT JOIN n ON n.id = p.id LEFT JOIN lists s ON s.id = p.id""")
def potential_duplicates(spark, folder):
    """Every listing with its group of equal listings and its possible duplicates, counted and listed."""
    found = S.find_potential_duplicates(points(spark, folder)).lists("potential_duplicates", "n_duplicates")
    return found.withColumn("potential_duplicates", F.to_json("potential_duplicates"))


@query("potential_duplicate_groups", f"""WITH {GROUPED_SQL}
SELECT DISTINCT a.group_id, b.group_id AS other_id, b.n_rows FROM matched m JOIN located a ON a.id = m.id JOIN located b ON b.id = m.other""")
def potential_duplicate_groups(spark, folder):
    """Which groups are possible duplicates of which."""
    return S.find_potential_duplicates(points(spark, folder)).links


@query("potential_duplicates_of", f"""WITH {DUPLICATES_SQL}, n AS (SELECT id, count(*) AS n FROM matched GROUP BY id ORDER BY n DESC, id LIMIT 1)
SELECT id, other FROM matched WHERE id IN (SELECT id FROM n)""")
def potential_duplicates_of(spark, folder):
    """The possible duplicates of the listing that has most of them, one by one."""
    cover = S.find_potential_duplicates(points(spark, folder))
    most = top_k(cover.counts("n"), "n", 1, tie="id")
    return cover.pairs_of(most)


# --- cells ------------------------------------------------------------------------------


def number_sql(value):
    text = repr(float(value))
    return text if "e" in text else text + "e0"


_DEGREE = math.pi * K.EARTH_RADIUS_KM / 180.0
_X = f"(lon * {number_sql(_DEGREE * math.cos(math.radians(19.4)))})"
_Y = f"(lat * {number_sql(_DEGREE)})"


def cells_sql(edge, source="history", name="cells"):
    e = number_sql(edge)
    return f"""{name}_a AS (SELECT *, ({_X} * {number_sql(math.sqrt(3.0) / 3.0)} - {_Y} / 3e0) / {e} AS fq,
    ({_Y} * {number_sql(2.0 / 3.0)}) / {e} AS fr FROM {source}),
{name}_b AS (SELECT *, floor(fq + 5e-1) AS nq, floor(fr + 5e-1) AS nr, floor(-fq - fr + 5e-1) AS ns FROM {name}_a),
{name}_c AS (SELECT *, abs(nq - fq) AS eq, abs(nr - fr) AS er, abs(ns - (-fq - fr)) AS es FROM {name}_b),
{name} AS (SELECT * EXCLUDE (fq, fr, nq, nr, ns, eq, er, es),
    CAST(CASE WHEN eq > er AND eq > es THEN -nr - ns ELSE nq END AS BIGINT) AS q,
    CAST(CASE WHEN NOT (eq > er AND eq > es) AND er > es THEN -nq - ns ELSE nr END AS BIGINT) AS r FROM {name}_c)"""


def ring_sql(k=1):
    return "ring(dq, dr) AS (VALUES " + ", ".join(f"({q}, {r})" for q, r in ring_offsets(k)) + ")"


CELL_TEXT = "CAST(q AS VARCHAR) || ':' || CAST(r AS VARCHAR)"


def with_cells(spark, folder, edge=0.2):
    return S.with_cell(history(spark, folder), edge_km=edge)


@query("hex_cells", f"WITH {HISTORY_SQL}, {cells_sql(0.2)} SELECT id, {CELL_TEXT} AS cell FROM cells")
def hex_cells(spark, folder):
    return with_cells(spark, folder).select("id", "cell")


@query("hex_kring", f"""WITH {HISTORY_SQL}, {cells_sql(0.2)}, {ring_sql(2)}
SELECT id, list_sort(list(CAST(q + dq AS VARCHAR) || ':' || CAST(r + dr AS VARCHAR)))::VARCHAR AS ring FROM cells, ring WHERE q IS NOT NULL GROUP BY id
UNION ALL SELECT id, NULL FROM cells WHERE q IS NULL""")
def hex_kring(spark, folder):
    ring = F.array_sort(k_ring("cell", 2))
    text = F.concat(F.lit("["), F.array_join(F.transform(ring, lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "), F.lit("]"))
    return with_cells(spark, folder).select("id", text.alias("ring"))


def grouping_sql(edge):
    return f"""{HISTORY_SQL}, {cells_sql(edge)}, {ring_sql()},
blocks AS (SELECT q, r, row_number() OVER (ORDER BY min(id)) AS block_id FROM cells WHERE q IS NOT NULL GROUP BY q, r),
links AS (SELECT a.block_id AS a, b.block_id AS b FROM blocks a, ring JOIN blocks b ON b.q = a.q + dq AND b.r = a.r + dr),
owners AS (SELECT a AS block_id, min(b) AS owner FROM links GROUP BY a),
neighbourhoods AS (SELECT block_id, dense_rank() OVER (ORDER BY owner) AS neighbourhood_id FROM owners)"""


def reach_sql(edge):
    return f"""{grouping_sql(edge)},
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
groups AS (SELECT a AS block_id, min(b) AS first FROM reach GROUP BY a),
components AS (SELECT block_id, dense_rank() OVER (ORDER BY first) AS component_id FROM groups)"""


@query("block_ids", f"""WITH {grouping_sql(0.2)}
SELECT c.id, b.block_id FROM cells c LEFT JOIN blocks b ON b.q = c.q AND b.r = c.r""")
def block_ids(spark, folder):
    rows = with_cells(spark, folder)
    return S.attach(rows, S.occupied_cells(rows)).select("id", "block_id")


@query("neighbourhood_ids", f"""WITH {grouping_sql(0.2)}
SELECT c.id, n.neighbourhood_id FROM cells c LEFT JOIN blocks b ON b.q = c.q AND b.r = c.r LEFT JOIN neighbourhoods n ON n.block_id = b.block_id""")
def neighbourhood_ids(spark, folder):
    rows = with_cells(spark, folder)
    return S.attach(rows, S.neighbourhoods(S.occupied_cells(rows))).select("id", "neighbourhood_id")


@query("component_ids", f"""WITH RECURSIVE {reach_sql(0.2)}
SELECT c.id, g.component_id FROM cells c LEFT JOIN blocks b ON b.q = c.q AND b.r = c.r LEFT JOIN components g ON g.block_id = b.block_id""")
def component_ids(spark, folder):
    rows = with_cells(spark, folder)
    return S.attach(rows, S.components(S.occupied_cells(rows))).select("id", "component_id")


# --- comparables -------------------------------------------------------------------------

COMPARABLES_SQL = f"""{HISTORY_SQL}, {cells_sql(0.2)}, {ring_sql()},
around AS (SELECT id, q + dq AS q, r + dr AS r, property_type, is_development, no_bedrooms, no_full_bathrooms FROM cells, ring),
found AS (SELECT a.id, c.id AS other FROM around a JOIN cells c ON c.q = a.q AND c.r = a.r AND c.property_type = a.property_type
  AND c.is_development = a.is_development AND c.no_bedrooms = a.no_bedrooms AND c.no_full_bathrooms = a.no_full_bathrooms AND c.id <> a.id)"""


@query("comparable_counts", f"""WITH {COMPARABLES_SQL}
SELECT c.id, count(f.other) AS n_comparables FROM cells c LEFT JOIN found f ON f.id = c.id GROUP BY c.id""")
def comparable_counts(spark, folder):
    return P.count_comparables(with_cells(spark, folder))


BLOCKS_SQL = f"""{COMPARABLES_SQL},
blocks AS (SELECT id, min(id) OVER same AS group_id, count(*) OVER same AS n_rows FROM cells WHERE q IS NOT NULL AND property_type IS NOT NULL
  AND is_development IS NOT NULL AND no_bedrooms IS NOT NULL AND no_full_bathrooms IS NOT NULL
  WINDOW same AS (PARTITION BY q, r, property_type, is_development, no_bedrooms, no_full_bathrooms))"""


@query("comparables", f"""WITH {BLOCKS_SQL}, {lists_sql('found', 'blocks')}
SELECT c.id, b.group_id, coalesce(n.n, 0) AS n_comparables, CAST(coalesce(s.part, 0) AS BIGINT) AS part, CAST(to_json(s.others) AS VARCHAR) AS comparable_ids
FROM cells c LEFT JOIN blocks b ON b.id = c.id LEFT JOIN n ON n.id = c.id LEFT JOIN lists s ON s.id = c.id""")
def comparables(spark, folder):
    """Every listing with its block of alike listings and its comparables, counted and listed; null without any."""
    found = P.define_comparables(with_cells(spark, folder)).lists("comparable_ids", "n_comparables")
    return found.withColumn("comparable_ids", F.when(F.size("comparable_ids") > 0, F.to_json("comparable_ids")))


@query("comparable_groups", f"""WITH {BLOCKS_SQL}
SELECT DISTINCT a.group_id, b.group_id AS other_id, b.n_rows FROM found f JOIN blocks a ON a.id = f.id JOIN blocks b ON b.id = f.other""")
def comparable_groups(spark, folder):
    """Which blocks are comparable with which."""
    return P.define_comparables(with_cells(spark, folder)).links


@query("comparable_pairs_of", f"""WITH {COMPARABLES_SQL}, n AS (SELECT id, count(*) AS n FROM found GROUP BY id ORDER BY n DESC, id LIMIT 1)
SELECT id, other AS comparable_id FROM found WHERE id IN (SELECT id FROM n)""")
def comparable_pairs_of(spark, folder):
    """The sorted comparables of the listing that has most of them."""
    cover = P.define_comparables(with_cells(spark, folder))
    return P.comparable_pairs(cover, top_k(cover.counts("n"), "n", 1, tie="id"))


@query("comparables_drilldown", f"""WITH {COMPARABLES_SQL}, chosen AS (SELECT min(id) AS id FROM found)
SELECT id, property_type, no_bedrooms, asking_price FROM history
WHERE id IN (SELECT other FROM found WHERE id = (SELECT id FROM chosen) UNION SELECT id FROM chosen)""")
def comparables_drilldown(spark, folder):
    rows = with_cells(spark, folder)
    listing = P.count_comparables(rows).filter("n_comparables > 0").agg(F.min("id")).first()[0]
    return P.comparables_of(rows, -1 if listing is None else listing).select(
        "id", "property_type", "no_bedrooms", "asking_price"
    )


@query("comparables_random", f"""WITH {COMPARABLES_SQL}, chosen AS (SELECT id FROM found ORDER BY md5('7:' || CAST(id AS VARCHAR)), id LIMIT 1)
SELECT id, property_type FROM history
WHERE id IN (SELECT other FROM found WHERE id = (SELECT id FROM chosen) UNION SELECT id FROM chosen)""")
def comparables_random(spark, folder):
    return P.comparables_of(with_cells(spark, folder), seed=7).select("id", "property_type")


# --- pair scores ---------------------------------------------------------------------------

HIGH = 0.9  # the tuning threshold; statistics below are over all pairs

SCORED_COLUMNS = ["id", "lat", "lon", "property_type", "is_development", "no_bedrooms",
                  "no_full_bathrooms", "m2_built", "m2_terrain", "price_mxn", "m2_flags"]

# What they are made of; the order tells which of several equal keys is kept.
SCORED_FROM = ["property_type", "currency", "asking_price", "lat", "lon", "m2_built", "m2_terrain",
               "no_bedrooms", "no_full_bathrooms", "is_development"]

SCORED_ROWS_SQL = """prepared AS (SELECT * EXCLUDE (m2_built, m2_terrain, no_bedrooms, no_full_bathrooms),
  coalesce(no_bedrooms, 0) AS no_bedrooms, coalesce(no_full_bathrooms, 0) AS no_full_bathrooms,
  CASE WHEN m2_built IS NOT NULL AND (m2_terrain IS NULL OR m2_terrain < m2_built) THEN m2_built ELSE m2_terrain END AS m2_terrain,
  coalesce(m2_built, m2_terrain) AS m2_built,
  CASE WHEN currency = 'USD' THEN asking_price * 1.79813e1 ELSE asking_price END AS price_mxn FROM cells)"""


def scored_rows(spark, folder, edge=0.2):
    rows = fill_zero(history(spark, folder, SCORED_FROM))
    rows = with_repaired_areas(rows).withColumns(
        {"price_mxn": normalize_price(), "m2_flags": area_flag().cast("bigint")}
    ).select(*SCORED_COLUMNS)
    return S.with_cell(rows, edge_km=edge)


def grouped_rows(spark, folder, edge=0.2):
    rows = cut_lineage(scored_rows(spark, folder, edge))
    cells = S.occupied_cells(rows)
    ids = cells.join(S.neighbourhoods(cells), "cell").join(S.components(cells), "cell")
    return S.attach(rows, ids)


def ratio_sql(column):
    return (f"CASE WHEN a.{column} IS NULL OR b.{column} IS NULL THEN 0e0 "
            f"ELSE 1e0 - least(abs(a.{column} - b.{column}) / greatest(abs(a.{column}), abs(b.{column}), 1e0), 1e0) END")


def equal_sql(column, otherwise="0e0"):
    return f"CASE WHEN a.{column} = b.{column} THEN 1e0 ELSE {otherwise} END"


def groups_sql(columns):
    """Rows that agree in every scored column, as in the Spark result."""
    return f"grouped AS (SELECT {columns}, min(id) AS id, count(*) AS n FROM located GROUP BY {columns})"


N_PAIRS = "CAST(CASE WHEN a.id = b.id THEN a.n * (a.n - 1) / 2 ELSE a.n * b.n END AS BIGINT) AS n_pairs"

COMPARABLE_SCORES_SQL = f"""{HISTORY_SQL}, {cells_sql(0.2)}, {SCORED_ROWS_SQL},
located AS (SELECT * FROM prepared WHERE q IS NOT NULL),
{groups_sql('q, r, property_type, is_development, no_bedrooms, no_full_bathrooms, m2_built, m2_terrain, price_mxn')},
scored AS (SELECT a.property_type, a.is_development, a.no_bedrooms, a.no_full_bathrooms, a.id AS id_left, b.id AS id_right, {N_PAIRS},
  {ratio_sql('m2_built')} AS s_m2built, {ratio_sql('m2_terrain')} AS s_m2terrain, {ratio_sql('price_mxn')} AS s_price
  FROM grouped a JOIN grouped b ON a.property_type = b.property_type AND a.is_development = b.is_development
    AND a.no_bedrooms = b.no_bedrooms AND a.no_full_bathrooms = b.no_full_bathrooms AND (a.id < b.id OR (a.id = b.id AND a.n > 1))
    AND abs(a.q - b.q) <= 1 AND abs(a.r - b.r) <= 1 AND abs(a.q + a.r - b.q - b.r) <= 1),
final AS (SELECT *, (2e0 * s_m2built + 1e0 * s_m2terrain + 2e0 * s_price) / 5e0 AS score FROM scored)"""


def dealt_scores(rows, min_score=HIGH):
    """Scores of comparable rows; to be evaluated by ``evaluated``."""
    return P.score_comparables(rows, min_score=min_score, tile=P.TILE)


def evaluated(df):
    """Written once, with the rows dealt out by tiles left where they lie."""
    with kept_partitions(df.sparkSession):
        return cut_lineage(df)


@query("pair_scores_comparables", f"WITH {COMPARABLE_SCORES_SQL} SELECT * FROM final WHERE score >= 9e-1")
def pair_scores_comparables(spark, folder):
    return P.score_comparables(scored_rows(spark, folder), min_score=HIGH)


NEIGH_SCORES_SQL = f"""{reach_sql(0.2)}, {SCORED_ROWS_SQL},
located AS (SELECT p.*, {CELL_TEXT} AS cell, b.block_id, n.neighbourhood_id, g.component_id,
    CASE WHEN m2_built IS NULL AND m2_terrain IS NULL THEN 0 ELSE 1 END AS m2_flags
  FROM prepared p JOIN blocks b USING (q, r) JOIN neighbourhoods n ON n.block_id = b.block_id JOIN components g ON g.block_id = b.block_id),
{groups_sql('neighbourhood_id, component_id, block_id, cell, m2_flags, no_bedrooms, no_full_bathrooms, m2_built, m2_terrain, price_mxn')},
scored AS (SELECT a.neighbourhood_id, a.component_id, a.component_id AS component_id_left, b.component_id AS component_id_right,
  a.id AS id_left, b.id AS id_right, a.cell AS cell_left, b.cell AS cell_right, a.m2_flags AS m2_flags_left, b.m2_flags AS m2_flags_right, {N_PAIRS},
  {ratio_sql('m2_built')} AS s_m2built, {ratio_sql('m2_terrain')} AS s_m2terrain, {ratio_sql('price_mxn')} AS s_price,
  {equal_sql('no_bedrooms')} AS s_no_bedrooms, {equal_sql('no_full_bathrooms')} AS s_no_full_bathrooms,
  {ratio_sql('no_bedrooms')} AS r_beds, {ratio_sql('no_full_bathrooms')} AS r_baths, {equal_sql('block_id')} AS s_block,
  {equal_sql('neighbourhood_id', '5e-1')} AS s_near, a.neighbourhood_id = b.neighbourhood_id AS same_neighbourhood
  FROM grouped a JOIN grouped b ON a.component_id = b.component_id AND (a.id < b.id OR (a.id = b.id AND a.n > 1))),
near AS (SELECT *, 1e0 AS s_neigh, (1e0 * s_m2built + 1e0 * s_m2terrain + 1e0 * s_price + 2e0 * s_no_bedrooms + 2e0 * s_no_full_bathrooms
  + 2e0 * s_block + 1e0) / 1e1 AS score FROM scored WHERE same_neighbourhood),
wide AS (SELECT *, (1e0 * s_m2built + 1e0 * s_m2terrain + 1e0 * s_price + 1e0 * r_beds + 1e0 * r_baths + 3e0 * s_near + 2e0 * s_block) / 1e1 AS score FROM scored)"""

NEIGH_COLUMNS = """neighbourhood_id, id_left, id_right, component_id_left, component_id_right, cell_left, cell_right, m2_flags_left,
m2_flags_right, n_pairs, s_m2built, s_m2terrain, s_price, s_no_bedrooms, s_no_full_bathrooms, s_block, s_neigh, score"""


@query("pair_scores_neigh", f"WITH RECURSIVE {NEIGH_SCORES_SQL} SELECT {NEIGH_COLUMNS} FROM near WHERE score >= 9e-1")
def pair_scores_neigh(spark, folder):
    return P.score_neighbourhood(
        grouped_rows(spark, folder), carry=["component_id", "cell", "m2_flags"], min_score=HIGH
    )


@query("pair_scores_component", f"""WITH RECURSIVE {NEIGH_SCORES_SQL}
SELECT component_id, id_left, id_right, cell_left, cell_right, n_pairs, s_m2built, s_m2terrain, s_price,
  r_beds AS s_no_bedrooms, r_baths AS s_no_full_bathrooms, s_near AS s_neigh, s_block, score FROM wide WHERE score >= 9e-1""")
def pair_scores_component(spark, folder):
    return P.score_component(grouped_rows(spark, folder), carry=["cell"], min_score=HIGH)


# --- tuning -----------------------------------------------------------------------------------

ALL_SQL = f"WITH {COMPARABLE_SCORES_SQL}, high AS (SELECT * FROM final WHERE score >= 9e-1)"
_FIELDS = "score >= 9e-1 AND s_price >= 8.5e-1 AND s_m2built >= 8.5e-1 AND s_m2terrain >= 8.5e-1"


@query("score_funnel", f"""{ALL_SQL}, s(stage, n) AS (
  SELECT 'high_score', n_pairs FROM final WHERE score >= 9e-1 UNION ALL SELECT 'within_tolerance', n_pairs FROM final WHERE {_FIELDS}
  UNION ALL SELECT 'perfect', n_pairs FROM final WHERE {_FIELDS} AND score = 1)
SELECT t.stage, count(s.n) AS n_groups, CAST(coalesce(sum(s.n), 0) AS BIGINT) AS n_pairs
FROM (VALUES ('high_score'), ('within_tolerance'), ('perfect')) t(stage) LEFT JOIN s ON s.stage = t.stage GROUP BY t.stage""")
def score_funnel(spark, folder):
    return evaluated(P.score_funnel(dealt_scores(scored_rows(spark, folder))))


@query("score_histogram", f"""{ALL_SQL}, bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(20) t(i)),
counted AS (SELECT least(CAST(floor((score - 9e-1) / ((1e0 - 9e-1) / 20)) AS INTEGER), 19) AS bin, sum(n_pairs) AS n FROM high GROUP BY 1)
SELECT b.bin, 9e-1 + b.bin * ((1e0 - 9e-1) / 20) AS lower, 9e-1 + (b.bin + 1) * ((1e0 - 9e-1) / 20) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM bins b LEFT JOIN counted c ON c.bin = b.bin
UNION ALL SELECT -1, 0e0, 9e-1, CAST(coalesce(sum(n_pairs), 0) AS BIGINT) FROM final WHERE score < 9e-1""")
def score_histogram(spark, folder):
    rows = cut_lineage(scored_rows(spark, folder))
    high = evaluated(A.histogram(dealt_scores(rows), bins=20, lo=HIGH, hi=1.0, weight="n_pairs"))
    return A.with_rest(high, P.count_pairs(rows), 0.0)


@query("score_share", f"{ALL_SQL} SELECT CAST(sum(n_pairs) FILTER (score >= 9.5e-1) AS DOUBLE) / CAST(sum(n_pairs) AS DOUBLE) * 1e2 AS pct FROM final")
def score_share(spark, folder):
    """Percent of all comparable pairs; pairs under the threshold are counted, not formed."""
    rows = cut_lineage(scored_rows(spark, folder))
    return evaluated(A.share_at_least(dealt_scores(rows, 0.95), 0.95, weight="n_pairs", total=P.count_pairs(rows)))


@query("score_trend", f"""{ALL_SQL}, e AS (SELECT min(s_price) AS lo, (max(s_price) - min(s_price)) / 10 AS w FROM high),
bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(10) t(i)),
means AS (SELECT CAST(floor((s_price - lo) / w) AS INTEGER) AS bin, sum(score * n_pairs) / sum(n_pairs) AS m FROM high, e GROUP BY 1)
SELECT b.bin, lo + (b.bin + 5e-1) * w AS center, m AS mean_score FROM bins b, e LEFT JOIN means ON means.bin = b.bin""")
def score_trend(spark, folder):
    scores = evaluated(dealt_scores(scored_rows(spark, folder)).select("score", "s_price", "n_pairs"))
    return A.binned_trend(scores, bins=10, weight="n_pairs")


@query("score_margin", f"""{ALL_SQL}, e AS (SELECT min(score) AS s0, max(score) AS s1, min(s_price) AS a0, max(s_price) AS a1 FROM high)
SELECT CASE WHEN a1 = a0 THEN 0e0 ELSE (s1 - s0) / (a1 - a0) END AS slope, s0 - CASE WHEN a1 = a0 THEN 0e0 ELSE (s1 - s0) / (a1 - a0) END * a0 AS intercept FROM e""")
def score_margin(spark, folder):
    return evaluated(A.margin_line(dealt_scores(scored_rows(spark, folder))))


@query("score_repeated", f"""{ALL_SQL},
same AS (SELECT a.id AS one, b.id AS other, {ratio_sql('m2_built')} AS s_m2built, {ratio_sql('m2_terrain')} AS s_m2terrain, {ratio_sql('price_mxn')} AS s_price
  FROM located a JOIN located b ON a.property_type = b.property_type AND a.is_development = b.is_development
    AND a.no_bedrooms = b.no_bedrooms AND a.no_full_bathrooms = b.no_full_bathrooms AND a.id <> b.id
    AND abs(a.q - b.q) <= 1 AND abs(a.r - b.r) <= 1 AND abs(a.q + a.r - b.q - b.r) <= 1),
top AS (SELECT one FROM same WHERE (2e0 * s_m2built + 1e0 * s_m2terrain + 2e0 * s_price) / 5e0 >= 1e0)
SELECT one AS id, count(*) AS n_pairs FROM top GROUP BY one HAVING count(*) > 1""")
def score_repeated(spark, folder):
    """Listings in more than one perfect pair, with how many."""
    rows = cut_lineage(scored_rows(spark, folder))
    columns = [*P.COMPARABLE_KEYS, "cell", "m2_built", "m2_terrain", "price_mxn"]
    perfect = dealt_scores(rows, 1.0).filter("score >= 1").select("id_left", "id_right", "n_pairs", "score")
    members = P.group_members(rows.dropna(subset=[*P.COMPARABLE_KEYS, "cell"]), columns)
    return P.repeated_listings(evaluated(perfect), members)
