"""Cleaning and scalar function queries."""

from pyspark.sql import functions as F

from terralist import constants as K
from terralist.functions import amenities as A, numbers as N, text as T
from terralist.operators import filters as R, shaping as S
from terralist.operators.keys import stable_slice, number_rows, ordered, union_relaxed
from terralist.plans import clean as C
from terralist.queries.adapter import (
    LISTINGS_SQL, NEW, OLD, OLD_SQL, PORTAL_SQL, WAVES_SQL, listings, portal_listings, wave,
)
from terralist.queries.registry import query, table


def quoted(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sql_pattern(words):
    """Alternation of literal words for RE2."""
    return "|".join(w.replace("'", "''").replace(".", r"\.") for w in words)


# --- one source ------------------------------------------------------------------

# Raw rows arrive more than once: the change log states stand in for repeats.
SOURCE_SQL = f"""{WAVES_SQL},
raw AS (SELECT id_ext AS id, asking_price, currency, lat, lon, operation_type, property_type, source_type,
    CONCAT(' ', id_ext, ' ') AS zip_code, m2_built, no_bedrooms FROM old_wave
  UNION ALL SELECT id_ext, asking_price * 2e0, currency, lat, lon, operation_type, property_type, source_type,
    CONCAT(' ', id_ext, ' '), m2_built, no_bedrooms FROM new_wave),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY asking_price) AS rn FROM raw) WHERE rn = 1),
complete AS (SELECT * FROM firsts WHERE asking_price IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL),
sold AS (SELECT * FROM complete WHERE upper(operation_type) = 'SALE'),
priced AS (SELECT * FROM sold WHERE (currency IN ('MXN', 'MXP') AND asking_price >= 5e5) OR (currency = 'USD' AND asking_price >= 2.5e4))"""


def source_rows(spark, folder):
    columns = ["asking_price", "currency", "lat", "lon", "operation_type", "property_type",
               "source_type", "m2_built", "no_bedrooms"]

    def shaped(which, factor):
        df = wave(spark, folder, which)
        return df.select(
            F.col("id_ext").alias("id"), *columns,
            F.concat(F.lit(" "), "id_ext", F.lit(" ")).alias("zip_code"),
        ).withColumn("asking_price", F.col("asking_price") * F.lit(factor))

    return shaped(OLD, 1.0).unionByName(shaped(NEW, 2.0))


@query("standardize_source", f"""WITH {SOURCE_SQL}
SELECT id, asking_price, currency, lat, lon, m2_built, no_bedrooms, operation_type, property_type, source_type,
  trim(zip_code) AS zip_code, 'i24' AS source FROM priced""")
def standardize_source(spark, folder):
    return C.standardize_source(
        source_rows(spark, folder), "i24", operation="SALE", order_by="asking_price"
    )


@query("standardize_exploratory", f"""WITH {SOURCE_SQL}
SELECT * EXCLUDE (rn) FROM priced WHERE property_type IN ({quoted(K.ANALYSED_PROPERTY_TYPES)})""")
def standardize_exploratory(spark, folder):
    return C.standardize_exploratory(source_rows(spark, folder), order_by="asking_price")


@query("stage_counts", f"""WITH {SOURCE_SQL}
SELECT 'all_rows' AS stage, count(*) AS n_rows FROM firsts UNION ALL SELECT 'complete', count(*) FROM complete
UNION ALL SELECT 'operation', count(*) FROM sold UNION ALL SELECT 'price_floor', count(*) FROM priced
UNION ALL SELECT 'property_type', count(*) FROM priced WHERE property_type IN ({quoted(K.ANALYSED_PROPERTY_TYPES)})""")
def stage_counts(spark, folder):
    from terralist.operators.keys import one_per_key
    from terralist.operators.profile import stage_counts as count_stages

    unique = one_per_key(source_rows(spark, folder), "id", order_by="asking_price")
    return count_stages(unique, C.exploratory_stages(unique))


@query("stage_summary", f"""WITH {OLD_SQL}, n AS (SELECT count(*) AS a, count(*) FILTER (lat IS NOT NULL AND lon IS NOT NULL) AS b FROM old_wave)
SELECT 0 AS step, 'wave' AS stage, a AS n_rows, 0 AS row_change, 16 AS n_columns, 0 AS column_change, '' AS added, '' AS removed FROM n
UNION ALL SELECT 1, 'located', b, b - a, 16, 0, '', '' FROM n
UNION ALL SELECT 2, 'priced', b, 0, 16, 0, 'price_mxn', 'asking_price' FROM n""")
def stage_summary(spark, folder):
    from terralist.operators.profile import stage_summary as summarize

    rows = wave(spark, folder, OLD)
    located = R.with_point(rows)
    priced = S.all_except(
        located.withColumn("price_mxn", N.normalize_price()), "asking_price"
    )
    return summarize([("wave", rows), ("located", located), ("priced", priced)])


# --- full clean --------------------------------------------------------------------

FOLDED = "replace(replace(strip_accents(coalesce({}, '')), 'ß', 'SS'), 'ẞ', 'SS')"


def normalized_sql(column):
    return rf"trim(regexp_replace(upper({FOLDED.format(column)}), '\s+', ' ', 'g'))"


NUMBER_SQL = r"""TRY_CAST(nullif(regexp_extract(regexp_replace({0}, ',', ''), '-?\d+(?:\.\d+)?'), '') AS DOUBLE)"""
HOMOLOGATED_SQL = "upper(CASE property_type " + " ".join(
    f"WHEN '{raw}' THEN '{to}'" for raw, to in K.PROPERTY_TYPES.items()
) + " ELSE property_type END)"


def amenity_sql(values):
    """Boolean of a raw amenity text in SQL."""
    low = f"""lower(trim(trim({values}), '"'))"""
    number = rf"TRY_CAST(replace(nullif(regexp_extract({low}, '-?\d+(?:[.,]\d+)?'), ''), ',', '.') AS DOUBLE)"
    return (f"CASE WHEN {values} IS NULL THEN NULL WHEN {number} IS NOT NULL THEN {number} > 0 "
            f"WHEN {low} IN ({quoted(K.TRUE_WORDS)}) THEN true "
            f"WHEN {low} IN ({quoted(K.FALSE_WORDS)}) THEN false END")


# Key and value of every amenity of every listing, keys reduced to plain form.
AMENITIES_SQL = rf"""entries AS (SELECT p.id, p.wave, e.key AS raw_key, e.rowid AS place,
    replace(lower(regexp_replace(strip_accents(e.key), '[^a-zA-Z0-9\s]', '', 'g')), ' ', '_') AS key,
    regexp_replace(coalesce(json_extract_string(p.amenidades, '$."' || e.key || '"'), ''), '^(-?\d+)\.0+$', '\1') AS value
  FROM portal p, json_each(CASE WHEN json_valid(p.amenidades) AND left(trim(p.amenidades), 1) = '{{' THEN p.amenidades ELSE '{{}}' END) e),
last_entry AS (SELECT id, wave, key, arg_max(value, place) AS value FROM entries GROUP BY ALL),
amen AS (SELECT id, wave, {', '.join(f"max(value) FILTER (key = '{k}') AS {k}" for k in K.AMENITY_KEYS)} FROM last_entry GROUP BY ALL)"""

def development_sql(url):
    rules = [f"WHEN regexp_matches({url}, '{site}') THEN nullif(regexp_extract({url}, '{part}', 1), '')" for site, part in K.DEVELOPMENT_URL_RULES]
    return f"CASE {' '.join(rules)} END"


CLEAN_SQL = rf"""WITH {PORTAL_SQL}, {AMENITIES_SQL},
texts AS (SELECT *, {normalized_sql('title')} AS title_clean, {normalized_sql('content')} AS description_clean,
    {normalized_sql('property_type')} AS type_clean, {normalized_sql('source_listing_url')} AS url_clean,
    {HOMOLOGATED_SQL} AS kind FROM portal),
flags AS (SELECT *,
    contains(type_clean, 'DESARROLLO') OR regexp_matches(description_clean, '{K.PRESALE_PATTERN}')
      OR coalesce(year_built >= 2025, false) OR main_development_url IS NOT NULL AS dev_flag,
    ({' OR '.join(f"(regexp_matches({c}, '{sql_pattern(K.AUCTION_WORDS)}') AND NOT regexp_matches({c}, '{sql_pattern(K.AUCTION_VETO_WORDS)}'))" for c in ('description_clean', 'title_clean', 'url_clean'))}) AS auction,
    CASE WHEN kind <> 'DESARROLLO' THEN kind WHEN regexp_matches(title, '{K.LAND_PATTERN}') THEN 'TERRENO'
      WHEN regexp_matches(title, '{K.HOUSE_PATTERN}') THEN 'CASA' ELSE 'DEPARTAMENTO' END AS final_kind,
    {NUMBER_SQL.format('m2_built_text')} AS built, {NUMBER_SQL.format('m2_terrain_text')} AS terrain FROM texts),
kept AS (SELECT f.*, {', '.join(f'a.{k} AS am_{k}' for k in K.AMENITY_KEYS)} FROM flags f LEFT JOIN amen a ON a.id = f.id AND a.wave = f.wave
  WHERE NOT auction AND publisher_name NOT IN ({quoted(K.EXCLUDED_PUBLISHERS)}) AND final_kind NOT IN ({quoted(K.EXCLUDED_PROPERTY_TYPES)})),
cleaned AS (SELECT id_ext, {development_sql('main_development_url')} AS id_dev,
    title, content AS description, zip_code, lat, lon, final_kind AS property_type, property_type AS property_type_raw,
    operation_type, no_bedrooms, no_full_bathrooms, year_built, asking_price, currency, built AS m2_built,
    CASE WHEN terrain < built OR (terrain IS NULL AND final_kind = 'DEPARTAMENTO') THEN built ELSE terrain END AS m2_terrain,
    amenidades, {', '.join(f"{amenity_sql('am_' + k)} AS {k}" for k in K.AMENITY_KEYS)},
    publisher_name, source_type, source_listing_url, main_development_url, dev_flag AS is_development,
    CAST(auction AS TINYINT) AS is_remate FROM kept WHERE wave = '{OLD}')"""

PORTAL_DROP = ["id_dev", "is_development", "m2_built", "m2_terrain", "id"]


def portal_wave(spark, folder, which=OLD):
    """One wave as it would arrive: portal id as ``id``, areas as text."""
    rows = portal_listings(spark, folder).filter(F.col("wave") == which).drop("wave")
    return rows.drop(*PORTAL_DROP).withColumnsRenamed(
        {"id_ext": "id", "m2_built_text": "m2_built", "m2_terrain_text": "m2_terrain"}
    )


@query("clean_listings", f"{CLEAN_SQL} SELECT * FROM cleaned")
def clean_listings(spark, folder):
    return C.clean_listings(portal_wave(spark, folder), with_id=False)


@query("clean_listings_numbered", f"""{CLEAN_SQL}
SELECT row_number() OVER (ORDER BY id_ext, source_type) AS id, id_ext, source_type, property_type FROM cleaned""")
def clean_listings_numbered(spark, folder):
    return C.clean_listings(portal_wave(spark, folder)).select(
        "id", "id_ext", "source_type", "property_type"
    )


@query("clean_for_analysis", f"""{CLEAN_SQL},
sale AS (SELECT * FROM cleaned WHERE operation_type = 'sale' AND lat IS NOT NULL AND lon IS NOT NULL)
SELECT id_ext, property_type, TRY_CAST(no_full_bathrooms AS BIGINT) AS no_full_bathrooms,
  CASE WHEN m2_built IS NOT NULL AND (m2_terrain IS NULL OR m2_terrain < m2_built) THEN m2_built ELSE m2_terrain END AS m2_terrain,
  coalesce(m2_built, m2_terrain) AS m2_built,
  CASE WHEN currency = 'USD' THEN asking_price * 1.79813e1 ELSE asking_price END AS price_mxn FROM sale""")
def clean_for_analysis(spark, folder):
    return C.clean_for_analysis(portal_wave(spark, folder), with_id=False).select(
        "id_ext", "property_type", "no_full_bathrooms", "m2_terrain", "m2_built", "price_mxn"
    )


@query("property_types", f"""WITH {LISTINGS_SQL} SELECT id, wave, {HOMOLOGATED_SQL} AS canonical FROM listings""")
def property_types(spark, folder):
    return listings(spark, folder).select("id", "wave", T.homologate("property_type").alias("canonical"))


@query("auction_flag", rf"""WITH {PORTAL_SQL}, t AS (SELECT id, wave, {normalized_sql('title')} AS a, {normalized_sql('content')} AS b FROM portal)
SELECT id, wave, CAST({' OR '.join(f"(regexp_matches({c}, '{sql_pattern(K.AUCTION_WORDS)}') AND NOT regexp_matches({c}, '{sql_pattern(K.AUCTION_VETO_WORDS)}'))" for c in 'ab')} AS TINYINT) AS is_remate FROM t""")
def auction_flag(spark, folder):
    rows = portal_listings(spark, folder).select(
        "id", "wave", T.clean_text("title").alias("a"), T.clean_text("content").alias("b")
    )
    return rows.select("id", "wave", T.is_auction("a", "b").alias("is_remate"))


# --- attributes ---------------------------------------------------------------------


@query("amenities", f"""WITH {PORTAL_SQL}, {AMENITIES_SQL}
SELECT p.id, p.wave, {', '.join(f"{amenity_sql('a.' + k)} AS {k}" for k in K.AMENITY_KEYS)}
FROM portal p LEFT JOIN amen a ON a.id = p.id AND a.wave = p.wave""")
def amenities(spark, folder):
    rows = portal_listings(spark, folder)
    return rows.select("id", "wave", A.amenities("amenidades").alias("a")).select(
        "id", "wave", "a.*"
    )


@query("event_properties", r"""SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS normalized,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) > 0 AS k FROM events""")
def event_properties(spark, folder):
    normalized = A.normalized_amenities("props")
    return table(spark, folder, "events").select("event_id", normalized.alias("m")).select(
        "event_id", F.to_json("m").alias("normalized"),
        A.lenient_boolean(F.try_element_at("m", F.lit("k"))).alias("k"),
    )


@query("url_dev_id", rf"""WITH {PORTAL_SQL}, urls AS (SELECT 'p' || CAST(page_id AS VARCHAR) AS id, url FROM pages
  UNION ALL SELECT 'd' || CAST(page_id AS VARCHAR), 'https://www.lamudi.com.mx/desarrollo/' || regexp_extract(url, '([a-z]+)/\d+', 1) || '-' || CAST(page_id AS VARCHAR) FROM pages
  UNION ALL SELECT wave || id_ext, main_development_url FROM portal)
SELECT id, {development_sql('url')} AS id_dev FROM urls""")
def url_dev_id(spark, folder):
    pages = table(spark, folder, "pages")
    number = F.col("page_id").cast("string")
    made = F.concat(F.lit("https://www.lamudi.com.mx/desarrollo/"),
                    F.regexp_extract("url", r"([a-z]+)/\d+", 1), F.lit("-"), number)
    urls = pages.select(F.concat(F.lit("p"), number).alias("id"), "url").union(
        pages.select(F.concat(F.lit("d"), number), made)
    ).union(
        portal_listings(spark, folder).select(F.concat("wave", "id_ext"), "main_development_url")
    )
    return urls.select("id", T.development_id("url").alias("id_dev"))


@query("number_parsers", rf"""WITH {PORTAL_SQL}
SELECT id, wave, {NUMBER_SQL.format('m2_built_text')} AS first_number,
  TRY_CAST(nullif(regexp_extract(replace(m2_built_text, ',', ''), '-?\d+(?:\.\d+)?'), '') AS DOUBLE) AS all_commas,
  TRY_CAST(nullif(regexp_replace(m2_built_text, '[^\d.]', '', 'g'), '') AS DOUBLE) AS digits,
  CASE WHEN regexp_matches(trim(m2_built_text), '^\s*[0-9]+(\.[0-9]+)?\s*-\s*[0-9]+(\.[0-9]+)?\s*$')
    THEN (CAST(regexp_extract(m2_built_text, '^\s*([0-9]+(?:\.[0-9]+)?)\s*-\s*([0-9]+(?:\.[0-9]+)?)', 1) AS DOUBLE)
        + CAST(regexp_extract(m2_built_text, '^\s*([0-9]+(?:\.[0-9]+)?)\s*-\s*([0-9]+(?:\.[0-9]+)?)', 2) AS DOUBLE)) / 2e0
    ELSE TRY_CAST(nullif(regexp_extract(m2_built_text, '[0-9]+(?:\.[0-9]+)?'), '') AS DOUBLE) END AS midpoint
FROM portal""")
def number_parsers(spark, folder):
    text = "m2_built_text"
    return portal_listings(spark, folder).select(
        "id", "wave", T.first_number(text).alias("first_number"),
        T.first_number(text, all_commas=True).alias("all_commas"),
        T.digits_and_dots(text).alias("digits"), T.range_midpoint(text).alias("midpoint"),
    )


@query("area_repair", f"""WITH {LISTINGS_SQL}, z AS (SELECT id, wave, m2_built AS b, m2_terrain AS t, upper(property_type) AS k,
  coalesce(no_bedrooms, 0) AS no_bedrooms, coalesce(no_full_bathrooms, 0) AS no_full_bathrooms FROM listings)
SELECT id, wave, no_bedrooms, no_full_bathrooms,
  CASE WHEN t < b OR (t IS NULL AND k = 'DEPARTAMENTO') THEN b ELSE t END AS terrain_only,
  CASE WHEN b IS NOT NULL AND (t IS NULL OR t < b) THEN b ELSE t END AS m2_terrain, coalesce(b, t) AS m2_built,
  CASE WHEN b IS NULL AND t IS NULL THEN 0e0 ELSE 1e0 END AS m2_flags FROM z""")
def area_repair(spark, folder):
    rows = N.fill_zero(listings(spark, folder)).select(
        "id", "wave", "no_bedrooms", "no_full_bathrooms", "m2_built", "m2_terrain",
        N.repair_terrain(kind=F.upper("property_type")).alias("terrain_only"),
        N.area_flag().alias("m2_flags"),
    )
    return N.with_repaired_areas(rows)


@query("price_normalize", f"""WITH {LISTINGS_SQL}
SELECT id, wave, CASE WHEN currency = 'USD' THEN asking_price * 1.79813e1 ELSE asking_price END AS price_mxn,
  CASE currency WHEN 'USD' THEN asking_price * 2e1 WHEN 'MXP' THEN asking_price * 5e-1 ELSE asking_price END AS two_rates
FROM listings""")
def price_normalize(spark, folder):
    return listings(spark, folder).select(
        "id", "wave", N.normalize_price().alias("price_mxn"),
        N.normalize_price(rates={"USD": 20.0, "MXP": 0.5}).alias("two_rates"),
    )


@query("comparable_numbers", f"""WITH {LISTINGS_SQL}
SELECT id, wave, round(nullif(CASE WHEN id % 3 = 0 THEN 'nan'::DOUBLE ELSE asking_price / 7e0 END, 'nan'::DOUBLE), 6) AS price,
  TRY_CAST(no_full_bathrooms AS BIGINT) AS baths FROM listings""")
def comparable_numbers(spark, folder):
    price = F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("asking_price") / 7)
    return listings(spark, folder).select(
        "id", "wave", N.comparable_number(price).alias("price"),
        N.to_integer("no_full_bathrooms").alias("baths"),
    )


# --- names and dates --------------------------------------------------------------------


@query("wave_name", r"""SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN event_type ELSE 'b' END AS wave
FROM events""")
def wave_name(spark, folder):
    events = table(spark, folder, "events")
    path = (
        F.when(F.col("event_id") % 3 == 0,
               F.concat(F.lit("/raw/data/"), F.date_format("ts", "yyyy-MM-dd"), F.lit("/")))
        .when(F.col("event_id") % 3 == 1, F.col("event_type"))
        .otherwise("a/b/")
    )
    return events.select("event_id", N.wave_name(path).alias("wave"))


@query("date_parse", """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) END AS day,
  strftime(ts - INTERVAL 6 HOUR, '%Y-%m-%d') AS run FROM events""")
def date_parse(spark, folder):
    events = table(spark, folder, "events")
    text = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy/dd")).otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    return events.select(
        "event_id", N.lenient_date(text).alias("day"), N.run_label("ts").alias("run")
    )


# --- schema shaping ---------------------------------------------------------------------


@query("align_schema", f"""WITH {LISTINGS_SQL}
SELECT id_ext AS id, wave, CAST(NULL AS VARCHAR) AS title, asking_price, CAST(NULL AS BIGINT) AS apt_floor,
  TRY_CAST(source_type AS DOUBLE) AS lat, TRY_CAST(no_bedrooms AS BIGINT) AS no_bedrooms FROM listings""")
def align_schema(spark, folder):
    rows = S.rename_present(
        listings(spark, folder).drop("id", "lat"),
        {"id_ext": "id", "source_type": "lat", "not_there": "x"},
    )
    return S.align(
        rows, ["id", "wave", "title", "asking_price", "apt_floor", "lat", "no_bedrooms"],
        {"asking_price": "double", "apt_floor": "bigint", "lat": "double", "no_bedrooms": "bigint"},
    )


@query("export_columns", f"""WITH {OLD_SQL}
SELECT id, CAST(id_ext AS DOUBLE) AS lat, TRY_CAST(source_type AS DOUBLE) AS lon, asking_price, year_built,
  CAST(NULL AS VARCHAR) AS title, '["' || source_type || '","' || currency || '"]' AS tags FROM old_wave""")
def export_columns(spark, folder):
    rows = wave(spark, folder, OLD).select(
        "id", F.col("id_ext").alias("lat"), F.col("source_type").alias("lon"), "asking_price",
        "year_built", F.array("source_type", "currency").alias("tags"),
    )
    return S.nested_to_json(S.with_missing_text(S.to_double(rows), ["title"]))


@query("union_with_missing", f"""WITH {WAVES_SQL}
SELECT id_ext, CAST(id AS DOUBLE) AS code, currency, CAST(NULL AS DOUBLE) AS year_built FROM old_wave
UNION ALL SELECT id_ext, asking_price, NULL, year_built FROM new_wave""")
def union_with_missing(spark, folder):
    old = wave(spark, folder, OLD).select("id_ext", F.col("id").alias("code"), "currency")
    new = wave(spark, folder, NEW).select("id_ext", F.col("asking_price").alias("code"), "year_built")
    return union_relaxed(old, new)


@query("row_ids", f"""WITH {LISTINGS_SQL}
SELECT id_ext, wave, row_number() OVER (ORDER BY id_ext, wave) + 100 AS id, (SELECT max(id) FROM listings) AS largest FROM listings""")
def row_ids(spark, folder):
    from terralist.operators.profile import largest

    rows = listings(spark, folder)
    top = largest(rows, "id").scalar()
    numbered = number_rows(rows.select("id_ext", "wave"), ["id_ext", "wave"], start_at=101)
    return numbered.withColumn("largest", top)


@query("analysis_slice", f"""WITH {LISTINGS_SQL}
SELECT {', '.join(K.ANALYSIS_COLUMNS)}, TRY_CAST(no_full_bathrooms AS BIGINT) AS baths FROM listings
WHERE wave = '{OLD}' AND lat IS NOT NULL AND lon IS NOT NULL AND property_type IN ({quoted(K.ANALYSED_PROPERTY_TYPES)})
ORDER BY id LIMIT 50000""")
def analysis_slice(spark, folder):
    rows = R.only_types(R.with_point(wave(spark, folder, OLD)))
    return stable_slice(S.analysis_columns(rows), "id", 50_000).withColumn(
        "baths", N.to_integer("no_full_bathrooms")
    )


@query("first_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def first_orders(spark, folder):
    """The first rows by key, fewer than there are."""
    return stable_slice(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500)


@query("class_split", f"""WITH {OLD_SQL}
SELECT CASE WHEN property_type = 'Departamento' THEN 'apartment' ELSE 'house' END AS class, currency LIKE '%USD%' AS dollars,
  count(*) AS n, count(*) FILTER (m2_built IS NULL OR m2_terrain IS NULL OR no_bedrooms IS NULL OR no_full_bathrooms IS NULL OR lat IS NULL) AS n_incomplete
FROM old_wave WHERE property_type IN ({quoted(K.ANALYSED_PROPERTY_TYPES)}) GROUP BY ALL""")
def class_split(spark, folder):
    columns = ["property_type", "currency", "m2_built", "m2_terrain", "no_bedrooms",
               "no_full_bathrooms", "lat"]
    houses, apartments = R.split_classes(wave(spark, folder, OLD).select(*columns))
    incomplete = R.any_null(houses)
    rows = S.tag(houses, **{"class": "house"}).unionByName(S.tag(apartments, **{"class": "apartment"}))
    return rows.groupBy("class", F.col("currency").contains("USD").alias("dollars")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(incomplete).alias("n_incomplete")
    )


@query("incomplete_rows", f"""WITH {OLD_SQL}
SELECT id, lat, m2_built, m2_terrain FROM old_wave WHERE lat IS NULL OR m2_built IS NULL OR m2_terrain IS NULL""")
def incomplete_rows(spark, folder):
    rows = wave(spark, folder, OLD).select("id", "lat", "m2_built", "m2_terrain")
    return R.rows_with_null(rows)


@query("multi_key_sort", f"""WITH {OLD_SQL}
SELECT id, no_bedrooms, m2_built FROM old_wave ORDER BY no_bedrooms ASC NULLS LAST, m2_built DESC NULLS LAST, id""")
def multi_key_sort(spark, folder):
    rows = wave(spark, folder, OLD).select("id", "no_bedrooms", "m2_built")
    return ordered(rows, ("no_bedrooms", "asc"), ("m2_built", "desc"), ("id", "asc"))
