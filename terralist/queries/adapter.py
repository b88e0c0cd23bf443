"""Listings in two waves, made from the orders table by a fixed rule.

The supplied tables hold no listings.  Each order becomes a listing; its
priority decides in which waves it appears, so some keys continue, some are
new and some are removed.  Both engines evaluate the same column expressions;
literals with an exponent keep both in double arithmetic.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralist.operators.keys import one_per_key
from terralist.queries.registry import table
from terralist.session import spread

WAVES = ["2024-01-01", "2024-01-08"]
OLD, NEW = WAVES

# Every order is in at least one wave: low priority ones only in the second,
# urgent ones only in the first.
IN_WAVE = (
    f"(wave = '{OLD}' AND o_orderpriority <> '5-LOW') OR "
    f"(wave = '{NEW}' AND o_orderpriority <> '1-URGENT')"
)

# Customers whose orders are all the same listing at one place, posted again and again.
PILE = "o_custkey % 40 = 0"


def _piled(copies: str, others: str) -> str:
    return f"CASE WHEN {PILE} THEN {copies} ELSE {others} END"


COLUMNS = {
    "wave": "wave",
    "id": "o_orderkey",
    "id_ext": "CAST(o_orderkey AS STRING)",
    "source_type": """CASE o_orderkey % 4 WHEN 0 THEN 'i24' WHEN 1 THEN 'lamudi'
        WHEN 2 THEN 'remax' ELSE 'propiedades' END""",
    "operation_type": "CASE WHEN o_orderkey % 10 = 9 THEN 'rent' ELSE 'sale' END",
    "property_type": """CASE o_custkey % 8 WHEN 0 THEN 'Casa' WHEN 1 THEN 'Departamento'
        WHEN 2 THEN 'Casa en condominio' WHEN 3 THEN 'Desarrollo' WHEN 4 THEN 'Quinta'
        WHEN 5 THEN 'Loft' WHEN 6 THEN 'Lote / Terreno' ELSE 'Oficina' END""",
    "currency": _piled("'MXN'", "CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'MXP' ELSE 'MXN' END"),
    "asking_price": _piled("1e6 + CAST(o_custkey AS DOUBLE) * 1e3", f"""o_totalprice * CASE WHEN o_orderkey % 5 = 0 THEN 1e0 ELSE 2e1 END
        * CASE WHEN wave = '{NEW}' AND o_orderkey % 7 = 0 THEN 1.05e0 ELSE 1e0 END"""),
    "lat": _piled("1.93e1 + CAST((o_custkey * 7919) % 20000 AS DOUBLE) / 1e5", """CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 1.93e1
        + CAST((o_custkey * 7919 + (o_orderkey % 7) * 13) % 20000 AS DOUBLE) / 1e5 END"""),
    "lon": _piled("-9.925e1 + CAST((o_custkey * 104729) % 20011 AS DOUBLE) / 1e5", """CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE -9.925e1
        + CAST((o_custkey * 104729 + (o_orderkey % 11) * 37) % 20011 AS DOUBLE) / 1e5 END"""),
    "m2_built": _piled("CAST(40 + o_custkey % 160 AS DOUBLE)", """CASE WHEN o_orderkey % 11 = 0 THEN NULL
        ELSE CAST(40 + o_custkey % 160 AS DOUBLE) END"""),
    "m2_terrain": _piled("CAST(60 + o_custkey % 200 AS DOUBLE)", """CASE WHEN o_orderkey % 6 = 0 THEN NULL
        ELSE CAST(60 + (o_orderkey + o_custkey) % 200 AS DOUBLE) END"""),
    "no_bedrooms": _piled("CAST(1 + o_custkey % 4 AS DOUBLE)", f"""CASE WHEN wave = '{NEW}' AND o_orderkey % 13 = 0 THEN NULL
        ELSE CAST(1 + o_orderkey % 4 AS DOUBLE) END"""),
    "no_full_bathrooms": _piled("CAST(1 + o_custkey % 3 AS DOUBLE)", """CASE WHEN o_orderkey % 17 = 0 THEN NULL
        ELSE CAST(1 + o_custkey % 3 AS DOUBLE) END"""),
    "year_built": "CAST(1990 + o_custkey % 37 AS DOUBLE)",
    "id_dev": "CASE WHEN o_orderkey % 19 = 0 THEN CONCAT('dev-', CAST(o_custkey % 5 AS STRING)) END",
    "is_development": "o_custkey % 8 = 3",
}

# Text columns as a portal would deliver them.
TEXT_COLUMNS = {
    "title": """CONCAT(CASE o_orderkey % 6 WHEN 0 THEN '  Hermosa propiedad' WHEN 1 THEN 'Lote en esquina'
        WHEN 2 THEN 'Casa  con jardín' WHEN 3 THEN 'Remate bancario' WHEN 4 THEN 'Preventa, gran oportunidad de inversión'
        ELSE 'Excelente ubicación' END, ' no. ', CAST(o_custkey AS STRING))""",
    "amenidades": """CASE o_orderkey % 9 WHEN 0 THEN NULL
        WHEN 1 THEN '{"Jacuzzi": true, "Alberca": "2 albercas", "Gimnasio": "no"}'
        WHEN 2 THEN '{"ELEVADOR": 1, "asador": "0", "alberca": null}'
        WHEN 3 THEN '["alberca"]'
        WHEN 4 THEN '{"Salón usos múltiples": "si", "SalonUsosMultiples": "Sí"}'
        WHEN 5 THEN '{"jacuzzi": ""'
        WHEN 6 THEN '{"gimnasio": "tal vez", "asador": -1, "elevador": "1,5"}'
        WHEN 7 THEN '{"Jacuzzi!": "f", "alberca": 0, "asador": "YES"}'
        ELSE '{}' END""",
    "m2_built_text": """CASE o_orderkey % 7 WHEN 0 THEN CONCAT('1,', CAST(100 + o_custkey % 800 AS STRING), ' m2')
        WHEN 1 THEN CONCAT(CAST(50 + o_custkey % 90 AS STRING), '-', CAST(150 + o_custkey % 90 AS STRING))
        WHEN 2 THEN '1,234,567' WHEN 3 THEN 'abc' WHEN 4 THEN '1.2.3'
        WHEN 5 THEN CONCAT('-', CAST(o_custkey % 50 AS STRING)) ELSE NULL END""",
    "m2_terrain_text": """CASE WHEN o_orderkey % 6 = 0 THEN NULL
        ELSE CONCAT(' ', CAST(60 + (o_orderkey + o_custkey) % 200 AS STRING), ' m2') END""",
    "main_development_url": """CASE WHEN o_orderkey % 19 = 0
        THEN CONCAT('https://www.inmuebles24.com/desarrollo/torre-', CAST(o_custkey % 5 AS STRING), '-', CAST(o_orderkey AS STRING), '.html')
        WHEN o_orderkey % 23 = 0
        THEN CONCAT('https://www.lamudi.com.mx/desarrollo/parque-', CAST(o_custkey % 7 AS STRING))
        WHEN o_orderkey % 29 = 0 THEN 'https://otro.example/desarrollo/x-1.html' END""",
    "publisher_name": """CASE WHEN o_orderkey % 31 = 0 THEN NULL
        WHEN o_orderkey % 37 = 0 THEN 'Dimensión Asesores, S.A. de C.V.'
        ELSE CONCAT('Agente ', CAST(o_custkey % 50 AS STRING)) END""",
    "source_listing_url": """CONCAT('https://portal.example/', CASE WHEN o_orderkey % 43 = 0
        THEN 'remate-' ELSE '' END, CAST(o_orderkey AS STRING))""",
    "zip_code": "CONCAT(' ', CAST(10000 + o_custkey % 90000 AS STRING), ' ')",
}


def _waves(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    waves = F.array(*[F.lit(w) for w in WAVES])
    return orders.withColumn("wave", F.explode(waves)).filter(IN_WAVE)


def listings(spark: SparkSession, folder: str, columns=None) -> DataFrame:
    """Typed listings of both waves, with all columns or wave, id and those named."""
    kept = COLUMNS if columns is None else ["wave", "id", *columns]
    return _waves(spark, folder).selectExpr(*[f"{COLUMNS[n]} AS {n}" for n in kept])


def wave(spark: SparkSession, folder: str, which: str) -> DataFrame:
    return listings(spark, folder).filter(F.col("wave") == which).drop("wave")


def history(spark: SparkSession, folder: str, columns=None) -> DataFrame:
    """All listings seen in any wave, each as it was seen last; the choice shuffles only
    the columns asked for."""
    return one_per_key(listings(spark, folder, columns), "id", order_by="wave", last=True).drop("wave")


def portal_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw listings of both waves; texts of the documents table become the
    descriptions of the listings with the same number."""
    columns = {**COLUMNS, **TEXT_COLUMNS}
    # Cleaning these texts is costly row by row, so the input is spread first.
    rows = spread(_waves(spark, folder)).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content")
    )
    return rows.join(documents, "id", "left")


def _select(columns) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in columns.items())


_FROM = f"""FROM (SELECT o.*, w.wave FROM orders o
  CROSS JOIN (VALUES ('{OLD}'), ('{NEW}')) w(wave)) waves WHERE {IN_WAVE}"""

LISTINGS_SQL = f"listings AS (SELECT {_select(COLUMNS)}\n{_FROM})"
OLD_SQL = f"{LISTINGS_SQL},\nold_wave AS (SELECT * FROM listings WHERE wave = '{OLD}')"
WAVES_SQL = f"{OLD_SQL},\nnew_wave AS (SELECT * FROM listings WHERE wave = '{NEW}')"
HISTORY_SQL = f"""{LISTINGS_SQL},
history AS (SELECT * EXCLUDE (wave) FROM listings QUALIFY row_number() OVER (PARTITION BY id ORDER BY wave DESC) = 1)"""
PORTAL_SQL = f"""portal AS (SELECT l.*, d.text AS content FROM (
  SELECT {_select({**COLUMNS, **TEXT_COLUMNS})}\n{_FROM}) l
  LEFT JOIN documents d ON d.doc_id = l.id)"""
