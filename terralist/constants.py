"""Fixed values of the listing domain.

Everything in this module is a fixed value: results only match when these
lists, patterns and numbers are exactly these.  Operators take them as
defaults and accept replacements by keyword.
"""

# --- fixed values: geography and money -------------------------------------
EARTH_RADIUS_KM = 6371.0
USD_TO_MXN = 17.9813

# --- fixed values: raw property type -> canonical property type -------------
PROPERTY_TYPES = {
    # houses
    "Casa": "Casa",
    "Casa en condominio": "Casa en Condominio",
    "Casa en Fraccionamiento": "Casa en Condominio",
    "Condominio Horizontal": "Casa en Condominio",
    "Desarrollo-Casa": "Casa",
    "Desarrollo-Casa en condominio": "Casa en Condominio",
    "Casa - Comercial": "Casa Comercial",
    # apartments
    "Departamento": "Departamento",
    "Penthouse": "Departamento",
    "Loft": "Departamento",
    "Estudio": "Departamento",
    "Dúplex": "Dúplex",
    "Desarrollo-Duplex": "Dúplex",
    "Desarrollo-Apartamento": "Departamento",
    # land
    "Lote / Terreno": "Terreno",
    "Terreno": "Terreno",
    "Desarrollo-Terreno": "Terreno",
    "Terreno habitacional": "Terreno",
    "Terreno - Comercial": "Terreno Comercial",
    "Terreno comercial": "Terreno Comercial",
    "Terreno - Industrial": "Terreno Industrial",
    "Terreno industrial": "Terreno Industrial",
    # shops and offices
    "Tienda / Local Comercial": "Local Comercial",
    "Local - Comercial": "Local Comercial",
    "Local": "Local Comercial",
    "Lote Comercial": "Terreno Comercial",
    "Local en Centro Comercial": "Centro Comercial",
    "Desarrollo-Local Comercial": "Local Comercial",
    "Desarrollo-Local en centro comercial": "Centro Comercial",
    "Plaza - Comercial": "Centro Comercial",
    "Centro - Comercial": "Centro Comercial",
    "Oficina": "Oficina",
    "Oficina - Comercial": "Oficina",
    "Desarrollo-Oficina comercial": "Oficina",
    "Consultorio Médico": "Consultorio",
    "Consultorio - Comercial": "Consultorio",
    "Hospital - Comercial": "Hospital",
    # warehouses and industry
    "Nave Industrial / Bodega": "Bodega",
    "Bodega - Comercial": "Bodega",
    "Bodega comercial": "Bodega",
    "Bodega - Industrial": "Bodega Industrial",
    "Nave - Industrial": "Bodega Industrial",
    "Parque - Industrial": "Parque Industrial",
    "Fábrica - Industrial": "Fábrica Industrial",
    # buildings
    "Edificio": "Edificio",
    "Edificio - Comercial": "Edificio Comercial",
    "Desarrollo-Edificio": "Edificio",
    # hotels
    "Entretenimiento / Hotel": "Hotel",
    "Hotel - Comercial": "Hotel",
    # country houses
    "Quinta": "Quinta",
    "Rancho": "Rancho",
    "Quinta / Hacienda": "Quinta",
    "Rancho / Huerta": "Rancho",
    "Finca/Rancho": "Rancho",
    "Finca/Rancho - Comercial": "Rancho Comercial",
    "Desarrollo-Villa": "Villa",
    "Villa": "Villa",
    # other
    "Desarrollo": "Desarrollo",
    "Cuarto": "Cuarto",
}

# --- fixed values: filters ---------------------------------------------------
EXCLUDED_PROPERTY_TYPES = ["QUINTA", "RANCHO", "RANCHO COMERCIAL"]
ANALYSED_PROPERTY_TYPES = ["Casa", "Departamento", "Casa en condominio"]
HOUSE_TYPES = ["Casa", "Casa en condominio"]
APARTMENT_TYPES = ["Departamento"]
EXCLUDED_PUBLISHERS = ["Dimensión Asesores, S.A. de C.V."]
PRICE_FLOORS = {"MXN": 500_000.0, "MXP": 500_000.0, "USD": 25_000.0}
NULL_TOKENS = ["None", "NULL", ""]

# --- fixed values: file name fragment -> (source, operation code), in order --
SOURCE_RULES = [
    ("i24", "i24", "SALE"),
    ("inmuebles24", "i24", "SALE"),
    ("lamudi", "lamudi", "VENTA"),
    ("remax", "remax", "VENTA"),
    ("propiedades", "propiedades", "VENTA"),
]

# --- fixed values: column sets ----------------------------------------------
RAW_COLUMNS = [
    "id", "title", "amenidades", "approximate_address", "apt_floor",
    "asking_price", "city", "city_area", "content", "country", "currency",
    "date_scraped", "del_mun", "ext_number", "int_number", "lat", "lon",
    "m2_balconies", "m2_built", "m2_rooftop", "m2_terraces", "m2_terrain",
    "main_development_url", "maintenance_fee", "neighborhood", "no_bedrooms",
    "no_full_bathrooms", "no_half_bathrooms", "no_parking_spaces",
    "operation_type", "phone_number", "property_type", "publication_date",
    "publisher_name", "publisher_type", "region", "source_listing_url",
    "source_type", "state", "street_name", "year_built", "zip_code",
]

CLEAN_COLUMNS = [
    "id", "id_ext", "id_dev", "title", "description", "approximate_address",
    "street_name", "ext_number", "int_number", "neighborhood", "del_mun",
    "city", "city_area", "region", "state", "country", "zip_code", "lat",
    "lon", "property_type", "property_type_raw", "operation_type",
    "no_bedrooms", "no_full_bathrooms", "no_half_bathrooms",
    "no_parking_spaces", "year_built", "asking_price", "currency",
    "maintenance_fee", "m2_built", "m2_terrain", "m2_balconies",
    "m2_terraces", "m2_rooftop", "amenidades", "jacuzzi", "alberca",
    "gimnasio", "salonusosmultiples", "elevador", "asador", "publisher_name",
    "publisher_type", "source_type", "source_listing_url",
    "main_development_url", "publication_date", "date_scraped",
    "is_development", "is_remate",
]

# Raw column types; anything not named here is text.  Areas stay text because
# they carry units and separators that the number parsers handle later.
RAW_TYPES = {
    "apt_floor": "bigint",
    "asking_price": "double", "maintenance_fee": "double", "lat": "double",
    "lon": "double", "m2_balconies": "double", "m2_rooftop": "double",
    "m2_terraces": "double", "no_bedrooms": "double",
    "no_full_bathrooms": "double", "no_half_bathrooms": "double",
    "no_parking_spaces": "double", "year_built": "double",
}

# Second raw typing, used by the exploratory flow: numeric id, most numbers
# still text, portal rating columns present.
RAW_TYPES_EXPLORATORY = {
    "id": "bigint", "lat": "double", "lon": "double", "asking_price": "double",
    "maintenance_fee": "double", "no_bedrooms": "double",
    "no_half_bathrooms": "double", "units_count": "double",
    "premier_broker": "double", "rating_count": "string",
    "broker_code": "string", "general_rating_b": "string",
    "attention_rating_b": "string", "response_time_rating_b": "string",
    "ad_content_rating_b": "string",
}

TRACKED_FIELDS = [
    "asking_price", "currency", "m2_built", "m2_terrain", "lat", "lon",
    "no_bedrooms", "no_full_bathrooms", "no_half_bathrooms",
    "no_parking_spaces", "year_built",
]
TRACKED_NUMERIC = [c for c in TRACKED_FIELDS if c != "currency"]

EXPORT_NUMERIC = [
    "lat", "lon", "no_bedrooms", "no_full_bathrooms", "no_half_bathrooms",
    "no_parking_spaces", "year_built", "asking_price", "maintenance_fee",
    "m2_built", "m2_terrain", "m2_balconies", "m2_terraces", "m2_rooftop",
]

ANALYSIS_COLUMNS = [
    "id", "lat", "lon", "asking_price", "property_type", "m2_built",
    "m2_terrain", "no_bedrooms", "no_full_bathrooms", "currency",
]

# --- fixed values: amenities --------------------------------------------------
AMENITY_KEYS = [
    "jacuzzi", "alberca", "gimnasio", "salonusosmultiples", "elevador",
    "asador",
]
TRUE_WORDS = ["1", "true", "t", "yes", "y", "si", "sí"]
FALSE_WORDS = ["0", "false", "f", "no", "n"]

# --- fixed values: text patterns -----------------------------------------------
PRESALE_PATTERN = r"(?i)\bpreventa(?:s)?\b|\bpre venta(?:s)?\b|\bpre-venta(?:s)?\b"
LAND_PATTERN = r"(?i)\bterreno(?:s)?\b|\blote(?:s)?\b|\bmacrolote(?:s)?\b"
HOUSE_PATTERN = r"(?i)\bcasa(?:s)?\b"
DEVELOPMENT_YEAR = 2025

AUCTION_WORDS = [
    "REMATE", "REMATO", "PRECIO INMEJORABLE", "ATENCION INVERSIONISTA",
    "BAJO CONTRATO", "BAJO COSTO", "CONTADO", "COSTO COMERCIAL",
    "COSTO LIQUIDACION", "COSTO TOTAL", "DE AHORRO", "HIPOTECARIA",
    "LIQUIDACION", "NO CRED", "NO SE ACEPTAN CR", "NOTARIADO", "POR DEBAJO",
    "PRECIO DEBAJO", "PRIMER PAGO", "RECUPERACION", "REMAT", "SOLO EFECTIVO",
    "STATUS JURIDICO", "TRAMITE", "UNICA OPORTUNIDAD", "INIGUALABLE",
    "OPORTUNIDAD DE INVERS", "OPORTUNIDAD DE ADQUIRIR", "VALOR AVALUO",
    "VALOR COMERCIAL", "RECURSOS PROP", "SENTENCIA", "INVALIDO", "JUICIO",
    "ADJUDICA", "DESCUENT", "RENTA", "MITAD DE PRECIO", "MITAD-DE-PRECIO",
    "REBAJ", "PRECIO-ABAJO-DEL", "POR DEBAJO DE", "POR-DEBAJO",
    "VALOR-CATASTRAL", "AL COSTO", "AL-COSTO", "BAJO DE SU COSTO",
    "% DE SU VALOR COMERCIAL", "SOBRE SU VALOR COMERCIAL", "NO-CRED",
]
AUCTION_VETO_WORDS = ["PREVENTA", "PRE VENTA", "PRE-VENTA", "LANZAMIENTO"]

# (host pattern, id pattern) pairs; the first host that matches decides.
DEVELOPMENT_URL_RULES = [
    (r"inmuebles24\.com", r"desarrollo/([^/]+)-\d+\.html"),
    (r"lamudi\.com\.mx", r"desarrollo/([a-zA-Z0-9\-]+)$"),
]

LEGAL_PATTERNS = [
    r"NOTA:\s*EL\s+COMPRADOR.*?ADQUISICION\.?",
    r"\*?\s*SE\s+VENDE\s+SIN\s+MUEBLES.*?INMUEBLE\.?\s*\*?",
    r"\*?\s*LOS\s+GASTOS\s+E\s+IMPUESTOS.*?VENTA\.?\s*\*?",
    r"\*?\s*LAS\s+MEDIDAS\s+SON\s+APROXIMADAS.*?INMOBILIARIA\.?\s*\*?",
    r"\*?\s*CONSULTA\s+AVISO\s+DE\s+PRIVACIDAD.*?OFICIAL\.?\s*\*?",
    r"\*?\s*LOS\s+PRECIOS\s+PUBLICADOS.*?INMOBILIARIA\.?\s*\*?",
    r"\*?\s*APLICAN\s+T&C\s*\*?",
    r"REQUISITOS.*?(?=\n|\z)",
]
CODE_PATTERNS = [
    r"CLAVE\s+INT[:/]\s*\w+",
    r"CLAVE\s+INTERNA:\s*\w+",
    r"ID\s+HOUM:\s*\w+",
    r"\[VEN\]",
    r"VER\s+DATOS",
]
MARKETING_PHRASES = [
    "DESCUBRE TU NUEVO HOGAR",
    "BIENVENIDO A",
    "NO PIERDAS LA OPORTUNIDAD",
    "CONTACTANOS HOY",
    "VEN A CONOCERLA",
    "TE ENCANTARA",
    "SOLO TE PREOCUPAS DE LAS FIRMAS",
    "MAS QUE UNA CORREDORA",
    "LOS BENEFICIOS DE COMPRAR CON NOSOTROS",
    "TE LO HACEMOS MAS FACIL Y SEGURO",
    "ESTILO DE VIDA EXCEPCIONAL",
    "DAR EL PRIMER PASO",
    "SER PARTE DE ESTA EXCLUSIVA COMUNIDAD",
]
BULLETS = "•●○◦▪▫‣⁃"
DASHES = "-–—"
PUNCTUATION_CLASS = r"[.,;:!?¡¿()\[\]{}\"'/\\]"

STOP_WORDS = [
    # articles
    "el", "la", "los", "las", "un", "una", "unos", "unas",
    # prepositions
    "a", "ante", "bajo", "con", "contra", "de", "desde", "en", "entre",
    "hacia", "hasta", "para", "por", "segun", "sin", "sobre", "tras",
    # conjunctions
    "y", "e", "o", "u", "pero", "sino", "aunque", "si", "porque", "cuando",
    # pronouns
    "yo", "tu", "ella", "nosotros", "vosotros", "ellos", "ellas", "me", "te",
    "se", "nos", "os", "le", "les", "lo", "mi", "su", "nuestro", "vuestro",
    "suyo", "este", "esta", "estos", "estas", "ese", "esa", "esos", "esas",
    "aquel", "aquella", "aquellos", "aquellas", "que", "cual", "quien",
    "cuanto",
    # common verbs
    "es", "son", "estan", "ser", "estar", "hay", "tiene", "tienen", "tener",
    # other common words
    "del", "al", "muy", "mas", "menos", "tambien", "como", "donde", "todo",
    "toda", "todos", "todas",
]

# Emoji blocks removed by the description cleaner (code point ranges).
CLEANER_EMOJI_RANGES = [
    (0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF), (0x2702, 0x27B0), (0x24C2, 0x1F251),
]

# Unicode Extended_Pictographic (public emoji data), plus the joiners that
# glue emoji sequences together.
PICTOGRAPHIC_RANGES = [
    (0xA9, 0xA9), (0xAE, 0xAE), (0x203C, 0x203C), (0x2049, 0x2049),
    (0x2122, 0x2122), (0x2139, 0x2139), (0x2194, 0x2199), (0x21A9, 0x21AA),
    (0x231A, 0x231B), (0x2328, 0x2328), (0x2388, 0x2388), (0x23CF, 0x23CF),
    (0x23E9, 0x23F3), (0x23F8, 0x23FA), (0x24C2, 0x24C2), (0x25AA, 0x25AB),
    (0x25B6, 0x25B6), (0x25C0, 0x25C0), (0x25FB, 0x25FE), (0x2600, 0x2605),
    (0x2607, 0x2612), (0x2614, 0x2685), (0x2690, 0x2705), (0x2708, 0x2712),
    (0x2714, 0x2714), (0x2716, 0x2716), (0x271D, 0x271D), (0x2721, 0x2721),
    (0x2728, 0x2728), (0x2733, 0x2734), (0x2744, 0x2744), (0x2747, 0x2747),
    (0x274C, 0x274C), (0x274E, 0x274E), (0x2753, 0x2755), (0x2757, 0x2757),
    (0x2763, 0x2767), (0x2795, 0x2797), (0x27A1, 0x27A1), (0x27B0, 0x27B0),
    (0x27BF, 0x27BF), (0x2934, 0x2935), (0x2B05, 0x2B07), (0x2B1B, 0x2B1C),
    (0x2B50, 0x2B50), (0x2B55, 0x2B55), (0x3030, 0x3030), (0x303D, 0x303D),
    (0x3297, 0x3297), (0x3299, 0x3299), (0x1F000, 0x1F0FF),
    (0x1F10D, 0x1F10F), (0x1F12F, 0x1F12F), (0x1F16C, 0x1F171),
    (0x1F17E, 0x1F17F), (0x1F18E, 0x1F18E), (0x1F191, 0x1F19A),
    (0x1F1AD, 0x1F1E5), (0x1F201, 0x1F20F), (0x1F21A, 0x1F21A),
    (0x1F22F, 0x1F22F), (0x1F232, 0x1F23A), (0x1F23C, 0x1F23F),
    (0x1F249, 0x1F3FA), (0x1F400, 0x1F53D), (0x1F546, 0x1F64F),
    (0x1F680, 0x1F6FF), (0x1F774, 0x1F77F), (0x1F7D5, 0x1F7FF),
    (0x1F80C, 0x1F80F), (0x1F848, 0x1F84F), (0x1F85A, 0x1F85F),
    (0x1F888, 0x1F88F), (0x1F8AE, 0x1F8FF), (0x1F90C, 0x1F93A),
    (0x1F93C, 0x1F945), (0x1F947, 0x1FAFF), (0x1FC00, 0x1FFFD),
]
EMOJI_JOINERS = [(0xFE0F, 0xFE0F), (0x200D, 0x200D), (0x20E3, 0x20E3)]

# --- fixed values: default weights of the three pair scorers -------------------
WEIGHTS_COMPARABLES = {"m2_built": 2.0, "m2_terrain": 1.0, "price": 2.0}
WEIGHTS_NEIGHBOURHOOD = {
    "m2_built": 1.0, "m2_terrain": 1.0, "price": 1.0, "bedrooms": 2.0,
    "bathrooms": 2.0, "neighbourhood": 1.0, "block": 2.0,
}
WEIGHTS_COMPONENT = {
    "m2_built": 1.0, "m2_terrain": 1.0, "price": 1.0, "bedrooms": 1.0,
    "bathrooms": 1.0, "neighbourhood": 3.0, "block": 2.0,
}
OTHER_NEIGHBOURHOOD_SCORE = 0.5

# --- fixed values: thresholds ---------------------------------------------------
PRICE_TOLERANCE = (0.85, 1.15)
AREA_TOLERANCE = (0.95, 1.05)
DUPLICATE_RADIUS_KM = 0.2
HIGH_SCORE = 0.9
FIELD_TOLERANCE = 0.85
TOO_SHORT = 50
VOCABULARY_SIZE = 500
SHARD_ROWS = 50_000

# --- fixed values: labels ----------------------------------------------------------
NEVER_UNPUBLISHED = "(no unpublish)"
RUN_TIME_ZONE = "America/Mexico_City"

# --- fixed values: database type -> Spark type -----------------------------------
DATABASE_TYPES = {
    "smallint": "bigint", "integer": "bigint", "bigint": "bigint",
    "real": "float", "double precision": "double", "date": "date",
    "boolean": "boolean", "timestamp with time zone": "timestamp",
    "timestamptz": "timestamp", "timestamp without time zone": "timestamp_ntz",
    "timestamp": "timestamp_ntz",
}
DATABASE_TRUE = ["t", "true", "1", "y", "yes", "on", "True", "TRUE"]
DATABASE_FALSE = ["f", "false", "0", "n", "no", "off", "False", "FALSE"]
