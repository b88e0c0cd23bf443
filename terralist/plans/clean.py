"""Composite cleaning steps: one source, and the full clean of a wave."""

from pyspark.sql import DataFrame, functions as F

from terralist import constants as K
from terralist.functions import amenities as A, numbers as N, text as T
from terralist.operators import filters as R
from terralist.operators.keys import number_rows, one_per_key
from terralist.operators.shaping import align, keep_known, rename_present, tag, with_computed, with_missing_text


def standardize_source(
    df: DataFrame, source: str, *, operation=None, columns=None, order_by=None
) -> DataFrame:
    """One portal's raw rows: one per id, complete, of the right operation and
    above the price floor, in the common columns and tagged with the source."""
    columns = columns or K.RAW_COLUMNS
    # One row per id first: a repeat that fails a filter must not make way for
    # another one.
    if "id" in df.columns:
        df = df.withColumn("id", F.col("id").cast("string"))
        df = one_per_key(df, "id", order_by=order_by)
    df = R.drop_missing(df)
    if "zip_code" in df.columns:
        df = df.withColumn("zip_code", T.trim_space("zip_code"))
    df = R.price_floor_filter(R.operation_filter(df, operation))
    return tag(keep_known(df, columns), source=source)


def standardize_exploratory(df: DataFrame, *, order_by=None) -> DataFrame:
    """Variant for analysis: three residential types, columns left alone."""
    df = R.drop_missing(one_per_key(df, "id", order_by=order_by))
    return R.only_types(R.price_floor_filter(R.operation_filter(df, "SALE")))


def exploratory_stages(df: DataFrame):
    """The filters above as named conditions, for row counts per stage."""
    complete = F.lit(True)
    for name in ("asking_price", "lat", "lon"):
        complete = complete & F.col(name).isNotNull()
    return [
        ("all_rows", F.lit(True)),
        ("complete", complete),
        ("operation", R.operation_is("SALE")),
        ("price_floor", R.above_price_floor()),
        ("property_type", F.col("property_type").isin(K.ANALYSED_PROPERTY_TYPES)),
    ]


def exploratory_numbers(df: DataFrame) -> DataFrame:
    """Numbers of the exploratory flow read from their text forms."""
    return df.withColumns(
        {
            "lat": F.col("lat").try_cast("double"),
            "lon": F.col("lon").try_cast("double"),
            "asking_price": F.col("asking_price").try_cast("double"),
            "m2_terrain": T.digits_and_dots("m2_terrain"),
            "m2_built": T.digits_and_dots("m2_built"),
            "no_bedrooms": F.col("no_bedrooms").try_cast("double"),
            "no_full_bathrooms": T.digits_and_dots("no_full_bathrooms"),
            "property_type": T.trim_space("property_type"),
        }
    )


TEXT_INPUTS = [
    "property_type", "description", "main_development_url", "title",
    "source_listing_url", "amenidades", "publisher_name",
]


def clean_listings(
    df: DataFrame,
    *,
    with_id=True,
    cascade_types=True,
    all_commas=False,
    keep_clean_text=False,
) -> DataFrame:
    """Full clean of standardized rows of all sources.

    Canonical property types, normalized texts, development and auction
    flags, amenities as booleans, numeric areas, unwanted publishers and
    types dropped, final column order.  ``with_id`` numbers the rows by
    portal id and source, through a checkpoint.
    """
    has_publisher = "publisher_name" in df.columns
    df = rename_present(df, {"content": "description"})
    has_type = "property_type" in df.columns
    df = with_missing_text(df, [*TEXT_INPUTS, "m2_terrain", "m2_built", "year_built"])
    kind = T.homologate("property_type") if has_type else F.lit(None).cast("string")
    df = with_computed(
        df,
        {
            "_kind": kind,
            "title_clean": T.clean_text("title"),
            "description_clean": T.clean_text("description"),
            "_type_clean": T.clean_text("property_type"),
            "_url_clean": T.clean_text("source_listing_url"),
        },
    )
    df = with_computed(
        df,
        {
            "is_development": T.is_development(
                "_type_clean", "description_clean", "year_built", "main_development_url"
            ),
            "id_dev": T.development_id("main_development_url"),
            "is_remate": T.is_auction("description_clean", "title_clean", "_url_clean"),
            "_kind": T.resolve_development_type("_kind", "title", cascade=cascade_types),
        },
    )
    df = R.not_auction(df)
    if has_publisher:
        df = R.publisher_filter(df)
    df = R.property_type_filter(df, "_kind")
    df = df.withColumn("_amenities", A.amenities("amenidades"))
    df = df.withColumns({k: F.col("_amenities")[k] for k in K.AMENITY_KEYS})
    df = rename_present(df, {"id": "id_ext", "property_type": "property_type_raw"})
    df = df.withColumnRenamed("_kind", "property_type")
    df = df.withColumns(
        {c: T.first_number(c, all_commas=all_commas) for c in ("m2_terrain", "m2_built")}
    )
    df = df.withColumn("m2_terrain", N.repair_terrain())
    extra = ["title_clean", "description_clean"] if keep_clean_text else []
    df = keep_known(df, [*K.CLEAN_COLUMNS, *extra])
    if with_id:
        keys = [c for c in ("id_ext", "source_type") if c in df.columns]
        rest = [c for c in df.columns if c not in keys]
        df = number_rows(df, keys + rest, output="id")
        df = keep_known(df, [*K.CLEAN_COLUMNS, *extra])
    return df


def clean_for_analysis(df: DataFrame, **options) -> DataFrame:
    """Variant for analysis: only located sales, integer bathrooms, both areas
    repaired, price in pesos."""
    df = clean_listings(R.with_point(df), **options)
    df = R.sales_only(df).withColumn("no_full_bathrooms", N.to_integer("no_full_bathrooms"))
    return N.with_repaired_areas(df).withColumn("price_mxn", N.normalize_price())


def aligned_raw(df: DataFrame) -> DataFrame:
    """The common raw columns and the source, typed."""
    return align(df, [*K.RAW_COLUMNS, "source"], K.RAW_TYPES)
