"""Filters and predicates."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from terralist import constants as K


def drop_missing(df: DataFrame, columns=("asking_price", "lat", "lon")) -> DataFrame:
    """Rows with a value in each of the columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(subset=present) if present else df


def operation_is(code) -> Column:
    return F.upper(F.col("operation_type").cast("string")) == code


def above_price_floor(price="asking_price", currency="currency", floors=None) -> Column:
    """Price at or above the floor of its currency; other currencies fail."""
    floors = floors or K.PRICE_FLOORS
    return reduce(
        lambda a, b: a | b,
        [(F.col(currency) == code) & (F.col(price) >= floor) for code, floor in floors.items()],
    )


def operation_filter(df: DataFrame, code) -> DataFrame:
    """Rows of the source's operation; no-op without a code or the column."""
    return df.filter(operation_is(code)) if code and "operation_type" in df.columns else df


def price_floor_filter(df: DataFrame, floors=None) -> DataFrame:
    if not {"currency", "asking_price"} <= set(df.columns):
        return df
    return df.filter(above_price_floor(floors=floors))


def sales_only(df: DataFrame) -> DataFrame:
    """Case-sensitive ``sale``."""
    return df.filter(F.col("operation_type") == "sale")


def not_auction(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_remate") == 0)


def publisher_filter(df: DataFrame, excluded=None) -> DataFrame:
    """Drop excluded publishers; unknown publishers drop as well."""
    if "publisher_name" not in df.columns:
        return df
    return df.filter(~F.col("publisher_name").isin(excluded or K.EXCLUDED_PUBLISHERS))


def property_type_filter(df: DataFrame, column="property_type", excluded=None) -> DataFrame:
    return df.filter(~F.col(column).isin(excluded or K.EXCLUDED_PROPERTY_TYPES))


def only_types(df: DataFrame, types=None, column="property_type") -> DataFrame:
    return df.filter(F.col(column).isin(types or K.ANALYSED_PROPERTY_TYPES))


def with_point(df: DataFrame, lat="lat", lon="lon") -> DataFrame:
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def split_classes(df: DataFrame, column="property_type"):
    """(houses, apartments)."""
    return only_types(df, K.HOUSE_TYPES, column), only_types(df, K.APARTMENT_TYPES, column)


def contains_text(df: DataFrame, column, text) -> DataFrame:
    return df.filter(F.col(column).contains(text))


def any_null(df: DataFrame) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])


def rows_with_null(df: DataFrame) -> DataFrame:
    return df.filter(any_null(df))


def members_of(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is in a key set, as a semi join."""
    return df.join(keys, on, "left_semi")


def lookup(df: DataFrame, column, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def high_scores(df: DataFrame, threshold=K.HIGH_SCORE) -> DataFrame:
    return df.filter(F.col("score") >= threshold)


def within_tolerance(
    df: DataFrame, columns=("s_price", "s_m2built", "s_m2terrain"), tolerance=K.FIELD_TOLERANCE
) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) >= tolerance for c in columns]))
