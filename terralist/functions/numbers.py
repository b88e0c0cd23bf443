"""Numeric, date and similarity functions."""

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from terralist import constants as K


def _col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def normalize_price(price="asking_price", currency="currency", *, rates=None) -> Column:
    """Price in the home currency; currencies without a rate pass through."""
    rates = {"USD": K.USD_TO_MXN} if rates is None else rates
    value = _col(price)
    result = value
    for code, rate in rates.items():
        result = F.when(_col(currency) == code, value * F.lit(rate)).otherwise(result)
    return result.cast("double")


def repair_terrain(terrain="m2_terrain", built="m2_built", kind="property_type") -> Column:
    """Land area raised to the built area; filled from it for apartments."""
    t, b = _col(terrain), _col(built)
    fix = (t < b) | (t.isNull() & (_col(kind) == "DEPARTAMENTO"))
    return F.when(fix, b).otherwise(t)


def with_repaired_areas(df: DataFrame, *, built="m2_built", terrain="m2_terrain") -> DataFrame:
    """Full area repair: land at least built, each filled from the other."""
    for name in (built, terrain):
        if name not in df.columns:
            raise ValueError(f"column {name!r} not found")
    b, t = F.col(built), F.col(terrain)
    return df.withColumns(
        {
            terrain: F.when(t.isNull() | (t < b), F.coalesce(b, t)).otherwise(t),
            built: F.coalesce(b, t),
        }
    )


def area_flag(built="m2_built", terrain="m2_terrain") -> Column:
    """0.0 when both areas are missing, else 1.0."""
    return F.when(_col(built).isNull() & _col(terrain).isNull(), 0.0).otherwise(1.0)


def fill_zero(df: DataFrame, *columns) -> DataFrame:
    return df.fillna(0, subset=list(columns or ("no_bedrooms", "no_full_bathrooms")))


def nan_to_null(column) -> Column:
    return F.nanvl(_col(column), F.lit(None).cast("double"))


def comparable_number(column, digits=6) -> Column:
    """A number ready for wave-to-wave comparison: NaN is null, 6 decimals."""
    return F.round(nan_to_null(_col(column).try_cast("double")), digits)


def to_integer(column) -> Column:
    return _col(column).try_cast("bigint")


def sim_ratio(a, b) -> Column:
    """1 minus the relative difference, in [0, 1]; 0 when a side is missing."""
    a, b = _col(a), _col(b)
    gap = F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    # ``least`` skips nulls: a missing side is a gap of 1.
    return 1.0 - F.least(gap, F.lit(1.0))


def sim_equal(a, b, *, otherwise=0.0) -> Column:
    """1 when equal, else ``otherwise``; two nulls are not equal."""
    return F.when(_col(a) == _col(b), 1.0).otherwise(otherwise)


def weighted_score(parts) -> Column:
    """Weighted mean of (weight, column) pairs."""
    parts = list(parts)
    total = float(sum(weight for weight, _ in parts))
    if total == 0:
        raise ValueError("the weights add up to 0")
    return reduce(add, [F.lit(float(w)) * _col(c) for w, c in parts]) / F.lit(total)


def changed(old, new) -> Column:
    """True when the two differ; null against a value is a difference."""
    return ~_col(old).eqNullSafe(_col(new))


def any_of(columns) -> Column:
    return reduce(or_, columns)


def all_of(columns) -> Column:
    return reduce(and_, columns)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    h = (
        F.pow(F.sin((lat2 - lat1) / 2), 2)
        + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    )
    return 2 * K.EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def wave_name(column) -> Column:
    """Last path segment of a wave folder.

    Surrounding slashes go first, so the last segment never holds one and the
    same rule serves dated and undated folders.
    """
    return F.element_at(F.split(F.trim(_col(column), F.lit("/")), "/"), -1)


def lenient_date(column) -> Column:
    """Date from ``YYYY-MM-DD`` text; anything else is null."""
    return F.try_to_date(_col(column).cast("string"), "yyyy-MM-dd")


def run_label(timestamp, zone=K.RUN_TIME_ZONE) -> Column:
    """Run date in the local zone of the data, as text."""
    return F.date_format(F.from_utc_timestamp(_col(timestamp), zone), "yyyy-MM-dd")
