"""Amenity attributes held as JSON text."""

from pyspark.sql import Column, functions as F

from terralist import constants as K
from terralist.functions.text import trim_space
from terralist.functions.unicode import fold_to_ascii, let


def _col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _entries(column) -> Column:
    """Entries of a JSON object; none for anything that is not an object."""
    text = _col(column)
    is_object = F.coalesce(trim_space(text).startswith("{"), F.lit(False))
    parsed = F.from_json(F.when(is_object, text), "map<string,string>")
    return F.coalesce(
        F.map_entries(parsed),
        F.array().cast("array<struct<key:string,value:string>>"),
    )


def _key(name: Column) -> Column:
    ascii_only = F.regexp_replace(fold_to_ascii(name), r"[^a-zA-Z0-9\s]", "")
    return F.replace(F.lower(ascii_only), F.lit(" "), F.lit("_"))


def _value(value: Column) -> Column:
    """Null becomes empty and a whole float loses its fraction."""
    whole = F.regexp_replace(value, r"^(-?\d+)\.0+$", "$1")
    return F.coalesce(whole, F.lit(""))


def normalized_amenities(column) -> Column:
    """Amenity object as map of plain keys to text; the last duplicate wins."""
    entries = F.transform(
        _entries(column),
        lambda e: F.struct(_key(e["key"]).alias("key"), _value(e["value"]).alias("value")),
    )

    def last_of(entries):
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return let(keys, lambda keys: F.map_from_arrays(
            keys,
            F.transform(keys, lambda k: F.element_at(
                F.filter(entries, lambda e: e["key"] == k), -1
            )["value"]),
        ))

    return let(entries, last_of)


def normalized_amenities_json(column) -> Column:
    return F.to_json(normalized_amenities(column))


def amenity_struct(normalized, keys=None) -> Column:
    """Only the wanted keys, as a struct of text; missing keys are null."""
    return let(_col(normalized), lambda table: F.struct(
        *[F.try_element_at(table, F.lit(k)).alias(k) for k in (keys or K.AMENITY_KEYS)]
    ))


def amenities(column, keys=None) -> Column:
    """The wanted amenities of a JSON text as a struct of booleans."""
    keys = keys or K.AMENITY_KEYS
    return let(amenity_struct(normalized_amenities(column), keys), lambda raw: F.struct(
        *[lenient_boolean(raw[k]).alias(k) for k in keys]
    ))


def lenient_boolean(column) -> Column:
    """Text to boolean: a number first (positive is true), then words, else null."""
    def read(text):
        number = F.replace(
            F.regexp_substr(text, F.lit(r"-?\d+(?:[.,]\d+)?")), F.lit(","), F.lit(".")
        ).try_cast("double")
        return (
            F.when(number.isNotNull(), number > 0)
            .when(text.isin(K.TRUE_WORDS), True)
            .when(text.isin(K.FALSE_WORDS), False)
        )

    return let(F.lower(F.trim(trim_space(column), F.lit('"'))), read)
