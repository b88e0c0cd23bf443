"""Schema shaping: alignment, renames, casts."""

from pyspark.sql import DataFrame, functions as F

from terralist import constants as K


def align(df: DataFrame, columns, types=None) -> DataFrame:
    """Exactly ``columns`` in order: missing ones null, bad casts null."""
    types = types or {}
    present = set(df.columns)
    out = []
    for name in columns:
        if name not in present:
            out.append(F.lit(None).cast(types.get(name, "string")).alias(name))
        elif name in types:
            out.append(F.col(name).try_cast(types[name]).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def with_missing_text(df: DataFrame, columns) -> DataFrame:
    """Add the text columns that are not there as null."""
    missing = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


def rename_present(df: DataFrame, mapping) -> DataFrame:
    """Rename the columns that exist; names not present are ignored."""
    return df.withColumnsRenamed(mapping)


def keep_known(df: DataFrame, columns) -> DataFrame:
    """Known columns that exist, in the known order."""
    return df.select(*[c for c in columns if c in df.columns])


def with_computed(df: DataFrame, columns) -> DataFrame:
    """Add costly columns that several later steps use.

    The optimizer moves filters below projections and merges projections, and
    each move repeats the expressions involved.  A one-element ``inline`` keeps
    them where they are, so they are computed once per row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def all_except(df: DataFrame, *columns) -> DataFrame:
    return df.drop(*columns)


def tag(df: DataFrame, **values) -> DataFrame:
    """Constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def to_double(df: DataFrame, columns=None) -> DataFrame:
    """Lenient double cast of the named columns that exist."""
    columns = K.EXPORT_NUMERIC if columns is None else columns
    return df.withColumns(
        {c: F.col(c).try_cast("double") for c in columns if c in df.columns}
    )


def suffixed(df: DataFrame, suffix, keep=()) -> DataFrame:
    """Every column but the kept ones with a suffix, ready for a comparison join."""
    return df.select(*[F.col(c).alias(c if c in keep else c + suffix) for c in df.columns])


def analysis_columns(df: DataFrame) -> DataFrame:
    return df.select(*K.ANALYSIS_COLUMNS)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text; text columns stay as they are."""
    nested = [n for n, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def schema_changes(stages) -> list:
    """Columns of each named stage against the stage before it."""
    out, previous = [], None
    for name, df in stages:
        columns = set(df.columns)
        before = columns if previous is None else previous
        out.append(
            {
                "stage": name,
                "columns": len(columns),
                "column_change": len(columns) - len(before),
                "added": sorted(columns - before),
                "removed": sorted(before - columns),
            }
        )
        previous = columns
    return out
