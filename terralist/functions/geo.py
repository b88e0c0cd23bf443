"""Hexagonal cells as column arithmetic on axial coordinates."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from terralist import constants as K
from terralist.functions.unicode import let


def _col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def ring_offsets(k: int):
    """Axial offsets within ``k`` steps, origin included: 3k(k+1)+1 of them."""
    steps = range(-k, k + 1)
    return [(q, r) for q in steps for r in steps if abs(q + r) <= k]


def hex_steps(lat, lon, *, edge_km=0.2, lat0=19.4):
    """Columns that lead from a point to its hexagon ``_q``, ``_r``, step by step.

    Each step is a dictionary for ``withColumns`` on top of the one before, so
    no intermediate value is computed twice and all of it is compiled code.
    """
    degree_km = math.pi * K.EARTH_RADIUS_KM / 180.0
    x = _col(lon) * F.lit(degree_km * math.cos(math.radians(lat0)))
    y = _col(lat) * F.lit(degree_km)
    c = F.col
    yield {
        "_fq": (x * F.lit(math.sqrt(3.0) / 3.0) - y / F.lit(3.0)) / F.lit(edge_km),
        "_fr": (y * F.lit(2.0 / 3.0)) / F.lit(edge_km),
    }
    yield {
        "_nq": F.floor(c("_fq") + 0.5),
        "_nr": F.floor(c("_fr") + 0.5),
        "_ns": F.floor(-c("_fq") - c("_fr") + 0.5),
    }
    yield {
        "_eq": F.abs(c("_nq") - c("_fq")),
        "_er": F.abs(c("_nr") - c("_fr")),
        "_es": F.abs(c("_ns") - (-c("_fq") - c("_fr"))),
    }
    # The coordinate with the largest rounding error follows from the others.
    fix_q = (c("_eq") > c("_er")) & (c("_eq") > c("_es"))
    fix_r = ~fix_q & (c("_er") > c("_es"))
    yield {
        "_q": F.when(fix_q, -c("_nr") - c("_ns")).otherwise(c("_nq")).cast("bigint"),
        "_r": F.when(fix_r, -c("_nq") - c("_ns")).otherwise(c("_nr")).cast("bigint"),
    }


def cell_text(q, r) -> Column:
    """Cell id ``q:r``; null without coordinates."""
    q, r = _col(q), _col(r)
    return F.when(q.isNotNull() & r.isNotNull(), F.concat_ws(":", q, r))


def cell_axial(cell):
    """The two axial coordinates of a cell id."""
    return [F.split_part(_col(cell), F.lit(":"), F.lit(i)).cast("bigint") for i in (1, 2)]


def k_ring(cell, k=1, *, offsets=None) -> Column:
    """Cells within ``k`` steps of a cell, the cell included."""
    def ring(axial):
        return F.array(*[
            F.concat_ws(":", axial["q"] + dq, axial["r"] + dr)
            for dq, dr in (offsets or ring_offsets(k))
        ])

    q, r = cell_axial(cell)
    axial = F.struct(q.alias("q"), r.alias("r"))
    return F.when(_col(cell).isNotNull(), let(axial, ring))


def half_offsets(k: int):
    """One of each two opposite directions, without the origin: every unordered
    pair of distinct neighbouring cells comes up exactly once."""
    return [o for o in ring_offsets(k) if o > (0, 0)]


def explode_ring(df: DataFrame, cell, output, *, offsets) -> DataFrame:
    """One row per cell at the given offsets around a row's cell."""
    q, r = cell_axial(cell)
    around = F.array(*[
        F.struct(F.lit(dq).alias("q"), F.lit(dr).alias("r")) for dq, dr in offsets
    ])
    kept = [c for c in df.columns if c != output]
    return (
        df.withColumns({"_q": q, "_r": r})
        .select(*kept, "_q", "_r", F.explode(around).alias("_o"))
        .select(*kept, cell_text(F.col("_q") + F.col("_o.q"), F.col("_r") + F.col("_o.r")).alias(output))
    )
