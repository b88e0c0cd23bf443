"""Radius search, potential duplicates and hexagonal grouping."""

import math
from functools import reduce
from itertools import product
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from terralist import constants as K
from terralist.functions.geo import (
    cell_text, explode_ring, half_offsets, hex_steps, k_ring, ring_offsets,
)
from terralist.functions.numbers import haversine_km, nan_to_null
from terralist.operators.cover import PairCover
from terralist.operators.keys import dense_ids, number_rows
from terralist.operators.shaping import with_computed
from terralist.operators.skew import HOT_ROWS, group_key, match_counts, outer_join, split_hot
from terralist.session import cut_lineage, kept_partitions

# Bands are widened by this factor so that rounding never loses a pair.
WIDEN = 1.0 + 1e-7
# Cells along a side of the tiles that rows are dealt out by.
TILE = 4
# Profiles a task of the duplicate search holds; each is there under eight keys.
TASK_PROFILES = 50_000


# --- radius join ---------------------------------------------------------------


def _band(lat: Column, radius_km: float) -> Column:
    height = math.degrees(radius_km / K.EARTH_RADIUS_KM) * WIDEN
    return F.floor((lat + 90.0) / F.lit(height)).cast("bigint")


def _bins_in_band(band: Column, radius_km: float) -> Column:
    """How many longitude bins a latitude band has: each wide enough that two
    points within the radius are in the same or in neighbouring bins."""
    angle = radius_km / K.EARTH_RADIUS_KM
    height = math.degrees(angle) * WIDEN
    south = band * F.lit(height) - 90.0
    widest = F.greatest(F.abs(south), F.abs(south + height))
    ratio = F.lit(math.sin(angle)) / F.cos(F.radians(F.least(widest, F.lit(90.0))))
    width = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * WIDEN
    return F.when(
        (widest >= 90.0) | (ratio >= 1.0) | (width <= 0), F.lit(1)
    ).otherwise(F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))).cast("bigint")


def _bin(lon: Column, bins: Column) -> Column:
    turn = F.pmod(lon + 180.0, F.lit(360.0)) / 360.0
    return F.least(F.floor(turn * bins), bins - 1).cast("bigint")


def _cells_around(df: DataFrame, radius_km: float, made) -> DataFrame:
    """``df`` with ``_cells``: what ``made(band, bin, half, here)`` gives for the (band, bin)
    cells that hold all points near a row's ``lat`` and ``lon``, null for a cell that there is
    not.

    Of two cells that are near each other, one has the other as ``half``, and each has itself.
    No lambda is used on the cells: whatever such a function is given is not compiled.
    """
    bands = {d: F.col("_own") + d for d in (-1, 0, 1)}
    df = with_computed(df, {"_own": _band(F.col("lat"), radius_km)})
    df = with_computed(df, {f"_bins{d}": _bins_in_band(band, radius_km) for d, band in bands.items()})
    df = with_computed(df, {f"_mid{d}": _bin(F.col("lon"), F.col(f"_bins{d}")) for d in bands})
    # The two bins of a band of two are next to each other on both sides.
    along = {0: F.lit(True), 1: (F.col("_bins0") > 2) | (F.col("_mid0") == 0), -1: F.lit(False)}
    # A band of one or two bins has no more neighbours than that.
    cells = F.array(*[
        F.when(F.col(f"_bins{d}") > most, made(
            band, F.pmod(F.col(f"_mid{d}") + e, F.col(f"_bins{d}")), F.lit(d > 0) if d else along[e], F.lit((d, e) == (0, 0)),
        ))
        for d, band in bands.items() for e, most in ((0, 0), (1, 1), (-1, 2))
    ])
    return with_computed(df, {"_cells": cells}).drop("_own", *[f"_{n}{d}" for n in ("bins", "mid") for d in bands])


def _tile(band, number):
    """One number for a tile, as neither part reaches 32 bits."""
    return F.floor(band / TILE) * F.lit(1 << 32) + F.floor(number / TILE)


def _ratio_band(column, width):
    """Numbers whose ratio is within the width are in the same or in neighbouring bands;
    of those that are not above 0 only 0 is near anything, itself."""
    size = F.log(F.least(F.greatest(column, F.lit(1e-300)), F.lit(1e300)))
    return F.when(column <= 0, F.lit(-(1 << 40))).otherwise(F.floor(size / F.lit(width)).cast("bigint"))


def _meeting_keys(left, right, tolerances):
    """Both sides with keys under which rows meet if their numbers may match, each pair once.

    Both sides are the same rows.  ``tolerances`` are (least, most) by column, as parts of
    the number of one row of a pair; on the right the column is named ``n_``; a missing
    number matches all.  So rows meet by the numbers that neither lacks: a code says which
    numbers the left has and which the right, and a row is repeated for what the other side
    may have.  The left is the one with the smaller code, so rows that have all numbers,
    which are most, are repeated on the right and look for each other only.  The keys of a
    row are in ``_keys``; the names of their numbers are returned too.
    """
    sides = 1 << len(tolerances)
    widths = {c: max(-math.log(least), math.log(most)) * WIDEN for c, (least, most) in tolerances.items()}

    def keyed(side, prefix, code, around):
        own = reduce(add, [F.when(F.col(prefix + c).isNull(), 0).otherwise(1 << i) for i, c in enumerate(widths)])
        side = with_computed(side, {"_has": own})
        side = with_computed(side, {
            f"_b{i}": F.when(F.col(prefix + c).isNull(), F.lit(0 if w else 0.0)).otherwise(_ratio_band(F.col(prefix + c), w) if w else F.col(prefix + c))
            for i, (c, w) in enumerate(widths.items())
        })
        rows = []
        for other in range(sides):
            steps = [(-1, 0, 1) if around and w and other >> i & 1 else (0,) for i, w in enumerate(widths.values())]
            for step in product(*steps):
                numbers = [
                    (F.col(f"_b{i}") + d if w else F.col(f"_b{i}")) if other >> i & 1 else F.lit(0 if w else 0.0).cast("bigint" if w else "double")
                    for i, (d, w) in enumerate(zip(step, widths.values(), strict=True))
                ]
                # A number that is missing is 0 on both sides and has no neighbouring bands.
                moved = sum(1 << i for i, d in enumerate(step) if d)
                key = F.struct(code(F.col("_has"), other).alias("code"), *[n.alias(f"k{i}") for i, n in enumerate(numbers)])
                ordered = F.col("_has") <= other if around else F.col("_has") >= other
                rows.append(F.when(ordered & (F.col("_has").bitwiseAND(F.lit(moved)) == moved), key))
        # Made once a row, before the row is repeated.
        return with_computed(side, {"_keys": F.array(*rows)}).drop("_has", *[f"_b{i}" for i in range(len(widths))])

    return (
        keyed(left, "", lambda own, other: own * sides + other, True),
        keyed(right, "n_", lambda own, other: own + other * sides, False),
        [f"k{i}" for i in range(len(widths))],
    )


def radius_pairs(
    rows: DataFrame,
    *,
    radius_km,
    key,
    tolerances=None,
    prepared=None,
    where=None,
    pieces=None,
    hot_rows=HOT_ROWS,
):
    """Pairs of rows within ``radius_km``, inclusive: each pair once, in either order, and
    each row with itself.

    Rows carry ``lat``, ``lon`` and a unique ``key``; the columns of the second come under
    the prefix ``n_``.  Each row sits in one (latitude band, longitude bin); a point within
    the radius is in one of three bands and there in one of three bins.  So this is an
    equi-join on a grid key with an exact distance filter, in which a row looks at that half
    of the cells around it that do not look back.  ``tolerances`` are numbers that have to
    match in one direction at least, see ``_meeting_keys``.

    Rows are dealt out by tiles of ``TILE`` x ``TILE`` cells, so a row travels to the
    few tiles around it and is repeated for cells, and for the numbers in ``tolerances``,
    where it has arrived.  Tiles with many rows are split over
    shards.  ``prepared`` adds columns to each side on arrival, ``where`` is a cheap
    condition on both sides to test before the distance.  Write the result inside
    ``kept_partitions``, or Spark deals the repeated rows out again.
    """
    pieces = pieces or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    right = rows.withColumnsRenamed({c: f"n_{c}" for c in rows.columns})
    right = with_computed(right, {"_band": _band(F.col("n_lat"), radius_km)})
    right = with_computed(
        right, {"_bin": _bin(F.col("n_lon"), _bins_in_band(F.col("_band"), radius_km))}
    )
    right = right.withColumn("_tile", _tile(F.col("_band"), F.col("_bin")))
    # A row that has all numbers looks for its like only, which looks for it as well.
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in tolerances or {}], F.lit(True))
    left = _cells_around(rows, radius_km, lambda band, number, half, here: F.when(half | ~whole, _tile(band, number)))
    left = left.withColumn("_tile", F.explode(F.array_distinct("_cells"))).drop("_cells").filter(F.col("_tile").isNotNull())
    left, right = split_hot(left, right, ["_tile"], spread_by=f"n_{key}", hot_rows=TILE * hot_rows)
    left, right = (side.repartition(pieces, "_tile", "_shard") for side in (left, right))
    if prepared:
        left, right = prepared(left, right)
    keys = ["_tile", "_shard", "_spot"]
    if tolerances:
        left, right, more = _meeting_keys(left, right, tolerances)
        keys += more

    def spot(band, number):
        return F.pmod(band, F.lit(TILE)) * TILE + F.pmod(number, F.lit(TILE))

    left = _cells_around(left, radius_km, lambda band, number, half, here: F.when(
        (half | ~whole) & (_tile(band, number) == F.col("_tile")), F.struct(spot(band, number).alias("spot"), half.alias("half"), here.alias("here"))))
    left = left.withColumn("_cell", F.explode("_cells")).drop("_cells").filter(F.col("_cell").isNotNull())
    left = left.withColumns({"_spot": F.col("_cell.spot"), "_half": F.col("_cell.half"), "_here": F.col("_cell.here")}).drop("_cell")
    right = right.withColumn("_spot", spot(F.col("_band"), F.col("_bin"))).drop("_band", "_bin")
    if tolerances:
        left, right = (
            side.withColumn("_key", F.explode("_keys")).drop("_keys").filter(F.col("_key").isNotNull()).withColumns({
                "_code": F.col("_key.code"), "_spot": F.col("_spot") * (1 << 2 * len(tolerances)) + F.col("_key.code"), **{k: F.col(f"_key.{k}") for k in more}
            }).drop("_key")
            for side in (left, right)
        )
        # Both have the same numbers.
        like = F.col("_code") % ((1 << len(tolerances)) + 1) == 0
        left, right = left.filter(F.col("_half") | ~like).withColumn("_here", F.col("_here") & like).drop("_code"), right.drop("_code")
    once = ~F.col("_here") | (F.col(key) <= F.col(f"n_{key}"))
    near = haversine_km("lat", "lon", "n_lat", "n_lon") <= F.lit(float(radius_km))
    return (
        left.drop("_half").join(right.hint("shuffle_hash"), keys)
        .filter(once & (near if where is None else where & near))
        .drop("_here", *keys)
    )


# --- potential duplicates --------------------------------------------------------

MATCH_COLUMNS = ["lat", "lon", "asking_price", "m2_built", "no_bedrooms", "no_full_bathrooms"]


def _reach(df, *, low, high, tolerances, prefix=""):
    """Two columns a number: the values that match it, from least to greatest.

    A missing number matches everything.  Nothing here is null, so a pair is tested
    in few instructions.
    """
    infinity = F.lit(float("inf"))
    return df.withColumns({
        name: F.coalesce(value, end)
        for column, (least, most) in tolerances.items()
        for name, value, end in (
            (f"{low}_{column}", F.col(prefix + column) * F.lit(least), -infinity),
            (f"{high}_{column}", F.col(prefix + column) * F.lit(most), infinity),
        )
    })


def _tolerances(price_tolerance, area_tolerance):
    return {"asking_price": price_tolerance, "m2_built": area_tolerance, "no_bedrooms": (1.0, 1.0), "no_full_bathrooms": (1.0, 1.0)}


def duplicate_rule(columns, *, back=False) -> Column:
    """Attribute test of a center against a neighbour: what the center reaches meets
    what the neighbour is (both from ``_reach``); ``back`` tests the neighbour as center.

    Not symmetric: tolerances are relative to the center.  That two listings of the
    same development are not duplicates of each other is for ``other_development``.
    """
    c = F.col
    own, other = ("n_", "") if back else ("", "n_")
    rule = c(f"{own}active")
    for name in columns:
        rule = rule & (c(f"{other}high_{name}") >= c(f"{own}min_{name}")) & (c(f"{other}low_{name}") <= c(f"{own}max_{name}"))
    return rule


def other_development() -> Column:
    return F.coalesce(F.col("id_dev") != F.col("n_id_dev"), F.lit(True))


def with_duplicate_profile(df: DataFrame, *, id_col="id") -> DataFrame:
    """(id, active, profile, attributes): the inputs of the duplicate search.

    Rows with equal coordinates and attributes share one ``profile``; rows
    without finite coordinates have none.
    """
    types = dict(df.dtypes)

    def number(name):
        if name not in types:
            return F.lit(None).cast("double").alias(name)
        return nan_to_null(F.col(name).try_cast("double")).alias(name)

    active = F.coalesce("is_active", F.lit(True)) if "is_active" in types else F.lit(True)
    dev = F.col("id_dev").cast("string") if "id_dev" in types else F.lit(None).cast("string")
    out = df.select(
        F.col(id_col), active.alias("active"), *[number(n) for n in MATCH_COLUMNS],
        dev.alias("id_dev"),
    )
    infinity = F.lit(float("inf"))
    located = (F.abs("lat") < infinity) & (F.abs("lon") < infinity)
    return out.withColumn(
        "profile", F.when(located, group_key(*MATCH_COLUMNS, "id_dev"))
    )


def number_profiles(rows: DataFrame, *, id_col="id") -> DataFrame:
    """One row a profile: its number, the least id, how many rows, and what is compared.

    ``rows`` comes from ``with_duplicate_profile``.  Copies collapse into one weighted
    profile, so a pile of equal listings costs one row in a join and its size only shows
    in ``n_rows``.  The number, fixed by writing the table, names a profile in joins.
    """
    return cut_lineage(
        rows.filter(F.col("profile").isNotNull())
        .groupBy("profile", *MATCH_COLUMNS, "id_dev")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("active").alias("active"), F.min(id_col).alias("group_id"))
        .withColumn("number", F.monotonically_increasing_id())
    )


def duplicate_profiles(
    profiles: DataFrame,
    *,
    radius_km=K.DUPLICATE_RADIUS_KM,
    price_tolerance=K.PRICE_TOLERANCE,
    area_tolerance=K.AREA_TOLERANCE,
    hot_rows=HOT_ROWS,
) -> DataFrame:
    """(center, neighbour, n_rows, group_id, other_id): numbers of profiles that match
    each other, with their names; ``profiles`` comes from ``number_profiles``."""
    tolerances = _tolerances(price_tolerance, area_tolerance)
    # Rooms and area are part of the join key, of which the rooms are exact.
    keyed = {c: t for c, t in tolerances.items() if c != "asking_price" and 0 < t[0] <= t[1]}
    tested = {c: t for c, t in tolerances.items() if c not in keyed or t != (1.0, 1.0)}
    rows = profiles.select("number", "n_rows", "group_id", "active", "lat", "lon", "id_dev", *tolerances)

    def prepared(left, right):
        # Each is a center to the other, so both have what they are and what they reach.
        exact = {c: (1.0, 1.0) for c in tested}
        sides = []
        for side, prefix in ((left, ""), (right, "n_")):
            for low, high, widths in (("min", "max", tested), ("low", "high", exact)):
                side = _reach(side, low=prefix + low, high=prefix + high, tolerances=widths, prefix=prefix)
            sides.append(side)
        return sides

    forth, back = duplicate_rule(tested), duplicate_rule(tested, back=True)
    pieces = max(int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), profiles.count() // TASK_PROFILES + 1)
    matched = radius_pairs(
        rows, radius_km=radius_km, key="number", tolerances=keyed, prepared=prepared,
        where=(forth | back) & other_development(), pieces=pieces, hot_rows=hot_rows,
    )
    same = F.col("number") == F.col("n_number")

    def link(own, other):
        return F.struct(*[F.col(f"{side}{c}").alias(name) for side, c, name in (
            (own, "number", "center"), (other, "number", "neighbour"), (other, "n_rows", "n_rows"), (own, "group_id", "group_id"), (other, "group_id", "other_id"))])

    # A lone row does not match itself.
    links = F.array(F.when(forth & ~(same & (F.col("n_rows") == 1)), link("", "n_")), F.when(back & ~same, link("n_", "")))
    return matched.select(F.explode(links).alias("_link")).filter(F.col("_link").isNotNull()).select("_link.*")


def count_potential_duplicates(df: DataFrame, *, id_col="id", **options) -> DataFrame:
    """(id, n_duplicates) for every row, without writing out a single pair."""
    rows = cut_lineage(with_duplicate_profile(df, id_col=id_col))
    profiles = number_profiles(rows, id_col=id_col)
    with kept_partitions(df.sparkSession):
        counts = cut_lineage(match_counts(duplicate_profiles(profiles, **options)).withColumnsRenamed({"center": "number", "n_matches": "_n"}))
    # Only profiles that match something are looked up.
    counts = profiles.select("number", "profile").join(counts, "number").select("profile", "_n")
    return outer_join(rows.select(id_col, "profile", "active"), counts, ["profile"]).select(
        id_col,
        F.when(F.col("active"), F.coalesce("_n", F.lit(0))).otherwise(F.lit(0))
        .cast("bigint").alias("n_duplicates"),
    )


def find_potential_duplicates(df: DataFrame, *, id_col="id", hot_rows=HOT_ROWS, **options) -> PairCover:
    """Possible duplicates of every row as a cover of the pairs.

    Inactive rows and rows without coordinates have none of their own.
    """
    rows = cut_lineage(with_duplicate_profile(df, id_col=id_col).select(id_col, "active", *MATCH_COLUMNS, "id_dev", "profile"))
    profiles = number_profiles(rows, id_col=id_col)
    names = profiles.select("profile", "group_id")
    members = outer_join(rows.select(id_col, "active", "profile"), names, ["profile"], hot_rows=hot_rows).select(
        id_col, "group_id", F.col("active").alias("asks")
    )
    links = duplicate_profiles(profiles, hot_rows=hot_rows, **options).select("group_id", "other_id", F.col("n_rows").cast("bigint").alias("n_rows"))
    members = cut_lineage(members)
    with kept_partitions(df.sparkSession):
        return PairCover(members, cut_lineage(links), id_col)


# --- cells ---------------------------------------------------------------------


def with_cell(
    df: DataFrame, *, lat="lat", lon="lon", output="cell", edge_km=0.2, lat0=19.4
) -> DataFrame:
    """Hexagonal cell of each point, null without a point."""
    columns = [c for c in df.columns if c != output]
    for step in hex_steps(lat, lon, edge_km=edge_km, lat0=lat0):
        df = df.withColumns(step)
    return with_computed(df, {output: cell_text("_q", "_r")}).select(*columns, output)


def with_ring(df: DataFrame, *, cell="cell", k=1, output="ring") -> DataFrame:
    return df.withColumn(output, k_ring(cell, k))


def occupied_cells(df: DataFrame, *, cell="cell", order_by="id", start_at=1) -> DataFrame:
    """(cell, block_id): occupied cells numbered by their first row.

    Cells are pre-aggregated, so everything built on this grows with the area
    covered and not with the number of rows.
    """
    return dense_ids(df, cell, F.col(order_by), output="block_id", start_at=start_at)


def attach(df: DataFrame, mapping: DataFrame, *, cell="cell") -> DataFrame:
    """Left join of a cell mapping; a null cell gets null."""
    return outer_join(df, mapping, [cell])


def neighbourhoods(cells: DataFrame, *, cell="cell", k=1, start_at=1) -> DataFrame:
    """(cell, neighbourhood_id): greedy cover in order of ``block_id``.

    Going through the cells in order, each claims every unclaimed occupied
    cell in its ring.  A cell therefore belongs to the lowest-numbered occupied
    cell in its own ring, which needs no loop.
    """
    claims = explode_ring(
        cells.select(cell, F.col("block_id").alias("_owner")), cell, cell, offsets=ring_offsets(k)
    )
    owners = (
        claims.join(cells.select(cell), cell, "left_semi")
        .groupBy(cell).agg(F.min("_owner").alias("_owner"))
    )
    ids = number_rows(
        owners.select("_owner").distinct(), "_owner",
        output="neighbourhood_id", start_at=start_at,
    )
    return owners.join(ids, "_owner").select(cell, "neighbourhood_id")


def cell_edges(cells: DataFrame, *, cell="cell", k=1) -> DataFrame:
    """(src, dst) by ``block_id``: each neighbouring pair of cells once."""
    reach = explode_ring(
        cells.select(cell, F.col("block_id").alias("src")), cell, cell, offsets=half_offsets(k)
    )
    return reach.join(
        cells.select(cell, F.col("block_id").alias("dst")), cell
    ).select("src", "dst")


def connected_labels(vertices: DataFrame, edges: DataFrame, *, max_rounds=64) -> DataFrame:
    """(vertex, root): one root per connected component.

    Randomised contraction: each round every vertex merges into the neighbour
    (or itself) that comes first in a fresh pseudo-random order, and the graph
    shrinks to the chosen vertices.  The expected number of rounds is
    logarithmic whatever the shape of the graph, and every round is an
    aggregate with map-side combine and two joins on unique keys.  The maps of
    the rounds are composed backwards, from the smallest to the largest.
    """
    rounds = []
    edges, left = cut_lineage(edges.filter("src <> dst").select("src", "dst"), count=True)
    for number in range(max_rounds):
        if not left:
            break
        both = edges.union(edges.select("dst", "src"))
        order = F.xxhash64(F.col("dst"), F.lit(number))
        own = F.xxhash64(F.col("src"), F.lit(number))
        merged = cut_lineage(
            both.groupBy("src").agg(F.min(F.struct(order.alias("o"), "dst")).alias("m"))
            .select(
                F.col("src").alias("vertex"),
                F.when(F.struct(own, "src") < F.col("m"), F.col("src"))
                .otherwise(F.col("m.dst")).alias("root"),
            )
        )
        rounds.append(merged)
        edges, left = cut_lineage(
            edges.join(merged.select(F.col("vertex").alias("src"), F.col("root").alias("_s")), "src")
            .join(merged.select(F.col("vertex").alias("dst"), F.col("root").alias("_d")), "dst")
            .filter("_s <> _d")
            .select(F.least("_s", "_d").alias("src"), F.greatest("_s", "_d").alias("dst"))
            .distinct(),
            count=True,
        )
    else:
        raise RuntimeError("components did not settle")
    labels = None
    for merged in reversed(rounds):
        if labels is not None:
            final = labels.select(F.col("vertex").alias("root"), F.col("root").alias("_final"))
            merged = merged.join(final, "root", "left").select(
                "vertex", F.coalesce("_final", "root").alias("root")
            )
        labels = merged
    alone = vertices.select(F.col("vertex"), F.col("vertex").alias("root"))
    if labels is None:
        return alone
    return labels.union(alone.join(labels, "vertex", "left_anti"))


def components(cells: DataFrame, *, cell="cell", k=1, start_at=1) -> DataFrame:
    """(cell, component_id): groups of cells linked by rings, by first row."""
    labels = connected_labels(
        cells.select(F.col("block_id").alias("vertex")), cell_edges(cells, cell=cell, k=k)
    )
    first = labels.groupBy("root").agg(F.min("vertex").alias("_first"))
    ids = number_rows(first, "_first", output="component_id", start_at=start_at)
    return (
        cells.select(cell, F.col("block_id").alias("vertex"))
        .join(labels, "vertex").join(ids, "root").select(cell, "component_id")
    )
