import math

from hypothesis import given, settings, strategies as st
import pytest

from terralist.functions import geo, numbers as N
from terralist.operators.spatial import with_cell


def one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_prices(spark):
    rows = [(100.0, "USD"), (100.0, "MXP"), (None, "USD"), (5.0, None)]
    got = one(spark, rows, "asking_price double, currency string", N.normalize_price())
    assert got == [pytest.approx(1798.13), 100.0, None, 5.0]


def test_areas(spark):
    rows = [(100.0, 50.0), (100.0, None), (None, 70.0), (None, None), (60.0, 80.0)]
    df = spark.createDataFrame(rows, "m2_built double, m2_terrain double")
    assert [tuple(r) for r in N.with_repaired_areas(df).collect()] == [
        (100.0, 100.0), (100.0, 100.0), (70.0, 70.0), (None, None), (60.0, 80.0)]
    assert [r[0] for r in df.select(N.area_flag()).collect()] == [1.0, 1.0, 1.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        N.with_repaired_areas(df.drop("m2_built"))
    rows = [(100.0, 50.0, "CASA"), (100.0, None, "CASA"), (100.0, None, "DEPARTAMENTO"), (None, 5.0, "CASA")]
    assert one(spark, rows, "m2_built double, m2_terrain double, property_type string", N.repair_terrain()) == [
        100.0, None, 100.0, 5.0]


def ratio(a, b):
    if a is None or b is None:
        return 0.0
    return 1.0 - min(max(abs(a - b) / max(abs(a), abs(b), 1.0), 0.0), 1.0)


def test_similarities(spark):
    rows = [(1.0, 1.0), (0.0, 0.0), (None, None), (None, 5.0), (5.0, None), (100.0, 50.0), (-3.0, 3.0), (0.2, 0.7)]
    assert one(spark, rows, "a double, b double", N.sim_ratio("a", "b")) == [pytest.approx(ratio(*r)) for r in rows]
    assert one(spark, rows, "a double, b double", N.sim_equal("a", "b")) == [1, 1, 0, 0, 0, 0, 0, 0]
    df = spark.createDataFrame(rows, "a double, b double")
    with pytest.raises(ValueError):
        df.select(N.weighted_score([(0.0, "a"), (0.0, "b")]))


def test_changed_and_rounding(spark):
    rows = [(None, None), (None, 1.0), (1.0, None), (1.0, 1.0), (1.0, 2.0), (float("nan"), float("nan"))]
    assert one(spark, rows, "a double, b double", N.changed("a", "b")) == [False, True, True, False, True, False]
    assert one(spark, [(float("nan"),), (1.00000049,), (None,)], "a double", N.comparable_number("a")) == [None, 1.0, None]


def test_distance(spark):
    rows = [(19.4, -99.1, 19.4, -99.1), (0.0, 0.0, 0.0, 180.0), (19.0, -99.0, 20.0, -99.0)]
    got = one(spark, rows, "a double, b double, c double, d double", N.haversine_km("a", "b", "c", "d"))
    assert got == [0.0, pytest.approx(math.pi * 6371.0), pytest.approx(math.pi * 6371.0 / 180)]


def test_names_and_dates(spark):
    rows = [("data/2024-01-08/",), ("2024-01-08",), ("/a/b",), ("x",), ("",)]
    assert one(spark, rows, "w string", N.wave_name("w")) == ["2024-01-08", "2024-01-08", "b", "x", ""]
    assert [str(d) for d in one(spark, [("2024-01-08",), ("08/01/2024",), (None,)], "w string", N.lenient_date("w"))] == [
        "2024-01-08", "None", "None"]
    df = spark.sql("SELECT TIMESTAMP '2024-01-08 03:00:00' AS t")
    assert df.select(N.run_label("t")).first()[0] == "2024-01-07"


def test_rings():
    for k in range(4):
        offsets = geo.ring_offsets(k)
        assert len(offsets) == 3 * k * (k + 1) + 1
        assert {(-q, -r) for q, r in offsets} == set(offsets)


def test_ring_columns(spark):
    df = spark.createDataFrame([("3:-2",), (None,)], "cell string")
    ring, missing = [r[0] for r in df.select(geo.k_ring("cell")).collect()]
    assert len(set(ring)) == 7 and "3:-2" in ring and missing is None
    exploded = geo.explode_ring(df.dropna(), "cell", "near", offsets=geo.ring_offsets(1))
    assert sorted(r.near for r in exploded.collect()) == sorted(ring)
    half = geo.half_offsets(1)
    assert len(half) == 3 and not {(-q, -r) for q, r in half} & set(half)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(19.0, 19.8), st.floats(-99.6, -98.9)), min_size=1, max_size=50))
def test_cell_is_the_nearest_center(spark, points):
    """The chosen hexagon's center is nearer than the center of any neighbour."""
    edge, km = 0.2, math.pi * 6371.0 / 180.0
    df = spark.createDataFrame(points, "lat double, lon double")
    for (lat, lon), row in zip(points, with_cell(df).collect()):
        q, r = map(int, row.cell.split(":"))
        x, y = lon * km * math.cos(math.radians(19.4)), lat * km

        def gap(q, r):
            return math.hypot(x - edge * math.sqrt(3) * (q + r / 2), y - edge * 1.5 * r)

        assert all(gap(q, r) <= gap(q + a, r + b) + 1e-6 for a, b in geo.ring_offsets(1))
