import math
import random

import pytest
from pyspark.sql import functions as F

from terralist import constants as K
from terralist.operators import filters as R, keys as O, pairs as P, profile as A, shaping as S, skew, spatial as G, vectors as V, waves as W


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- keys -------------------------------------------------------------------------


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 2, "z"), (None, 1, "n"), (2, None, "q")], "k int, v int, t string")
    assert rows(O.one_per_key(df, "k", order_by="v")) == [(1, 2, "z"), (2, None, "q"), (None, 1, "n")]
    assert rows(O.one_per_key(df, "k", order_by="v", last=True)) == [(1, 5, "b"), (2, None, "q"), (None, 1, "n")]
    assert df.count() - O.any_per_key(df, "k").count() == 2


def test_latest_at(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-05", 2), ("a", "2024-02-01", 3), ("b", None, 4)], "k string, d string, v int")
    df = df.withColumn("d", F.col("d").cast("date"))
    assert rows(O.latest_at(df, "k", "d", "2024-01-08")) == [("a", 2)]
    assert rows(O.latest_at(df, "k", "d", None)) == []


def test_number_rows(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = O.number_rows(df, "v", start_at=10)
    assert rows(got) == sorted([(v, v + 10) for v in values], key=repr)
    assert O.number_rows(df.filter("v < 0"), "v").count() == 0
    old = spark.createDataFrame([(7,)], "id int")
    assert {r.id for r in O.continue_ids(df.limit(3), old, "v").collect()} == {8, 9, 10}


def test_unions_and_sets(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2.5, None)], "i double, n string")
    got = O.union_relaxed(a, b)
    assert dict(got.dtypes) == {"i": "double", "s": "string", "n": "string"} and got.count() == 2
    assert O.empty_like(spark, "a int").count() == 0
    x, y = (spark.createDataFrame([(v,) for v in vs], "k int") for vs in ([1, 2, 2], [2, 3]))
    assert rows(O.key_union(x, y)) == [(1,), (2,), (3,)]
    assert rows(O.key_intersection(x, y)) == [(2,)] and rows(O.key_difference(x, y)) == [(1,)]


def test_repeats_and_top(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7), (2, 0.7), (None, 1.0)], "k int, s double")
    assert rows(O.repeated(df, "k")) == [(1, 0.5), (1, 0.7)]
    assert rows(O.with_group_size(df, "k")) == [(1, 0.5, 2), (1, 0.7, 2), (2, 0.7, 1), (None, 1.0, 1)]
    assert [tuple(r) for r in O.top_k(df.filter("k is not null"), "s", 2, tie="k").collect()] == [(1, 0.7, 1), (2, 0.7, 2)]
    assert [r.k for r in O.ordered(df, ("s", "desc"), ("k", "asc")).collect()] == [None, 1, 2, 1]
    assert O.random_key(df, "k", seed=3).collect() == O.random_key(df, "k", seed=3).collect()


# --- shaping and filters -----------------------------------------------------------


def test_align(spark):
    df = spark.createDataFrame([("1", "x", 2)], "a string, drop string, c int")
    got = S.align(df, ["c", "b", "a"], {"a": "double", "b": "bigint"})
    assert got.dtypes == [("c", "int"), ("b", "bigint"), ("a", "double")] and rows(got) == [(2, None, 1.0)]
    assert S.align(spark.createDataFrame([("x",)], "a string"), ["a"], {"a": "double"}).first()[0] is None
    assert S.rename_present(df, {"a": "z", "none": "y"}).columns == ["z", "drop", "c"]
    assert S.suffixed(df, "__old", keep=["a"]).columns == ["a", "drop__old", "c__old"]
    assert S.keep_known(df, ["c", "q", "a"]).columns == ["c", "a"]
    nested = spark.sql("SELECT array(1,2) a, 'x' s, map('k', 1) m")
    assert tuple(S.nested_to_json(nested).first()) == ("[1,2]", "x", '{"k":1}')


def test_filters(spark):
    df = spark.createDataFrame(
        [(500_000.0, "MXN"), (499_999.0, "MXN"), (25_000.0, "USD"), (24_999.0, "USD"), (1e9, "EUR"), (None, "MXN"), (1e6, None)],
        "asking_price double, currency string")
    assert rows(R.price_floor_filter(df)) == [(25_000.0, "USD"), (500_000.0, "MXN")]
    pub = spark.createDataFrame([("a",), (None,), (K.EXCLUDED_PUBLISHERS[0],)], "publisher_name string")
    assert rows(R.publisher_filter(pub)) == [("a",)]
    assert R.publisher_filter(df).count() == 7 and R.operation_filter(df, "SALE").count() == 7
    op = spark.createDataFrame([("Sale",), ("sale",), ("venta",), (None,)], "operation_type string")
    assert R.operation_filter(op, "SALE").count() == 2 and R.sales_only(op).count() == 1
    assert R.operation_filter(op, None).count() == 4


# --- radius search -------------------------------------------------------------------


def brute_duplicates(data):
    """Straight restatement on one small list."""
    out = {}
    for c in data:
        found = set()
        for n in data:
            if c is n or c["active"] is False or None in (c["lat"], c["lon"], n["lat"], n["lon"]):
                continue
            p1, p2 = math.radians(c["lat"]), math.radians(n["lat"])
            h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(n["lon"] - c["lon"]) / 2) ** 2
            if 2 * 6371 * math.asin(min(1, math.sqrt(h))) > 0.2:
                continue

            def within(k, lo, hi):
                a, b = c[k], n[k]
                return a is None or b is None or a * lo <= b <= a * hi

            def same(k):
                return c[k] is None or n[k] is None or c[k] == n[k]

            if (within("price", 0.85, 1.15) and within("m2", 0.95, 1.05) and same("beds") and same("baths")
                    and (c["dev"] is None or n["dev"] is None or c["dev"] != n["dev"])):
                found.add(n["id"])
        out[c["id"]] = sorted(found)
    return out


def listing_frame(spark, data):
    return spark.createDataFrame(
        [(d["id"], d["lat"], d["lon"], d["price"], d["m2"], d["beds"], d["baths"], d["dev"], d["active"]) for d in data],
        "id long, lat double, lon double, asking_price double, m2_built double, no_bedrooms double, no_full_bathrooms double, id_dev string, is_active boolean")


def random_listings(seed, n=260):
    r = random.Random(seed)
    spots = [(19.4, -99.1), (0.0, 179.9995), (0.0, -179.9995), (-33.0, 0.0), (70.0, 25.0), (85.0, -10.0), (89.9995, 5.0)]

    def maybe(v, p=0.1):
        return None if r.random() < p else v

    data = []
    for i in range(n):
        lat, lon = r.choice(spots)
        lon = lon + r.uniform(-1, 1) * 0.003 / max(math.cos(math.radians(lat)), 1e-3)
        lon = (lon + 180) % 360 - 180
        data.append(dict(
            id=i, lat=maybe(min(lat + r.uniform(-0.002, 0.002), 90.0), 0.03), lon=maybe(lon, 0.03), price=maybe(r.choice([100.0, 85.0, 115.0, 90.0, 200.0])),
            m2=maybe(r.choice([100.0, 95.0, 105.0, 104.9])), beds=maybe(float(r.randint(1, 2))), baths=maybe(1.0),
            dev=maybe(r.choice(["d1", "d2"]), 0.7), active=maybe(r.random() > 0.1)))
    # A third of all rows are copies at one point.
    data += [dict(data[0], id=n + i, lat=19.4, lon=-99.1, active=None) for i in range(n // 2)]
    return data


def listed(cover, ids):
    got = {r[0]: [] for r in ids.collect()}
    for one, other in map(tuple, cover.pairs_of(ids).collect()):
        got[one].append(other)
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("hot_rows", [20_000, 3])
def test_duplicates_equal_brute_force(spark, hot_rows):
    data = random_listings(5)
    expected = brute_duplicates(data)
    df = listing_frame(spark, data)
    counts = dict(rows(G.count_potential_duplicates(df, hot_rows=hot_rows)))
    assert counts == {k: len(v) for k, v in expected.items()}
    cover = G.find_potential_duplicates(df, hot_rows=hot_rows)
    assert {r.id: r.n for r in cover.counts("n").collect()} == counts
    assert cover.total().first()[0] == sum(counts.values())
    assert listed(cover, df) == expected
    some = df.filter("id % 7 = 3")
    assert listed(cover, some) == {k: expected[k] for k in expected if k % 7 == 3}


def test_cover_grows_with_groups_not_rows(spark):
    base = dict(lat=19.4, lon=-99.1, m2=None, beds=None, baths=None, dev=None, active=True)
    data = [dict(base, id=i, price=100.0 + i % 3) for i in range(900)]
    cover = G.find_potential_duplicates(listing_frame(spark, data), hot_rows=100)
    assert cover.links.count() == 9 and cover.members.count() == 900
    assert sorted({r.group_id for r in cover.members.collect()}) == [0, 1, 2]
    assert {r.n for r in cover.counts("n").collect()} == {899}
    assert cover.pairs_of(spark.createDataFrame([(5,), (5,), (-1,)], "id long")).count() == 899
    none = G.find_potential_duplicates(listing_frame(spark, data).limit(0))
    assert none.members.count() == none.links.count() == none.total().first()[0] == 0


@pytest.mark.parametrize("hot_rows,part_rows", [(20_000, 10_000), (3, 7), (3, 1)])
def test_lists_of_a_cover(spark, hot_rows, part_rows):
    """Every row has all its partners, in order and in parts; rows without any have one empty part."""
    data = random_listings(5)
    expected = brute_duplicates(data)
    df = listing_frame(spark, data)
    found = G.find_potential_duplicates(df, hot_rows=hot_rows).lists("found", "n", part_rows=part_rows).collect()
    got = {k: [] for k in expected}
    for r in sorted(found, key=lambda r: (r.id, r.part)):
        assert r.n == len(expected[r.id]) and len(r.found) <= part_rows and (r.found or (r.n == 0 and r.part == 0))
        got[r.id] += r.found
    assert got == expected and len({(r.id, r.part) for r in found}) == len(found)
    # A null id is counted, but has no name that could be listed.
    base = dict(lat=19.4, lon=-99.1, m2=None, beds=None, baths=None, dev=None, active=True, price=1.0)
    odd = listing_frame(spark, [dict(base, id=1), dict(base, id=None), dict(base, id=3, lat=None)])
    lists = G.find_potential_duplicates(odd).lists("found", "n", part_rows=part_rows)
    assert rows(lists.select("id", "n", "part", "found")) == [(1, 1, 0, []), (3, 0, 0, []), (None, 1, 0, [1])]


def test_potential_duplicates_are_listed(spark, monkeypatch):
    """The query returns who the possible duplicates are, not only how many."""
    from terralist.queries import spatial as Q

    data = random_listings(5)
    monkeypatch.setattr(Q, "points", lambda spark, folder: listing_frame(spark, data))
    got = {r.id: (r.n_duplicates, r.potential_duplicates) for r in Q.potential_duplicates(spark, "").collect()}
    assert got == {k: (len(v), str(v).replace(" ", "")) for k, v in brute_duplicates(data).items()}


def test_duplicate_boundaries(spark):
    base = dict(lat=19.4, lon=-99.1, m2=None, beds=None, baths=None, dev=None, active=True)
    data = [dict(base, id=1, price=100.0), dict(base, id=2, price=115.0), dict(base, id=3, price=85.0),
            dict(base, id=4, price=100.0, dev="a"), dict(base, id=5, price=100.0, dev="a"), dict(base, id=6, price=100.0, active=False)]
    df = listing_frame(spark, data)
    got = listed(G.find_potential_duplicates(df), df)
    # 115 is within 15 % of 100, but 100 is not within 15 % of 85 seen from 85.
    assert got == brute_duplicates(data)
    assert got[6] == [] and 6 in got[1] and 5 not in got[4]


@pytest.mark.parametrize("numbers", [None, ["m2_built", "no_bedrooms"]])
def test_radius_search_forms_each_pair_once(spark, numbers):
    """Poles, the antimeridian and missing numbers included; a row meets itself once."""
    data = [dict(d, id=i) for i, d in enumerate(random_listings(9, 200)) if d["lat"] is not None and d["lon"] is not None]
    by_id = {d["id"]: d for d in data}
    df = listing_frame(spark, data).select("id", "lat", "lon", "m2_built", "no_bedrooms")
    tolerances = {c: t for c, t in (("m2_built", (0.95, 1.05)), ("no_bedrooms", (1.0, 1.0))) if numbers}
    found = G.radius_pairs(df, radius_km=0.2, key="id", tolerances=tolerances, hot_rows=3).select("id", "n_id").collect()
    pairs = [tuple(sorted(p)) for p in found]

    def near(a, b):
        p1, p2 = math.radians(a["lat"]), math.radians(b["lat"])
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b["lon"] - a["lon"]) / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h))) <= 0.2

    def match(a, b):
        return not numbers or all(a[k] is None or b[k] is None or a[k] * lo <= b[k] <= a[k] * hi for k, lo, hi in (("m2", 0.95, 1.05), ("beds", 1.0, 1.0)))

    expected = {(a, b) for a in by_id for b in by_id if a <= b and near(by_id[a], by_id[b]) and (match(by_id[a], by_id[b]) or match(by_id[b], by_id[a]))}
    assert len(set(pairs)) == len(pairs) and expected <= set(pairs)
    assert numbers or set(pairs) == expected


def test_radius_join_has_no_cross_join(spark):
    df = listing_frame(spark, random_listings(2, 40))
    plan = G.count_potential_duplicates(df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


# --- grouping --------------------------------------------------------------------------


def axial_frame(spark, cells):
    return spark.createDataFrame([(i, None if c is None else f"{c[0]}:{c[1]}") for i, c in enumerate(cells)], "id long, cell string")


def sequential_groups(cells):
    """Block, neighbourhood and component by going through the cells in order."""
    ring = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]
    order = list(dict.fromkeys(c for c in cells if c is not None))
    block = {c: i + 1 for i, c in enumerate(order)}
    near, owner = 0, {}
    for c in order:
        claimed = [n for n in ((c[0] + a, c[1] + b) for a, b in ring) if n in block and n not in owner]
        if claimed:
            near += 1
            owner.update({n: near for n in claimed})
    comp, number = {}, 0
    for c in order:
        if c not in comp:
            number += 1
            stack = [c]
            while stack:
                x = stack.pop()
                if x not in comp:
                    comp[x] = number
                    stack += [n for n in ((x[0] + a, x[1] + b) for a, b in ring) if n in block and n not in comp]
    return block, owner, comp


@pytest.mark.parametrize("cells", [
    [(0, 0)], [(0, 0), (1, 0), None], [(i, 0) for i in range(40)], [(5, 5), (0, 0), (5, 6), (1, 0), (9, 9)],
    [(random.Random(3).randint(0, 9) * 1 + i % 3, (i * 7) % 11) for i in range(60)],
    [((i * 37) % 17, (i * 53) % 19) for i in range(120)],
])
def test_cell_groups_equal_sequential(spark, cells):
    df = axial_frame(spark, cells)
    occupied = G.occupied_cells(df)
    block, owner, comp = sequential_groups(cells)

    def by_cell(frame, column):
        return {tuple(map(int, r.cell.split(":"))): r[column] for r in frame.collect()}

    assert by_cell(occupied, "block_id") == block
    assert by_cell(G.neighbourhoods(occupied), "neighbourhood_id") == owner
    assert by_cell(G.components(occupied), "component_id") == comp
    assert G.attach(df, occupied).count() == len(cells)


# --- pairs ------------------------------------------------------------------------------


def pair_rows(spark, n=140, seed=4):
    r = random.Random(seed)

    def maybe(v):
        return None if r.random() < 0.08 else v

    data = []
    for i in range(n):
        data.append((i, f"{r.randint(0, 2)}:{r.randint(0, 2)}", r.choice("AB"), r.random() < 0.3, maybe(float(r.randint(1, 2))), maybe(1.0),
                     maybe(r.choice([80.0, 90.0, 100.0, 0.5, -3.0])), maybe(r.choice([100.0, 120.0])), maybe(r.choice([1e6, 1.1e6, 1.3e6, 0.0]))))
    data += [(n + i, "1:1", "A", False, 1.0, 1.0, 80.0, 100.0, 1e6) for i in range(n // 2)]
    return spark.createDataFrame(
        data, "id long, cell string, property_type string, is_development boolean, no_bedrooms double, no_full_bathrooms double,"
        "m2_built double, m2_terrain double, price_mxn double")


def near(a, b):
    (q1, r1), (q2, r2) = (map(int, c.split(":")) for c in (a, b))
    return max(abs(q1 - q2), abs(r1 - r2), abs(q1 + r1 - q2 - r2)) <= 1


def ratio(a, b):
    return 0.0 if a is None or b is None else 1.0 - min(abs(a - b) / max(abs(a), abs(b), 1.0), 1.0)


KEYS = ["property_type", "is_development", "no_bedrooms", "no_full_bathrooms"]


def test_comparables_equal_brute_force(spark):
    df = pair_rows(spark)
    data = df.collect()
    expected = {
        a.id: sorted(b.id for b in data if b.id != a.id and near(a.cell, b.cell) and all(a[k] is not None and a[k] == b[k] for k in KEYS))
        for a in data}
    assert dict(rows(P.count_comparables(df))) == {k: len(v) for k, v in expected.items()}
    cover = P.define_comparables(df)
    assert listed(cover, df) == expected
    one = next(k for k, v in expected.items() if v)
    assert {r.id for r in P.comparables_of(df, one).collect()} == {one, *expected[one]}
    pairs = [tuple(r) for r in P.comparable_pairs(cover, df).collect()]
    assert pairs == sorted((k, v) for k, found in expected.items() for v in found)
    assert P.comparables_of(df, seed=1).count() > 1


def test_comparables_are_listed(spark, monkeypatch):
    """The query returns which listings are comparable, not only how many; null without any."""
    from terralist.queries import spatial as Q

    df = pair_rows(spark)
    data = df.collect()
    expected = {
        a.id: sorted(b.id for b in data if b.id != a.id and near(a.cell, b.cell) and all(a[k] is not None and a[k] == b[k] for k in KEYS))
        for a in data}
    monkeypatch.setattr(Q, "with_cells", lambda spark, folder: df)
    got = {r.id: (r.n_comparables, r.part, r.comparable_ids) for r in Q.comparables(spark, "").collect()}
    assert any(expected.values()) and got == {k: (len(v), 0, str(v).replace(" ", "") if v else None) for k, v in expected.items()}


@pytest.mark.parametrize("min_score", [0.0, 0.6, 0.9, 0.97, 1.0])
@pytest.mark.parametrize("hot_rows", [20_000, 4])
def test_comparable_scores_equal_brute_force(spark, min_score, hot_rows):
    df = pair_rows(spark)
    data = df.collect()
    expected = {}
    for a in data:
        for b in data:
            if a.id < b.id and near(a.cell, b.cell) and all(a[k] is not None and a[k] == b[k] for k in KEYS):
                score = (2 * ratio(a.m2_built, b.m2_built) + ratio(a.m2_terrain, b.m2_terrain) + 2 * ratio(a.price_mxn, b.price_mxn)) / 5
                if score >= min_score:
                    expected[a.id, b.id] = round(score, 9)
    scores = P.score_comparables(df, min_score=min_score, hot_rows=hot_rows)
    members = P.group_members(df, [*KEYS, "cell", "m2_built", "m2_terrain", "price_mxn"])
    got = {(r.id_left, r.id_right): round(r.score, 9) for r in P.expand_pairs(scores, members).collect()}
    assert got == expected
    assert (scores.agg(F.sum("n_pairs")).first()[0] or 0) == len(expected)


@pytest.mark.parametrize("min_score", [0.0, 0.7, 0.9, 0.95])
def test_neighbourhood_and_component_scores_equal_brute_force(spark, min_score):
    df = pair_rows(spark).withColumns({
        "block_id": F.substring("cell", 1, 1).cast("long"), "neighbourhood_id": F.pmod(F.col("id"), F.lit(3)),
        "component_id": F.when(F.col("id") % 11 != 0, F.col("id") % 2)})
    data = df.collect()

    def equal(a, b, no=0.0):
        return 1.0 if a is not None and a == b else no

    near_pairs, wide_pairs = {}, {}
    for a in data:
        for b in data:
            if a.id >= b.id:
                continue
            sims = ratio(a.m2_built, b.m2_built) + ratio(a.m2_terrain, b.m2_terrain) + ratio(a.price_mxn, b.price_mxn)
            block = 2 * equal(a.block_id, b.block_id)
            if a.neighbourhood_id == b.neighbourhood_id:
                score = (sims + 2 * equal(a.no_bedrooms, b.no_bedrooms) + 2 * equal(a.no_full_bathrooms, b.no_full_bathrooms) + block + 1) / 10
                if score >= min_score:
                    near_pairs[a.id, b.id] = round(score, 9)
            if a.component_id is not None and a.component_id == b.component_id:
                score = (sims + ratio(a.no_bedrooms, b.no_bedrooms) + ratio(a.no_full_bathrooms, b.no_full_bathrooms)
                         + 3 * equal(a.neighbourhood_id, b.neighbourhood_id, 0.5) + block) / 10
                if score >= min_score:
                    wide_pairs[a.id, b.id] = round(score, 9)
    columns = ["m2_built", "m2_terrain", "price_mxn", "no_bedrooms", "no_full_bathrooms", "block_id", "neighbourhood_id"]
    for scorer, extra, expected in ((P.score_neighbourhood, [], near_pairs), (P.score_component, ["component_id"], wide_pairs)):
        scores = scorer(df, min_score=min_score, hot_rows=6)
        members = P.group_members(df, [*extra, *columns])
        got = {(r.id_left, r.id_right): round(r.score, 9) for r in P.expand_pairs(scores, members).collect()}
        assert {k: v for k, v in got.items() if abs(v - min_score) > 1e-8} == {k: v for k, v in expected.items() if abs(v - min_score) > 1e-8}


def test_zero_weights_are_refused(spark):
    with pytest.raises(ValueError):
        P.score_comparables(pair_rows(spark), min_score=0.9, weights={"price": 0.0})
    with pytest.raises(TypeError):
        P.score_comparables(pair_rows(spark))


# --- skew -------------------------------------------------------------------------------


def test_split_hot_keeps_every_match_once(spark):
    left = spark.createDataFrame([(i, i % 3) for i in range(30)], "l int, k int")
    right = spark.createDataFrame([(i, 0 if i < 50 else i % 3) for i in range(70)], "r int, k int")
    a, b = skew.split_hot(left, right, ["k"], spread_by="r", hot_rows=5)
    assert b.select("_shard").distinct().count() > 1
    got = a.join(b, ["k", "_shard"]).select("l", "r")
    assert rows(got) == rows(left.join(right, "k").select("l", "r"))


def test_group_key_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "5"), ("5", None), (None, None), ("", ""), ("5", "5")], "a string, b string")
    assert df.select(skew.group_key("a", "b")).distinct().count() == 5


# --- waves --------------------------------------------------------------------------------

HIST = "id long, id_ext string, asking_price double, currency string, published_wave string, unpublished_wave string, is_active boolean"


def merged(spark, history, new, **options):
    h = spark.createDataFrame(history, HIST)
    n = spark.createDataFrame(new, "id_ext string, asking_price double, currency string")
    return W.merge_history(h, n, "w2", tracked=["asking_price", "currency"], **options)


def test_merge(spark):
    history = [(1, "same", 1.0, "MXN", "w1", None, True), (2, "gone", 1.0, "MXN", "w1", None, True), (3, "to_null", 1.0, "MXN", "w1", None, True),
               (4, "from_null", None, "MXN", "w1", None, True), (5, "back", 1.0, "MXN", "w0", "w1", False), (6, None, 1.0, "MXN", "w1", None, True),
               (7, "dead", 1.0, "MXN", "w0", "w1", False)]
    new = [("same", 1.0, "MXN"), ("to_null", None, "USD"), ("from_null", 5.0, None), ("back", 2.0, "MXN"), ("fresh", 9.0, "USD"), ("fresh", 8.0, "USD"), (None, 3.0, "MXN")]
    got = {r.id_ext: r.asDict() for r in merged(spark, history, new).collect()}
    assert len(got) == 8
    assert got["same"]["asking_price_last_updated_wave"] is None and got["same"]["is_active"]
    assert (got["gone"]["unpublished_wave"], got["gone"]["is_active"]) == ("w2", False)
    assert got["to_null"]["asking_price"] == 1.0 and got["to_null"]["asking_price_last_updated_wave"] is None
    assert (got["to_null"]["currency"], got["to_null"]["currency_last_updated_wave"]) == ("USD", "w2")
    assert (got["from_null"]["asking_price"], got["from_null"]["currency"]) == (5.0, "MXN")
    assert (got["back"]["asking_price"], got["back"]["is_active"], got["back"]["unpublished_wave"]) == (2.0, False, "w1")
    assert (got["fresh"]["id"], got["fresh"]["asking_price"], got["fresh"]["published_wave"], got["fresh"]["is_active"]) == (8, 8.0, "w2", True)
    assert got["dead"]["unpublished_wave"] == "w1" and got[None]["is_active"]
    back = {r.id_ext: r for r in merged(spark, history, new, reactivate=True).collect()}["back"]
    assert back.is_active and back.unpublished_wave is None


def test_merge_twice_changes_nothing_and_empty_history(spark):
    new = [("a", 1.0, "MXN"), ("b", 2.0, "MXN")]
    first = merged(spark, [], new)
    assert sorted(r.id for r in first.collect()) == [1, 2]
    n = spark.createDataFrame(new, "id_ext string, asking_price double, currency string")
    again = W.merge_history(first, n, "w3", tracked=["asking_price", "currency"])
    assert rows(again.select(*first.columns)) == rows(first)


def test_change_log(spark):
    log = spark.createDataFrame(
        [("a", "s", 1.0, "MXN", "2024-01-01"), ("a", "s", 7.0, "MXN", "2023-12-01"), ("b", "s", 1.0, "MXN", "2024-01-01"), ("c", "s", float("nan"), None, "2024-01-01"), ("x", "s", 1.0, "MXN", "2024-03-01")],
        "id_ext string, source_type string, asking_price double, currency string, wave_date string").withColumn("wave_date", F.col("wave_date").cast("date"))
    new = spark.createDataFrame(
        [("a", "s", 1.0000001, "MXN"), ("b", "s", None, "MXN"), ("c", "s", None, None), ("d", "s", 4.0, "USD"), (None, "s", 5.0, "USD"), ("x", "s", 1.0, "MXN")],
        "id_ext string, source_type string, asking_price double, currency string")
    got = W.change_log(new, log, "2024-01-08", "2024-01-01", fields=["asking_price", "currency"])
    assert {(r.id_ext, r.change_type) for r in got.collect()} == {("b", "changed"), ("d", "new"), ("x", "new")}
    assert {r.id_ext for r in W.change_log(new, log, "w", None, fields=["asking_price"]).collect()} == {"a", "b", "c", "d", "x"}
    assert W.append_new(got, got).count() == 0
    stats = W.overlap_stats(new, log.filter("id_ext <> 'x'")).first()
    assert (stats.n_new_wave, stats.n_common, stats.n_published) == (6, 3, 3)


def test_identical_in_waves(spark):
    log = spark.createDataFrame([("a", "1", 1.0, None), ("a", "2", 1.0, None), ("b", "1", 1.0, None), ("b", "2", None, None), ("c", "1", 1.0, None), ("d", "1", 2.0, "x"), ("d", "2", 3.0, "x")],
                                "id_ext string, wave_date string, asking_price double, currency string")
    assert rows(W.identical_in_waves(log, fields=["asking_price", "currency"])) == [("a",)]
    audit = W.log_audit(log, fields=["asking_price", "currency"]).first()
    assert tuple(audit) == (7, 4, 3, 1)


# --- profile ----------------------------------------------------------------------------------


def test_histogram_and_trend(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.5, 2.0), (1.0, 3.0), (1.0, 5.0), (None, 1.0)], "x double, score double")
    assert [r["count"] for r in A.histogram(df, "x", bins=2).orderBy("bin").collect()] == [1, 3]
    assert [r["count"] for r in A.histogram(df, "x", bins=4, lo=0, hi=2).orderBy("bin").collect()] == [1, 1, 2, 0]
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r["count"] for r in A.histogram(same, "x", bins=3).collect()) == 2
    assert [r.mean_score for r in A.binned_trend(df, attribute="x", bins=2).orderBy("bin").collect()] == [1.0, 2.0]
    assert [r.mean_score for r in A.binned_trend(df, attribute="x", bins=2, include_max=True).orderBy("bin").collect()] == [1.0, pytest.approx(10 / 3)]
    assert tuple(A.margin_line(df.filter("x is not null"), attribute="x").first()) == (4.0, 1.0)
    assert A.share_at_least(df, 2.0).first()[0] == pytest.approx(60.0)


def test_stage_summary_and_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "a int, b double")
    got = [tuple(r) for r in A.stage_summary([("x", df), ("y", df.filter("a > 1").withColumn("c", F.lit(1)).drop("b"))]).orderBy("step").collect()]
    assert got == [(0, "x", 2, 0, 2, 0, "", ""), (1, "y", 1, -1, 2, 0, "c", "b")]
    assert A.any_all_nan(df, ["b"]).first()[0] is True
    observed, observation = A.observed(df, "n")
    observed.collect()
    assert observation.get["n_rows"] == 2
    assert rows(A.null_counts(spark.createDataFrame([(None, 1)], "a int, b int"))) == [("a", 1), ("b", 0)]


# --- vectors -------------------------------------------------------------------------------------


def test_tfidf_by_hand(spark):
    docs = {1: "casa azul casa", 2: "casa verde", 3: "x"}
    df = spark.createDataFrame(list(docs.items()), "id int, text string")
    counts = {1: {"casa": 2, "azul": 1, "casa azul": 1, "azul casa": 1}, 2: {"casa": 1, "verde": 1, "casa verde": 1}}
    df_of = {}
    for c in counts.values():
        for t in c:
            df_of[t] = df_of.get(t, 0) + 1
    expected = {}
    for i, c in counts.items():
        w = {t: n * (math.log(4 / (1 + df_of[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        expected.update({(i, t): v / norm for t, v in w.items()})
    got = {(r.id, r.term): r.weight for r in V.tfidf(df).collect()}
    assert got == pytest.approx(expected)
    assert [r.term for r in V.vocabulary(df, size=2).collect()] == ["casa", "azul"]
    shape = V.matrix_shape(df, V.tfidf(df)).first()
    assert (shape.n_texts, shape.n_terms, shape.n_nonzero) == (3, 6, 7)


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])], "vec_id int, embedding array<float>")
    assert [(r.vec_id, round(r.similarity, 6)) for r in V.nearest_vectors(df, 1, 2).collect()] == [(2, 0.6), (3, 0.0)]
    with pytest.raises(ValueError):
        V.nearest_vectors(df, 99)
    with pytest.raises(Exception, match="vector length"):
        V.fixed_length(df, 3).collect()
    texts = spark.createDataFrame([(1, "aa"), (2, "b")], "id int, text string")
    got = dict(rows(V.embed(texts, lambda ts: [[len(t), 0.0] for t in ts], batch_size=1)))
    assert got == {1: [1.0, 0.0], 2: [1.0, 0.0]}


def test_all_pairs_are_counted_and_listings_that_repeat(spark):
    same = {"property_type": "CASA", "is_development": False, "no_bedrooms": 2.0, "no_full_bathrooms": 1.0}
    rows = [dict(same, id=i, cell="0:0", m2_built=100.0, m2_terrain=120.0, price_mxn=5.0) for i in range(3)]
    rows += [dict(same, id=9, cell="0:1", m2_built=100.0, m2_terrain=120.0, price_mxn=5.0)]
    rows += [dict(same, id=10, cell="5:5", m2_built=100.0, m2_terrain=120.0, price_mxn=5.0)]
    rows += [dict(same, id=11, cell="0:0", m2_built=1.0, m2_terrain=9.0, price_mxn=77.0)]
    df = spark.createDataFrame(rows)
    assert P.count_pairs(df).collect() == [(10,)]
    scores = P.score_comparables(df, min_score=0.9)
    members = P.group_members(df, [*P.COMPARABLE_KEYS, "cell", "m2_built", "m2_terrain", "price_mxn"])
    assert sorted(map(tuple, P.repeated_listings(scores, members).collect())) == [(0, 3), (1, 3), (2, 3), (9, 3)]
    funnel = {r["stage"]: (r["n_groups"], r["n_pairs"]) for r in P.score_funnel(scores).collect()}
    assert funnel == {"high_score": (2, 6), "within_tolerance": (2, 6), "perfect": (2, 6)}
    none = {r["stage"]: r["n_pairs"] for r in P.score_funnel(scores.limit(0)).collect()}
    assert none == {"high_score": 0, "within_tolerance": 0, "perfect": 0}
    assert P.count_pairs(df.limit(0)).collect() == [(0,)]


def test_a_fraction_survives_a_whole_number_history(spark):
    from terralist.operators import waves as W

    history = spark.createDataFrame([(1, "a", 3, True, None)], "id long, id_ext string, no_bedrooms long, is_active boolean, unpublished_wave string")
    new = spark.createDataFrame([("a", 3.5)], "id_ext string, no_bedrooms double")
    row = W.merge_history(history, new, "2024-01-08", key="id_ext", tracked=["no_bedrooms"]).first()
    assert row["no_bedrooms"] == 3.5 and row["no_bedrooms_last_updated_wave"] == "2024-01-08"


def test_numbering_evaluates_its_input_once(spark):
    from terralist.operators import keys

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(500).selectExpr("id % 7 AS k", "id * 31 % 500 AS v", "'x' AS other", "id AS id")
    rows = keys.number_rows(source.mapInArrow(count, source.schema), ["k", "v"], output="id", start_at=10)
    got = [(r.k, r.v, r.id) for r in rows.orderBy("id").collect()]
    assert [i for _, _, i in got] == list(range(10, 510)) and got == sorted(got) and seen.value == 500
    assert rows.columns.count("id") == 1


def test_outer_join_spreads_null_and_hot_keys(spark):
    from terralist.operators.skew import outer_join

    # Nine of ten keys are null; half of the others are one key.
    left = spark.range(20_000).selectExpr("CASE WHEN id % 10 > 0 THEN NULL WHEN id % 20 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "id")
    right = left.filter("k IS NOT NULL").select("k").distinct().filter("k <> 'k30'").withColumn("v", F.length("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = outer_join(left, right, ["k"], hot_rows=100)
        per_task = lambda df: [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum("v")).collect()]
        sizes, plain = per_task(joined), per_task(left.join(right, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Rows without a key stay in the partition they came in, a fourth of the table each.
    assert max(sizes) <= 5000 < 18_000 <= max(plain)
    got = {r.id: (r.k, r.v) for r in joined.collect()}
    assert got == {r.id: (r.k, r.v) for r in left.join(right, "k", "left").collect()} and joined.count() == 20_000


@pytest.mark.parametrize("min_score", [0.5, 0.9, 0.97])
def test_bands_only_leave_out_pairs_under_the_score(spark, min_score):
    df = pair_rows(spark)
    columns = df.columns
    price = "price_mxn" if "price_mxn" in columns else next(c for c in columns if "price" in c)
    got = [
        sorted(map(str, P.score_comparables(df, price=price, min_score=min_score, bands=bands, hot_rows=hot).collect()))
        for bands, hot in ((0, 20_000), (1, 20_000), (2, 20_000), (2, 3))
    ]
    assert got[0] and got[0] == got[1] == got[2] == got[3]


@pytest.mark.parametrize("min_score", [0.5, 0.9, 0.97])
def test_bands_of_dense_keys_leave_out_nothing(spark, min_score):
    df = pair_rows(spark)
    found = lambda **o: sorted(map(str, P.score_comparables(df, min_score=min_score, **o).collect()))
    assert found() and found() == found(band_rows=1) == found(band_rows=4, hot_rows=3)


def test_scored_rows_are_copied_for_cells_only(spark, monkeypatch):
    df, seen = pair_rows(spark), []

    def watched(left, right, *args, **options):
        seen.append(left.count() / right.count())
        return skew.split_hot(left, right, *args, **options)

    monkeypatch.setattr(P, "split_hot", watched)
    P.score_comparables(df, min_score=0.9)
    assert seen == [4.0]


def test_hot_keys_do_not_shuffle_the_rows(spark):
    left = spark.createDataFrame([(i, i % 3) for i in range(30)], "l int, k int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a, _ = skew.split_hot(left, left.withColumnRenamed("l", "r"), ["k"], spread_by="r", hot_rows=5)
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_are_tested_by_one_short_sum(spark):
    df = pair_rows(spark).withColumns({"block_id": F.lit(1), "neighbourhood_id": F.lit(1), "component_id": F.lit(1)})
    plan = P.score_component(df, min_score=0.9)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "_shard" in line and "Join" in line and "greatest" in line]
    assert joins and all(line.count("greatest") == 5 for line in joins)


def test_scores_without_cells_shuffle_their_rows_once(spark):
    """Both sides of the join are one shuffle; rows of hot keys alone are dealt out again."""
    from terralist.operators.pairs import _dealt_once

    df = pair_rows(spark).withColumns({"block_id": F.col("id") % 2, "neighbourhood_id": F.col("id") % 2, "component_id": F.lit(1)})
    for scorer in (P.score_component, P.score_neighbourhood):
        for score in (0.9, 0.6):
            found = [sorted(map(str, scorer(df, min_score=score, hot_rows=hot).collect())) for hot in (20_000, 4)]
            assert found[0] and found[0] == found[1]
    rows = spark.range(20).selectExpr("id", "id % 2 AS k")
    (left, right), (others, again) = _dealt_once(rows, ["k"], 4, 20_000)
    assert left is right is again and others.count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = P.score_component(df, min_score=0.9)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Both sides of both joins, of which the rows of hot keys are the only other ones.
    assert plan.count("ReusedExchange") >= 2
    assert sum("Exchange hashpartitioning" in line and "REPARTITION_BY_NUM" in line and "Reused" not in line for line in plan.splitlines()) == 2


def test_profiles_meet_by_number_and_without_nulls(spark):
    data = random_listings(8, 60)
    data += [dict(d, price=-d["price"]) for d in data if d["price"]]  # ids repeat
    kept = G.with_duplicate_profile(listing_frame(spark, data))
    profiles = G.number_profiles(kept)
    matches = G.duplicate_profiles(profiles)
    assert dict(matches.dtypes)["center"] == "bigint" and profiles.select("number").distinct().count() == profiles.count()
    plan = matches._jdf.queryExecution().executedPlan().toString()
    tests = [line for line in plan.split("\n") if "Join" in line and "n_max_asking_price" in line]
    assert tests and all(line.count("coalesce") <= 1 for line in tests)


def test_scored_rows_are_shuffled_once_and_narrow(spark):
    """Rows are dealt to the join as they are: no second shuffle for floating keys, no value twice."""
    df = pair_rows(spark).withColumns({"no_bedrooms": F.col("no_bedrooms").cast("double"), "no_full_bathrooms": F.col("no_full_bathrooms").cast("double")})
    plan = P.score_comparables(df, min_score=0.9)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_shard" in line]
    assert len(dealt) == 2 and all("REPARTITION_BY_NUM" in line for line in dealt)
    assert "l_no_bedrooms" not in plan.split("SortMergeJoin")[-1]


def test_signed_zeros_are_equal_keys(spark):
    df = pair_rows(spark).limit(1).drop("id", "no_bedrooms")
    values = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, 1e300), (4, 1e300), (5, float("nan"))], "id long, no_bedrooms double")
    df = df.crossJoin(values).withColumns({"no_full_bathrooms": F.lit(1.5), "cell": F.lit("0:0"), "price_mxn": F.col("id") + 1e6})
    df = df.fillna({"m2_built": 50.0, "m2_terrain": 50.0}).withColumns({"property_type": F.lit("CASA"), "is_development": F.lit(False)})
    found = P.score_comparables(df, min_score=0.9).select("id_left", "id_right", "no_full_bathrooms").collect()
    assert sorted(map(tuple, found)) == [(1, 2, 1.5), (3, 4, 1.5)]


def test_duplicate_search_meets_by_numbers_and_repeats_rows_after_the_shuffle(spark):
    """Missing, zero, negative and endless numbers match as before, and only tiles are shuffled for."""
    values = [None, 0.0, -0.0, -5.0, 100.0, 105.0, 95.0, 104.99, 1e305, float("inf")]
    base = dict(lat=19.4, lon=-99.1, price=None, dev=None, active=True)
    data = [dict(base, m2=m, beds=b, baths=t) for m in values for b in (None, 0.0, -0.0, 2.0) for t in (None, 1.0)]
    data = [dict(d, id=i) for i, d in enumerate(data)]
    df = listing_frame(spark, data)
    expected = brute_duplicates(data)
    assert dict(rows(G.count_potential_duplicates(df))) == {k: len(v) for k, v in expected.items()}
    assert listed(G.find_potential_duplicates(df, hot_rows=3), df) == expected
    many = listing_frame(spark, random_listings(3, 60))
    matches = G.duplicate_profiles(G.number_profiles(G.with_duplicate_profile(many)))
    from terralist.session import kept_partitions
    with kept_partitions(spark):
        plan = matches.select("*")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_shard" in line]
    assert "ShuffledHashJoin" in plan and len(dealt) == 2 and all("REPARTITION_BY_NUM" in line for line in dealt)


@pytest.mark.parametrize("order", [["v", "t"], [F.col]])
def test_numbering_by_all_columns_evaluates_its_input_once(spark, order):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 2000, 1, 5).selectExpr("(id * 7) % 2000 AS v", "'t' AS t").mapInArrow(count, "v long, t string")
    got = O.number_rows(df, [o("v") if callable(o) else o for o in order])
    assert rows(got.select("v", "id")) == sorted(((v, v + 1) for v in range(2000)), key=repr)
    assert seen.value == 2000


def test_scores_by_tiles_carry_a_row_about_twice(spark, monkeypatch):
    """Tiles give the pairs that cells give, across tile borders too; cells and bands are made after the shuffle."""
    from terralist.queries.spatial import dealt_scores
    from terralist.session import kept_partitions

    plain = pair_rows(spark)
    shifted = [plain.withColumn("id", F.col("id") + 1000 * i).withColumn("cell", F.concat(
        F.split_part("cell", F.lit(":"), F.lit(1)).cast("int") + q, F.lit(":"), F.split_part("cell", F.lit(":"), F.lit(2)).cast("int") + r,
    )) for i, (q, r) in enumerate([(0, 0), (-1, 0), (7, -9), (-8, 7), (6, 6)])]
    df = O.union_all(*shifted).localCheckpoint()
    for score, options in ((0.5, {}), (0.9, {}), (0.9, {"band_rows": 1}), (0.9, {"band_rows": 3, "hot_rows": 4}), (0.0, {"hot_rows": 4}), (1.0, {})):
        expected = sorted(map(str, P.score_comparables(df, min_score=score).collect()))
        for tile in (1, 3, P.TILE):
            scores = P.score_comparables(df, min_score=score, tile=tile, **options)
            with kept_partitions(spark):
                assert expected and sorted(map(str, scores.collect())) == expected
    seen = []

    def watched(left, right, *args, **options):
        seen.append((left.count() + right.count()) / left.count())
        return skew.split_hot(left, right, *args, **options)

    monkeypatch.setattr(P, "split_hot", watched)
    scores = dealt_scores(df)
    assert len(seen) == 1 and seen[0] < 3
    with kept_partitions(spark):
        plan = scores.select("*")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_shard" in line]
    assert "ShuffledHashJoin" in plan and len(dealt) == 2 and all("REPARTITION_BY_NUM" in line for line in dealt)
