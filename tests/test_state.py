"""The maintained state against sorting the whole history."""

import random

from pyspark.sql import functions as F

from terralist.operators.keys import latest_at
from terralist.operators.state import new_state
from terralist.operators.waves import change_log, log_against

SCHEMA = "id_ext string, asking_price double, lat double, wave_date date"
DAYS = ["2024-01-01", "2024-01-08", "2024-01-15"]


def history(spark, seed, days, keys=40, repeats=2):
    rng = random.Random(seed)
    rows = [
        (rng.choice([f"k{rng.randrange(keys)}", None]) if rng.random() < 0.1 else f"k{rng.randrange(keys)}", rng.choice([1.0, 2.0, None]), rng.random(), rng.choice(days))
        for _ in range(keys * repeats)
    ]
    return spark.createDataFrame([(k, p, x, None if rng.random() < 0.05 else d) for k, p, x, d in rows], "id_ext string, asking_price double, lat double, d string").select(
        "id_ext", "asking_price", "lat", F.col("d").cast("date").alias("wave_date"))


def same(a, b):
    return sorted(map(tuple, a.select(*sorted(a.columns)).collect()), key=repr) == sorted(map(tuple, b.select(*sorted(a.columns)).collect()), key=repr)


def test_state_equals_sorting_the_log(spark):
    log = history(spark, 1, DAYS[:2]).cache()
    state = new_state(log, "listings", key="id_ext", date="wave_date", cutoff=DAYS[0])
    assert same(state.rows(), latest_at(log, "id_ext", "wave_date", DAYS[0], keep_date=True).filter("id_ext IS NOT NULL"))
    # A later wave, an earlier one that comes late, and rows that are there already.
    later, late = history(spark, 2, DAYS[2:], keys=60).cache(), history(spark, 3, ["2023-12-01"]).cache()
    after = state.advance(later).advance(late).advance(later.limit(0))
    everything = log.filter(F.col("wave_date") <= DAYS[0]).union(later).union(late)
    assert same(after.rows(), latest_at(everything, "id_ext", "wave_date", "2030-01-01", keep_date=True).filter("id_ext IS NOT NULL"))
    # Versions are apart; one can go without the others.
    assert state.rows().count() < after.rows().count()
    state.drop()
    assert after.rows().count() > 0


def test_log_from_the_state_moves_no_history(spark):
    log, new = history(spark, 4, DAYS[:1]), history(spark, 5, DAYS[1:2]).drop("wave_date")
    state = new_state(log, "listings", key="id_ext", date="wave_date", cutoff=DAYS[0])
    found = log_against(new, state.latest(), DAYS[1], fields=["asking_price", "lat"])
    assert same(found, change_log(new, log, DAYS[1], DAYS[0], fields=["asking_price", "lat"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for frame in (log_against(new, state.latest(), DAYS[1], fields=["asking_price", "lat"]), state.rows().join(new.select("id_ext").distinct(), "id_ext", "full")):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "__" in line)
            assert "Bucketed: true" in lines[scan]
            # Nothing above the scan of the state up to the join is an exchange.
            depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-|"))
            above = []
            for line in reversed(lines[:scan]):
                own = len(line) - len(line.lstrip(" :+-|"))
                if own < depth:
                    above.append(line)
                    depth = own
                if "Join" in line and own <= depth:
                    break
            assert above and not any("Exchange" in line for line in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
