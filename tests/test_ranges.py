"""CSV in ranges equals one reader over the whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from terralist.sources import files, ranges


def body(seed, rows, separator=","):
    rng = random.Random(seed)
    text = io.StringIO()
    out = csv.writer(text, delimiter=separator, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    out.writerow(["id", "note", "more"])
    values = ["x", "", 'he said "no"', "two\nlines", "a,b;c", '"', '\n"\n', "é漢", "word " * 40, '""\n,,"', "line\n" * rng.choice([2, 30])]
    for i in range(rows):
        out.writerow([i, rng.choice(values), rng.choice(values)])
        if rng.random() < 0.1:
            text.write("\n")
    if rng.random() < 0.5:
        text.write('99999,a"b,c"d "e"\n')
    return text.getvalue()


def reference(text, separator):
    return sorted([tuple((r + [None] * 3)[:3]) for r in csv.reader(io.StringIO(text, newline=""), delimiter=separator) if r][1:], key=repr)


@pytest.mark.parametrize("seed,size", [(1, 64), (2, 333), (3, 1000), (4, 20_000), (5, 50)])
def test_ranges_equal_one_reader(spark, tmp_path, seed, size):
    separator = ",;"[seed % 2]
    texts = [body(seed, 120, separator), body(seed + 100, 3, separator), "id,note,more\n".replace(",", separator), ""]
    for i, text in enumerate(texts):
        with open(f"{tmp_path}/{i}.csv", "w", encoding="utf-8", newline="") as file:
            file.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        lines = ranges.text_lines(spark, str(tmp_path))
        tasks = lines.select("path", "start").distinct().count()
        got = ranges.csv_ranges(spark, str(tmp_path), ["id", "note", "more"], separator=separator).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 5 or size > 1000
    assert sorted(map(tuple, got), key=repr) == sorted((r for t in texts for r in reference(t, separator)), key=repr)


def test_header_over_ranges_and_open_end(spark, tmp_path):
    with open(f"{tmp_path}/a.csv", "w") as file:
        file.write('"first\nof\nall ' + "x" * 200 + '",b\n1,"two\nlines"\n2,"never closed\n' + "y" * 100)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40)
    try:
        got = sorted(map(tuple, ranges.csv_ranges(spark, str(tmp_path), ["a", "b"]).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [("1", "two\nlines"), ("2", "never closed\n" + "y" * 100 + "\n")]


def test_quote_states():
    after = ranges.quoted_after
    assert not after(b'a,"b",c', False, b",") and after(b'a,"b', False, b",") and not after(b'b",c', True, b",")
    assert after(b'b""c', True, b",") and not after(b'a"b,c', False, b",") and after(b'b"x"y,"z', True, b",")
    assert after(b"", True, b",") and not after(b"", False, b",")


def test_states_are_scanned(spark):
    rng = random.Random(4)
    maps, want = [], {}
    for path in "ab":
        state = False
        for start in range(0, 400, 10):
            want[path, start] = state
            outside, inside = rng.choice([(False, True), (True, False), (True, True), (False, False)])
            maps.append((path, start, outside, inside))
            state = inside if state else outside
    rng.shuffle(maps)
    frame = spark.createDataFrame(maps, "path string, start long, outside boolean, inside boolean").repartition(4)
    assert {(r.path, r.start): r.open for r in ranges.range_states(frame).collect()} == want


def test_typed_reader_reads_ranges(spark, tmp_path):
    with open(f"{tmp_path}/p.csv", "w") as file:
        file.write("id;note\n" + "".join(f'{i};"n\n{i}"\n' for i in range(50)))
    rows = files.plain_csv(spark, str(tmp_path), "id bigint, note string")
    assert rows.agg(F.sum("id"), F.count_distinct("note")).first()[:] == (1225, 50)
