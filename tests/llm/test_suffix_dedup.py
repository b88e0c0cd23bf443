"""Operator 5 against a set of all windows seen so far."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terralist.llm import suffix_dedup


def brute(rows, length):
    """rows: (key, text) in order; equal rows count as one document."""
    seen, out = set(), {}
    for row in dict.fromkeys(rows):
        data = (row[1] or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p:p + length]
            if window in seen:
                covered[p:p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        out[row] = (len(data), sum(covered), len([1 for i, c in enumerate(covered) if c and not (i and covered[i - 1])]), kept)
    return out


def check(docs, rows, length, gram, block):
    done = suffix_dedup.remove_repeats(docs.withColumn("copy", F.col("text")), length=length, gram=gram, block=block).collect()
    want = brute(rows, length)
    assert len(done) == len(rows)
    for r in done:
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        assert (r["n_bytes"], removed, len(r["spans"]), bytes(r["kept"])) == want[r["doc_id"], r["copy"]]


@pytest.mark.parametrize("block", [100_000, 4])
def test_random_repeats(spark, block):
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(6)]
    rows = [(5, None), (6, "")]
    rows += [(i, "a" * (3 * i)) for i in range(7, 20)]
    rows += [(i, "".join(rng.choice(parts) if rng.random() < 0.7 else rng.choice("abcé") for _ in range(rng.randint(1, 9)))) for i in range(20, 90)]
    rows += [rows[30], rows[30], (95, rows[40][1]), (None, rows[41][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(docs, rows, 20, 8, block)


def test_long_documents_go_in_segments(spark, monkeypatch):
    rng = random.Random(4)
    part = "".join(rng.choice("abcd") for _ in range(400))
    data = np.frombuffer((part + "".join(rng.choice("abcd") for _ in range(3000)) + part).encode(), np.uint8)
    whole = suffix_dedup.anchors(data, 20, 8)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    for a, b in zip(whole, suffix_dedup.anchors(data, 20, 8), strict=True):
        assert (a == b).all() or a is whole[2]


def test_column_wise_order_finds_all_equal_windows():
    rng = random.Random(5)
    length, gram = 12, 4
    side = length - gram
    texts = [bytes(rng.choice(b"ab") for _ in range(2 * side + gram)) for _ in range(200)]
    left = np.full(len(texts), side)
    sizes = np.array([len(t) for t in texts])
    rank = np.arange(len(texts))
    found = suffix_dedup.repeated_windows(np.frombuffer(b"".join(texts), np.uint8), left, sizes, rank, length, gram)
    for c in range(side + 1):
        seen = set()
        for i, t in enumerate(texts):
            assert found[i, c] == (t[c:c + length] in seen)
            seen.add(t[c:c + length])


def test_odd_documents(odd, clashing, none):
    last = 1 << 62
    rows = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=lambda r: last if r[0] is None else r[0])
    # Two rows without an id hold different texts, one of them none.
    for docs in (odd, clashing):
        check(docs.select([c for c in docs.columns if c != "copy"]), rows, 100, 32, 100_000)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_whole_characters(spark):
    rows = [(1, "é" * 30), (2, "xé" + "é" * 30 + "ü")]
    done = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=21, gram=8, characters=True).collect()
    assert {r["doc_id"]: bytes(r["kept"]).decode() for r in done}[2].startswith("x")


def test_rows_without_an_id_are_told_apart(spark):
    # Two texts that share the 31 bits of hash kept beside a position.
    parts = F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{k}"))) for k in range(9)])
    texts = spark.range(150_000).select(parts.alias("text")).withColumn("own", F.shiftrightunsigned(F.xxhash64("text"), 33))
    pair = texts.groupBy("own").agg(F.collect_list("text").alias("t")).filter("size(t) = 2").first()["t"]
    rows = [(None, pair[0]), (None, pair[1]), (1, pair[0][100:260])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    done = {r["copy"]: r for r in suffix_dedup.remove_repeats(docs.withColumn("copy", F.col("text"))).collect()}
    assert bytes(done[pair[1]]["kept"]) == pair[1].encode() and done[pair[1]]["spans"] == []
    assert [tuple(s) for s in done[pair[0]]["spans"]] == [(100, 260)]
