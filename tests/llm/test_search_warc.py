"""Operators 3 and 8 against plain Python; damaged archives."""

import base64
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terralist.llm import maxscore, warc


def test_top_k_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(rng.choice([16, 16, 12]))]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(60)] + [(400, None), (401, [1.0, None]), (402, [float("nan")] * 3), (403, [float("inf")]), (None, [1.0]), (404, [])]
    rows += [rows[5], rows[20], rows[20]]
    found = maxscore.top_k(maxscore.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("id") % 20 == 0, k=7, shard_rows=40, query_rows=5)
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-int((whole[q][:n] * whole[c][:n]).sum()), c) for c in whole if c != q for n in [min(len(whole[q]), len(whole[c]))])
        assert got[q] == [(k + 1, c, -s) for k, (s, c) in enumerate(scores[:7])]


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0]), (0, [-2.0]), (1, [3.0]), (1, [-5.0]), (1, [3.0]), (2, [4.0])]
    vectors = maxscore.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = maxscore.top_k(vectors, F.col("id") % 20 == 0, k=4, shard_rows=2, query_rows=1).orderBy("rank").select("vec_id", "score").collect()
    assert got == [(1, 10 * 4096), (2, 4 * 4096), (1, 3 * 4096), (1, -5 * 4096)]


def test_few_and_no_vectors(spark):
    small = maxscore.whole_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"))
    assert maxscore.top_k(small, F.col("id") % 20 == 0).select("vec_id", "score").collect() == [(1, 8192)]
    assert maxscore.top_k(small.limit(0), F.col("id") % 20 == 0).count() == 0


def test_bounds_never_lose_a_row():
    rng = np.random.default_rng(2)
    x = rng.integers(-60, 60, (24, 500))
    shard = maxscore.Shard(np.arange(500), x.astype(np.float32), rows=64)
    for _ in range(20):
        q = rng.integers(-60, 60, 24).astype(np.float32)
        scores = (q[:, None] * x).sum(axis=0).astype(int)
        want = sorted((-s, i) for i, s in enumerate(scores) if i != 3)[:9]
        ids, best = shard.top(3, q, 9)
        assert list(zip((-best).tolist(), ids.tolist(), strict=True)) == want


PAGES = [(1, "http://a/ü b", "<p>x</p>"), (2, "http://a/2%20", "<p>x</p>"), (3, None, None), (4, "http://b\r\nX: y", ""), (5, "u", "long " * 60_000),
         (6, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "u", "<p>x</p>"), (2, "http://a/2%20", "<p>x</p>"), (7, "u", "\x1f\x08 é"), (8, "u", "é" * 999)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("split", [1 << 10, 1 << 25])
def test_round_trip(spark, compress, split):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("_digest", F.lit(2))
    manifest = warc.write_archives(pages.repartition(2), compress=compress)
    rows = warc.read_archives(manifest, split_bytes=split).collect()
    assert [r for r in rows if r["kind"] == "gap"] == [] and len(rows) == len(PAGES)
    largest = defaultdict(lambda: -1)
    for i, _, h in PAGES:
        largest[digest(h)] = max(largest[digest(h)], -1 if i is None else i)
    want = sorted((str(i) if i is not None else "", len((h or "").encode()), digest(h), "response" if i == largest[digest(h)] else "revisit",
                   None if i == largest[digest(h)] else str(largest[digest(h)])) for i, _, h in PAGES)
    assert sorted((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == sorted(want)
    for r in rows:
        if r["record_type"] == "response":
            assert digest(bytes(r["payload"]).decode()) == r["payload_digest"]
    assert {r["url"] for r in rows if r["record_id"] == "2"} == {"http://a/2%20"}


def test_no_pages(spark):
    manifest = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(tmp_path, compress):
    import io

    rng = random.Random(7)
    records = [warc.record_bytes(i, f"http://x/{i}", f"page {i} ".encode() * rng.randint(5, 400)) for i in range(30)]
    parts = [warc.member(r) if compress else r for r in records]
    starts = np.cumsum([0] + [len(p) for p in parts])
    data = bytearray(b"".join(parts))
    middle = lambda i: int(starts[i] + len(parts[i]) * 3 // 4)
    for at in range(middle(4), middle(4) + 3):
        data[at] ^= 0x55
    data[starts[9]:starts[9] + 4] = b"JUNK"
    cut = middle(20)
    del data[cut:cut + 2]
    data += b"trailing bytes"
    read = list(warc.read_range(warc.Window(io.BytesIO(bytes(data)), len(data)), 0, len(data)))
    good = [f["warc-record-id"] for kind, _, _, f, _ in read if kind == "record"]
    assert good == [f"<urn:page:{i}>" for i in range(30) if i not in (4, 9, 20)]
    gaps = [(a, b) for kind, a, b, _, _ in read if kind == "gap"]
    assert [a for a, _ in gaps] == [starts[4], starts[9], starts[20], len(data) - 14]
    # The records and gaps cover the file, and ranges of any size find the same ones.
    assert sum(b - a for _, a, b, _, _ in read) == len(data)
    for step in (997, 4096):
        parts = [x[:3] for s in range(0, len(data), step) for x in warc.read_range(warc.Window(io.BytesIO(bytes(data)), len(data)), s, s + step)]
        assert [p for p in parts if p[0] == "record"] == [x[:3] for x in read if x[0] == "record"]


@pytest.mark.parametrize("compress", [True, False])
def test_gaps_at_range_borders(compress):
    import io

    rng = random.Random(11)
    parts = [warc.record_bytes(i, f"http://x/{i}", f"page {i} ".encode() * rng.randint(5, 400)) for i in range(30)]
    parts = [warc.member(r) if compress else r for r in parts]
    starts = np.cumsum([0] + [len(p) for p in parts])
    data = bytearray(b"".join(parts))
    for i in (0, 4, 9, 10, 11, 20, 29):
        data[starts[i]:starts[i] + 4] = b"JUNK"
    found = lambda s, e: [x[:3] for x in warc.read_range(warc.Window(io.BytesIO(bytes(data)), len(data)), s, e)]
    whole = found(0, len(data))
    assert sum(b - a for _, a, b in whole) == len(data) and sum(k == "gap" for k, _, _ in whole) == 5
    for step in (int(starts[4]), int(starts[9]) - 1, 301, 997, 4096):
        assert [x for s in range(0, len(data), step) for x in found(s, s + step)] == whole


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("step", [400, 1000, 3000, 1 << 20])
def test_records_inside_a_payload_are_payload(spark, tmp_path, compress, step):
    wrap = warc.member if compress else bytes
    inner = b"".join(wrap(warc.record_bytes(i, "http://in", random.Random(i).randbytes(300))) for i in range(90, 99))
    records = [warc.record_bytes(1, "http://a", b"first " * 50), warc.record_bytes(2, "http://b", inner), warc.record_bytes(3, "http://c", b"last " * 50)]
    for name, data in (("held", b"".join(map(wrap, records))), ("plain", b"".join(wrap(warc.record_bytes(i, "u", b"x" * 900)) for i in range(9)))):
        (tmp_path / name).write_bytes(data)
    manifest = spark.createDataFrame([(f"file:{tmp_path / n}", (tmp_path / n).stat().st_size) for n in ("held", "plain")], "path string, bytes long")
    rows = warc.read_archives(manifest, split_bytes=step).collect()
    assert sorted((r["path"][-5:], r["kind"], r["record_id"]) for r in rows) == sorted([("/held", "record", str(i)) for i in (1, 2, 3)] + [("plain", "record", str(i)) for i in range(9)])
