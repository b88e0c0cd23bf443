"""Operator 12 against brute force over all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from terralist.llm import periodic_runs, queries


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words):
    """(start, length, period) of every run, by start and period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end > start and end - start + q >= max(12, 2 * q):
                found.setdefault((start, end + q), q)
            start = max(end, start + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made_periodic(words, doc_id):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def place_runs(texts, block):
    bounds = np.cumsum([0] + [len(t) for t in texts]).astype(np.int64)
    starts, ends, periods = periodic_runs.find_runs(np.array([w for t in texts for w in t], np.int32), bounds, block)
    out = [[] for _ in texts]
    for s, e, q in zip(starts.tolist(), ends.tolist(), periods.tolist(), strict=True):
        t = int(np.searchsorted(bounds, s, "right")) - 1
        out[t].append((s - int(bounds[t]), e - s, q))
    return out


@st.composite
def texts(draw):
    letters = draw(st.sampled_from([1, 2, 3, 40]))
    words = draw(st.lists(st.integers(0, letters - 1), max_size=150))
    if words and draw(st.booleans()):
        a = draw(st.integers(0, len(words) - 1))
        p = 1 + (len(words) - a) // draw(st.integers(2, 9))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    return words


@given(st.lists(texts(), max_size=4), st.sampled_from([1, 40, 1_000_000]), st.booleans())
@settings(max_examples=250, deadline=None)
def test_runs_are_all_runs(given_texts, block, copies):
    given_texts = given_texts + given_texts if copies else given_texts
    assert place_runs(given_texts, block) == [brute(t) for t in given_texts]


@given(st.lists(st.integers(0, 2), min_size=1, max_size=200), st.data())
@settings(max_examples=200, deadline=None)
def test_common_prefixes(words, data):
    whole = periodic_runs.CommonPrefixes(np.array(words, np.int32), len(words))
    i = data.draw(st.integers(0, len(words)))
    j = data.draw(st.integers(0, len(words)).filter(lambda v: v != i))
    want = 0
    while max(i, j) + want < len(words) and words[i + want] == words[j + want]:
        want += 1
    assert whole.common(np.array([i]), np.array([j])).tolist() == [want]


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    # With every hash equal, names come from the windows themselves.
    unique = np.unique

    def blind(values, **options):
        return unique(np.zeros_like(values) if values.dtype == np.uint64 else values, **options)

    monkeypatch.setattr(periodic_runs.np, "unique", blind)
    rng = random.Random(2)
    given_texts = [[rng.randrange(2) for _ in range(200)] for _ in range(3)]
    assert place_runs(given_texts, 1000) == [brute(t) for t in given_texts]


@pytest.mark.parametrize("words", [["a"] * 30_000, ["a", "b"] * 9_000, [str(i) for i in range(30_000)]])
def test_long_texts(words):
    numbers = np.unique(words, return_inverse=True)[1]
    period = len(set(words[:100]))
    want = [] if period > 2 else [(0, len(words), period)]
    assert place_runs([numbers], 100_000) == [want]


def test_odd_documents(spark, odd, clashing, none):
    for docs in (odd, clashing):
        docs = docs.filter("length(coalesce(text, '')) < 20000")
        rows = periodic_runs.periodic_runs(docs).select("text", "n_words", "runs", "collapsed").collect()
        assert len(rows) == docs.count() and any(r["runs"] for r in rows)
        for r in rows:
            words = words_of(r["text"])
            runs = brute(words)
            assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == runs
            assert r["collapsed"] == collapsed(words, runs)
    assert periodic_runs.periodic_runs(none).count() == 0
    # Only the space of the contract parts words.
    rows = spark.createDataFrame([("x y z \x1c\t\x0ba\x00b\r\n",)], "text string")
    assert periodic_runs.periodic_runs(rows).first()["collapsed"] == "x y z \x1c a\x00b"


def test_query(spark, tmp_path, odd):
    odd.filter("length(coalesce(text, '')) < 20000").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in ("/root/testdata/sf0.001", str(tmp_path)):
        docs = [r for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(words_of(r["text"])) < 3000]
        wanted = []
        for d in docs:
            words = made_periodic(words_of(d["text"]), d["doc_id"])
            runs = brute(words)
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            lines = "".join("%d,%d,%d\n" % r for r in runs)
            wanted.append((
                d["doc_id"], len(runs), *best, None if not runs else 1000 * best[1] // best[2],
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
            ))
        got = [tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, folder).collect()]
        ids = {d["doc_id"] for d in docs}
        assert sorted((g for g in got if g[0] in ids), key=repr) == sorted(wanted, key=repr)
