"""Operator 1 against brute force over all pairs."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from samples import prose
from terralist.llm import jaccard


def word_sets(rows, size):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, size, percent):
    sets = word_sets(rows, size)
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(b)] = find(a)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        names = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out.append((rows[i][0], len(sets[i]), min(names) if names else None))
    return sorted(out, key=repr)


def variants(seed, count, words, edits):
    rng = random.Random(seed)
    base = prose(seed, words, [f"w{k}" for k in range(300)]).split()
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(40)}"
        yield " ".join(copy)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_components(spark, size, percent):
    texts = [*variants(1, 40, 80, 5), *variants(2, 25, 60, 3), *variants(3, 10, 12, 1)]
    texts += [prose(k, 30) for k in range(20)] + [texts[0]] * 15 + [texts[3].upper(), None, "", "a b", "A  b", "a", None]
    # A passage many share, around which the rest differs.
    shared = prose(99, 60, [f"p{k}" for k in range(200)])
    texts += [f"{prose(200 + k, 4 + k % 14, [f'q{j}' for j in range(500)])} {shared}" for k in range(40)]
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard.near_duplicates(docs, size=size, percent=percent, buckets=1 << 12)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, size, percent)


def test_first_tokens_share_one_for_every_similar_pair():
    for n in range(1, 60):
        for m in range(n, 75):
            for both in range(1, n + 1):
                if 100 * both >= 85 * (n + m - both):
                    # Worst case: all that is not shared comes first.
                    assert n - both < jaccard.near(n) and m - both < jaccard.far(m)


def test_least_shared_holds_for_similar_pairs_under_any_order():
    rng = random.Random(8)
    for _ in range(3000):
        n = rng.randint(1, 60)
        both = rng.randint(1, n)
        m = rng.randint(both, 70)
        if 100 * both >= 85 * (n + m - both):
            tokens = list(range(n + m - both))
            rng.shuffle(tokens)
            x, y = sorted(tokens[:n]), sorted(tokens[n - both:])
            shared = set(x[:jaccard.far(n)]) & set(y[:jaccard.far(m)])
            assert len(shared) >= jaccard.least_shared(n, m, 85)


def test_odd_documents(odd, clashing, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for docs in (odd, clashing):
        found = jaccard.near_duplicates(docs, buckets=1 << 12).collect()
        assert sorted((tuple(r) for r in found), key=repr) == brute(rows, 4, 85)
    assert jaccard.near_duplicates(none, buckets=1 << 12).count() == 0


def test_sets_are_made_of_a_megabyte_at_a_time():
    texts = [prose(k, 2000, [f"w{j}" for j in range(50)]) for k in range(500)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert batch.nbytes > 2 * jaccard.TEXT_BYTES
    got = list(jaccard._each_text([batch], 4, None))
    assert max(piece.nbytes for piece, _ in got) <= jaccard.TEXT_BYTES
    sizes = [len(s) for _, sets in got for s in sets]
    assert sizes == [len(s) for s in word_sets(list(enumerate(texts)), 4)]
    counts = np.zeros(64, np.int64)
    with_classes = [s for _, sets in jaccard._each_text([batch], 4, jaccard.Frequency(counts, counts)) for s, _ in sets]
    assert all((s == t).all() and (s[1:] > s[:-1]).all() for s, t in zip((s for _, sets in got for s in sets), with_classes, strict=True))
