"""Operators 4 and 9 against plain Python."""

import re
from collections import Counter

from pyspark.sql import functions as F

from terralist.llm import mixing, quality
from terralist.llm.words import word_count


def size_of(text):
    return len((text or "").encode().split())


def targets_of(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * weight[s] > 3 * sizes[s] * free}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else left * weight[s] / free for s in names}
        capped |= over


def test_mix_odd_documents(odd, clashing, none):
    rows = odd.collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += size_of(r["text"])
    want = targets_of(sizes)
    for docs in (odd, clashing.drop("size")):
        sized = docs.withColumn("size", word_count(F.col("text")))
        done = mixing.mix(sized)
        got = done.collect()
        assert len(got) == len(rows)
        taken = Counter()
        for r in got:
            assert r["size"] == size_of(r["text"]) and r["source_size"] == sizes[r["source"]]
            assert abs(r["target"] - want[r["source"]]) < 1e-6
            assert 0 <= r["taken"] <= 3 * r["size"]
            taken[r["source"]] += r["taken"]
        assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
        kept = mixing.take(done).collect()
        words = Counter()
        for r in kept:
            words[r["source"]] += size_of(r["text"])
        assert words == +taken
    assert mixing.mix(none.withColumn("size", F.lit(0).cast("long"))).count() == 0
    again = mixing.mix(odd.withColumn("size", word_count(F.col("text"))).repartition(5)).select("doc_id", "size", "taken")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(((r["doc_id"], r["size"], r["taken"]) for r in got), key=repr)


def repeat_words(words, k=8):
    starts = Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return len({i + j for i in range(len(words) - k + 1) if starts[tuple(words[i:i + k])] > 1 for j in range(k)})


def test_quality_odd_documents(odd, clashing, none):
    for docs in (odd, clashing):
        for r in quality.quality(docs).collect():
            text = r["text"] or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
            assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
            assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
            assert r["n_dup_lines"] == len(lines) - len(set(lines))
            assert r["n_repeat_words"] == repeat_words(words)
            assert r["base_failed"] == (len(words) < 20 or 100 * r["n_repeat_words"] > 30 * len(words))
            assert r["kept"] == (not r["failed"]) and not (r["kept"] and r["base_failed"])
    assert quality.quality(none).count() == 0


def test_quality_verdicts(spark):
    good = "The river was over the stone and a cloud of the green house walks under it. And so it was for all of them, to the end of the long day."
    rows = [("good", good), ("symbols", " ".join(f"the### {w}&&&" for w in good.split())),
            ("no stop words", " ".join(f"xq{i}z" for i in range(40)))]
    got = {r["name"]: r for r in quality.quality(spark.createDataFrame(rows, "name string, text string")).collect()}
    assert got["good"]["kept"]
    assert "symbol_ratio" in got["symbols"]["failed"] and "stop_word_ratio" in got["no stop words"]["failed"]
