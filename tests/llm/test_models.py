"""Operators 6 and 7: exact counts, formulas by hand, held-out quality."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terralist.llm import langid, recurrent_lm

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def models(docs):
    return langid.fit(docs.filter(langid.fold("doc_id", 3) != 1))


def test_fold_is_crc32_of_the_text(docs):
    for r in docs.select("doc_id", langid.fold("doc_id", 3).alias("f")).limit(50).collect():
        assert r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 3


def test_counts_cover_all_texts(spark):
    rows = [("en", "The cat. THE dog"), ("en", "cat"), ("de", "Hund"), (None, "zzz"), ("fr", None)]
    got = {(r["label"], r["gram"]): r["n"] for r in langid.count_grams(spark.createDataFrame(rows, "lang string, text string")).collect()}
    want = Counter((lang, g) for lang, runs in (("en", ["the", "cat", "the", "dog", "cat"]), ("de", ["hund"])) for r in runs for g in langid.grams(r))
    assert got == want


def kneser_ney(longest, uniform):
    """Probability of a symbol after a context, by the textbook recursion."""
    levels = {langid.ORDER: {g: n for g, n in longest.items() if len(g) == langid.ORDER}}
    for order in range(langid.ORDER - 1, 0, -1):
        own = Counter(g[1:] for g in levels[order + 1])
        own.update({g: n for g, n in longest.items() if len(g) == order and g[0] == "^"})
        levels[order] = own

    def p(context, symbol):
        if context is None:
            return uniform
        order = len(context) + 1
        lower = p(context[1:] if context else None, symbol)
        seen = {g: n for g, n in levels[order].items() if g[:-1] == context}
        if not seen:
            return lower
        ones, twos = (sum(n == k for n in levels[order].values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.75
        total = sum(seen.values())
        return max(seen.get(context + symbol, 0) - d, 0) / total + d * len(seen) / total * lower

    return p


def test_scores_are_interpolated_kneser_ney():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    longest = Counter(g for w in words for g in langid.grams(w))
    found = langid.Models({"x": dict(longest)})
    p = kneser_ney(longest, found.uniform)
    for word in ["abc", "dddd", "a", "cabdz", "zz", *words[:5]]:
        padded = f"^{word}$"
        want = sum(math.log(p(padded[max(0, i - langid.ORDER + 1):i], padded[i])) for i in range(1, len(padded)))
        assert abs(found.score([word])[0][0] - want) < 1e-4
    total = sum(p("ab", s) for s in {c for g in longest for c in g} - {"^"})
    assert total < 1.0001


@pytest.mark.parametrize("cells", [langid.CELLS, 400])
def test_all_ngrams_count_whatever_the_bound(spark, cells):
    rng = random.Random(5)
    rows = [(lang, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(50))) for lang, letters in (("a", "abcde"), ("b", "bcdé漢字xy")) for _ in range(12)]
    docs = spark.createDataFrame(rows + rows[:1], "lang string, text string")
    longest = {name: Counter(g for lang, t in rows + rows[:1] if lang == name for run in langid.runs(t) for g in langid.grams(run)) for name in "ab"}
    want = langid.Models({name: dict(seen) for name, seen in longest.items()})
    found = langid.fit(docs, cells=cells)
    assert (found.entries is None) == (cells > 400) and found.uniform == want.uniform
    assert sum(len(t.keys) for t in (*found.seen.values(), *found.context.values())) * 2 <= cells
    texts = [(i, t, 7) for i, (_, t) in enumerate(rows[::5])] + [(90, "cab zzz 漢字 x", 7), (91, None, 7), (92, "", 7), (93, "cab zzz 漢字 x", 8)]
    got = langid.with_sums(spark.createDataFrame(texts, "id long, text string, _key long").drop("_key"), found).collect()
    assert len(got) == len(texts)
    for r in got:
        words = langid.runs(r["text"] or "")
        sums = want.score(words).sum(axis=0) if words else np.zeros(2)
        assert r["_symbols"] == sum(len(w) + 1 for w in words) and np.abs(np.array(r["_sums"]) - sums).max() < 1e-3
    judged = langid.identify(spark.createDataFrame(texts, "id long, text string, _key long"), found).collect()
    assert len(judged) == len(texts) and all(r["_key"] in (7, 8) for r in judged)
    assert [r["lang_pred"] for r in sorted(judged, key=lambda r: r["id"])][-3:-1] == ["und"] * 2


def test_held_out_accuracy_and_rejection(spark, docs, models):
    found = langid.identify(docs.filter(langid.fold("doc_id", 3) == 1), models)
    right, total, rejected = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert right / total > 0.98 and rejected == 0
    rows = [("Привет мир как дела сегодня в нашем городе",), ("xqzj kkpw vvbq zzkq wwxq jjqz " * 5,), ("12 34 !?",), (None,), ("",)]
    odd = langid.identify(spark.createDataFrame(rows, "text string"), models).collect()
    assert all(r["rejected"] for r in odd) and [r["lang_pred"] for r in odd[2:]] == ["und"] * 3 and all(r["score"] == 0 for r in odd[2:])


def test_rejection_of_a_language_left_out(docs):
    training = docs.filter((langid.fold("doc_id", 3) != 1) & (F.col("lang") != "fr"))
    found = langid.identify(docs.filter((langid.fold("doc_id", 3) == 1) & (F.length("text") > 100)), langid.fit(training))
    share = {r["foreign"]: r["share"] for r in found.groupBy((F.col("lang") == "fr").alias("foreign")).agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert share[True] > 0.9 and share[False] < 0.01


def test_a_rare_language_is_calibrated(spark):
    rng = random.Random(9)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(40))
    rows = [("a", text("abcde")) for _ in range(300)] + [("b", text("fghij")) for _ in range(5)]
    found = langid.fit(spark.createDataFrame(rows, "lang string, text string"), calibration=40)
    assert np.isfinite(found.means).all() and np.isfinite(found.limits).all()
    tried = [("own", text("fghij")), ("odd", "".join(rng.choice("klmnop") for _ in range(200)))]
    got = {r["id"]: r for r in langid.identify(spark.createDataFrame(tried, "id string, text string"), found).collect()}
    assert got["own"]["lang_pred"] == "b" and not got["own"]["rejected"] and got["odd"]["rejected"]


def test_language_of_odd_documents(odd, clashing, none, models):
    for docs in (odd, clashing):
        rows = langid.identify(docs, models).collect()
        assert len(rows) == odd.count()
        for r in rows:
            assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or ""))) and 0 <= r["score"] <= 1
    assert langid.identify(none, models).count() == 0
    assert langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def check_scores(rows, got, training):
    seen = Counter(t for r in rows if training(r) for t in tokens(r["text"]))
    n, v = sum(seen.values()), len(seen)
    assert len(got) == len(rows)
    for r in got:
        own = tokens(r["copy"])
        want = sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert abs(r["base_score"] - want) <= 1e-9 * abs(want) + 1e-9
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(seen[t] > 0 for t in own), n)
        assert r["score"] <= 1e-6 and math.isfinite(r["score"])


@pytest.mark.parametrize("table", [400_000, 3])
def test_scores_of_odd_documents(odd, clashing, monkeypatch, table):
    # With a table of three words, most words meet their counts in the join.
    monkeypatch.setattr(recurrent_lm.vocabulary, "__defaults__", (table,))
    rows = odd.collect()
    training = F.coalesce(F.col("doc_id") % 5 != 0, F.lit(True))
    for docs in (odd, clashing):
        got = recurrent_lm.score_documents(docs.withColumn("copy", F.col("text")), training).collect()
        check_scores(rows, got, lambda r: r["doc_id"] is None or r["doc_id"] % 5 != 0)


def test_no_training_and_no_documents(odd, none):
    got = recurrent_lm.score_documents(odd, F.lit(False)).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert recurrent_lm.score_documents(none, F.lit(True)).count() == 0


def test_model_beats_counts_on_held_out_documents(docs):
    held = langid.fold("doc_id", 10) == 0
    rows = recurrent_lm.score_documents(docs.withColumn("held", held), ~F.col("held")).filter("held")
    model, base = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert model > base


def test_gradients_by_difference(monkeypatch):
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, recurrent_lm.HEAD + recurrent_lm.TAIL, n) for n in (9, 7, 7, 2)]
    start = [p.astype(np.float32) * 3 for p in recurrent_lm.fresh()]
    tokens = sum(map(len, sequences))

    def loss(parameters):
        return -recurrent_lm.log_likelihoods(parameters, sequences).sum() * np.log(10) / tokens

    # One step in one window: the first moment is a tenth of the gradient.
    moved = [p.copy() for p in start]
    moments = [0, [np.zeros_like(p) for p in moved], [np.zeros_like(p) for p in moved]]
    recurrent_lm.train(moved, sequences, moments)
    for k, p in enumerate(start):
        flat = np.abs(moments[1][k]).ravel().argsort()[-3:]
        for at in flat:
            for sign in (1, -1):
                trial = [q.astype(np.float64) for q in start]
                trial[k].ravel()[at] += sign * 1e-3
                up = loss(trial) if sign > 0 else up
                down = loss(trial) if sign < 0 else None
            assert abs((up - down) / 2e-3 - 10 * moments[1][k].ravel()[at]) < 2e-3


def test_state_is_carried_across_windows():
    parameters = [p * 5 for p in recurrent_lm.fresh()]
    rng = np.random.default_rng(2)
    long = rng.integers(0, 60, 3 * recurrent_lm.WINDOW + 5)
    whole = recurrent_lm.log_likelihoods(parameters, [long])[0]
    x, y, lengths = recurrent_lm.padded([long], [0])
    steps = recurrent_lm.forward(parameters, x, np.zeros((1, recurrent_lm.HIDDEN), np.float32), [1] * len(x))
    logits, _, total = recurrent_lm.class_logs(parameters, np.concatenate([s[5] for s in steps]))
    assert abs((logits[np.arange(len(y)), y[:, 0]] - np.log(total[:, 0])).sum() / np.log(10) - whole) < 1e-3


def test_counting_letters_lets_go_of_what_another_operator_left(spark):
    from terralist.llm import batches

    class Docs:
        """Takes the function that tasks run."""

        def mapInArrow(self, function, schema):  # noqa: N802
            self.count = function
            return self

        filter = select = groupBy = agg = lambda self, *args: self  # noqa: N815

    docs = Docs()
    langid.count_grams(docs)
    batches.held("byte_bpe", "ranks", object)
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b"], "text": ["Ab ab", "x1²y_Éa"]})
    begun = docs.count(iter([batch]))
    first = next(begun)
    assert batches._held == [None, None, None]
    seen = [(r["label"], r["gram"], r["n"]) for part in (first, *begun) for r in part.to_pylist()]
    expected = Counter()
    for name, run, n in (("a", "ab", 2), ("b", "x", 1), ("b", "y", 1), ("b", "éa", 1)):
        for g in langid.grams(run):
            expected[name, g] += n
    assert {(name, g): n for name, g, n in seen} == expected and len(seen) == len(expected)


def test_scorer_looks_runs_up_once():
    models = langid.Models({"x": dict(Counter(langid.grams("abc"))), "y": dict(Counter(langid.grams("bcd")))})
    scorer = langid.Scorer(models)
    # A run gets its row when it is met, and is scored with all others of its texts.
    symbols, sums, found = scorer.texts(["abc Bcd abc", None, "zz漢字"])
    assert list(scorer.items()) == [("abc", 0), ("bcd", 1), ("zz漢字", 2)] and scorer["new"] == 3 and scorer.new == ["new"]
    assert symbols.tolist() == [12, 0, 5] and found[1] == []
    for own, total in zip(found, sums, strict=True):
        want = models.score(own).sum(axis=0) if own else np.zeros(2)
        assert np.abs(total - want).max() < 1e-5
    assert np.abs(scorer.texts(["new abc"])[1][0] - models.score(["new", "abc"]).sum(axis=0)).max() < 1e-5


def lm_vocabulary(kinds, outside=0):
    words = [b" ", *(b"w%05d" % i for i in range(1, kinds))]
    counts = [20_000 // (1 + i) + 1 for i in range(kinds)]
    return recurrent_lm.Vocabulary(words, counts, sum(counts) + outside, kinds + outside)


@pytest.mark.parametrize(("kinds", "outside"), [(3, 5), (300, 0), (6000, 700)])
def test_classes_and_words_within_them_make_one_distribution(kinds, outside):
    words = lm_vocabulary(kinds, outside)
    classes = recurrent_lm.classes_of(words.firsts)
    own = words.outcomes[:min(kinds, recurrent_lm.WORDS)]
    assert len(set(own.tolist())) == len(own) and (np.diff(classes[words.outcomes]) >= 0).all()
    # The words of an outcome, unseen ones included, share it whole.
    mass = np.bincount(words.outcomes[:-1], 10.0 ** words.shares[:-1], words.firsts[-1])
    unseen = (outside + recurrent_lm.ADDED * (outside + 1)) * 10.0 ** words.shares[-1]
    mass[words.outcomes[-1]] += unseen
    used = np.unique(words.outcomes)
    assert len(used) == words.firsts[-1] and np.abs(mass[used] - 1).max() < 1e-9
    rng = np.random.default_rng(3)
    parameters = [p + rng.standard_normal(p.shape).astype(np.float32) for p in recurrent_lm.fresh(7, words.firsts)]
    before = words.outcomes[rng.integers(0, kinds, 5)]
    alone = recurrent_lm.log_likelihoods(parameters, [before], words.firsts)[0]
    longer = recurrent_lm.log_likelihoods(parameters, [np.append(before, o) for o in range(words.firsts[-1])], words.firsts)
    empty = np.flatnonzero(np.diff(words.firsts) == 0)
    steps = recurrent_lm.forward(parameters, np.append(-1, before)[:, None], np.zeros((1, recurrent_lm.HIDDEN), np.float32), [1] * 6)
    _, e, total = recurrent_lm.class_logs(parameters, steps[-1][5])
    # Classes without any word keep their part of the softmax over classes.
    assert abs((10.0 ** (longer - alone)).sum() + (e / total)[0, empty].sum() - 1) < 1e-3


def test_words_within_a_class_are_learned():
    words = lm_vocabulary(300)
    # Of two words of one class, each always follows its own word.
    a, b = 40, 41
    classes = recurrent_lm.classes_of(words.firsts)
    assert classes[words.outcomes[a]] == classes[words.outcomes[b]]
    rng = np.random.default_rng(5)
    sequences = [words.outcomes[[x for k in rng.integers(0, 2, 40) for x in ((3, a) if k else (5, b))]] for _ in range(300)]
    parameters = recurrent_lm.fresh(7, words.firsts)
    parameters[5][:] = words.bias
    moments = [0, [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]]
    for _ in range(20):
        recurrent_lm.train(parameters, sequences, moments, words.firsts)
    right, wrong = recurrent_lm.log_likelihoods(parameters, [words.outcomes[[3, a, 5, b]], words.outcomes[[3, b, 5, a]]], words.firsts)
    assert right > wrong + 1


def test_gradients_within_classes_by_difference():
    words = lm_vocabulary(120)
    rng = np.random.default_rng(1)
    sequences = [words.outcomes[rng.integers(0, 120, n)] for n in (40, 30, 9)]
    start = [p + rng.standard_normal(p.shape).astype(np.float32) * np.float32(0.3) for p in recurrent_lm.fresh(7, words.firsts)]
    tokens = sum(map(len, sequences))
    moved = [p.copy() for p in start]
    moments = [0, [np.zeros_like(p) for p in moved], [np.zeros_like(p) for p in moved]]
    recurrent_lm.train(moved, sequences, moments, words.firsts)

    def loss(k, at, by):
        trial = [q.astype(np.float64) for q in start]
        trial[k].ravel()[at] += by
        return -recurrent_lm.log_likelihoods(trial, sequences, words.firsts).sum() * np.log(10) / tokens

    for k in range(6):
        # Squares within classes are of the gradient itself, first moments a tenth of it.
        got = np.sqrt(moments[2][k]) if k > 3 else 10 * np.abs(moments[1][k])
        for at in got.ravel().argsort()[-3:]:
            assert abs(abs(loss(k, at, 1e-3) - loss(k, at, -1e-3)) / 2e-3 - got.ravel()[at]) < 2e-3
