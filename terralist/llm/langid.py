"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased and cut into runs of letters; a model predicts each letter
of a run, and its end, from up to four symbols before, never from before the
start of the run.  All labelled training texts are counted: tasks add up the
runs they see and send n-gram counts, so the shuffle follows the number of
distinct n-grams.  Continuation counts, discounts, totals and back-off weights
come from all of them, as Spark aggregates.

Finished models are sorted arrays of 64-bit hashes, one row per n-gram and one
column per language.  Up to ``cells`` numbers are collected and broadcast; if a
model has more, those of its most frequent n-grams are, and what a text has
besides meets the whole model in a join, so scores do not depend on the bound.

The language with the lowest cross-entropy per symbol
wins.  Calibration measures, on a bounded number of distinct texts of every
language, scored by models that have not counted them, how cross-entropy spreads
with length, and how near the texts of other languages come whose own model is
left out; texts are rejected beyond a limit between the two.

Defined results: null texts and texts without a letter are ``und`` with score 0
and rejected; ties go to the language first in code point order; without any
labelled text every text is ``und``; rows are judged one by one, whatever their
length; other columns pass through, those named as an added one are replaced.
"""

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window, functions as F, types as T

from terralist.llm.batches import held, map_batches, pieces, release, sheltered, vacate
from terralist.session import cut_lineage

ORDER = 5
#: Bound of the broadcast tables: n-grams and contexts times languages.
CELLS = 8_000_000
#: Distinct texts per language that calibrate.
CALIBRATION_TEXTS = 1000
#: Fewer texts than this have no spread of their own; the least spread, as a share of the mean.
LEAST_TEXTS, LEAST_SPREAD = 8, 0.01
#: Rejection beyond so many standard deviations where no other language tells; half of it at least.
REJECT_AT = 8.0
#: Letters of evidence after which the score no longer grows.
EVIDENCE = 30
UNKNOWN = "und"
#: Runs counted before they are sent as n-grams, runs whose scores are kept, runs scored together.
FLUSH = 150_000
CACHED = 200_000
TOGETHER = 10_000
#: Bytes of text scored together.
SCORED_BYTES = 2 << 20

_letters = re.compile(r"[^\W\d_]+").findall
_plain = re.compile(r"[a-z]+").findall


def runs(text):
    """Runs of letters of a text, lower-cased."""
    if text.isascii():
        return _plain(text.lower())
    found = _letters(text.lower())
    return found if "".join(found).isalpha() else [r for f in found for r in re.split(r"[^\w]+", "".join(c if c.isalpha() else " " for c in f)) if r]


def grams(run):
    """The longest n-gram that ends at each symbol of a run and at its end."""
    padded = f"^{run}$"
    return [padded[max(0, i - ORDER + 1):i + 1] for i in range(1, len(padded))]


def count_grams(docs, text="text", label="lang"):
    """(label, gram, n) over all labelled texts."""
    def count(batches):
        # What another operator left in this worker goes before texts are counted.
        vacate()
        words = {}

        def flush():
            for name, seen in words.items():
                total = Counter()
                for run, n in seen.items():
                    for g in grams(run):
                        total[g] += n
                if total:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(total)), pa.array(list(total)), pa.array(list(total.values()), pa.int64())],
                        names=["label", "gram", "n"],
                    )
            words.clear()

        for batch in batches:
            for piece in pieces(batch):
                for name, value in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    words.setdefault(name, Counter()).update(runs(value))
                if sum(map(len, words.values())) > FLUSH:
                    yield from flush()
        yield from flush()
        # The worker stays for the next stage; the memory of the counters need not.
        release()

    rows = docs.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(label, text)
    return rows.mapInArrow(count, "label string, gram string, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))


def hashes(symbols, length):
    """Hash of the ``length`` code points ending at each row's last column."""
    return hashed([symbols[:, c] for c in range(symbols.shape[1] - length, symbols.shape[1])], len(symbols))


def hashed(columns, rows):
    """The same of code points given by column."""
    h = np.full(rows, len(columns), np.uint64)
    for c in columns:
        h ^= c
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _points(texts, width):
    """Code points of texts of one length, right-aligned in rows."""
    out = np.zeros((len(texts), width), np.uint64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points):
        out[:, width - len(points) // len(texts):] = points.reshape(len(texts), -1)
    return out


class Table:
    """Sorted hashes with a row of one number per language."""

    def __init__(self, keys, values):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def rows(self, keys):
        """(row, found) of each key."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


class Models:
    """The models of all languages; pickled as plain arrays."""

    def __init__(self, counts):
        """``counts``: language -> {longest n-gram: count}."""
        self.languages = sorted(counts)
        k = len(self.languages)
        alphabet = {c for seen in counts.values() for g in seen for c in g} | {"?"}
        self.uniform = 1.0 / (len(alphabet) + 1)
        self.seen, self.context = {}, {}
        levels = [self.by_order(counts[name]) for name in self.languages]
        for order in range(1, ORDER + 1):
            ratio, gamma = {}, {}
            for j, level in enumerate(levels):
                own = level[order]
                total, kinds, ones, twos = Counter(), Counter(), 0, 0
                for g, n in own.items():
                    total[g[:-1]] += n
                    kinds[g[:-1]] += 1
                    ones += n == 1
                    twos += n == 2
                discount = ones / (ones + 2 * twos) if ones and twos else 0.75
                for g, n in own.items():
                    ratio.setdefault(g, np.zeros(k))[j] = max(n - discount, 0) / total[g[:-1]]
                for h, n in total.items():
                    gamma.setdefault(h, np.ones(k))[j] = discount * kinds[h] / n
            stack = lambda d: np.array(list(d.values())).reshape(len(d), k).astype(np.float32)
            self.seen[order] = Table(hashes(_points(list(ratio), order), order), stack(ratio))
            self.context[order] = Table(hashes(_points(list(gamma), max(1, order - 1)), order - 1), stack(gamma))
        self.means = self.spread = self.limits = self.entries = None

    @classmethod
    def of_entries(cls, languages, symbols, seen, context, entries=None):
        """Models of finished numbers; ``entries`` is the whole model if the tables are a part of it."""
        models = cls.__new__(cls)
        models.languages, models.uniform = languages, 1.0 / (symbols + 1)
        models.seen, models.context = seen, context
        models.means = models.spread = models.limits = None
        models.entries = entries
        return models

    def __getstate__(self):
        # Tasks need to know whether the tables are whole, not the data frame.
        return self.__dict__ | {"entries": None if self.entries is None else True}

    @staticmethod
    def by_order(longest):
        """Counts of each order: as they are at the top and at a run's start, else of left neighbours."""
        level = {ORDER: {g: n for g, n in longest.items() if len(g) == ORDER}}
        starts = Counter()
        for g, n in longest.items():
            if g[0] == "^":
                starts[g] += n
        for order in range(ORDER - 1, 0, -1):
            own = Counter(g[1:] for g in level[order + 1])
            for g, n in starts.items():
                if len(g) == order:
                    own[g] += n
            level[order] = dict(own)
        return level

    def score(self, words):
        """Natural log probability of each run in each language."""
        return self.score_stored(words)[0]

    def score_stored(self, words):
        """(log probabilities of each run, open n-grams of each run).

        An n-gram is open if the tables are a part of the model and lack it or one
        of its lower orders; open n-grams add 0 here.
        """
        sizes = np.array([len(w) + 1 for w in words])
        text = "".join(f"^{w}$" for w in words)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        keep = np.ones(len(points), bool)
        keep[starts] = False
        at = np.flatnonzero(keep)
        begins = np.cumsum(sizes) - sizes
        inside = np.arange(len(at)) - np.repeat(begins, sizes) + 1
        columns = [points[np.maximum(at - d, 0)] for d in range(ORDER - 1, -1, -1)]
        p = np.full((len(at), len(self.languages)), self.uniform, np.float32)
        left = np.zeros(len(at), bool)
        for order in range(1, ORDER + 1):
            # Rows whose context is known; the first orders hold every row, so nothing is copied.
            deep = slice(None) if order <= 2 else np.flatnonzero(inside >= order - 1)
            own = [c[deep] for c in columns[ORDER - order:]]
            row, known = self.context[order].rows(hashed(own[:-1], len(at) if order <= 2 else len(deep)))
            if not known.all():
                deep = np.arange(len(at)) if order <= 2 else deep
                left[deep[~known]] = True
                deep, row, own = deep[known], row[known], [c[known] for c in own]
            q = p[deep] * self.context[order].values[row]
            row, known = self.seen[order].rows(hashed(own, len(q)))
            if known.all():
                q += self.seen[order].values[row]
            else:
                left[np.arange(len(at))[deep][~known]] = True
                q[known] += self.seen[order].values[row[known]]
            p[deep] = q
        logs = np.log(p)
        # Only tables that are a part of the model leave n-grams open.
        opened = None if self.entries is None else [[] for _ in words]
        if opened is not None and left.any():
            logs[left] = 0
            owner = np.repeat(np.arange(len(words)), sizes)
            for i in np.flatnonzero(left).tolist():
                opened[owner[i]].append(text[at[i] - min(ORDER - 1, inside[i]):at[i] + 1])
        return np.add.reduceat(logs, begins, axis=0), opened


class Scorer(dict):
    """Run -> row of a matrix of log probabilities, for a bounded number of runs."""

    def __init__(self, models):
        self.models = models
        self.matrix = np.zeros((0, len(models.languages)), np.float32)
        self.opened, self.new = [], []

    def __missing__(self, run):
        row = self[run] = len(self.matrix) + len(self.new)
        self.new.append(run)
        return row

    def texts(self, values):
        """(symbols, log probability per language, runs) of texts."""
        found = [runs(v) if v else [] for v in values]
        if len(self) > CACHED:
            self.clear()
            self.matrix, self.opened = self.matrix[:0], []
        every = list(chain.from_iterable(found))
        rows = np.fromiter(map(self.__getitem__, every), np.int64, len(every))
        if self.new:
            new, self.new = self.new, []
            done = [self.models.score_stored(new[i:i + TOGETHER]) for i in range(0, len(new), TOGETHER)]
            self.matrix = np.concatenate([self.matrix, *(m for m, _ in done)])
            self.opened.extend(o for _, opened in done for o in opened or ())
        letters = np.fromiter(map(len, every), np.int64, len(every)) + 1
        owner = np.repeat(np.arange(len(values)), [len(f) for f in found])
        symbols = np.bincount(owner, letters, len(values)).astype(np.int64)
        sums = np.stack([np.bincount(owner, self.matrix[rows, j], len(values)) for j in range(self.matrix.shape[1])], axis=1)
        return symbols, sums, found

    def open_grams(self, found):
        """n-grams of a text's runs that the tables leave open, with their number."""
        return Counter(g for w in found for g in self.opened[self[w]])


def _scorer(shared):
    return held("langid", shared, lambda: Scorer(shared.value))


def orders(counted):
    """(label, gram, n, weight) of all orders from (label, gram, n) of the longest n-grams.

    ``n`` is as in ``Models.by_order``.  ``weight`` is the largest count of a longest
    n-gram that ends in ``gram``, so the entries above a weight hold all they need.
    """
    longest = counted.select("label", "gram", "n", F.col("n").alias("weight"))
    starts = longest.filter(F.startswith("gram", F.lit("^")))
    level = longest.filter(F.length("gram") == ORDER)
    levels = [level]
    for order in range(ORDER - 1, 0, -1):
        lower = level.select("label", F.expr("substring(gram, 2)").alias("gram"), F.lit(1).cast("long").alias("n"), "weight")
        own = starts.filter(F.length("gram") == order)
        level = cut_lineage(lower.unionByName(own).groupBy("label", "gram").agg(F.sum("n").alias("n"), F.max("weight").alias("weight")))
        levels.append(level)
    return levels


def build(counted, cells=CELLS):
    """Models of (label, gram, n), all numbers from all n-grams; None if there are none."""
    levels = orders(counted)
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    size = F.length("gram")
    facts = grams.groupBy("label", size.alias("order")).agg(
        F.sum((F.col("n") == 1).cast("long")).alias("ones"), F.sum((F.col("n") == 2).cast("long")).alias("twos")).collect()
    if not facts:
        return None
    languages = sorted({r["label"] for r in facts})
    k = len(languages)
    discounts = {(r["label"], r["order"]): r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] and r["twos"] else 0.75 for r in facts}
    rows = [(name, order, languages.index(name), d) for (name, order), d in discounts.items()]
    given = grams.sparkSession.createDataFrame(rows, "label string, order int, j int, discount double")
    grams = grams.withColumn("order", size).join(F.broadcast(given), ["label", "order"]).drop("label")
    grams = grams.withColumn("context", F.expr("left(gram, order - 1)"))
    totals = grams.groupBy("j", "order", "context").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.max("weight").alias("weight"), F.first("discount").alias("discount"))
    ratios = grams.join(totals.select("j", "order", "context", "total"), ["j", "order", "context"]).select(
        F.lit(True).alias("symbol"), "order", "gram", "weight", "j", (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("value"))
    gammas = totals.select(F.lit(False).alias("symbol"), "order", F.col("context").alias("gram"), "weight", "j", (F.col("discount") * F.col("kinds") / F.col("total")).alias("value"))
    entries = cut_lineage(ratios.unionByName(gammas).groupBy("symbol", "order", "gram").agg(
        F.max("weight").alias("weight"), F.collect_list(F.struct("j", "value")).alias("values")))
    bins = entries.groupBy(F.floor(F.log2("weight")).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    symbols = entries.filter("symbol AND order = 1").count() + 2
    number, low = 0, 64
    for row in sorted(bins, key=lambda r: -r["b"]):
        if (number + row["n"]) * k > cells:
            break
        number, low = number + row["n"], row["b"]
    whole = number == sum(r["n"] for r in bins)
    stored = entries if whole else entries.filter(F.col("weight") >= F.lit(float(2**low)))
    tables, rows = {True: {}, False: {}}, stored.select("symbol", "order", "gram", "values").toArrow()
    for order in range(1, ORDER + 1):
        for symbol in (True, False):
            part = rows.filter(pc.and_(pc.equal(rows["symbol"], symbol), pc.equal(rows["order"], order)))
            values = np.full((part.num_rows, k), 0.0 if symbol else 1.0, np.float32)
            if part.num_rows:
                lists = part["values"].combine_chunks()
                at = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                values[at, lists.flatten().field("j").to_numpy()] = lists.flatten().field("value").to_numpy()
            length = order if symbol else order - 1
            tables[symbol][order] = Table(hashes(_points(part["gram"].to_pylist(), max(1, length)), length), values)
    return Models.of_entries(languages, symbols, tables[True], tables[False], None if whole else entries)


def fit(docs, text="text", label="lang", cells=CELLS, calibration=CALIBRATION_TEXTS):
    """The models of all languages that label a text; None if there is none."""
    counted = cut_lineage(count_grams(docs, text, label))
    models = build(counted, cells)
    if models is not None:
        calibrate(models, docs, counted, text, label, calibration, cells)
    return models


def open_logs(grams, models):
    """(gram, logs): log probability per language of longest n-grams, by joins with the whole model."""
    entries, k, uniform = models.entries, len(models.languages), models.uniform
    chain = grams.select("gram", F.explode(F.sequence(F.lit(1), F.length("gram"))).alias("order")).withColumns({
        "own": F.expr("right(gram, order)"), "context": F.expr("left(right(gram, order), order - 1)")})
    ratios = entries.filter("symbol").select(F.col("gram").alias("own"), F.col("values").alias("ratio"))
    gammas = entries.filter("NOT symbol").select("order", F.col("gram").alias("context"), F.col("values").alias("gamma"))
    found = chain.join(ratios, "own", "left").join(gammas, ["order", "context"], "left")
    steps = found.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("order", "ratio", "gamma"))).alias("steps"))

    def run(batches):
        for batch in batches:
            logs = []
            for steps in batch.column("steps").to_pylist():
                p = np.full(k, uniform)
                for step in steps:
                    if step["gamma"] is None:
                        continue
                    for e in step["gamma"]:
                        p[e["j"]] *= e["value"]
                    for e in step["ratio"] or ():
                        p[e["j"]] += e["value"]
                logs.append(np.log(p))
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(logs, pa.list_(pa.float64()))], names=["gram", "logs"])

    return steps.mapInArrow(run, "gram string, logs array<double>")


SUMS = {"_symbols": T.LongType(), "_sums": T.ArrayType(T.DoubleType())}


def with_sums(docs, models, text="text"):
    """``docs`` with ``_symbols`` and ``_sums``: log probability per language, by joins where the tables leave it open."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def stored(columns):
        symbols, sums, found = _scorer(shared).texts(columns[text].to_pylist())
        return {"_symbols": pa.array(symbols, pa.int64()), "_sums": pa.array(list(sums), pa.list_(pa.float64()))}, found

    if models.entries is None:
        return map_batches(docs, lambda columns: stored(columns)[0], SUMS, reads=[text], limit=SCORED_BYTES)

    def partly(columns):
        out, found = stored(columns)
        opened = [list(_scorer(shared).open_grams(f).items()) for f in found]
        return out | {"_open": pa.array([[{"gram": g, "n": n} for g, n in o] for o in opened], pa.list_(pa.struct([("gram", pa.string()), ("n", pa.int64())])))}

    kind = T.ArrayType(T.StructType([T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())]))
    # Equal texts share a key and their sums.
    key = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    begun = cut_lineage(map_batches(docs.select(text, key.alias("_key")), partly, SUMS | {"_open": kind}, reads=[text], limit=SCORED_BYTES).drop(text).dropDuplicates(["_key"]))
    asked = begun.select("_key", F.explode("_open").alias("o")).select("_key", "o.gram", "o.n")
    logs = open_logs(asked.select("gram").distinct(), models)
    parts = asked.join(logs, "gram").select("_key", "n", F.posexplode("logs").alias("j", "log"))
    more = parts.groupBy("_key", "j").agg(F.sum(F.col("n") * F.col("log")).alias("more"))
    more = more.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("j", "more"))).alias("_more"))
    sums = F.when(F.col("_more").isNull(), F.col("_sums")).otherwise(F.zip_with("_sums", "_more", lambda s, m: s + m["more"]))
    done = begun.join(more, "_key", "left").select("_key", "_symbols", sums.alias("_sums"))
    return docs.withColumn("_key", key).join(done, "_key").drop("_key")


def held_out(docs, text, label, limit):
    """The labelled rows that calibrate: per language up to ``limit`` distinct texts, a fourth at most, by the order of a hash."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(label, text).withColumn("_hash", F.xxhash64(text))
    numbers = rows.groupBy(label).agg(F.approx_count_distinct("_hash").alias("_n"))
    # Enough of the smallest hashes, by a bound that leaves few of a long list to sort.
    bound = F.lit(-(2.0**63)) + F.lit(2.0**64) * F.least(F.lit(1.0), F.lit(4.0 * limit) / F.col("_n"))
    few = rows.join(F.broadcast(numbers), label).filter(F.col("_hash") <= bound).select(label, "_hash", "_n").distinct()
    ranked = few.withColumn("_rank", F.row_number().over(Window.partitionBy(label).orderBy("_hash")))
    chosen = cut_lineage(ranked.filter((F.col("_rank") <= limit) & (F.col("_rank") <= F.ceil(F.col("_n") / 4)) & (F.col("_n") > 1)).select(label, "_hash"))
    return cut_lineage(rows.join(chosen, [label, "_hash"], "left_semi"))


def calibrate(models, docs, counted, text, label, limit, cells=CELLS):
    """Per language: mean cross-entropy of its texts, how the variance falls with length, and the limit in standard deviations.

    The texts are scored by models that have not counted them.
    """
    part = held_out(docs, text, label, limit)
    less = count_grams(part, text, label).withColumn("n", -F.col("n"))
    rest = counted.unionByName(less).groupBy("label", "gram").agg(F.sum("n").alias("n")).filter("n > 0")
    trial = build(cut_lineage(rest), cells)
    k = len(models.languages)
    models.means, models.spread, models.limits = np.full(k, -np.log(models.uniform)), np.zeros((k, 2)), np.zeros(k)
    if trial is None:
        return
    one = entropies(part.dropDuplicates([label, "_hash"]).select(label, text), trial, text).filter("symbols > 0")
    place = F.array_position(F.array([F.lit(x) for x in trial.languages]), F.col(label)).cast("int")
    others = F.filter(F.transform("entropy", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))), lambda e: e["i"] != F.col("_own"))
    scored = one.withColumn("_own", place).filter("_own > 0").select(
        label, "symbols", F.element_at("entropy", F.col("_own")).alias("h"), F.array_min(others).alias("o"))
    data = scored.select(label, "symbols", "h", F.col("o.h").alias("other"), F.element_at(F.array([F.lit(x) for x in trial.languages]), F.col("o.i").cast("int")).alias("nearest")).toArrow().to_pydict()
    names, nearest = np.array(data[label], dtype=object), np.array(data["nearest"], dtype=object)
    n, h = np.array(data["symbols"], float), np.array(data["h"], float)
    other = np.array([np.inf if x is None else x for x in data["other"]], float)
    # Texts that look more like another language say nothing about those judged to be in their own.
    good = h <= other
    means = {name: np.average(h[own], weights=n[own]) for name in models.languages if (own := good & (names == name)).any()}
    if not means:
        return
    level = np.array([means.get(name, np.nan) for name in names], float)
    for j, name in enumerate(models.languages):
        own = good & (names == name)
        mean = means.get(name, max(means.values()))
        if own.sum() < LEAST_TEXTS:
            # Too few for a spread of their own: the deviations of all languages, to scale.
            own = good
            sizes, values = n[own], h[own] * mean / level[own]
        else:
            sizes, values = n[own], h[own]
        squares = (values - mean) ** 2
        long = sizes >= np.median(sizes)
        base = squares[long].mean()
        short = max(0.0, ((squares - base) * sizes)[~long].mean()) if (~long).any() else base
        floor = (mean * LEAST_SPREAD) ** 2
        models.means[j], models.spread[j] = mean, (max(base, floor), max(short, floor))
        deviations = lambda x, size: (x - mean) / np.sqrt(models.spread[j][0] + models.spread[j][1] / size)  # noqa: B023, E731
        high = max(REJECT_AT / 2, np.quantile(deviations(values, sizes), 0.999))
        foreign = (names != name) & (n >= EVIDENCE) & np.isfinite(other)
        if (foreign & (nearest == name)).sum() >= LEAST_TEXTS:
            foreign &= nearest == name
        low = np.quantile(deviations(other[foreign], n[foreign]), 0.01) if foreign.any() else np.inf
        models.limits[j] = (low + high) / 2 if high < low < np.inf else high if low < np.inf else max(high, REJECT_AT)


def entropies(docs, models, text="text"):
    """``docs`` with ``symbols`` and ``entropy``, one number per language."""
    per = F.transform("_sums", lambda s: -s / F.greatest(F.col("_symbols"), F.lit(1)))
    return with_sums(docs, models, text).withColumns({"symbols": F.col("_symbols"), "entropy": per}).drop(*SUMS)


@sheltered("_key", "_symbols", "_sums")
def identify(docs, models, text="text"):
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``entropy`` of the choice and ``rejected``."""
    if models is None:
        return docs.withColumns({
            "lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "entropy": F.lit(None).cast("double"), "rejected": F.lit(True),
        })
    shared = docs.sparkSession.sparkContext.broadcast(models)
    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "entropy": T.DoubleType(), "rejected": T.BooleanType()}
    if models.entries is None:
        return map_batches(docs, lambda columns: judged(shared.value, *_scorer(shared).texts(columns[text].to_pylist())[:2]), added, reads=[text], limit=SCORED_BYTES)

    def joined(columns):
        sums = columns["_sums"].flatten().to_numpy().reshape(len(columns["_sums"]), -1)
        return judged(shared.value, columns["_symbols"].to_numpy(), sums)

    return map_batches(with_sums(docs, models, text), joined, added, reads=list(SUMS)).drop(*SUMS)


def judged(models, symbols, sums):
    """The added columns, from the number of symbols and the log probability per language."""
    h = -sums / np.maximum(symbols, 1)[:, None]
    best = h.argmin(axis=1)
    rows = np.arange(len(h))
    weight = np.minimum(symbols, EVIDENCE)[:, None]
    score = 1 / np.exp(np.minimum(-(h - h[rows, best][:, None]) * weight, 0)).sum(axis=1)
    base, short = models.spread[best].T
    limit = models.means[best] + models.limits[best] * np.sqrt(base + short / np.maximum(symbols, 1))
    none = symbols == 0
    names = np.array([*models.languages, UNKNOWN], dtype=object)
    return {
        "lang_pred": pa.array(names[np.where(none, len(models.languages), best)], pa.string()),
        "score": pa.array(np.where(none, 0.0, score), pa.float64()),
        "entropy": pa.array(h[rows, best], pa.float64(), mask=none),
        "rejected": pa.array(none | (h[rows, best] > limit), pa.bool_()),
    }


def fold(key, parts):
    """crc32 of a column as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts))
