"""Scoring of whole documents by a gated recurrent language model.

Tokens are words and one end per document.  The output is class-factored: classes
are stretches of the vocabulary in order of frequency, the most frequent words alone
in theirs, the others in classes of balanced mass.  From its state the network (numpy,
one gated layer) predicts the class by a softmax over classes and the word by a softmax
over the words of that class.  Words with parameters of their own are the ``WORDS`` most
frequent; the others of a class are one outcome of it, and a word's share of that outcome
is its smoothed training count.  The network reads these outcomes too.  It is trained
with truncated backpropagation, and its state goes on from window to window, so a
document's score is that of the document as a whole.

* Word counts come from all training documents: tasks add up, one shuffle
  follows.  They are never collected; the bounded table of frequent words is
  broadcast, all other words meet their counts in a join.
* Training takes each training document once.  In every round tasks train on
  their share from the same parameters, and the results are averaged, weighted
  by tokens, in two steps.
* Documents are read in lanes sorted by length, so lanes end together.

Defined results: null and empty texts are one end; rows are scored one by one,
repeated rows alike; without training documents all counts are 0; words unseen
in training share a fixed mass of the last class; other columns pass through, those
named as an added one are replaced.
"""

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from terralist.llm.batches import map_batches, pieces, sheltered
from terralist.session import cut_lineage

END = b" "
#: Words that are a class of their own, and classes of balanced mass of all others.
HEAD, TAIL = 16, 48
#: Words with parameters of their own: the square of the number of classes.
WORDS = (HEAD + TAIL) ** 2
#: Bound of the broadcast table of words.
TABLE = 400_000
HIDDEN = 16
LANES, WINDOW = 512, 16
#: Tokens of a step of training where lanes allow; tokens whose outcomes are scored together.
LEAST_TOKENS, TOGETHER = 4096, 8192
ROUNDS = 3
RATE = 0.01
#: Rate of the words within classes, by the sum of all squares.
RATE_WITHIN = 0.05
#: Bytes of text a task turns into lanes at a time.
CHUNK_BYTES = 8 << 20
FLUSH = 500_000
ADDED = 0.1


def tokens(text):
    """Lower-cased words as bytes, without the end."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def count_words(docs, text="text"):
    """(word, n) over all documents, ends included."""
    def count(batches):
        seen = Counter()

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()

        for batch in batches:
            for piece in pieces(batch):
                for value in piece.column(0).to_pylist():
                    seen.update(tokens(value))
                    seen[END] += 1
                if len(seen) > FLUSH:
                    yield from flush()
        if seen:
            yield from flush()

    return docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary(dict):
    """Word -> index, frequent words first; all others share the index after them.

    ``outcomes`` has the outcome of each index.  Outcomes are numbered class by class,
    class c from ``firsts[c]``: its words with parameters, then one for its other words.
    """

    def __init__(self, words, counts, tokens, kinds):
        super().__init__(zip(words, range(len(words)), strict=True))
        k = self.size = len(words)
        self.tokens, self.kinds = tokens, kinds
        counts, last = np.asarray(counts, float), HEAD + TAIL - 1
        rest = counts[HEAD:]
        middle = (np.cumsum(rest) - rest / 2) / max(1.0, rest.sum())
        # Words outside the table are of the last class, that of the rarest.
        classes = np.concatenate([np.arange(min(HEAD, k)), HEAD + np.minimum(middle * TAIL, TAIL - 1).astype(np.int64), [last]])
        own = np.arange(k + 1) < min(WORDS, k)
        others = np.bincount(classes[~own], minlength=last + 1)
        singles = np.bincount(classes[own], minlength=last + 1)
        self.firsts = np.append(0, np.cumsum(singles + (others > 0)))
        self.outcomes = self.firsts[classes + 1] - 1
        self.outcomes[own] = np.arange(own.sum()) + np.append(0, np.cumsum(others > 0))[classes[own]]
        # Smoothed mass of each class's other words; unseen ones are in the last.
        others[last] += kinds - k
        mass = np.bincount(classes[:k], np.where(own[:k], 0, counts), last + 1) + ADDED * others
        mass[last] += tokens - counts.sum()
        self.logs = np.append(np.log10(counts + ADDED), 0.0)
        # Log share of the outcome: the count of words outside the table is added by the join.
        self.shares = np.where(own, 0.0, self.logs - np.log10(np.maximum(mass, ADDED))[classes])
        outcomes = np.zeros(self.firsts[-1])
        outcomes[self.firsts[1:][others > 0] - 1] = mass[others > 0]
        outcomes[self.outcomes[own]] = counts[own[:k]] + ADDED
        total = np.add.reduceat(np.append(outcomes, 0.0), self.firsts[:-1])
        self.bias = np.log(outcomes / total[classes_of(self.firsts)])
        self.floor = np.log10(tokens + ADDED * (kinds + 1))

    def __missing__(self, word):
        return self.size

    def __reduce__(self):
        return _restored, (list(self), {k: v for k, v in self.__dict__.items()})


def _restored(words, state):
    vocabulary = Vocabulary.__new__(Vocabulary)
    dict.update(vocabulary, zip(words, range(len(words)), strict=True))
    vocabulary.__dict__.update(state)
    return vocabulary


def vocabulary(counts, table=TABLE):
    """The table of frequent words, with the totals of the classes of the others."""
    bins = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("tokens")).collect()
    size, low = 0, 64
    for row in sorted(bins, key=lambda r: -r["b"]):
        if size + row["kinds"] > table:
            break
        size, low = size + row["kinds"], row["b"]
    frequent = counts.filter(F.col("n") >= F.lit(float(2**low)).cast("double")).toArrow().to_pydict()
    order = sorted(range(len(frequent["n"])), key=lambda i: (-frequent["n"][i], frequent["word"][i]))
    words, numbers = [frequent["word"][i] for i in order], [frequent["n"][i] for i in order]
    return Vocabulary(words, numbers, sum(r["tokens"] for r in bins), sum(r["kinds"] for r in bins))


def classes_of(firsts):
    """The class of each outcome."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


#: Classes of one outcome each.
PLAIN = np.arange(HEAD + TAIL + 1)


def fresh(seed=7, firsts=PLAIN):
    """Parameters: input table (with a row for the start), recurrent weights, weights and bias of the classes and, a row for each outcome, within them."""
    rng = np.random.default_rng(seed)
    classes, outcomes = HEAD + TAIL, int(firsts[-1])
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return [
        small(outcomes + 1, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN), small(HIDDEN, classes), np.zeros(classes, np.float32),
        np.zeros((outcomes, HIDDEN), np.float32), np.zeros(outcomes, np.float32),
    ]


def flat(parameters):
    return np.concatenate([p.ravel() for p in parameters])


def shaped(vector, firsts=PLAIN):
    out, at = [], 0
    for p in fresh(firsts=firsts):
        out.append(vector[at:at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return out


def _gate(x):
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def lanes_of(sequences, lanes=LANES):
    """Groups of sequence numbers of like length, longest first."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    return [order[i:i + lanes] for i in range(0, len(order), lanes)]


def padded(sequences, group):
    """(time, lane) matrix of outcomes, shifted one behind for the inputs (the last row of the table at the start), and lengths."""
    lengths = np.array([len(sequences[i]) for i in group])
    y = np.zeros((int(lengths[0]), len(group)), np.int64)
    for j, i in enumerate(group):
        y[:lengths[j], j] = sequences[i]
    x = np.empty_like(y)
    x[0], x[1:] = -1, y[:-1]
    return x, y, lengths


def forward(parameters, x, state, widths):
    """States of a window; lane count falls with time.  Keeps what the way back needs."""
    table, recurrent = parameters[:2]
    steps, h = [], state
    for t in range(len(x)):
        n = widths[t]
        before = h[:n]
        given = table[x[t, :n]]
        carried = before @ recurrent
        gates = _gate(given[:, :2 * HIDDEN] + carried[:, :2 * HIDDEN])
        keep, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        inner = carried[:, 2 * HIDDEN:]
        new = np.tanh(given[:, 2 * HIDDEN:] + reset * inner)
        after = new + keep * (before - new)
        steps.append((before, keep, reset, inner, new, after))
        h = after
    return steps


def class_logs(parameters, states):
    """Log probabilities of all classes for states joined over time."""
    logits = states @ parameters[2]
    logits += parameters[3]
    # States lie within 1, so the weights bound the logits; beyond that bound the
    # exponential could leave the range of its type and rows are shifted.
    if np.abs(parameters[2]).sum(axis=0).max() + np.abs(parameters[3]).max() > 60:
        logits -= logits.max(axis=1, keepdims=True)
    e = np.exp(logits)
    total = e.sum(axis=1, keepdims=True)
    return logits, e, total


def within(parameters, states, places, own, firsts):
    """(slice of the rows, slice of the outcomes, exponentials, sums, logs of the targets) of each class of several outcomes.

    Rows are sorted by their class, ``own``; ``places`` are their targets.
    """
    weights, bias = parameters[4:]
    begins = np.searchsorted(own, np.arange(len(firsts)))
    for c in np.flatnonzero((np.diff(begins) > 0) & (np.diff(firsts) > 1)).tolist():
        rows, outcomes = slice(begins[c], begins[c + 1]), slice(firsts[c], firsts[c + 1])
        logits = states[rows] @ weights[outcomes].T
        logits += bias[outcomes]
        logits -= logits.max(axis=1, keepdims=True)
        chosen = logits[np.arange(len(logits)), places[rows] - firsts[c]]
        e = np.exp(logits, out=logits)
        total = e.sum(axis=1, keepdims=True)
        yield rows, outcomes, e, total, chosen - np.log(total[:, 0])


def sorted_by_class(states, targets, classes):
    """(order, states, targets, classes) of rows sorted by the class of their target."""
    own = classes[targets]
    order = np.argsort(own.astype(np.uint8), kind="stable")
    return order, states.take(order, axis=0), targets[order], own[order]


def windows(x, y, lengths, window=WINDOW, least=0):
    """(inputs, targets, lanes at each step) of windows of ``window`` steps.

    Where few lanes are left, a window goes on up to ``least`` tokens, 16 times its steps at most.
    """
    widths = np.searchsorted(-lengths, -np.arange(len(x)), side="left")
    ends, t = np.cumsum(widths), 0
    while t < len(x):
        enough = int(np.searchsorted(ends, ends[t] - widths[t] + least)) + 1
        stop = min(max(t + window, min(enough, t + 16 * window)), len(x))
        yield x[t:stop], y[t:stop], widths[t:stop].tolist()
        t = stop


def train(parameters, sequences, moments, firsts=PLAIN):
    """Truncated backpropagation over the sequences of outcomes; changes the parameters in place."""
    classes = classes_of(firsts)
    for group in lanes_of(sequences):
        x, y, lengths = padded(sequences, group)
        state = np.zeros((len(group), HIDDEN), np.float32)
        for wx, wy, widths in windows(x, y, lengths, least=LEAST_TOKENS):
            steps = forward(parameters, wx, state, widths)
            states = np.concatenate([s[5] for s in steps])
            targets = np.concatenate([wy[t, :n] for t, n in enumerate(widths)])
            _, e, total = class_logs(parameters, states)
            share = np.float32(1.0 / len(e))
            e *= share / total
            e[np.arange(len(e)), classes[targets]] -= share
            grads = [None, np.zeros_like(parameters[1]), states.T @ e, e.sum(axis=0)]
            back = e @ parameters[2].T
            order, given, places, own = sorted_by_class(states, targets, classes)
            more = np.zeros_like(given)
            for rows, outcomes, d, total, _ in within(parameters, given, places, own, firsts):
                d *= share / total
                d[np.arange(len(d)), places[rows] - outcomes.start] -= share
                more[rows] = d @ parameters[4][outcomes]
                for k, g in ((4, d.T @ given[rows]), (5, d.sum(axis=0))):
                    squares = moments[2][k][outcomes]
                    squares += g * g
                    g *= np.float32(RATE_WITHIN)
                    g /= np.sqrt(squares) + np.float32(1e-6)
                    parameters[k][outcomes] -= g
            back[order] += more
            inputs = np.empty((len(states), 3 * HIDDEN), np.float32)
            later, at = np.zeros((0, HIDDEN), np.float32), len(states)
            for t in range(len(steps) - 1, -1, -1):
                before, keep, reset, inner, new, _ = steps[t]
                n = widths[t]
                at -= n
                d = back[at:at + n]
                d[:len(later)] += later
                d_new = d * (1 - keep) * (1 - new * new)
                d_gates = inputs[at:at + n]
                d_gates[:, :HIDDEN] = d * (before - new) * keep * (1 - keep)
                d_gates[:, HIDDEN:2 * HIDDEN] = d_new * inner * reset * (1 - reset)
                d_gates[:, 2 * HIDDEN:] = d_new
                carried = d_gates.copy()
                carried[:, 2 * HIDDEN:] *= reset
                grads[1] += before.T @ carried
                later = d * keep + carried @ parameters[1].T
            rows = np.concatenate([wx[t, :n] for t, n in enumerate(widths)])
            by = np.argsort(rows, kind="stable")
            begins = np.flatnonzero(np.append(True, rows[by][1:] != rows[by][:-1]))
            # Of the input table only the rows that were read have a gradient and are moved.
            read = rows[by][begins]
            grads[0] = np.add.reduceat(inputs.take(by, axis=0), begins, axis=0)
            moments[0] += 1
            scale = np.float32(RATE / (1 - 0.9 ** moments[0]))
            level = np.float32(1 - 0.99 ** moments[0])
            for k, g in enumerate(grads):
                np.clip(g, -1, 1, out=g)
                first, second = (m[k].take(read, axis=0) if k == 0 else m[k] for m in moments[1:])
                first += np.float32(0.1) * (g - first)
                g *= g
                g -= second
                g *= np.float32(0.01)
                second += g
                step = np.sqrt(second / level)
                step += np.float32(1e-6)
                np.divide(first, step, out=step)
                step *= scale
                if k == 0:
                    moments[1][k][read], moments[2][k][read] = first, second
                    parameters[k][read] -= step
                else:
                    parameters[k] -= step
            last = steps[-1][5]
            state = np.concatenate([last, state[len(last):]])


def log_likelihoods(parameters, sequences, firsts=PLAIN):
    """log10 probability of each sequence of outcomes."""
    out, classes = np.zeros(len(sequences)), classes_of(firsts)
    held, size = [], 0

    def settle():
        states, targets, owners = map(np.concatenate, zip(*held, strict=True))
        logits, _, total = class_logs(parameters, states)
        logs = logits[np.arange(len(targets)), classes[targets]] - np.log(total[:, 0])
        order, given, places, own = sorted_by_class(states, targets, classes)
        for rows, *_, inner in within(parameters, given, places, own, firsts):
            logs[order[rows]] += inner
        out[:] += np.bincount(owners, logs, len(out))
        held.clear()

    for group in lanes_of(sequences):
        x, y, lengths = padded(sequences, group)
        state, lanes = np.zeros((len(group), HIDDEN), np.float32), np.array(group)
        for wx, wy, widths in windows(x, y, lengths):
            steps = forward(parameters, wx, state, widths)
            held.append((np.concatenate([s[5] for s in steps]), np.concatenate([wy[t, :n] for t, n in enumerate(widths)]), np.concatenate([lanes[:n] for n in widths])))
            size += len(held[-1][1])
            if size >= TOGETHER:
                settle()
                size = 0
            last = steps[-1][5]
            state = np.concatenate([last, state[len(last):]])
    if held:
        settle()
    return out / np.log(10)


def indices(words, texts):
    """Index of each token of each text, the end included."""
    end = words[END]
    for text in texts:
        found = tokens(text)
        out = np.empty(len(found) + 1, np.int64)
        out[:-1] = np.fromiter(map(words.get, found, repeat(words.size)), np.int64, len(found))
        out[-1] = end
        yield found, out


def fit(docs, words, text="text", rounds=ROUNDS, seed=7):
    """Parameters after all rounds; every document is trained on once."""
    spark = docs.sparkSession
    begun = fresh(seed, words.firsts)
    begun[5][:] = words.bias
    vector = flat(begun).astype(np.float64)
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((words, vector))

        def local(batches):
            words, start = shared.value
            parameters = shaped(start, words.firsts)
            moments = [0, [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]]
            seen = 0
            for batch in batches:
                for piece in pieces(batch, CHUNK_BYTES):
                    sequences = [words.outcomes[i] for _, i in indices(words, piece.column(0).to_pylist())]
                    train(parameters, sequences, moments, words.firsts)
                    seen += sum(map(len, sequences))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(flat(parameters).astype(np.float64) * seen).tobytes()], pa.binary())], names=["n", "sums"])

        def add(frame):
            sums = sum(np.frombuffer(x.as_buffer(), np.float64) for x in frame.column("sums"))
            return pa.table({"n": pa.array([sum(frame.column("n").to_pylist())], pa.int64()), "sums": pa.array([sums.tobytes()], pa.binary())})

        share = docs.filter(F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(seed)), F.lit(rounds)) == number).select(text)
        trained = share.mapInArrow(local, "n long, sums binary").withColumn("some", F.floor(F.spark_partition_id() / 64))
        some = trained.groupBy("some").applyInArrow(add, "n long, sums binary")
        rows = some.groupBy(F.lit("all").alias("all")).applyInArrow(add, "n long, sums binary").collect()
        if rows:
            vector = np.frombuffer(rows[0]["sums"], np.float64) / rows[0]["n"]
    return vector


@sheltered("_key", "_logs", "_model", "_rare", "_more", "_known")
def score(docs, counts, words, vector, text="text"):
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs = docs.select([c for c in docs.columns if c not in added])
    shared = docs.sparkSession.sparkContext.broadcast((words, vector))
    rare = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))

    def batch(columns):
        words, start = shared.value
        found = list(indices(words, columns[text].to_pylist()))
        number = np.array([len(i) for _, i in found])
        begins = np.cumsum(number) - number
        joined = np.concatenate([i for _, i in found])
        known, logs, shares = (np.add.reduceat(x, begins) for x in ((joined < words.size).astype(np.int64), words.logs[joined], words.shares[joined]))
        model = log_likelihoods(shaped(start, words.firsts), np.split(words.outcomes[joined], begins[1:]), words.firsts)
        names, times, ends = [], [], [0]
        for own, index in found:
            rare = Counter([own[k] if k < len(own) else END for k in np.flatnonzero(index >= words.size).tolist()])
            names.extend(rare)
            times.extend(rare.values())
            ends.append(len(names))
        others = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(times, pa.int64())], names=["word", "n"]))
        return {
            "n_tokens": pa.array(number, pa.int64()), "n_known": pa.array(known, pa.int64()), "_logs": pa.array(logs, pa.float64()),
            "_model": pa.array(model + shares, pa.float64()), "_rare": others,
        }

    scored = cut_lineage(map_batches(docs.withColumn("_key", F.xxhash64(*docs.columns)), batch, {
        "n_tokens": T.LongType(), "n_known": T.LongType(), "_logs": T.DoubleType(), "_model": T.DoubleType(), "_rare": rare,
    }, reads=[text]).drop(text))
    # Rows alike in all columns share a key and their words.
    asked = scored.select("_key", F.explode("_rare").alias("r")).select("_key", "r.word", "r.n").distinct()
    given = asked.join(counts.withColumnRenamed("n", "c"), "word", "left")
    sums = given.groupBy("_key").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ADDED)).alias("_more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_known"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("_rare").join(sums, "_key", "left").withColumns({
        "n_known": (F.col("n_known") + zero("_known")).cast("long"),
        "train_tokens": F.lit(int(words.tokens)).cast("long"),
        "base_score": F.col("_logs") + zero("_more") - F.col("n_tokens") * F.lit(float(words.floor)),
        "score": F.col("_model") + zero("_more"),
    }).drop("_key", "_logs", "_model", "_more", "_known")


def score_documents(docs, training, text="text"):
    """Count and train on the rows where ``training`` holds; score all rows."""
    rows = docs.filter(training)
    counts = cut_lineage(count_words(rows, text))
    words = vocabulary(counts)
    return score(docs, counts, words, fit(rows, words, text), text)
