"""N-gram Jaccard join with several global token orders.

A document's set holds the hashes of its distinct word n-grams.  If two sets are
similar enough, their first tokens share one under *any* order of all tokens:
the smaller set's first ``near`` tokens meet the larger set's first ``far``.  The
first order makes candidates from an index of these tokens; under the second and
the third order a pair then has to share as many of its first tokens as its
sizes imply before its sets are compared in full.  All orders put tokens of frequent words and frequent tokens last, by
classes from two sketches over all documents; within a class each has its own
hash order.

Where copies pile up, no pairs are written within a group:

* equal sets are one vertex, whatever their number;
* index entries without an entry of another set of like size for their token
  are dropped before anything is joined;
* first every set meets the smallest set of each of its tokens only; those
  linked to it become one component, and after that only pairs across components
  are formed.  Links inside a component cannot change the result.

Defined results: null texts and texts without words have an empty set, size 0
and no links; rows are told apart by themselves, so repeated rows and ids link
like other equal texts; a null id is never the smallest; an empty table gives an
empty result; extra columns are not read.  Sets and n-grams are 64-bit hashes.
"""

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from terralist.llm.batches import held, pieces
from terralist.operators.spatial import connected_labels
from terralist.session import cut_lineage

SIZE = 4
PERCENT = 85
#: Buckets of the frequency sketch (a power of two); it bounds what is broadcast.
BUCKETS = 1 << 20
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
FILTER_BITS = 1 << 23
WORDS = 500_000
#: Bytes of text made into sets at a time; a worker holds many times that in words.
TEXT_BYTES = 1 << 20


class WordHashes(dict):
    """Word -> 64-bit hash; forgets when full."""

    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh3_64_intdigest

    def __missing__(self, word):
        if len(self) >= WORDS:
            self.clear()
        h = self[word] = self.digest(word)
        return h


def mixed(x, seed=0x9E3779B97F4A7C15):
    """A bijective mix of 64-bit numbers, one per odd seed."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(seed)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def words_of(texts):
    """(hashes of all words joined, where each text's words start and end)."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    known = held("jaccard", "words", WordHashes)
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64, int(counts.sum()))
    ends = np.cumsum(counts)
    return flat, (ends - counts).tolist(), ends.tolist()


def shingle_sets(texts, size=SIZE, frequency=None):
    """Sorted distinct n-gram hashes of each text.

    With a ``Frequency``, (set, class of each token) of each text.
    """
    return sets_of_words(*words_of(texts), size, frequency)


def sets_of_words(flat, starts, ends, size=SIZE, frequency=None):
    grams = np.zeros(len(flat), np.uint64)
    kinds = np.zeros(len(flat), np.uint8) if frequency is None else frequency.of_words(flat)
    rarest = kinds.copy()
    if len(flat) >= size:
        last = len(flat) - size + 1
        h = flat[:last].copy()
        for k in range(1, size):
            h = mixed(h) + flat[k:last + k]
            np.minimum(rarest[:last], kinds[k:last + k], out=rarest[:last])
        grams[:last] = mixed(h)
    sets = []
    for a, b in zip(starts, ends, strict=True):
        if b - a >= size:
            # Sorting is several times as fast as numpy's own search for distinct values.
            given = grams[a:b - size + 1]
            at = None if frequency is None else np.argsort(given)
            tokens = np.sort(given) if at is None else given[at]
            first = np.append(True, tokens[1:] != tokens[:-1])
            tokens = tokens[first]
            own = None if at is None else rarest[a:b - size + 1][at[first]]
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                h = mixed(h) + flat[k:k + 1]
            tokens, own = mixed(h), kinds[a:b].min(keepdims=True)
        else:
            tokens, own = np.empty(0, np.uint64), np.empty(0, np.uint8)
        sets.append(tokens if frequency is None else (tokens, np.minimum(own + frequency.of_tokens(tokens), 63)))
    return sets


class Frequency:
    """Classes of frequency from two sketches of fixed size, of words and of tokens.

    A token's class is that of its rarest word plus its own.  Buckets only hold
    sums, so that a class may be too high: that costs candidates, never links.
    """

    def __init__(self, words, tokens):
        self.words, self.tokens = words, tokens
        self.shift = np.uint64(64 - int(len(tokens)).bit_length() + 1)

    @staticmethod
    def classes(counts):
        mean = max(1.0, counts.sum() / len(counts))
        return np.minimum(np.log2(np.maximum(counts / mean, 1)), 63).astype(np.uint8)

    def of_words(self, hashes):
        return self.words[hashes >> self.shift]

    def of_tokens(self, tokens):
        return self.tokens[tokens >> self.shift]


def vertex(tokens):
    """64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = mixed(tokens, ORDERS[1]).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def far(n, percent=PERCENT):
    """How many first tokens of a set of ``n`` can hold the first shared one."""
    return n - -(-percent * n // 100) + 1


def near(n, percent=PERCENT):
    """The same for the smaller set of a pair."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def first_tokens(tokens, classes, order, count):
    """The first ``count`` tokens in the given order: by class, then by hash."""
    rank = mixed(tokens, order) >> np.uint64(6) | classes.astype(np.uint64) << np.uint64(58)
    return tokens[np.argsort(rank)[:count]]


def _each_text(batches, size, frequency):
    """(rows, sets) for pieces of the batches: the text is the last column."""
    for batch in batches:
        for piece in pieces(batch, TEXT_BYTES):
            yield piece, shingle_sets(piece.column(piece.num_columns - 1).to_pylist(), size, frequency)


def profiles(docs, key, text, size, buckets):
    """(key, n, v) per row, and the ``Frequency`` of words and tokens."""
    parts = 64

    def read(batches):
        counts = np.zeros((2, buckets), np.int64)
        shift = np.uint64(64 - int(buckets).bit_length() + 1)
        kind = None
        for piece in (p for batch in batches for p in pieces(batch, TEXT_BYTES)):
            kind = piece.schema.types[0]
            flat, starts, ends = words_of(piece.column(1).to_pylist())
            sets = sets_of_words(flat, starts, ends, size)
            for row, hashes in enumerate((flat, np.concatenate([*sets, np.empty(0, np.uint64)]))):
                counts[row] += np.bincount((hashes >> shift).astype(np.int64), minlength=buckets)
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([vertex(s) if len(s) else None for s in sets], pa.int64()),
                pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary()),
            ], names=["key", "n", "v", "block", "counts"])
        blocks = counts.reshape(2 * parts, -1)
        used = np.flatnonzero(blocks.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(used), kind), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()),
                pa.array(used, pa.int32()), pa.array([blocks[b].astype(np.uint32).tobytes() for b in used], pa.binary()),
            ], names=["key", "n", "v", "block", "counts"])

    def add(group, frame):
        total = np.zeros(buckets // parts, np.int64)
        for data in frame.column("counts"):
            part = data.as_buffer()
            total += np.frombuffer(part, np.uint32 if part.size == 4 * len(total) else np.int64).astype(np.int64)
        return pa.table({"block": pa.array([group[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    kind = docs.schema[key].dataType.simpleString()
    both = cut_lineage(docs.select(key, text).mapInArrow(read, f"key {kind}, n long, v long, block int, counts binary"))
    # Sums of the sketches in two steps, so that no task adds up those of all tasks.
    sketches = both.filter("block IS NOT NULL").select("block", "counts", F.spark_partition_id().alias("p"))
    some = sketches.withColumn("some", F.floor(F.col("p") / 64)).groupBy("block", "some").applyInArrow(add, "block int, counts binary")
    sums = some.groupBy("block").applyInArrow(add, "block int, counts binary")
    counts = np.zeros((2 * parts, buckets // parts), np.int64)
    for row in sums.collect():
        counts[row["block"]] = np.frombuffer(row["counts"], np.int64)
    words, tokens = counts.reshape(2, -1)
    return both.filter("block IS NULL").select("key", "n", "v"), Frequency(Frequency.classes(words), Frequency.classes(tokens))


def shared_tokens(docs, text, frequency, size, percent):
    """(token, v, n, low): index entries of tokens that two sets of like size have.

    ``low`` marks the entries the smaller set of a pair may be found by.  Tokens
    of frequent buckets are dealt out by set as well and kept unseen, so that a
    token that many sets share does not meet in one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequency)

    def entries(batches):
        seen = set()
        for _, sets in _each_text(batches, size, shared.value):
            parts = []
            for s, classes in sets:
                if len(s):
                    v, n = vertex(s), len(s)
                    if v in seen:
                        continue
                    seen.add(v)
                    first = first_tokens(s, classes, ORDERS[0], far(n, percent))
                    spread = np.where(shared.value.of_tokens(first) > 0, 1 + (v & 63), 0)
                    parts.append((first.view(np.int64), np.full(len(first), v), np.full(len(first), n), np.arange(len(first)) < near(n, percent), spread))
            if len(seen) > 1_000_000:
                seen.clear()
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32()), strict=True)],
                    names=["token", "v", "n", "low", "spread"],
                )

    def repeated(batches):
        """Entries with a set of like size next to them: the rows come sorted by token, size and set."""
        held, held_good = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            token, v = (rows.column(i).to_numpy() for i in (0, 1))
            rows = rows.filter(pa.array(np.append(True, (token[1:] != token[:-1]) | (v[1:] != v[:-1]))))
            token, n, spread = (rows.column(i).to_numpy().astype(np.int64) for i in (0, 2, 4))
            good = np.append(held_good, (token[1:] == token[:-1]) & (percent * n[1:] <= 100 * n[:-1]))
            keep = good | (spread > 0)
            keep[:-1] |= good[1:]
            yield rows.slice(0, rows.num_rows - 1).filter(pa.array(keep[:-1])).select(["token", "v", "n", "low"])
            held, held_good = rows.slice(rows.num_rows - 1), bool(good[-1])
        if held is not None and (held_good or held.column(4)[0].as_py() > 0):
            yield held.select(["token", "v", "n", "low"])

    index = docs.select(text).mapInArrow(entries, "token long, v long, n int, low boolean, spread int")
    dealt = index.repartition("token", "spread").sortWithinPartitions("token", "n", "v")
    return cut_lineage(dealt.mapInArrow(repeated, "token long, v long, n int, low boolean"))


def bit_filter(values, column, bits=FILTER_BITS):
    """A bit array of fixed size with a bit for each value."""
    position = F.pmod(F.col(column), F.lit(bits))
    words = values.select(position.alias("p")).groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
    out = np.zeros(bits // 64, np.uint64)
    table = words.toArrow()
    out[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return out


def short(tokens):
    """Tokens as 16-bit hashes: a set of them may seem larger in common, never smaller."""
    return (tokens >> np.uint64(48)).astype(np.uint16).tobytes()


def _wanted_sets(docs, text, wanted, frequency, size, bits, columns, schema):
    """Columns computed of each set in ``wanted``, one row per set, written once."""
    shared = docs.sparkSession.sparkContext.broadcast((frequency, bit_filter(wanted, "v", bits)))

    def read(batches):
        frequency, passes = shared.value
        seen = set()
        for _, sets in _each_text(batches, size, frequency):
            rows = []
            for s, classes in sets if frequency is not None else ((s, None) for s in sets):
                if not len(s):
                    continue
                v = vertex(s)
                p = v % bits
                if v in seen or not int(passes[p >> 6]) >> (p & 63) & 1:
                    continue
                seen.add(v)
                rows.append((v, len(s), *columns(s, classes)))
            if len(seen) > 1_000_000:
                seen.clear()
            if rows:
                arrays = [pa.array(c, pa.int64() if i < 2 else pa.binary()) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["v", "n", *schema]
    found = docs.select(text).mapInArrow(read, ", ".join(["v long", "n long", *(f"{c} binary" for c in schema)]))
    return cut_lineage(found.dropDuplicates(["v"]))


def order_sketches(docs, text, wanted, frequency, size, percent, bits=FILTER_BITS):
    """(v, n, second, third): first tokens under the other two orders, as short hashes."""
    def columns(s, classes):
        return [short(first_tokens(s, classes, o, far(len(s), percent))) for o in ORDERS[1:]]

    return _wanted_sets(docs, text, wanted, frequency, size, bits, columns, ["second", "third"])


def whole_sets(docs, text, wanted, size, bits=FILTER_BITS):
    """(v, n, tokens) of the sets in ``wanted``."""
    return _wanted_sets(docs, text, wanted, None, size, bits, lambda s, _: [s.tobytes()], ["tokens"])


def least_shared(nx, ny, percent):
    """How many of their first tokens two sets have to share under any order.

    Whichever set's first tokens end first, those it shares are first tokens of
    both up to there, and at most all that follow are shared.
    """
    needed = -(-percent * (nx + ny) // (100 + percent))
    return max(1, needed - max(nx - far(nx, percent), ny - far(ny, percent)))


def passing(pairs, sketches, percent=PERCENT):
    """The (x, y) of ``pairs`` that share enough first tokens under the second and the third order."""
    def orders(batches):
        for batch in batches:
            keep = []
            for nx, ny, x2, x3, y2, y3 in zip(*(batch.column(i).to_pylist() for i in range(2, 8)), strict=True):
                least = least_shared(nx, ny, percent)
                keep.append(all(
                    np.count_nonzero(np.isin(np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16), kind="sort")) >= least
                    for a, b in ((x2, y2), (x3, y3))
                ))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: sketches.select(F.col("v").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "second", "third")])
    tested = pairs.join(side("x"), "x").join(side("y"), "y")
    return cut_lineage(tested.select("x", "y", "x_n", "y_n", "x_second", "x_third", "y_second", "y_third").mapInArrow(orders, "x long, y long"), count=True)


def linked(pairs, sets, percent=PERCENT):
    """The (x, y) of ``pairs`` whose whole sets are similar enough."""
    def verify(batches):
        for batch in batches:
            for piece in pieces(batch):
                keep = []
                for a, b in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True):
                    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield piece.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: sets.select(F.col("v").alias(name), F.col("tokens").alias(f"{name}_tokens"))
    whole = pairs.join(side("x"), "x").join(side("y"), "y")
    return cut_lineage(whole.select("x", "y", "x_tokens", "y_tokens").mapInArrow(verify, "x long, y long"))


def near_enough(percent):
    """Condition on sizes: n of the smaller set, m of the larger one."""
    return (F.col("n") <= F.col("m")) & (100 * F.col("n") >= percent * F.col("m"))


def set_components(docs, frequency, text="text", size=SIZE, percent=PERCENT, stars=1):
    """(v, root) of the sets that share tokens: components of all links."""
    shared = shared_tokens(docs, text, frequency, size, percent)
    sketches = order_sketches(docs, text, shared, frequency, size, percent)
    links, labels = None, None
    for star in range(stars + 1):
        entries = shared if labels is None else shared.join(labels, "v")
        if labels is None:
            entries = entries.withColumn("root", F.col("v"))
        # Tokens of one component only have nothing left to say.
        open_tokens = cut_lineage(
            entries.groupBy("token").agg(
                F.min("root").alias("_a"), F.max("root").alias("_b"),
                F.min(F.when(F.col("low"), F.struct("n", F.xxhash64("root", F.lit(star)).alias("o"), "v", "root"))).alias("_lead"),
            ).filter("_a <> _b AND _lead IS NOT NULL").select("token", F.col("_lead.n").alias("n"), F.col("_lead.v").alias("x"), F.col("_lead.root").alias("x_root"))
        )
        larger = entries.select("token", F.col("v").alias("y"), F.col("n").alias("m"), F.col("root").alias("y_root"))
        if star < stars:
            smaller = open_tokens
        else:
            smaller = entries.filter("low").join(open_tokens.select("token"), "token", "left_semi").select(
                "token", "n", F.col("v").alias("x"), F.col("root").alias("x_root"))
        pairs = smaller.join(larger, "token").filter(near_enough(percent) & (F.col("x_root") != F.col("y_root"))).select("x", "y")
        passed, count = passing(cut_lineage(pairs.distinct()), sketches, percent)
        if not count:
            continue
        sets = whole_sets(docs, text, passed.select(F.explode(F.array("x", "y")).alias("v")), size)
        found = linked(passed, sets, percent).select(F.col("x").alias("src"), F.col("y").alias("dst"))
        links = found if links is None else links.union(found)
        labels = cut_lineage(
            connected_labels(shared.select(F.col("v").alias("vertex")).distinct(), links).select(F.col("vertex").alias("v"), "root"))
    return shared.select("v", F.col("v").alias("root")).distinct() if labels is None else labels


def near_duplicates(docs, key="doc_id", text="text", size=SIZE, percent=PERCENT, buckets=BUCKETS):
    """(key, n_shingles, component_id) per row; the component is its smallest key."""
    rows, frequency = profiles(docs, key, text, size, buckets)
    labels = set_components(docs, frequency, text, size, percent)
    first = rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("key").alias("_first"))
    named = first.join(labels, "v", "left").withColumn("root", F.coalesce("root", "v"))
    smallest = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    component = cut_lineage(named.join(smallest, "root").select("v", "component_id"))
    linked_rows = rows.filter("v IS NOT NULL").join(component, "v").select("key", "n", "component_id")
    empty = rows.filter("v IS NULL").select("key", "n", F.col("key").alias("component_id"))
    return linked_rows.unionByName(empty).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def near_duplicates_sql(size=SIZE, percent=PERCENT):
    """The same over ``documents`` in DuckDB's SQL, by all shared n-grams."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i : i + {size - 1}], ' '))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT d.doc_id, count(g.g) AS n FROM d LEFT JOIN g ON g.doc_id = d.doc_id GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {percent} * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.n"""
