"""Removal of repeated substrings by column-wise sorting of text contexts.

Every ``length``-byte string that also starts earlier is removed, earlier in
documents by key, then by place; matches never cross documents.

A collection's suffixes can be sorted column by column: each round inserts one
symbol in front of every document, updates the order by the symbols inserted
(the Burrows-Wheeler transform of the collection so far) and the common prefixes
of neighbours.  To keep rounds few and tasks small whatever the documents, the
columns are those of *contexts*:

* In every window of ``length`` bytes, the k-byte gram of least hash is its
  anchor.  The choice depends on the window only, so equal windows have equal
  anchors at equal places, and about one gram in thirty is an anchor.
* Anchors are range-sorted by gram, by the hash of the context (all bytes of
  the windows an anchor may belong to), then by place.  Of equal contexts all
  but the first are repeats as a whole.  Ranges split a gram that many share;
  grams at the ends of a range are passed on as if they were shared.
* First contexts whose gram occurs in other contexts too are fetched and sorted
  column by column, in blocks of bounded size; neighbours whose common prefix
  reaches ``length`` hold the same window, and all but the first are repeats.
  Equal windows stand at the same column, so a round needs the suffixes of that
  column only, and the sequential files of the method are the block's arrays.
* Grams with more contexts than a block may hold are settled by the hashes of
  their windows, as an aggregate that combines before the shuffle.

Defined results: null and short texts keep all bytes; a null key comes last;
rows equal in key and text count as one document and keep the same bytes; rows
with one key and different texts are ordered by a hash of the text; an empty
table gives an empty result; other columns pass through, those named as an added
one are replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from terralist.llm.batches import map_batches, pieces, sheltered, vacate
from terralist.session import cut_lineage

LENGTH = 100
GRAM = 32
BLOCK_CONTEXTS = 100_000
SEGMENT = 1 << 20
LAST = 1 << 62

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: One odd-looking number per byte value, from a mix of its value.
_SYMBOLS = None


def mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(which, count):
    """The first ``count`` powers of the base (0) or of its inverse (1) modulo 2**64."""
    if len(_powers[which]) < count:
        steps = np.full(max(count, 1 << 14), (_BASE, _INVERSE)[which], np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:count]


class Rolling:
    """Hashes of any substrings of one array of bytes."""

    def __init__(self, data):
        global _SYMBOLS
        if _SYMBOLS is None:
            _SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SYMBOLS[data] * _power(0, len(data)), out=self.sums[1:])

    def of(self, start, stop):
        return mixed((self.sums[stop] - self.sums[start]) * _power(1, len(self.sums))[start])


def sliding(values, width, pick):
    """``pick`` (minimum or maximum) over each ``width`` values in a row."""
    n = len(values)
    pad = -n % width
    edge = np.full(pad, np.iinfo(values.dtype).max if pick is np.minimum else 0, values.dtype)
    rows = np.concatenate([values, edge]).reshape(-1, width)
    ahead = pick.accumulate(rows, axis=1).ravel()
    back = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n - width + 1], ahead[width - 1:n])


def anchors(data, length=LENGTH, gram=GRAM):
    """(positions, gram hashes, context hashes) of a document's anchors."""
    n, side, width = len(data), length - gram, length - gram + 1
    if n < length:
        none = np.empty(0, np.uint64)
        return np.empty(0, np.int64), none, none
    found = []
    for begin in range(0, n - length + 1, SEGMENT):
        # The windows that start in this segment, and their contexts.
        first, stop = max(0, begin - side), min(n, begin + SEGMENT + 2 * length)
        rolling = Rolling(data[first:stop])
        size = stop - first
        grams = rolling.of(np.arange(size - gram + 1), np.arange(gram, size + 1))
        own = grams[begin - first:min(begin + SEGMENT + length - 1, n) - gram + 1 - first]
        low = sliding(own, width, np.minimum)
        rim = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(sliding(np.concatenate([rim, low, rim]), width, np.maximum) == own) + begin
        left, right = np.maximum(chosen - side, 0), np.minimum(chosen + gram + side, n)
        context = rolling.of(left - first, right - first) ^ mixed(((chosen - left) * 4096 + right - left).astype(np.uint64))
        found.append((chosen, grams[chosen - first], context))
    if len(found) == 1:
        return found[0]
    position, g, context = (np.concatenate(x) for x in zip(*found, strict=True))
    _, at = np.unique(position, return_index=True)
    return position[at], g[at], context[at]


def _bytes(text):
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def anchor_rows(docs, length, gram):
    """(gram, context, doc, place): ``place`` holds 31 bits of text hash and the position."""
    def read(batches):
        vacate()
        for batch in batches:
            for piece in pieces(batch):
                rows = []
                for doc, own, text in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True):
                    if text and len(text) * 4 >= length:
                        position, g, context = anchors(_bytes(text), length, gram)
                        rows.append((g.view(np.int64), context.view(np.int64), np.full(len(g), doc), position + (own << 32)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x), pa.int64()) for x in zip(*rows, strict=True)], names=["gram", "context", "doc", "place"])

    return docs.select("_doc", "_own", "_text").mapInArrow(read, "gram long, context long, doc long, place long")


def judge(rows):
    """(repeat, gram, doc, place) of sorted anchors.

    ``repeat`` is true for places whose context stands earlier too; the others
    are first places of contexts whose gram other contexts have as well.
    """
    def read(batches):
        vacate()
        last_gram = last_context = last_place = None
        held, first = None, True

        def out(table, repeat):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(table.num_rows, repeat)), table.column(0), table.column(2), table.column(3)], names=["repeat", "gram", "doc", "place"])

        for batch in batches:
            if not batch.num_rows:
                continue
            g, c, d, p = (batch.column(i).to_numpy() for i in range(4))
            before = lambda x, last: np.concatenate([[x[0] if last is None else last], x[:-1]])
            new = (g != before(g, last_gram)) | (c != before(c, last_context))
            if last_gram is None:
                new[0] = True
                same = np.zeros(len(g), bool)
                same[1:] = (d[1:] == d[:-1]) & (p[1:] == p[:-1]) & ~new[1:]
            else:
                same = (d == before(d, last_place[0])) & (p == before(p, last_place[1])) & ~new
            last_gram, last_context, last_place = g[-1], c[-1], (d[-1], p[-1])
            yield out(batch.filter(pa.array(~new & ~same)), True)
            firsts = batch.filter(pa.array(new))
            held = firsts if held is None else pa.concat_batches([held, firsts])
            if not held.num_rows:
                continue
            g = held.column(0).to_numpy()
            ready = int(np.searchsorted(g, g[-1]))
            if ready:
                begins = np.flatnonzero(np.append(True, g[1:ready] != g[:ready - 1]))
                sizes = np.diff(np.append(begins, ready))
                many = sizes > 1
                many[0] |= first
                first = False
                yield out(held.slice(0, ready).filter(pa.array(np.repeat(many, sizes))), False)
                held = held.slice(ready)
            if held.num_rows > 50_000:
                yield out(held.slice(0, held.num_rows - 1), False)
                held, first = held.slice(held.num_rows - 1), True
        if held is not None and held.num_rows:
            yield out(held, False)

    order = ["gram", "context", "doc", "place"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ranges.mapInArrow(read, "repeat boolean, gram long, doc long, place long"))


def packed(docs):
    """``docs`` with the text as compressed bytes, which is what is shuffled."""
    def batch(columns):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        return {"_packed": pa.array([None if t is None else press.compress(t.encode("utf-8", "surrogatepass")) for t in columns["_text"].to_pylist()], pa.binary())}

    return map_batches(docs, batch, {"_packed": T.BinaryType()}, reads=["_text"]).drop("_text")


def unpack(data):
    import zstandard

    return b"" if data is None else zstandard.ZstdDecompressor().decompress(data)


def contexts(docs, places, length, gram):
    """(gram, doc, place, left, data) of the contexts at ``places``."""
    side = length - gram

    def read(batches):
        vacate()
        for batch in batches:
            for piece in pieces(batch, 2 << 20):
                rows = []
                for doc, data, wanted in zip(*(piece.column(c).to_pylist() for c in ("doc", "_packed", "wanted")), strict=True):
                    text = unpack(data)
                    for w in wanted:
                        at = w["place"] & 0xFFFFFFFF
                        left = max(0, at - side)
                        rows.append((w["gram"], doc, w["place"], at - left, text[left:at + gram + side]))
                    if len(rows) > 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["gram", "doc", "place", "left", "data"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["gram", "doc", "place", "left", "data"])

    own = F.shiftright("place", 32).alias("own")
    grouped = places.groupBy("doc", own).agg(F.collect_list(F.struct("gram", "place")).alias("wanted"))
    texts = packed(docs.select("_doc", "_own", "_text")).dropDuplicates(["_doc", "_own"])
    joined = texts.join(grouped, (F.col("_doc") == F.col("doc")) & (F.col("_own") == F.col("own")))
    return joined.select("doc", "_packed", "wanted").mapInArrow(read, "gram long, doc long, place long, left long, data binary")


def range_minimum(values, low, high):
    """Minimum of ``values[low..high]`` for each pair of bounds."""
    span = high - low + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    tables = [values]
    for k in range(int(level.max(initial=0))):
        tables.append(np.minimum(tables[-1][:-(1 << k)], tables[-1][1 << k:]))
    out = np.empty(len(low), values.dtype)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(tables[k][low[at]], tables[k][high[at] - (1 << int(k)) + 1])
    return out


def repeated_windows(data, left, sizes, rank, length=LENGTH, gram=GRAM):
    """Matrix (context, column): the window that starts there stands in a context of lower rank.

    ``data`` is the joined bytes of the contexts; anchors are aligned.  Columns
    are inserted from the last to the first.
    """
    m, side = len(left), length - gram
    columns = 2 * side + gram
    symbols = np.zeros((columns, m), np.uint8)
    owner = np.repeat(np.arange(m), sizes)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[inside + np.repeat(side - left, sizes), owner] = data
    begin, end = side - left, side - left + sizes
    order = np.arange(m)
    common = np.zeros(m, np.uint8)
    repeats = np.zeros((m, side + 1), bool)
    for c in range(columns - 1, -1, -1):
        inserted = symbols[c][order]
        perm = np.argsort(inserted, kind="stable")
        now = inserted[perm]
        equal = np.flatnonzero(now[1:] == now[:-1]) + 1
        longer = np.zeros(m, np.uint8)
        if len(equal):
            longer[equal] = np.minimum(range_minimum(common, perm[equal - 1] + 1, perm[equal]), length - 1) + 1
        order, common = order[perm], longer
        if c <= side:
            starts = np.flatnonzero(common < length)
            if len(starts) < m:
                valid = (begin[order] <= c) & (end[order] >= c + length)
                ranks = np.where(valid, rank[order], np.iinfo(np.int64).max)
                lowest = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, m)))
                repeats[order, c] = valid & (ranks > lowest)
    return repeats


def spans_of(repeats, position, length=LENGTH, gram=GRAM):
    """(context, start, end) of the runs of repeated windows."""
    side = length - gram
    edges = np.diff(np.pad(repeats, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    _, after = np.nonzero(edges == -1)
    start = position[row] - side + first
    return row, start, start + (after - first) - 1 + length


def sort_blocks(rows, length, gram, block):
    """(doc, own, start, end) of repeats among contexts that come sorted by gram."""
    def settle(table):
        doc, place = table.column("doc").to_numpy(), table.column("place").to_numpy()
        # Equal places are one occurrence and get one rank.
        by = np.lexsort((place, doc))
        step = np.append(0, (doc[by][1:] != doc[by][:-1]) | (place[by][1:] != place[by][:-1]))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(step)
        values = table.column("data")
        data = np.frombuffer(b"".join(values.to_pylist()), np.uint8)
        sizes = pa.compute.binary_length(values).to_numpy().astype(np.int64)
        repeats = repeated_windows(data, table.column("left").to_numpy(), sizes, rank, length, gram)
        row, start, end = spans_of(repeats, place & 0xFFFFFFFF, length, gram)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[row]), pa.array(place[row] >> 32), pa.array(start), pa.array(end)], names=["doc", "own", "start", "end"])

    def read(batches):
        vacate()
        import pyarrow.compute  # noqa: F401

        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            if held.num_rows >= block:
                g = held.column(0).to_numpy()
                ready = int(np.flatnonzero(np.append(True, g[1:] != g[:-1]))[-1])
                if ready:
                    yield settle(held.slice(0, ready))
                    held = held.slice(ready)
        if held is not None and held.num_rows:
            yield settle(held)

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(read, "doc long, own long, start long, end long")


def window_spans(rows, length, gram):
    """The same for grams with many contexts, by hashes of their windows."""
    def read(batches):
        vacate()
        for batch in batches:
            for doc, place, left, data in zip(*(batch.column(c).to_pylist() for c in ("doc", "place", "left", "data")), strict=True):
                b = np.frombuffer(data, np.uint8)
                at = np.arange(max(0, left + gram - length), min(left, len(b) - length) + 1)
                h = Rolling(b).of(at, at + length).view(np.int64)
                second = Rolling(b[::-1].copy()).of(len(b) - at - length, len(b) - at).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(h), pa.array(second), pa.array(np.full(len(at), doc)), pa.array(np.full(len(at), place >> 32)),
                    pa.array((place & 0xFFFFFFFF) - left + at),
                ], names=["h", "second", "doc", "own", "start"])

    windows = cut_lineage(rows.mapInArrow(read, "h long, second long, doc long, own long, start long"))
    first = cut_lineage(windows.groupBy("h", "second").agg(F.min(F.struct("doc", "own", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    later = windows.join(first, ["h", "second"]).filter(F.struct("doc", "own", "start") > F.col("first"))
    return later.select("doc", "own", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs, length=LENGTH, gram=GRAM, block=BLOCK_CONTEXTS):
    """(doc, own, start, end) of repeats; ``docs`` has _doc, _own and _text."""
    side = length - gram
    judged = judge(anchor_rows(docs, length, gram))
    position = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    whole = judged.filter("repeat").select(
        "doc", F.shiftright("place", 32).alias("own"), F.greatest(position - side, F.lit(0)).alias("start"), (position + gram + side).alias("end"))
    places = judged.filter("NOT repeat").select("gram", "doc", "place")
    crowded = cut_lineage(places.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block).select("gram"))
    fetched = contexts(docs, places, length, gram)
    if crowded.isEmpty():
        return whole.unionByName(sort_blocks(fetched, length, gram, block))
    fetched = cut_lineage(fetched)
    return (
        whole.unionByName(sort_blocks(fetched.join(crowded, "gram", "left_anti"), length, gram, block))
        .unionByName(window_spans(fetched.join(crowded, "gram", "left_semi"), length, gram))
    )


@sheltered("_doc", "_own", "_text", "_packed", "_spans", "doc", "own")
def remove_repeats(docs, key="doc_id", text="text", length=LENGTH, gram=GRAM, block=BLOCK_CONTEXTS, characters=False):
    """``docs`` with the bytes ``kept`` in place of the text, ``n_bytes`` and ``spans`` removed (start, end).

    With ``characters``, spans shrink to whole characters, so ``kept`` is text.
    """
    added = ("n_bytes", "spans", "kept")
    docs = docs.select([c for c in docs.columns if c not in added])
    named = docs.withColumns({
        # Rows without an id are told apart by 93 bits of their text's hashes.
        "_doc": F.coalesce(F.col(key).cast("long"), F.lit(LAST) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(1)), 2)),
        "_own": F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 33),
        "_text": F.col(text),
    })
    spans = repeated_spans(named, length, gram, block)
    per_doc = spans.groupBy("doc", "own").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    texts = packed(named.drop(text))
    joined = texts.join(per_doc, (F.col("_doc") == F.col("doc")) & (F.col("_own") == F.col("own")), "left").drop("doc", "own")

    def cut(columns):
        sizes, spans, kept = [], [], []
        for data, found in zip(columns["_packed"].to_pylist(), columns["_spans"], strict=True):
            raw = unpack(data)
            merged, parts, at = [], [], 0
            if found.is_valid:
                start, end = (found.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                by = np.argsort(start, kind="stable")
                start, end = start[by], np.minimum(np.maximum.accumulate(end[by]), len(raw))
                new = np.append(True, start[1:] > end[:-1])
                begins = np.flatnonzero(new)
                for a, b in zip(start[begins].tolist(), end[np.append(begins[1:] - 1, len(end) - 1)].tolist(), strict=True):
                    if characters:
                        while a < b and raw[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                            b -= 1
                        if a == b:
                            continue
                    parts.append(raw[at:a])
                    merged.append({"start": a, "end": b})
                    at = b
            parts.append(raw[at:])
            sizes.append(len(raw))
            spans.append(merged)
            kept.append(b"".join(parts))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return {"n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())}

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    done = map_batches(joined, cut, {"n_bytes": T.LongType(), "spans": T.ArrayType(span), "kept": T.BinaryType()}, reads=["_packed", "_spans"])
    return done.drop("_doc", "_own", "_packed", "_spans")
