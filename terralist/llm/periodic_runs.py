"""Runs of repeated words: maximal stretches that keep a period.

The words of a batch of texts become one array of numbers.  How far two places
agree (their LCE) is answered through a difference cover: of every ``COVER``
places only those in the cover are sampled, and any two places reach a pair of
samples after the same, short distance.  So a query compares those few words and,
if they agree, takes the minimum of common windows between the ranks of the two
samples from a sparse table, and compares the words of the window after those.  Only sampled suffixes are sorted, by doubling names
of windows.  The array read backwards gives the same for what lies in front.

Runs are enumerated on a harmonic grid: a stretch of places that equal the word
``q`` later, as long as a run of period ``q`` asks for, holds a multiple of that
length.  The grid of all periods has about n log n places; those with equal words
are extended both ways by LCE.  A stretch found under several periods is a run of
the smallest.

Work is row-wise in Arrow batches: no shuffle, no hot key.  Memory follows the
batch of about four megabytes, or the longest text if that is longer (some 20
numbers a word); the grid goes in blocks.

Defined results: null and empty texts have no words and no runs; rows are
independent, so repeats give repeats; other columns pass through, and the columns
added replace any of the same name.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F, types as T

from terralist.llm.batches import map_batches
from terralist.llm.words import SPACE_CHARS, word_array

#: A perfect difference cover; the differences of its members are all numbers below COVER.
COVER, MEMBERS = 31, (1, 5, 11, 24, 25, 27)
#: Least words of a run, and its least number of periods.
LEAST_WORDS, LEAST_PERIODS = 12, 2
#: Places of the grid looked at together.
BLOCK = 500_000

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_CHARS.encode())] = True


def _meetings():
    """For two places by their remainders, how far ahead both are sampled."""
    sampled = np.zeros(COVER, bool)
    sampled[list(MEMBERS)] = True
    rest = np.arange(COVER)
    table = np.full((COVER, COVER), -1, np.int64)
    for ahead in range(COVER - 1, -1, -1):
        here = sampled[(rest + ahead) % COVER]
        table[np.ix_(here, here)] = ahead
    return table


class CommonPrefixes:
    """LCE queries on an array of numbers from 0 on."""

    def __init__(self, words, longest):
        n, size = len(words), len(MEMBERS)
        blocks = n // COVER + 2
        # Behind the end stands a number that no word has.
        self.words = np.full((blocks + 1) * COVER, -1, np.int32)
        self.words[:n] = words
        self.places = (np.arange(blocks)[:, None] * COVER + np.array(MEMBERS)).ravel()
        self.member = np.zeros(COVER, np.int64)
        self.member[list(MEMBERS)] = np.arange(size)
        self.meetings = _meetings()
        levels = self._names(longest)
        order = np.argsort(levels[-1][:-1], kind="stable")
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self._table(self._neighbours(levels, order))

    def _names(self, longest):
        """Names of windows of 1, 2, 4, ... times COVER words at all samples; 0 stands for none."""
        m, size = len(self.places), len(MEMBERS)
        mixed = np.zeros(m, np.uint64)
        for k in range(COVER):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + self.words[self.places + k].astype(np.uint64)
            mixed ^= mixed >> np.uint64(31)
        _, first, names = np.unique(mixed, return_index=True, return_inverse=True)
        like = self.places[first[names]]
        if any((self.words[self.places + k] != self.words[like + k]).any() for k in range(COVER)):
            # Two windows share a hash: name them by what they hold.
            windows = self.words[self.places[:, None] + np.arange(COVER)]
            names = np.unique(windows, axis=0, return_inverse=True)[1].ravel()
        levels, width = [np.append(names + 1, 0)], 1
        while width * COVER < longest and levels[-1].max() < m:
            behind = np.zeros(m, np.int64)
            behind[:max(0, m - width * size)] = levels[-1][width * size:m]
            names = np.unique(levels[-1][:m] * (m + 1) + behind, return_inverse=True)[1]
            levels.append(np.append(names + 1, 0))
            width *= 2
        return levels

    def _neighbours(self, levels, order):
        """Whole windows that each sampled suffix shares with the next in order."""
        m, size = len(order), len(MEMBERS)
        a, b = order[:-1], order[1:]
        known = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a] == levels[k][b]
            known += same * (1 << k)
            a, b = np.minimum(a + same * (size << k), m), np.minimum(b + same * (size << k), m)
        return known

    def _table(self, common):
        rows, width = [common.astype(np.int32)], 1
        while 2 * width <= len(common):
            last, row = rows[-1], rows[-1].copy()
            row[:-width] = np.minimum(last[:-width], last[width:])
            rows.append(row)
            width *= 2
        self.table = np.stack(rows)

    def _sample(self, places):
        return places // COVER * len(MEMBERS) + self.member[places % COVER]

    def common(self, i, j):
        """Words that agree from ``i`` and from ``j`` on, for arrays of different places."""
        ahead = self.meetings[i % COVER, j % COVER]
        out = ahead.copy()
        left = np.arange(len(i))
        synchronised = []
        for k in range(COVER):
            met = ahead[left] == k
            synchronised.append(left[met])
            left = left[~met]
            same = self.words[i[left] + k] == self.words[j[left] + k]
            out[left[~same]] = k
            left = left[same]
            if not len(left):
                break
        at = np.concatenate(synchronised)
        a, b = (self.rank[self._sample(p[at] + ahead[at])] for p in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        windows = np.minimum(self.table[k, low], self.table[k, high - (1 << k.astype(np.int64))])
        out[at] += windows.astype(np.int64) * COVER
        # Names of windows have no order of words, so the window that differs is compared.
        x, y = i[at] + out[at], j[at] + out[at]
        for k in range(COVER):
            same = (self.words[x + k] == self.words[y + k]) & (self.words[y + k] >= 0)
            at, x, y = at[same], x[same], y[same]
            if not len(at):
                break
            out[at] += 1
        return out


def find_runs(words, bounds, block=BLOCK):
    """(starts, ends, periods) of the runs of all texts, by text, start and period.

    Text ``t`` holds ``words[bounds[t]:bounds[t + 1]]``; starts and ends are places
    in ``words``.
    """
    none = np.empty(0, np.int64)
    sizes = np.diff(bounds)
    n, longest = len(words), int(sizes.max(initial=0))
    if longest < LEAST_WORDS:
        return none, none, none
    ahead = CommonPrefixes(words, longest)
    back = CommonPrefixes(words[::-1], longest)
    found = []
    # One line for each text and period: how many places of the grid it has.
    periods = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    least = np.maximum(LEAST_WORDS - period, (LEAST_PERIODS - 1) * period)
    places = -(-(sizes[text] - period) // least)
    total = np.cumsum(places)
    at = 0
    while at < len(text):
        begun = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, begun + block, "right")))
        line = np.repeat(np.arange(at, to), places[at:to])
        step = np.arange(len(line)) - (total[line] - places[line] - begun)
        i = bounds[text[line]] + step * least[line]
        j = i + period[line]
        same = words[i] == words[j]
        i, j, line = i[same], j[same], line[same]
        at = to
        if not len(i):
            continue
        begin, end = bounds[text[line]], bounds[text[line] + 1]
        forth = np.minimum(ahead.common(i, j), end - j)
        long = np.minimum(back.common(n - i, n - j), i - begin)
        whole = forth + long >= least[line]
        i, long, forth, q = i[whole], long[whole], forth[whole], period[line[whole]]
        found.append(_smallest(i - long, i + forth + q, q))
    if not found:
        return none, none, none
    starts, ends, periods = _smallest(*map(np.concatenate, zip(*found, strict=True)))
    order = np.lexsort((periods, starts))
    return starts[order], ends[order], periods[order]


def _smallest(starts, ends, periods):
    """Of equal stretches the one of the smallest period."""
    order = np.lexsort((periods, ends, starts))
    starts, ends, periods = starts[order], ends[order], periods[order]
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1]) | (ends[1:] != ends[:-1])
    return starts[new], ends[new], periods[new]


def split_words(column):
    """(words, bounds): the words of a column of texts as one Arrow array, and where each text's begin."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    letters = ~_SPACE[raw]
    follows = np.zeros(len(raw), bool)
    follows[1:] = letters[:-1]
    follows[ends[ends < len(raw)]] = False
    starts = np.flatnonzero(letters & ~follows)
    # Without the spaces, words lie end to end.
    kept = np.cumsum(letters, dtype=np.int64)
    offsets = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[letters].tobytes())])
    return words, np.searchsorted(starts, ends).astype(np.int64)


def _batch(text, count, runs, collapsed, block):
    def batch(columns):
        words, bounds = split_words(columns[text])
        numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts, ends, periods = find_runs(numbers, bounds, block)
        # A word goes if it lies behind the first period of a run.
        level = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(level, starts + periods, 1)
        np.add.at(level, ends, -1)
        kept = np.flatnonzero(np.cumsum(level[:-1]) == 0)
        cuts = np.searchsorted(kept, bounds).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words.take(pa.array(kept))), b" ")
        of = np.searchsorted(starts, bounds)
        base = np.repeat(bounds[:-1], np.diff(of))
        fields = [pa.array(a.astype(np.int64)) for a in (starts - base, ends - starts, periods)]
        listed = pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
        return {count: pa.array(np.diff(bounds)), runs: listed, collapsed: joined.cast(pa.string())}

    return batch


def periodic_runs(docs, text="text", count="n_words", runs="runs", collapsed="collapsed", block=BLOCK):
    """``docs`` with its number of words, its runs, and the text without their repeats.

    Runs are (start, length, period) in words, by start and period.  The collapsed
    text joins by spaces the words that lie in no run behind its first period.
    """
    added = {count: T.LongType(), runs: RUNS, collapsed: T.StringType()}
    return map_batches(docs, _batch(text, count, runs, collapsed, block), added, reads=[text])


def repeat_words(text, key):
    """The text of one row in ten (by a hash of ``key``) made periodic from some word on; others as they are.

    The hash is crc32 of the key's text; its tens choose where and with what period.
    """
    h = F.crc32(F.encode(key.cast("string"), "UTF-8"))
    words = word_array(text)
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    times = F.ceil((n - a) / p)
    period = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    repeated = F.slice(F.flatten(F.array_repeat(period, times.cast("int"))), 1, (n - a).cast("int"))
    periodic = F.array_join(F.concat(F.slice(words, 1, a.cast("int")), repeated), " ")
    return F.when((h % 10 == 0) & (n > 0), periodic).otherwise(text)


def longest_run(runs):
    """The longest of a column of runs, the first among equals; null without any."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("fewer"))))
    return F.when(best.isNotNull(), F.struct((-best["before"]).alias("start"), best["length"].alias("length"), (-best["fewer"]).alias("period")))


def run_lines(runs):
    """Every run as a line ``start,length,period``."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return F.array_join(lines, "")
