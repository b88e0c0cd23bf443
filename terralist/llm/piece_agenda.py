"""Piece encoding and decoding with an agenda of adjacent pairs ordered by score.

For merge-type vocabularies.  The symbols of a text stand in a linked list; an
agenda holds every adjacent pair that is a piece, best score first and leftmost
among equal scores (a heap; for a short word a list).  The best pair is taken off and joined, its neighbours enter
as new pairs, and pairs whose symbols have changed meanwhile are passed over when
they come up.  A symbol left over that is no piece is written as its bytes.

A text is read unit by unit: a unit begins at a space mark, and where the
vocabulary has no piece that holds two neighbouring characters side by side, no
merge can cross, so the unit is cut there.  Units met before come from a table of
bounded size.

Work is row-wise in Arrow batches: no shuffle, no hot key.  With ``check`` the
library encodes the same batch, and a column tells for each row whether the ids
agree.  The model file is read once on the driver (under a megabyte) and travels
with the task.

Defined results: null and empty texts give no ids and the empty text; rows are
independent, so repeats give repeats; other columns pass through, and the columns
added replace any of the same name.
"""

import re
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from terralist.llm.batches import map_batches

#: Units kept per worker, in each of two generations.
UNITS = 500_000
#: Longer units are first cut where nothing joins, and have a heap for their agenda.
SHORT = 24
#: Fixed values of the library: how a space is written, and what stands for the unknown piece.
SPACE_MARK = "▁"
UNKNOWN_SURFACE = " ⁇ "


def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


class Vocabulary:
    """Pieces of a model: ranks of those that merge, ids, and what each id stands for."""

    def __init__(self, model):
        given = library(model)
        ids = range(given.get_piece_size())
        names = [given.id_to_piece(i) for i in ids]
        self.bytes = {int(names[i][3:5], 16): i for i in ids if given.is_byte(i)}
        ordinary = [i for i in ids if not (given.is_byte(i) or given.is_control(i) or given.is_unknown(i))]
        if len(self.bytes) != 256 or any(given.is_unused(i) for i in ordinary):
            raise ValueError("only vocabularies with byte pieces and without unused ones are supported")
        self.ids = {names[i]: i for i in ordinary}
        # Equal scores share a rank: among them the leftmost pair goes first.
        order = {s: r for r, s in enumerate(sorted({given.get_score(i) for i in ordinary}, reverse=True))}
        self.ranks = {names[i]: order[given.get_score(i)] for i in ordinary}
        self.side_by_side = {pair for name in self.ids for pair in zip(name, name[1:], strict=False)}
        if any(b == SPACE_MARK != a for a, b in self.side_by_side):
            raise ValueError("pieces that hold a space after another symbol are not supported")
        self.control = {i for i in ids if given.is_control(i)}
        self.surface = [n.replace(SPACE_MARK, " ").encode() for n in names]
        for byte, i in self.bytes.items():
            self.surface[i] = bytes((byte,))
        for i in self.control:
            self.surface[i] = b""
        for i in ids:
            if given.is_unknown(i):
                self.surface[i] = UNKNOWN_SURFACE.encode()


NONE = 1 << 60


def merge_short(ranks, text):
    """The pieces of a short ``text``: its agenda is a list by place, searched for the best entry."""
    parts, rank = list(text), ranks.get
    agenda = [rank(a + b, NONE) for a, b in zip(text, text[1:], strict=False)]
    while agenda:
        best = min(agenda)
        if best == NONE:
            break
        i = agenda.index(best)
        joined = parts[i] + parts[i + 1]
        parts[i:i + 2] = [joined]
        del agenda[i]
        if i:
            agenda[i - 1] = rank(parts[i - 1] + joined, NONE)
        if i < len(agenda):
            agenda[i] = rank(joined + parts[i + 1], NONE)
    return parts


def merge(ranks, text):
    """Starts of the pieces of ``text`` after all merges, and its end."""
    n = len(text)
    # ends[i]: where the symbol that starts at i ends, -1 once it was joined to the one before.
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # An entry of the agenda is one number: rank, start and end of the pair, from high to low.
    bits = n.bit_length()
    low, rank = (1 << bits) - 1, ranks.get
    agenda = [(r << bits | i) << bits | i + 2 for i in range(n - 1) if (r := rank(text[i:i + 2])) is not None]
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        i, end = entry >> bits & low, entry & low
        middle = ends[i]
        # Symbols only grow, so a pair still stands if it still ends in the same place.
        if not 0 <= middle < n or ends[middle] != end:
            continue
        ends[i], ends[middle] = end, -1
        left = before[i]
        if left >= 0 and (r := rank(text[left:end])) is not None:
            heappush(agenda, (r << bits | left) << bits | end)
        if end < n:
            before[end] = i
            after = ends[end]
            if (r := rank(text[i:after])) is not None:
                heappush(agenda, (r << bits | i) << bits | after)
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at = ends[at]
    return [*starts, n]


class Encoder(dict):
    """Unit -> its ids, packed; missing units are cut where nothing joins, then merged."""

    def __init__(self, model, cached=UNITS):
        self.vocabulary = Vocabulary(model)
        self.cached, self.older = cached, {}
        # A word ends before a sign that no piece has behind a letter.
        behind = {b for a, b in self.vocabulary.side_by_side if a.isalpha()}
        signs = re.escape("".join(c for c in map(chr, range(128)) if not (c.isalnum() or c == "_" or c in behind)))
        mark = SPACE_MARK
        self.units = re.compile(rf"{mark}*[^\W\d_]++(?=[{signs}{mark}]|\Z)|{mark}*[^{mark}]+|{mark}+").findall

    def __missing__(self, unit):
        packed = self.older.get(unit)
        if packed is None:
            packed = self.parts(unit)
        if len(unit) <= 64:
            # Two generations: what is still in use moves on, the rest goes.
            if len(self) >= self.cached:
                self.older = dict(self)
                self.clear()
            self[unit] = packed
        return packed

    def parts(self, unit):
        if len(unit) <= SHORT:
            return self.merged(unit)
        joins = self.vocabulary.side_by_side
        cuts = [i for i, pair in enumerate(zip(unit, unit[1:], strict=False), 1) if pair not in joins]
        if not cuts:
            return self.merged(unit)
        return b"".join([self[unit[a:b]] for a, b in zip([0, *cuts], [*cuts, len(unit)], strict=True)])

    def merged(self, part):
        ids, spelled = self.vocabulary.ids, self.vocabulary.bytes
        if len(part) <= SHORT:
            pieces = merge_short(self.vocabulary.ranks, part)
        else:
            bounds = merge(self.vocabulary.ranks, part)
            pieces = [part[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        try:
            return array("i", map(ids.__getitem__, pieces)).tobytes()
        except KeyError:
            out = array("i")
            for p in pieces:
                out.extend((ids[p],) if p in ids else map(spelled.__getitem__, p.encode("utf-8", "surrogatepass")))
            return out.tobytes()

    def encode(self, text):
        """Ids of a text as 32-bit integers of the machine's byte order, packed."""
        if not text:
            return b""
        return b"".join(map(self.__getitem__, self.units(SPACE_MARK + text.replace(" ", SPACE_MARK))))


class Decoder:
    """Ids -> text: spelled bytes are read as UTF-8, each byte that fits nowhere being U+FFFD."""

    def __init__(self, model):
        self.vocabulary = Vocabulary(model)
        self.spelled = set(self.vocabulary.bytes.values())

    def decode(self, ids):
        surface, control = self.vocabulary.surface, self.vocabulary.control
        parts = list(map(surface.__getitem__, ids))
        # The mark in front of a text is no part of it.
        first = next((i for i, number in enumerate(ids) if number not in control), None)
        if first is not None and ids[first] not in self.spelled and ids[first] in self.marked:
            parts[first] = parts[first][1:]
        # A control id between spelled bytes parts them.
        if control.isdisjoint(ids):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return "".join(self.runs(ids, parts))

    @property
    def marked(self):
        found = self.__dict__.get("_marked")
        if found is None:
            found = self._marked = {i for name, i in self.vocabulary.ids.items() if name.startswith(SPACE_MARK)}
        return found

    def runs(self, ids, parts):
        held = b""
        for number, part in zip(ids, parts, strict=True):
            if number in self.spelled:
                held += part
                continue
            if held:
                yield spelled_text(held)
                held = b""
            yield part.decode()
        yield spelled_text(held)


def spelled_text(raw):
    """Text of bytes; one U+FFFD for each byte that is part of no character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[:error.start].decode() + "�")
            raw = raw[error.start + 1:]
    return "".join(out)


@lru_cache(maxsize=1)
def encoder(model):
    return Encoder(model)


@lru_cache(maxsize=1)
def decoder(model):
    return Decoder(model)


@lru_cache(maxsize=1)
def checker(model):
    return library(model)


def id_lists(packed):
    """An Arrow list column of packed ids."""
    ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int64)
    flat = np.frombuffer(b"".join(packed), np.int32)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(pa.list_(pa.int32()))


def numbers(column):
    """Id lists of an Arrow column, null as none, without an object per id."""
    values = column.values.to_numpy(zero_copy_only=False) if not column.values.null_count else None
    starts = column.offsets.to_pylist()
    for i, valid in enumerate(column.is_valid().to_pylist()):
        if not valid:
            yield []
        elif values is None:
            yield [v for v in column[i].as_py() if v is not None]
        else:
            yield values[starts[i]:starts[i + 1]].tolist()


def _encoded(model, text, ids, count, check):
    def batch(columns):
        texts, machine = columns[text].to_pylist(), encoder(model)
        packed = [machine.encode(t) for t in texts]
        made = {ids: id_lists(packed), count: pa.array([len(p) // 4 for p in packed], pa.int64())}
        if check:
            said = checker(model).encode([t or "" for t in texts], num_threads=1)
            made[check] = pa.array([array("i", a).tobytes() == b for a, b in zip(said, packed, strict=True)], pa.bool_())
        return made

    added = {ids: T.ArrayType(T.IntegerType()), count: T.LongType()}
    return batch, added | ({check: T.BooleanType()} if check else {})


def _decoded(model, ids, decoded):
    def batch(columns):
        machine = decoder(model)
        return {decoded: pa.array([machine.decode(n) for n in numbers(columns[ids])], pa.string())}

    return batch, {decoded: T.StringType()}


def encode(docs, model, text="text", ids="ids", count="n_tokens", check=None):
    """``docs`` with the ids (array of int) and their number.

    ``check`` names a column that tells whether the library gives the same ids.
    """
    batch, added = _encoded(model, text, ids, count, check)
    return map_batches(docs, batch, added, reads=[text])


def decode(docs, model, ids="ids", decoded="decoded_text"):
    """``docs`` with the text its ids stand for; a null list gives the empty text."""
    batch, added = _decoded(model, ids, decoded)
    return map_batches(docs, batch, added, reads=[ids])


def round_trip(docs, model, text="text", ids="ids", count="n_tokens", decoded="decoded_text", check=None):
    """Both in the same tasks: ids are decoded where they are made."""
    first, new = _encoded(model, text, ids, count, check)
    then, more = _decoded(model, ids, decoded)

    def batch(columns):
        made = first(columns)
        return made | then(made)

    return map_batches(docs, batch, new | more, reads=[text])
