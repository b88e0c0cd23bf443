"""Byte-level merge encoding and decoding of texts.

``encode`` splits a text by the pattern and sends each piece through the
transducer of the merge ranks (:mod:`terralist.llm.transducer`); pieces met
before come from a table of bounded size.  ``decode`` turns ids back into bytes
and text with an incremental UTF-8 state machine, so that ids may arrive in
blocks cut anywhere.

Both are row-wise: no shuffle, no hot key, and a task holds a few documents at a
time.  The rank file is read once on the driver (under a megabyte) and travels
with the task, so executors need no copy of it.

Defined results: null and empty texts give no ids and the empty text; rows are
independent, so repeats give repeats; other columns pass through untouched, and
the columns added replace any of the same name.
"""

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import types as T

from terralist.llm.batches import held, map_batches
from terralist.llm.transducer import Transducer

PIECES = 350_000
BLOCK_IDS = 1 << 16


def read_ranks(path):
    """Content of a rank file; ``path`` is read on the driver."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=4)
def parsed(data):
    ranks = {}
    for line in data.splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


@lru_cache(maxsize=2)
def packed_ids(data):
    return {token: rank.to_bytes(4, "little") for token, rank in parsed(data).items()}


class Encoder(dict):
    """Piece -> packed ids; missing pieces run through the transducer."""

    def __init__(self, data, pattern, cached=PIECES):
        import regex

        self.ranks = parsed(data)
        self.split = regex.compile(pattern).findall
        self.cached, self.older = cached, {}
        self.machine = Transducer(self.ranks, packed_ids(data).__getitem__, b"")

    def __missing__(self, piece):
        # Two generations: what is still in use moves on, the rest goes.
        if len(self) >= self.cached:
            self.older = dict(self)
            self.clear()
        packed = self.older.get(piece)
        if packed is not None:
            self[piece] = packed
            return packed
        raw = piece.encode("utf-8", "surrogatepass")
        # A piece that is a token as a whole is that token, even where merging would not build it.
        known = self.ranks.get(raw)
        packed = self.machine.run(raw) if known is None else known.to_bytes(4, "little")
        if len(piece) <= 64:
            self[piece] = packed
        return packed

    def encode(self, text):
        """Ids of a text as little-endian 32-bit integers."""
        return b"".join(map(self.__getitem__, self.split(text)))


def encoder(data, pattern):
    return held("byte_bpe", (data, pattern), lambda: Encoder(data, pattern))


# Classes of bytes in UTF-8, and for each state the classes it takes and where they lead.
_CLASSES = bytes(
    0 if b < 0x80 else 1 if b < 0x90 else 2 if b < 0xA0 else 3 if b < 0xC0 else 4 if b < 0xC2
    else 5 if b < 0xE0 else 6 if b == 0xE0 else 8 if b == 0xED else 7 if b < 0xF0
    else 9 if b == 0xF0 else 10 if b < 0xF4 else 11 if b == 0xF4 else 4
    for b in range(256)
)
_ANY = (1, 2, 3)
_TAKES = {
    0: {0: 0, 5: 1, 6: 2, 7: 3, 8: 4, 9: 5, 10: 6, 11: 7},
    1: dict.fromkeys(_ANY, 0), 2: {3: 1}, 3: dict.fromkeys(_ANY, 1), 4: {1: 1, 2: 1},
    5: {2: 3, 3: 3}, 6: dict.fromkeys(_ANY, 3), 7: {1: 3},
}
_NEXT = [[_TAKES[s].get(c, -1) for c in range(12)] for s in range(8)]


class Utf8Stream:
    """Text from bytes that come in any pieces; state is kept between them.

    Only the bytes outside ASCII go through the machine.  Malformed sequences
    become U+FFFD each, as the standard recommends for maximal subparts.
    """

    def __init__(self):
        import re

        self.foreign = re.compile(rb"[\x80-\xff]+").finditer
        self.state, self.held = 0, b""

    def feed(self, data):
        data, at, out = self.held + data, 0, []
        self.state, self.held = 0, b""
        end = len(data)
        for run in self.foreign(data):
            state, begin = 0, run.start()
            good = at
            for i in range(begin, run.end()):
                if state == 0:
                    begin = i
                step = _NEXT[state][_CLASSES[data[i]]]
                if step < 0:
                    out.append(data[good:begin].decode("utf-8"))
                    out.append("�")
                    good = i if i > begin else i + 1
                    begin = i
                    step = _NEXT[0][_CLASSES[data[i]]] if i == good else 0
                    step = max(step, 0)
                    if i == good and _NEXT[0][_CLASSES[data[i]]] < 0:
                        out.append("�")
                        good = i + 1
                state = step
            at = good
            if state:
                if run.end() == end:
                    out.append(data[at:begin].decode("utf-8"))
                    self.state, self.held = state, data[begin:]
                    return "".join(out)
                out.append(data[at:begin].decode("utf-8"))
                out.append("�")
                at = run.end()
        out.append(data[at:].decode("utf-8"))
        return "".join(out)

    def close(self):
        """What is left at the end: an unfinished sequence is malformed."""
        rest, self.state, self.held = "�" if self.held else "", 0, b""
        return rest


@lru_cache(maxsize=4)
def token_bytes(data):
    ranks = parsed(data)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode_blocks(data, ids, block=BLOCK_IDS):
    """(bytes, text) of packed ids, block by block."""
    table = token_bytes(data)
    stream = Utf8Stream()
    numbers = memoryview(ids).cast("I")
    for i in range(0, len(numbers), block):
        raw = b"".join(map(table.__getitem__, numbers[i:i + block]))
        yield raw, stream.feed(raw)
    yield b"", stream.close()


def _encoded(ranks, pattern, text, ids, count):
    def batch(columns):
        machine = encoder(ranks, pattern)
        packed = [machine.encode(t) if t else b"" for t in columns[text].to_pylist()]
        return {ids: pa.array(packed, pa.binary()), count: pa.array([len(p) // 4 for p in packed], pa.int64())}

    return batch, {ids: T.BinaryType(), count: T.LongType()}


def _decoded(ranks, ids, decoded, text):
    def batch(columns):
        raw, texts = [], []
        for packed in columns[ids].to_pylist():
            parts = list(decode_blocks(ranks, packed or b""))
            raw.append(b"".join(p[0] for p in parts))
            texts.append("".join(p[1] for p in parts))
        return {decoded: pa.array(raw, pa.binary()), text: pa.array(texts, pa.string())}

    return batch, {decoded: T.BinaryType(), text: T.StringType()}


def encode(docs, ranks, pattern, text="text", ids="ids", count="n_tokens"):
    """``docs`` with the packed ids (binary) and their number."""
    batch, added = _encoded(ranks, pattern, text, ids, count)
    return map_batches(docs, batch, added, reads=[text])


def decode(docs, ranks, ids="ids", decoded="decoded", text="decoded_text"):
    """``docs`` with the bytes and the text its packed ids stand for."""
    batch, added = _decoded(ranks, ids, decoded, text)
    return map_batches(docs, batch, added, reads=[ids])


def round_trip(docs, ranks, pattern, text="text", ids="ids", count="n_tokens", decoded="decoded", decoded_text="decoded_text"):
    """Both in one go through the same tasks: ids are decoded where they are made."""
    first, new = _encoded(ranks, pattern, text, ids, count)
    then, more = _decoded(ranks, ids, decoded, decoded_text)

    def batch(columns):
        made = first(columns)
        return made | then(made)

    return map_batches(docs, batch, new | more, reads=[text])


def checked_ids(docs, ranks, pattern, text="text", ids="ids", count="n_tokens", same="round_trip"):
    """``docs`` without their texts, with the packed ids, their number, and whether they decode to the text.

    The decoded text is compared where it is made and leaves no task.
    """
    first, new = _encoded(ranks, pattern, text, ids, count)

    def batch(columns):
        made = first(columns)
        whole = (
            "".join(p[1] for p in decode_blocks(ranks, packed or b"")) == (t or "")
            for packed, t in zip(made[ids].to_pylist(), columns[text].to_pylist())
        )
        return made | {same: pa.array(list(whole), pa.bool_()), text: pa.nulls(len(columns[text]), pa.string())}

    return map_batches(docs, batch, new | {same: T.BooleanType(), text: T.StringType()}, reads=[text], limit=1 << 20).drop(text)
