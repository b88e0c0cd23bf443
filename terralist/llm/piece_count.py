"""Token counts of a piece vocabulary by a compiled finite-state tokenizer.

The merges of the vocabulary become a transducer whose transitions carry the
number of tokens they emit (:mod:`terralist.llm.transducer`).  A text is read in
chunks.  A chunk is a map from the state it is entered in to the state it is
left in and the tokens emitted on the way; from its first boundary on, where no
piece of the vocabulary can continue, the map no longer depends on the entry, so
it is kept as (head, body, tail): the characters up to there, the count between
the first and the last boundary, the characters after it.  These maps compose
associatively, and a prefix scan over them gives the count of the text.

Texts longer than ``long`` characters are cut into chunks that Spark spreads
over tasks; the maps of one text are as many as its chunks.  All others stay in
their row.  The model file is read once on the driver and travels with the task.

Defined results: null and empty texts have no tokens; rows are independent, so
repeats give repeats; other columns pass through, and a column named as the
count is replaced.
"""

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from terralist.llm.batches import map_batches, sheltered
from terralist.llm.transducer import Transducer

CHUNK = 1 << 16
LONG = 1 << 20
UNITS = 200_000
#: Fixed values of the model format: how a space is written, and the kind of ordinary pieces.
SPACE_MARK = "▁"
ORDINARY = (1, 4, 5)
#: Letters behind which signs may start a unit.
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"


def read_model(path):
    with open(path, "rb") as file:
        return file.read()


def _fields(data):
    """(number, value) of the fields of a protocol buffer message."""
    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


@lru_cache(maxsize=2)
def piece_ranks(model):
    """Rank of each ordinary piece: better scores first, equal scores alike."""
    import struct

    scores = {}
    for number, value in _fields(model):
        if number == 1:
            piece = dict(_fields(value))
            if piece.get(3, 1) in ORDINARY:
                scores[piece[1].decode()] = struct.unpack("<f", piece.get(2, bytes(4)))[0]
    order = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
    return {p: order[s] for p, s in scores.items()}


class Counter(dict):
    """Unit -> its number of tokens; a unit lies between two boundaries."""

    def __init__(self, model, cached=UNITS):
        ranks = piece_ranks(model)
        # A symbol that is no piece is written as its bytes, one token each.
        value = lambda t: 1 if t in ranks else len(t.encode("utf-8", "surrogatepass"))
        self.machine = Transducer(ranks, value, 0)
        self.cached, self.older = cached, {}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in ranks):
            raise ValueError("pieces that hold a space after another symbol are not supported")
        # Characters that no piece joins to others stand alone; others that none has behind
        # a letter start a unit there.  Both follow from the vocabulary.
        ascii_signs = [chr(c) for c in range(128) if not chr(c).isalnum()]
        inside = {c for p in ranks if len(p) > 1 for c in p}
        behind = {b for p in ranks for a, b in zip(p, p[1:], strict=False) if re.match(LETTER, a)}
        alone = re.escape("".join(c for c in ascii_signs if c not in inside)) or r"\n"
        stops = re.escape("".join(c for c in ascii_signs if c in inside and c not in behind)) or r"\n"
        mark = SPACE_MARK
        plain = f"[^{mark}{alone}{stops}]+"
        self.units = re.compile(
            f"{mark}*(?:[{stops}]|{plain})(?:{plain}|(?<!{LETTER})[{stops}])*|{mark}+|[{alone}]"
        ).findall

    def __missing__(self, unit):
        if len(self) >= self.cached:
            self.older = dict(self)
            self.clear()
        count = self.older.get(unit)
        if count is None:
            count = self.machine.run(unit)
        if len(unit) <= 64:
            self[unit] = count
        return count

    def chunk_map(self, chunk):
        """(head, body, tail) of a chunk; body and tail are None without a boundary."""
        units = self.units(chunk)
        if len(units) < 2:
            return chunk, None, None
        return units[0], sum(map(self.__getitem__, units[1:-1])), units[-1]

    def compose(self, left, right):
        (head, body, tail), (head2, body2, tail2) = left, right
        if body is None:
            return head + head2, body2, tail2
        if body2 is None:
            return head, body, tail + head2
        return head, body + self.through(tail, head2) + body2, tail2

    def through(self, tail, head):
        """Tokens of a tail and the head that follows: the state is carried over."""
        state, count = self.machine.advance(self.machine.start, tail)
        state, more = self.machine.advance(state, head)
        return count + more + self.machine.finish(state)

    def total(self, maps):
        """Count of a text from the maps of its chunks, composed pair by pair."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        if not maps:
            return 0
        head, body, tail = maps[0]
        return self[head] + (0 if body is None else body + self[tail])

    def count(self, text, chunk=CHUNK):
        if not text:
            return 0
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
        return self.total([self.chunk_map(marked[i:i + chunk]) for i in range(0, len(marked), chunk)])


@lru_cache(maxsize=2)
def counter(model):
    return Counter(model)


def _count_long(docs, model, text, output, long, chunk):
    """Counts of texts over ``long`` characters, chunk by chunk over all tasks."""
    keyed = docs.withColumn("_key", F.sha2(text, 256))

    def cut(batches):
        for batch in batches:
            for key, value in zip(batch.column("_key").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                marked = SPACE_MARK + value.replace(" ", SPACE_MARK)
                for i in range(0, len(marked), chunk):
                    yield pa.RecordBatch.from_pylist([{"_key": key, "_at": i // chunk, "_chunk": marked[i:i + chunk]}])

    def mapped(columns):
        machine = counter(model)
        head, body, tail = zip(*map(machine.chunk_map, columns["_chunk"].to_pylist()), strict=True)
        return {"_head": pa.array(head, pa.string()), "_body": pa.array(body, pa.int64()), "_tail": pa.array(tail, pa.string())}

    def summed(columns):
        machine = counter(model)
        return {output: pa.array([
            machine.total([(m["_head"], m["_body"], m["_tail"]) for m in maps]) for maps in columns["_maps"].to_pylist()
        ], pa.int64())}

    chunks = keyed.select("_key", F.col(text).alias("_text")).mapInArrow(cut, "_key string, _at long, _chunk string")
    maps = map_batches(
        chunks.repartition("_key", "_at"), mapped,
        {"_head": T.StringType(), "_body": T.LongType(), "_tail": T.StringType()}, reads=["_chunk"],
    )
    # Copies of a text have the same chunks: one of each is enough.
    single = maps.groupBy("_key", "_at").agg(F.first(F.struct("_head", "_body", "_tail")).alias("m"))
    whole = single.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_at", "m._head", "m._body", "m._tail"))).alias("_maps"))
    counts = map_batches(whole, summed, {output: T.LongType()}, reads=["_maps"]).select("_key", output)
    return keyed.drop(output).join(counts, "_key").drop("_key")


@sheltered("_key", "_text")
def count_tokens(docs, model, text="text", output="n_tokens", long=LONG, chunk=CHUNK):
    """``docs`` with the number of tokens of each text."""
    def batch(columns):
        machine = counter(model)
        return {output: pa.array([machine.count(t, chunk) for t in columns[text].to_pylist()], pa.int64())}

    is_long = F.coalesce(F.length(text) > long, F.lit(False))
    short = map_batches(docs.filter(~is_long), batch, {output: T.LongType()}, reads=[text])
    return short.unionByName(_count_long(docs.filter(is_long), model, text, output, long, chunk))
