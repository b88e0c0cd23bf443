"""Arrow batches in tasks: add columns row-wise, with bounded pieces."""

import ctypes
import gc
from functools import wraps

import pyarrow as pa
from pyspark.sql import types as T

PIECE_BYTES = 4 << 20
_held = [None, None, None]


def held(owner, key, make):
    """The one large object that a worker keeps between batches and tasks, made by ``make()``.

    Workers are reused from stage to stage: what an operator asks for replaces what
    another, or the same for another key, left behind, and its memory goes back to the
    system before the new object is made.
    """
    if _held[0] != owner or _held[1] is not key and _held[1] != key:
        vacate()
        _held[:] = owner, key, make()
    return _held[2]


def vacate():
    """Let go of what another operator left here; for operators that hold nothing themselves."""
    if _held[0] is not None:
        _held[:] = None, None, None
        release()


def release():
    """Give unused memory of this worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def sheltered(*internal):
    """For an operator on a table: columns that bear its internal names pass through renamed."""
    def wrap(operator):
        @wraps(operator)
        def run(docs, *args, **kwargs):
            names, away = set(docs.columns) | set(internal), {}
            for c in docs.columns:
                if c in internal:
                    other = c
                    while other in names:
                        other = f"_{other}"
                    names.add(other)
                    away[c] = other
            if not away:
                return operator(docs, *args, **kwargs)
            return operator(docs.withColumnsRenamed(away), *args, **kwargs).withColumnsRenamed({v: k for k, v in away.items()})

        return run

    return wrap


def pieces(batch, limit=PIECE_BYTES):
    """Slices of a record batch of about ``limit`` bytes each, one row at least."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, int(rows * limit / max(1, batch.nbytes)))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def map_batches(df, function, added, reads=None, limit=PIECE_BYTES):
    """``df`` with columns computed by ``function(columns) -> {name: array}``.

    ``added`` maps the new names to Spark types; columns of those names are
    replaced.  Work is done in pieces of ``limit`` bytes, a few megabytes.
    """
    fields = [f for f in df.schema.fields if f.name not in added]
    schema = T.StructType(fields + [T.StructField(n, t) for n, t in added.items()])
    names = [f.name for f in fields]
    keep = list(names)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit):
                columns = {c: piece.column(c) for c in (reads or piece.schema.names)}
                new = function(columns)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in keep] + [new[n] for n in added], names=keep + list(added),
                )

    return df.mapInArrow(run, schema)
