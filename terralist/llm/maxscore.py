"""Exact top-k by inner product with MaxScore over shards.

A vector component is a term, its value the weight in the postings.  In a shard
every term has an upper bound of what it can add to a query's score.  Terms are
taken by falling bound; those at the end whose bounds together cannot lift a
document past the k-th best score so far are not essential.  Essential postings
are traversed for all documents of the shard, the others are probed only for
documents that can still reach the k-th score.  Shards answer with their k best,
and the k best of these are the result.

Queries meet candidates in blocks: every (shard, query block) pair is one task
of bounded size.  Sums are whole numbers and exact.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part, nor do rows without an id; a component a vector lacks counts as 0;
rows equal in id and vector count as one, other rows that repeat an id are each a
candidate and a query, and their id has one list of k; ties go to the smaller id; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 1024
STEP_ROWS = 4096
PROBED = 8


def whole_vectors(df, key="vec_id", vector="embedding", scale=64):
    """(id, x): one vector of whole numbers per distinct id and vector."""
    scaled = F.transform("vector", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    sound = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = sound.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).distinct()
    return rows.select("id", scaled.alias("x"))


def matrix(lists, width=None):
    """Ids and a term-major matrix from an Arrow list of (id, x)."""
    flat = lists.flatten() if isinstance(lists, pa.ListArray) else lists
    ids = flat.field(0).to_numpy(zero_copy_only=False)
    x = flat.field(1)
    sizes = np.diff(x.offsets.to_numpy())
    values = x.flatten().to_numpy(zero_copy_only=False)
    width = width or int(sizes.max(initial=0))
    out = np.zeros((width, len(ids)), np.int64)
    rows = np.repeat(np.arange(len(ids)), sizes)
    columns = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = columns < width
    out[columns[inside], rows[inside]] = values[inside]
    return ids, out


def exact_kind(x, q):
    """The fastest number type in which all sums are exact."""
    top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, len(x))
    return np.float32 if top < 2**24 else np.float64 if top < 2**53 else np.int64


class Shard:
    """Postings of one shard, in steps of rows; every term has its bounds in each."""

    def __init__(self, ids, x, rows=STEP_ROWS):
        self.steps = [
            (ids[i:i + rows], np.ascontiguousarray(x[:, i:i + rows]), x[:, i:i + rows].max(axis=1), x[:, i:i + rows].min(axis=1))
            for i in range(0, len(ids), rows)
        ]

    def top(self, own, query, k):
        """The k best (id, score) for one query, without the row of its own id."""
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for ids, x, high, low in self.steps:
            floor = best[-1] if len(best) == k else None
            rows, scores = self.competitive(x, high, low, query, floor)
            keep = ids[rows] != own
            best_ids = np.concatenate([best_ids, ids[rows][keep]])
            best = np.concatenate([best, scores[keep].astype(np.int64)])
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
        return best_ids, best

    @staticmethod
    def competitive(x, high, low, query, floor):
        """(rows, exact scores) of the rows that reach ``floor``."""
        if floor is None:
            return np.arange(x.shape[1]), query @ x
        bounds = np.maximum(query * high, query * low)
        order = np.argsort(-bounds, kind="stable")
        # What the terms from each place on can add at most.
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
        essential = int(np.argmax(rest <= floor)) if rest[-1] <= floor else len(order)
        essential = max(essential, 1)
        terms = order[:essential]
        scores = query[terms] @ x[terms]
        rows = np.flatnonzero(scores + rest[essential] >= floor)
        scores = scores[rows]
        for at in range(essential, len(order), PROBED):
            if not len(rows):
                break
            terms = order[at:at + PROBED]
            scores = scores + query[terms] @ x[np.ix_(terms, rows)]
            alive = scores + rest[min(at + PROBED, len(order))] >= floor
            rows, scores = rows[alive], scores[alive]
        return rows, scores


def _search(k):
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = matrix(batch.column("docs")[i].values)
                own, q = matrix(batch.column("queries")[i].values, len(x))
                kind = exact_kind(x, q)
                shard, q = Shard(ids, x.astype(kind)), q.T.astype(kind)
                found = [shard.top(o, v, k) for o, v in zip(own, q, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own, [len(f[0]) for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                ], schema=out)

    return run


def top_k(vectors, is_query, k=20, shard_rows=SHARD_ROWS, query_rows=QUERY_ROWS):
    """(query_id, rank, vec_id, score): the k best other vectors of each query.

    ``vectors`` is (id, x) with whole numbers, ``is_query`` a condition on it.
    """
    total, asked = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // query_rows))
    slot = lambda seed, n: F.pmod(F.xxhash64(F.col("id"), F.col("x"), F.lit(seed)), F.lit(n))
    packed = F.collect_list(F.struct("id", "x"))
    docs = vectors.groupBy(slot(1, shards).alias("shard")).agg(packed.alias("docs"))
    queries = vectors.filter(is_query).groupBy(slot(2, blocks).alias("block")).agg(packed.alias("queries"))
    docs = docs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", F.col("shard").cast("long"))
    found = docs.join(queries, ["shard", "block"]).mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k_sql(k=20, modulus=20):
    return f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % {modulus} = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
