"""Exact top-k inner-product search by the threshold algorithm.

The vectors are dealt into shards of bounded size, each shuffled to one task a single time; the queries
are copied to every shard and stream past it in blocks, behind its vectors. A shard keeps, for every
dimension, the list of its vectors sorted by that component. A query walks all lists in step, from the large end
where its own component is positive and from the small end where it is negative. After depth
``t`` no unseen vector of the shard can score more than the sum over the dimensions of the query
component times the last component read; the walk stops as soon as that bound is *below* the
k-th best score (below, not equal: an unseen vector with an equal score and a smaller id would
win). Shard results are merged to the k best of each query.

Cost: the vectors are shuffled once, the queries once per shard, and a task holds one shard
(``COMPONENTS_A_SHARD`` components and their lists) and one batch of queries. Where the vectors have
no preferred direction (many independent dimensions of equal spread), the bound falls only when most
of a shard is read, and the work is the product of queries and vectors.

Defined results: components become ``floor(256 * x)`` in double arithmetic. A vector that is
null, empty, or has a null, NaN or infinite component takes no part, neither as a query nor as
a candidate; a null id takes no part either. Vectors of unlike length are not compared. A row is
never a candidate of a query with its own id; repeated ids are candidates once for each row.
Fewer than k candidates give fewer rows; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import batch, materialise

K = 5
#: Queries that pass a shard at a time, and components of one shard: the memory bound of a task.
QUERIES_A_UNIT = 2048
COMPONENTS_A_SHARD = 1 << 19
FIRST_DEPTH = 64


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (array<bigint>) of the rows that take part."""
    x = F.col(embedding)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (table.where(x.isNotNull() & F.col(vec_id).isNotNull() & (F.size(x) > 0) & ~bad)
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * 256.0)).alias("v")))


class SortedLists:
    """The per-dimension sorted lists of one shard and the threshold walk over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        # exact in floats as long as no partial sum can pass the mantissa; int64 beyond that
        self.reach = float(np.abs(self.vectors).max(initial=0)) * vectors.shape[1]
        self.floats = {bits: self.vectors.astype(kind) for bits, kind in ((24, np.float32), (53, np.float64))
                       if self.reach * self.reach / max(vectors.shape[1], 1) < 2.0**bits}
        self.up = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32).T.copy()
        self.values = np.take_along_axis(self.vectors.T, self.up, axis=1)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        limit = self.reach * float(np.abs(query).max(initial=0))
        table = next((t for bits, t in self.floats.items() if limit < 2.0**bits), self.vectors)
        query = query.astype(table.dtype)
        # reading most rows in place is cheaper than gathering them
        found = (table @ query)[rows] if 4 * len(rows) > len(table) else table[rows] @ query
        return found.astype(np.int64)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, by score descending, then id."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        if not len(dims):  # every score is 0: the smallest ids win
            rows = np.flatnonzero(self.ids != query_id)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64)
        high = query[dims] > 0
        seen = self.ids == query_id
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, depth = 0, min(n, FIRST_DEPTH)
        while True:
            fresh = np.zeros(n, bool)
            fresh[self.up[dims[~high], done:depth]] = True
            fresh[self.up[dims[high], n - depth:n - done]] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            best_rows = np.concatenate([best_rows, rows])
            best = np.concatenate([best, self.scores(rows, query)])
            keep = np.lexsort((self.ids[best_rows], -best))[:k]
            best_rows, best = best_rows[keep], best[keep]
            if depth == n or seen.all():
                break
            last = np.where(high, self.values[dims, n - depth], self.values[dims, depth - 1])
            if len(best) == k and int((last * query[dims]).sum()) < best[-1]:
                break
            done, depth = depth, min(n, 2 * depth)
        return self.ids[best_rows], best


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.int64)
    return values.reshape(len(column), -1)


def _runs(rows: pa.RecordBatch, most: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((part, asked), rows) for the stretches of a sorted batch, of at most ``most`` rows each."""
    part, asked = np.asarray(rows["part"]), np.asarray(rows["asked"].cast(pa.int8()))
    ends = np.flatnonzero((np.diff(part) != 0) | (np.diff(asked) != 0)) + 1
    for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), rows.num_rows]):
        for at in range(lo, hi, most):
            yield (int(part[lo]), bool(asked[lo])), rows.slice(at, min(most, hi - at))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vectors_a_shard: int | None = None,
          queries_a_unit: int = QUERIES_A_UNIT) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` for each row of ``queries``
    (both as :func:`integer_vectors` gives them)."""
    spark = vectors.sparkSession
    rows = vectors.groupBy(F.size("v").alias("dim")).count().collect()  # one row for each vector length
    asked = {r["dim"] for r in queries.select(F.size("v").alias("dim")).distinct().collect()}
    shards = {r["dim"]: max(1, -(-r["count"] // (vectors_a_shard or max(1, COMPONENTS_A_SHARD // r["dim"]))))
              for r in rows if r["dim"] in asked}
    if not shards:
        empty = "query_id long, rank int, vec_id long, score long"
        return spark.createDataFrame([], empty)
    before = dict(zip(shards, np.cumsum([0, *shards.values()]).tolist()))  # the first part of each length

    def by_dim(table: dict[int, int]) -> F.Column:
        return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.size("v")]

    first, count = by_dim(before), by_dim(shards)
    left = (vectors.where(F.size("v").isin(list(shards)))
            .select("vec_id", "v", (first + F.pmod(F.xxhash64("vec_id"), count)).cast("int").alias("part"),
                    F.lit(False).alias("asked")))
    right = (queries.where(F.size("v").isin(list(shards)))
             .select("vec_id", "v", F.explode(F.sequence(first, first + count - 1)).alias("part"), F.lit(True).alias("asked")))
    dealt = left.unionByName(right).repartitionById(sum(shards.values()), "part").sortWithinPartitions("part", "asked")
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, lists = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            for (part, is_query), run in _runs(b, queries_a_unit):
                if part != shard:
                    shard, held, lists = part, [], None
                ids, values = np.asarray(run["vec_id"]), _matrix(run["v"])
                if not is_query:
                    held.append((ids.copy(), values.copy()))
                    continue
                if lists is None and held:
                    lists = SortedLists(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                if lists is not None:  # else no vector was dealt to this shard
                    found = [(q, *lists.top(q, v, k)) for q, v in zip(ids.tolist(), values)]
                    yield batch(out, query_id=np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64),
                                vec_id=np.concatenate([f[1] for f in found]), score=np.concatenate([f[2] for f in found]))

    found = dealt.mapInArrow(walk, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
