"""Exact top-k inner products with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it; sorted by
that key the rows fall into blocks, each a few annuli around pivots. A query
starts with the blocks whose annuli come nearest and goes on outwards until the
triangle inequality shows that no further block can hold a better score.

Inner products become distances by one more component: with R the greatest
norm, x' = (x, sqrt(R^2 - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q|^2 + R^2 - 2 q.x, so the nearest x' has the highest score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetflow.llm.common import stored
from sheetflow.operators.keyed import quoted

# Relative slack of bounds, for distances are rounded while scores are not.
SLACK = 1e-9


def grid_vector(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null, or one is not finite."""
    x = embedding.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where every sum stays below 2**53, else in integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries @ rows.T


def top_k(
    vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "vector", k: int = 5, pivots: int = 64,
    rows_per_block: int = 2048, most_blocks: int = 65_536, queries_per_task: int = 1024, first: int = 2, growth: int = 8,
) -> DataFrame:
    """query_id, rank (from 1), the key and score: the ``k`` highest inner products of each query with all other rows.

    ``queries``: a condition on the rows. ``vector``: an array of integers; rows
    with a null key or vector take no part, a shorter vector counts as filled up
    with 0. Every row is a candidate, also where keys or whole rows repeat; what
    has the key of the query is the query's own. Queries of equal key have one
    result, the best of all of them. Equal scores go to the smaller key. A query
    with fewer than ``k`` others gets them all; an empty table gives an empty
    one. Other columns are ignored.

    Of equal vectors only the k + 1 smallest keys, and of equal rows only k, can
    appear in any result, so only those are indexed; each task drops the others before the shuffle. The
    pivots are a sample of fixed size; all distinct rows are indexed. What the
    driver and the tasks hold of the index is one line per annulus, bounded by
    ``most_blocks``; beyond that the blocks grow instead.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(quoted(key).isNotNull() & quoted(vector).isNotNull())
    rows = stored(rows.select(quoted(key).cast("long").alias("id"), quoted(vector).alias("v"), queries.alias("asks")), "vectors")
    equal = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", "v").orderBy("id"))).filter(F.col("nth") <= k)
    same = Window.partitionBy("v").orderBy("id")
    listed = stored(equal.withColumn("place", F.dense_rank().over(same)).filter(F.col("place") <= k + 1).select("id", "v"), "listed")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, width, reach = listed.agg(F.count("id"), F.max(F.size("v")), F.max(square)).first()
    asking = rows.filter("asks")
    if not n:
        return _ranked(asking.select(F.col("id").alias("query"), "id", F.lit(0).cast("long").alias("score")).filter("false"), key, k)
    drawn = listed.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    centre = _matrix(pa.array([r["v"] for r in drawn]), width).astype(np.float64)
    norm = (centre**2).sum(axis=1)
    lift = np.sqrt(np.maximum(0, reach - norm))

    def nearest(batches):
        for b in batches:
            x = _matrix(b.column(1), width).astype(np.float64)
            own = (x**2).sum(axis=1)
            d2 = own[:, None] + norm - 2 * x @ centre.T + (np.sqrt(np.maximum(0, reach - own))[:, None] - lift) ** 2
            at = d2.argmin(axis=1)
            d = np.sqrt(np.maximum(0, d2[np.arange(len(at)), at]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at.astype(np.int32)), pa.array(d)], names=["id", "v", "pivot", "d"])

    size = max(rows_per_block, -(-n // most_blocks))
    by = ["pivot", "d", "id"]
    index = listed.mapInArrow(nearest, "id long, v array<long>, pivot int, d double")
    index = index.repartitionByRange(max(1, -(-n // (4 * size))), *by).sortWithinPartitions(*by)
    blocks = stored(index.mapInArrow(lambda b: _blocks(b, size, width), BLOCK), "blocks")
    rings = blocks.select("block", F.explode("rings").alias("r")).select("block", "r.*").orderBy("block", "pivot").collect()
    ring = (
        np.array([r["block"] for r in rings]),
        np.array([r["pivot"] for r in rings]),
        np.array([r["low"] for r in rings]),
        np.array([r["high"] for r in rings]),
    )
    n_blocks = len(set(ring[0].tolist()))
    best, done, upto = None, 0, min(first, n_blocks)
    while True:
        state = asking.select("id", "v").withColumn("kth", F.lit(None).cast("long"))
        if best is not None:
            kth = best.filter(F.col("nth") == k).select(F.col("query").alias("id"), F.col("score").alias("kth"))
            state = asking.select("id", "v").join(kth, "id", "left")
        visits = state.mapInArrow(_visits(ring, centre, reach, width, done, upto), "block long, id long, v array<long>")
        group = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // (50 * queries_per_task)))))
        asked = visits.groupBy("block", group.alias("g")).agg(F.collect_list(F.struct("id", "v")).alias("asked"))
        found = asked.join(blocks.drop("rings"), "block").select("asked", "ids", "matrix").mapInArrow(_compare(width, k), "query long, id long, score long")
        both = found if best is None else found.unionByName(best.drop("nth"))
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
        best = stored(both.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k), "best")
        if upto >= n_blocks:
            return _ranked(best.select("query", "id", "score"), key, k)
        done, upto = upto, min(n_blocks, upto * growth)


def _ranked(best: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score")


BLOCK = "block long, ids binary, matrix binary, rings array<struct<pivot:int,low:double,high:double>>"


def _blocks(batches, size: int, width: int):
    """Rows sorted by pivot and distance, packed ``size`` to a block, with the annuli that each block covers."""
    from pyspark import TaskContext

    part, count = TaskContext.get().partitionId(), 0
    kept: list[tuple] = []
    ring = pa.list_(pa.struct([("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))

    def pack(rows):
        ids = np.array([r[0] for r in rows], np.int64)
        matrix = _matrix(pa.array([r[1] for r in rows]), width)
        span: dict[int, list[float]] = {}
        for _, _, p, d in rows:
            span.setdefault(p, [d, d])[1] = d
        rings = [{"pivot": p, "low": lo, "high": hi} for p, (lo, hi) in span.items()]
        arrays = [pa.array([(part << 32) + count]), pa.array([ids.tobytes()]), pa.array([matrix.tobytes()]), pa.array([rings], ring)]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "ids", "matrix", "rings"])

    for b in batches:
        kept += zip(*(c.to_pylist() for c in b.columns), strict=True)
        while len(kept) >= size:
            yield pack(kept[:size])
            kept, count = kept[size:], count + 1
    if kept:
        yield pack(kept)


def _visits(ring, centre, reach: float, width: int, done: int, upto: int):
    """The blocks from place ``done`` to ``upto`` in a query's order that may still hold a result."""
    block, pivot, low, high = ring
    numbers, first = np.unique(block, return_index=True)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                q = _matrix(part.column(1), width).astype(np.float64)
                own = (q**2).sum(axis=1)
                to = np.sqrt(np.maximum(0, own[:, None] + reach - 2 * q @ centre.T))  # distances from the pivots
                short = np.maximum(0, np.maximum(to[:, pivot] - high, low - to[:, pivot]))
                least = np.minimum.reduceat(short, first, axis=1)
                order = np.argsort(least, axis=1, kind="stable")[:, done:upto]
                near = np.take_along_axis(least, order, axis=1)
                top = (own[:, None] + reach - near**2) / 2 + SLACK * (own[:, None] + reach + 1)
                kth = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
                who, nth = np.nonzero(~(top < kth[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[order[who, nth]]), part.column(0).take(pa.array(who)), part.column(1).take(pa.array(who))],
                    names=["block", "id", "v"],
                )

    return run


def _compare(width: int, k: int):
    """Best ``k`` rows of a block for each query that visits it."""

    def run(batches):
        for b in batches:
            for asked, ids, matrix in zip(*(c for c in b.columns), strict=True):
                structs = asked.values
                who, q = np.asarray(structs.field("id")), _matrix(structs.field("v"), width)
                own, x = np.frombuffer(ids.as_py(), np.int64), np.frombuffer(matrix.as_py(), np.int64).reshape(-1, width)
                scores = _scores(q, x)
                query, row, score = [], [], []
                for i, line in zip(who.tolist(), scores, strict=True):
                    others = np.flatnonzero(own != i)
                    mine = line[others]
                    cut = np.partition(mine, -k)[-k] if len(mine) > k else None
                    at = others if cut is None else others[mine >= cut]
                    at = at[np.lexsort((own[at], -line[at]))][:k]
                    query += [i] * len(at)
                    row += own[at].tolist()
                    score += line[at].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(row, pa.int64()), pa.array(score, pa.int64())], names=["query", "id", "score"])

    return run
