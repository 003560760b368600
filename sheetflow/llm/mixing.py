"""Mixing sources to target weights, as blocks dealt to output shards.

The documents of a source, in the order of a digest, are one long run of words
that is cut into blocks. How many blocks of each source the mix takes is exact:
a source that is to give more than it has runs through several epochs, and the
last block is cut where the target is reached. A binary tree over the output
shards splits these quotas: the draw of the left half of a node is
multivariate hypergeometric, and each node has a generator of its own, so any
task can compute any part of the tree again. The leaves say which stretch of a
source's permuted blocks a shard takes; a shard is then shuffled by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sheetflow.llm.common import stored
from sheetflow.operators.keyed import quoted

WORD = r"[^\x20\x09-\x0D]+"
# Rounds of the permutation of blocks.
ROUNDS = 24
# Leaves of the tree that one task works out.
LEAVES = 1024
# The sampler takes fewer than 10^9 blocks; the blocks grow so that a mix stays below.
MOST_BLOCKS = 500_000_000


@dataclass(frozen=True)
class Mix:
    """``documents``: every input row with source_size, target and its number; ``pieces``: what the shards hold.

    Both have ``part`` and ``at``, which name the input row.
    """

    documents: DataFrame
    pieces: DataFrame


def shares(sizes: list[int], weights: list[float], most: int = 3) -> list[float]:
    """Targets that sum to the sum of ``sizes``: by weight, none above ``most`` times its size.

    What is above goes to the others by weight, until none is above.
    """
    targets: list[float] = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    left = sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        for i in full or open_:
            targets[i] = float(most * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        left -= sum(most * sizes[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def turns(n: int, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> list[float]:
    """The weights in turn, for sources in the order of their names."""
    return [weights[i % len(weights)] for i in range(n)]


def split_quotas(quota: np.ndarray, shards: int, seed: int, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, blocks before it, blocks) per source, for the shards from ``first`` to ``last``.

    Every shard takes its equal part of all blocks, and every block goes to one
    shard. Only the nodes above the asked leaves are drawn.
    """
    total = int(quota.sum())
    stack = [(0, shards, quota, np.zeros_like(quota))]
    while stack:
        low, high, own, before = stack.pop()
        if high <= first or low >= last:
            continue
        if high - low == 1:
            yield low, before, own
            continue
        middle = (low + high) // 2
        wanted = middle * total // shards - low * total // shards
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(own, wanted, method="marginals")
        stack += [(middle, high, own - left, before + left), (low, middle, left, before)]


def _permuted(place: Column, n: Column, seed: int, *key: Column) -> Column:
    """A permutation of 0 to n - 1, drawn by ``key``: each round swaps a place with its mirror image, or does not."""

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), *key, r), n) - x, n)
        swap = F.xxhash64(F.lit(seed), *key, r, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), place, step)


def _running(rows: DataFrame) -> DataFrame:
    """Sorted rows with the number of their task and place there, and the words of their source ahead of them in the task."""
    schema = to_arrow_schema(T.StructType([*rows.schema.fields, *T.StructType.fromDDL("part int, at long, ahead long").fields]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, carry, current = TaskContext.get().partitionId(), 0, 0, -1
        for b in batches:
            if not b.num_rows:
                continue
            no, size = (b.column(c).to_numpy() for c in ("no", "size"))
            ends = np.cumsum(size)
            begins = np.flatnonzero(np.diff(no, prepend=no[0] - 1))
            base = np.repeat((ends - size)[begins], np.diff(np.append(begins, len(no))))
            ahead = ends - size - base
            if no[0] == current:
                ahead[: begins[1] if len(begins) > 1 else len(no)] += carry
            current, carry = no[-1], ahead[-1] + size[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(no), part), pa.int32()), pa.array(np.arange(at, at + len(no))), pa.array(ahead)], schema=schema)
            at += len(no)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *T.StructType.fromDDL("part int, at long, ahead long").fields]))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    most: int = 3,
    block_words: int = 4096,
    shard_words: int = 1 << 20,
    seed: int = 7,
) -> Mix:
    """Words of all sources in the shares of their weights, as many as there are.

    A document's size is its number of words; a null text has none. Sources
    weigh 1, 2, 3 and again, in code point order with the null source last,
    unless ``weights`` names them all. No word is taken more than ``most``
    times, and a source gives its target rounded to a whole word.

    documents: ``key``, source, size, source_size, target, part, at; one row
    per input row, also for null or repeated keys; other columns are ignored.
    pieces: shard, place (from 1, in the shuffled order of the shard), ``key``,
    source, epoch, start and words (in the document), part, at. A long document
    is cut where blocks end. An empty table gives empty ones.

    Texts are read once, where they lie; keys, digests and numbers are shuffled.
    One number per source reaches the driver and the tasks that split quotas.
    Rows that are equal in everything are interchangeable; else the result
    depends on the rows, ``seed`` and the sizes alone, not on their layout.
    """
    spark = docs.sparkSession
    body = F.coalesce(quoted(text).cast("string"), F.lit(""))
    size = F.regexp_count(body, F.lit(WORD)).cast("long")
    digest = F.xxhash64(F.lit(seed), quoted(key).cast("string"), body)
    sized = stored(docs.select(quoted(key).alias("key"), quoted(source).cast("string").alias("source"), size.alias("size"), digest.alias("h")), "mix-sizes")

    found = sorted(((r[0], r[1]) for r in sized.groupBy("source").agg(F.sum("size")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in found]
    targets = shares(sizes, turns(len(found)) if weights is None else [float(weights[name]) for name, _ in found], most)
    words = [min(round(t), most * n) for t, n in zip(targets, sizes, strict=True)]
    block = max(block_words, -(-sum(words) // MOST_BLOCKS))
    full = [w // n if n else 0 for w, n in zip(words, sizes, strict=True)]
    rest = [w - f * n for w, f, n in zip(words, full, sizes, strict=True)]
    quota = np.array([f * -(-n // block) + -(-r // block) for f, n, r in zip(full, sizes, rest, strict=True)], np.int64)
    shards = max(1, -(-sum(words) // shard_words))
    step = np.maximum(1, quota // shards)
    columns = {"no": range(len(found)), "source": [name for name, _ in found], "source_size": sizes, "target": targets, "full": full, "rest": rest, "step": step.tolist()}
    kinds = "no int, source string, source_size long, target double, full long, rest long, step long"
    about = spark.createDataFrame(pa.table(columns, to_arrow_schema(T.StructType.fromDDL(kinds))), kinds)

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = sized.join(about.select("no", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s"))).select("no", "h", "key", "size")
    place = ["no", "h", "key", "size"]
    laid = stored(_running(named.repartitionByRange(count, *place).sortWithinPartitions(*place)), "mix-order")
    earlier = Window.partitionBy("no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("no", "part").agg(F.sum("size").alias("_n")).select("no", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    rows = laid.join(parts, ["no", "part"]).join(about, "no").withColumn("offset", F.col("_base") + F.col("ahead"))
    documents = laid.join(about, "no").select(F.col("key").alias(key), "source", "size", "source_size", "target", "part", "at")
    return Mix(documents, _pieces(rows, _quotas(spark, quota, shards, step, seed), block, seed, key))


def _quotas(spark, quota: np.ndarray, shards: int, step: np.ndarray, seed: int) -> DataFrame:
    """(no, bucket, shard, first, end): the stretch of a source's block places that a shard takes, once for each bucket it touches."""
    kind = "no int, shard long, first long, end long"
    schema = to_arrow_schema(T.StructType.fromDDL(kind))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                for shard, before, own in split_quotas(quota, shards, seed, i * LEAVES, (i + 1) * LEAVES):
                    no = np.flatnonzero(own)
                    columns = [no, np.full(len(no), shard), before[no], (before + own)[no]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    tasks = -(-shards // LEAVES)
    # written, so that its real size decides how it is joined
    leaves = stored(spark.range(0, tasks, 1, tasks).mapInArrow(run, kind), "mix-quotas")
    steps = spark.createDataFrame(pa.table({"no": pa.array(range(len(step)), pa.int32()), "step": pa.array(step, pa.int64())}))
    touched = F.sequence(F.expr("first div step"), F.expr("(end - 1) div step"))
    return leaves.join(steps, "no").select("no", F.explode(touched).alias("bucket"), "shard", "first", "end")


def _pieces(rows: DataFrame, quotas: DataFrame, block: int, seed: int, key: str) -> DataFrame:
    """The stretches of documents that the mix takes, each with its shard and its place there."""
    size = F.lit(block).cast("long")
    whole = F.expr(f"source_size div {block}L")
    blocks = F.sequence(F.expr(f"offset div {block}L"), F.expr(f"(offset + size - 1) div {block}L"))
    epochs = F.sequence(F.lit(0).cast("long"), F.col("full") - F.when(F.col("rest") > 0, 0).otherwise(1))
    live = rows.filter("size > 0 AND full * source_size + rest > 0").withColumn("epoch", F.explode(epochs)).withColumn("block", F.explode(blocks))
    # the last, shorter block of a source stays at the end of every epoch, so that all before it are whole
    order = F.when(F.col("block") < whole, _permuted(F.col("block"), whole, seed, F.col("no"), F.col("epoch"))).otherwise(whole)
    live = live.withColumn("nth", order)
    used = F.when(F.col("epoch") < F.col("full"), size).otherwise(F.least(size, F.col("rest") - F.col("nth") * size))
    low = F.greatest("offset", F.col("block") * size)
    high = F.least(F.col("offset") + F.col("size"), F.col("block") * size + used)
    live = live.withColumns({"low": low, "words": high - low}).filter("words > 0")
    spot = F.col("epoch") * F.ceil(F.col("source_size") / size) + F.col("nth")
    live = live.select("no", F.col("key").alias(key), "source", "epoch", (F.col("low") - F.col("offset")).alias("start"), "words", "h", "part", "at", spot.alias("spot"), F.expr("step").alias("_step"))
    live = live.withColumn("bucket", F.expr("spot div _step"))
    inside = reduce(lambda x, y: x & y, [live["no"] == quotas["no"], live["bucket"] == quotas["bucket"], live["spot"] >= quotas["first"], live["spot"] < quotas["end"]])
    dealt = live.join(quotas, inside)
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "epoch", "h", "start"), "epoch", "part", "at", "start")
    return dealt.select("shard", F.row_number().over(local).alias("place"), key, "source", "epoch", "start", "words", "part", "at")


def taken(mixed: Mix) -> DataFrame:
    """``documents`` with taken (words, repeats counted) and pieces (shard:place:epoch:start:words, in the order of epoch and start)."""
    one = F.concat_ws(":", *[F.col(c).cast("string") for c in ("shard", "place", "epoch", "start", "words")])
    listed = F.array_sort(F.collect_list(F.struct("epoch", "start", one.alias("t"))))
    # a document has one piece for each block that it touches and epoch
    each = mixed.pieces.groupBy("part", "at").agg(F.sum("words").alias("taken"), F.transform(listed, lambda p: p["t"]).alias("pieces"))
    joined = mixed.documents.join(each, ["part", "at"], "left")
    none = F.array().cast("array<string>")
    return joined.withColumns({"taken": F.coalesce("taken", F.lit(0)), "pieces": F.coalesce("pieces", none)}).drop("part", "at")
