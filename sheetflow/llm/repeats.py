"""Finding repeated windows of sequences, by sampled buckets that are refined.

A window is ``window`` consecutive values of one document. Its bucket is the
smallest hash of the ``gram``-grams inside it: equal windows have equal buckets
wherever they stand, and consecutive windows mostly share one. A run is a
stretch of consecutive windows with the same first smallest gram; it is named
by a hash of all its values. Per document and run one row is sorted, not one per window.

``sweep`` walks over the sorted rows. A run that occurs again settles all its
windows at once. Only where one bucket holds different runs do the windows
differ, and these runs alone are taken apart further.

The rows are range-partitioned by bucket, run and document, so that a bucket
that a third of all documents share is spread over many tasks, and the sweep
holds a handful of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetflow.llm.common import slices, stored
from sheetflow.operators.keyed import quoted

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
# Values of documents without a key: beyond all keys, and equal in rank.
NO_KEY = 1 << 62
# Longer documents are scanned in overlapping pieces of so many values.
PIECE = 400_000
# Shorter ones are scanned together, until they have so many values: a scan holds some twenty arrays of them.
GATHER = 100_000

np.seterr(over="ignore")


def mix(x: np.ndarray) -> np.ndarray:
    """A finishing step for hashes: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> U(31))
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(32)
    return x


class Powers:
    def __init__(self, n: int):
        self.up = np.cumprod(np.concatenate(([U(1)], np.full(n, BASE, U))))
        self.down = np.cumprod(np.concatenate(([U(1)], np.full(n, INVERSE, U))))

    def sums(self, x: np.ndarray) -> np.ndarray:
        if len(x) >= len(self.up):
            self.__init__(2 * len(x))
        return np.concatenate(([U(0)], np.cumsum(x * self.up[: len(x)])))

    def hash(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the values from ``begin`` to ``end``, wherever they stand."""
        return mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(U) * U(0xD6E8FEB86659FD93))

    def every(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hash of each ``width`` consecutive values."""
        x = sums[width:] - sums[:-width]
        x *= self.down[: len(x)]
        x += U(width * 0xD6E8FEB86659FD93 % (1 << 64))
        return mix(x)


# A fixed random value for each byte.
BYTE_VALUES = mix((np.arange(1, 257).astype(U) * U(0x2545F4914F6CDD1D)) + U(0x632BE59BD9B4E019)) | U(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def byte_values(text: bytes, powers: Powers) -> np.ndarray:
    return BYTE_VALUES[np.frombuffer(text, np.uint8)]


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words: runs of bytes that are not ASCII white space."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], SPACE[np.frombuffer(text, np.uint8)], [True]))))
    return edge[::2], edge[1::2]


def word_values(text: bytes, powers: Powers) -> np.ndarray:
    """A hash of each word. Long texts are taken in pieces that end at white space."""
    out, at = [], 0
    while at < len(text):
        stop = min(len(text), at + 4 * PIECE)
        while stop < len(text) and text[stop] not in b" \t\n\v\f\r":
            stop += 1
        part = text[at:stop]
        begin, end = word_bounds(part)
        sums = powers.sums(byte_values(part, powers))
        out.append(powers.hash(sums, begin, end))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, U)


class Scan:
    """The windows of one stretch of values: runs, blocks and windows, each with its hash.

    ``piece`` numbers the values' documents (or pieces of them) from 0.
    """

    def __init__(self, values: np.ndarray, sizes: np.ndarray, window: int, gram: int, powers: Powers):
        self.window, self.gram, self.powers = window, gram, powers
        self.sums = powers.sums(values)
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        n = len(values) - window + 1
        self.grams = powers.every(self.sums, gram)
        least = _sliding_min(self.grams, window - gram + 1)[:n]
        inside = self.owner[:n] == self.owner[window - 1 :]
        # a run also ends where its smallest gram falls out, though an equal one may follow
        new = (least[1:] != least[:-1]) | (self.grams[: n - 1] == least[:-1])
        change = np.flatnonzero(new | (inside[1:] != inside[:-1]) | (self.owner[1:n] != self.owner[: n - 1])) + 1
        begin = np.concatenate(([0], change))
        end = np.concatenate((change, [n]))
        use = inside[begin]
        self.begin, self.end = begin[use], end[use]  # windows begin..end-1 of each run
        self.bucket = least[self.begin]
        self.run = powers.hash(self.sums, self.begin, self.end + window - 1)

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First value and hash of every window of the runs."""
        start = _ranges(self.begin[runs], self.end[runs])
        return start, self.powers.hash(self.sums, start, start + self.window)

    def blocks(self, runs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        """Windows of the runs in blocks: first window, last window, core and hull.

        A window's block is its distance from the first smallest gram in it,
        divided by ``size``, so equal windows are in equal blocks. The core is
        what all windows of a block have in common, the hull what they cover.
        """
        n = self.window - self.gram + 1
        place = self._places(runs, n)
        start = _ranges(self.begin[runs], self.end[runs])
        of = np.repeat(np.arange(len(runs)), self.end[runs] - self.begin[runs])
        block = (place[of] - start) // size
        if not len(start):
            return start, start, start.astype(U), start.astype(U)
        cut = np.concatenate(([0], np.flatnonzero((of[1:] != of[:-1]) | (block[1:] != block[:-1])) + 1, [len(start)]))
        first, last = start[cut[:-1]], start[cut[1:] - 1]
        p, k = place[of[cut[:-1]]], block[cut[:-1]]
        low, high = p - k * size, np.maximum(p - k * size - size + 1, p - n + 1)
        mark = k.astype(U) * U(0xA0761D6478BD642F)
        core = mix(self.powers.hash(self.sums, low, high + self.window) + mark)
        hull = mix(self.powers.hash(self.sums, first, last + self.window) + mark + (p - first).astype(U))
        return first, last, core, hull

    def _places(self, runs: np.ndarray, n: int) -> np.ndarray:
        """Where the first smallest gram of each run stands."""
        out = []
        for at in range(0, len(runs), 2000):
            part = runs[at : at + 2000]
            inside = self.grams[self.begin[part][:, None] + np.arange(n)] == self.bucket[part][:, None]
            out.append(self.begin[part] + inside.argmax(axis=1))
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All integers of the ranges begin..end-1, one range after the other."""
    size = end - begin
    if not size.sum():
        return np.zeros(0, np.int64)
    step = np.ones(size.sum(), np.int64)
    step[0] = begin[0]
    step[np.cumsum(size[:-1])] = begin[1:] - end[:-1] + 1
    return np.cumsum(step)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks of that width."""
    pad = (-len(x)) % width
    rows = np.concatenate((x, np.full(pad, ~U(0)))).reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    np.minimum.accumulate(rows[:, ::-1], axis=1, out=rows[:, ::-1])
    right = rows.ravel()
    n = len(x) - width + 1
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def scans(texts: list, values_of, window: int, gram: int, powers: Powers) -> Iterator[tuple[Scan, np.ndarray, np.ndarray]]:
    """Scans over many texts, each with the text's number and the first value of every piece in it."""
    held, total = [], 0
    for i, t in enumerate(texts):
        values = values_of(t, powers) if t else ()
        for at in range(0, max(0, len(values) - window + 1), PIECE):
            part = values[at : at + PIECE + window - 1]
            held.append((i, at, part))
            total += len(part)
            if total >= GATHER:
                yield _scan(held, window, gram, powers)
                held, total = [], 0
    if held:
        yield _scan(held, window, gram, powers)


def _scan(held: list, window: int, gram: int, powers: Powers):
    sizes = np.array([len(h[2]) for h in held])
    scan = Scan(np.concatenate([h[2] for h in held]), sizes, window, gram, powers)
    start = np.concatenate(([0], np.cumsum(sizes[:-1])))
    return scan, np.array([h[0] for h in held]), np.array([h[1] for h in held]) - start


def row_key(key: Column, text: Column) -> Column:
    """The key; rows without one get a number beyond all keys, from their text, so that they do not pile up."""
    return F.coalesce(key.cast("long"), F.lit(NO_KEY) + F.pmod(F.xxhash64(text), F.lit(NO_KEY)))


ROWS = "bucket long, name long, doc long, twice boolean"


def distinct_rows(doc: np.ndarray, bucket: np.ndarray, name: np.ndarray) -> pa.RecordBatch:
    """One row per document, bucket and name; ``twice``: the document has it more than once."""
    order = np.lexsort((name, bucket, doc))
    doc, bucket, name = doc[order], bucket[order], name[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1]) | (name[1:] != name[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate((at, [len(doc)])))
    arrays = [pa.array(bucket[at].view(np.int64)), pa.array(name[at].view(np.int64)), pa.array(doc[at]), pa.array(count > 1)]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "name", "doc", "twice"])


def repeats(rows: DataFrame, everywhere: bool, label: str, once: bool = False) -> DataFrame:
    """What the sweep says of each row: doc, name, gone, check.

    ``gone``: the name occurs elsewhere as well (``everywhere``: in any other
    row, or twice in this one; else: in a row of a smaller document). ``check``:
    the bucket may hold other names, and this row stands for its name. To find
    the ranges, Spark computes ``rows`` twice; ``once`` writes them to the
    shared folder first, where computing them costs more than that.
    """
    rows = stored(rows, f"{label}-rows") if once else rows
    order = ["bucket", "name", "doc"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number is given so that the ranges are not merged into fewer, larger ones
    swept = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        lambda batches: sweep(batches, everywhere), "doc long, name long, gone boolean, check boolean"
    )
    return stored(swept, label)


def sweep(batches, everywhere: bool) -> Iterator[pa.RecordBatch]:
    """Walk over rows sorted by bucket, name and document; see ``repeats``.

    Between batches it keeps the first row of the last bucket and of the last
    name. The first and the last bucket of a partition may go on in another
    one: their rows are always to be checked.
    """
    held = None
    first_bucket = None

    def result(doc, name, gone, check):
        keep = gone | check
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[keep]), pa.array(name[keep]), pa.array(gone[keep]), pa.array(check[keep])], names=["doc", "name", "gone", "check"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, name, doc = (batch.column(i).to_numpy() for i in range(3))
        twice = batch.column(3).to_numpy(zero_copy_only=False)
        none = np.zeros(len(doc), bool)
        now = [bucket, name, doc, twice, none, none]  # the last two: already told gone, already told check
        now = now if held is None else [np.concatenate(pair) for pair in zip(held, now, strict=True)]
        bucket, name, doc, twice, was_gone, was_check = now
        if first_bucket is None:
            first_bucket = bucket[0]
        new_bucket = np.concatenate(([True], bucket[1:] != bucket[:-1]))
        new_name = new_bucket | np.concatenate(([True], name[1:] != name[:-1]))
        of_bucket, of_name = np.cumsum(new_bucket) - 1, np.cumsum(new_name) - 1
        names = np.bincount(of_bucket, new_name)
        branching = (names > 1)[of_bucket] | (bucket == first_bucket)
        rank = np.minimum(doc, NO_KEY)
        lead = np.flatnonzero(new_name)
        if everywhere:
            gone = ((np.bincount(of_name) > 1) | (np.bincount(of_name, twice) > 0))[of_name]
        else:
            gone = rank > rank[lead][of_name]
        stands = new_name if everywhere else rank == rank[lead][of_name]
        check = branching & stands
        yield result(doc, name, gone & ~was_gone, check & ~was_check)
        was_gone, was_check = was_gone | gone, was_check | check
        last = [int(np.flatnonzero(new_bucket)[-1]), int(lead[-1])]
        # rows of the last name that could still turn out to need a check
        open_rows = np.flatnonzero((of_bucket == of_bucket[-1]) & stands & ~was_check)
        keep = np.unique(np.concatenate((last, open_rows)))
        held = [x[keep] for x in (bucket, name, doc, twice, was_gone, was_check)]
    if held is not None:
        bucket, name, doc, _, was_gone, was_check = held
        yield result(doc, name, np.zeros(len(doc), bool), (bucket == bucket[-1]) & ~was_check)


def settle_edges(swept: DataFrame, everywhere: bool) -> DataFrame:
    """The rows of a last level (bucket and name are the same) that are gone: doc, name.

    There, only the first and last name of a partition are left to check.
    """
    edges = swept.filter("check").withColumn("rank", F.least("doc", F.lit(NO_KEY)))
    ends = edges.groupBy("name").agg(F.min("rank").alias("least"), F.count("doc").alias("rows"))
    late = F.col("rows") > 1 if everywhere else F.col("rank") > F.col("least")
    more = edges.join(ends, "name").filter(late).select("doc", "name")
    return swept.filter("gone").select("doc", "name").unionByName(more)


def packed(docs: DataFrame, key: str, text: str, hashed: bool = False) -> DataFrame:
    """Row key and text, the text compressed, for it is to be shuffled to what was found in it; ``hashed``: and its hash."""
    body = quoted(text).cast("string")
    more = [F.xxhash64(body).alias("hash")] if hashed else []
    rows = docs.select(row_key(quoted(key), body).alias("doc"), body.cast("binary").alias("text"), *more)

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            small = [None if t is None else press.compress(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(small, pa.binary()), *b.columns[2:]], names=b.schema.names)

    return rows.mapInArrow(run, "doc long, text binary, hash long" if hashed else "doc long, text binary")


def unpacked(column: pa.Array | list) -> list:
    open_ = zstandard.ZstdDecompressor()
    texts = column if isinstance(column, list) else column.to_pylist()
    return [None if t is None else open_.decompress(t) for t in texts]


def by_document(found: DataFrame, **wanted: Column) -> DataFrame:
    """Names of each document as arrays, one column for each condition in ``wanted``; as many as the document has."""
    return found.groupBy("doc").agg(*[F.collect_set(F.when(c, F.col("name"))).alias(n) for n, c in wanted.items()])


class Wanted:
    """Names that each text of a batch asks for, from an array column of the batch (or of a slice of it)."""

    def __init__(self, column: pa.Array):
        sizes = np.diff(column.offsets.to_numpy()) if not column.null_count else pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        names = column.flatten().to_numpy().view(U)
        self.keys = np.sort(mix(names + np.repeat(np.arange(len(sizes)), sizes).astype(U) * BASE))
        self.any = sizes > 0

    def has(self, text: np.ndarray, name: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(name), bool)
        x = mix(name + text.astype(U) * BASE)
        return self.keys[np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)] == x


def spans_by_text(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of ``n`` texts the begins and ends among ``found``: (text, begin, end)."""
    text, begin, end = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(n + 1))
    return [(begin[order[a:b]], end[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def cover(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` values lie in one of the spans begin..end-1."""
    delta = np.bincount(begin, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(delta[:-1]) > 0


def span_edges(inside: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    return edge[::2].tolist(), edge[1::2].tolist()
