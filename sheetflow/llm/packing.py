"""Best-fit packing of token sequences in bulk-synchronous rounds.

Each round range-sorts the unplaced pieces together with the gaps of the open
sequences, largest first. A sweep over each range gives every piece the
smallest gap at or above its length (its successor). What finds none in its own
range is matched across ranges by rank: the n-th left-over piece of a range
takes the n-th left-over gap of the nearest larger range. The gaps are updated
and the next round begins; pieces that fit into no gap open new sequences.

A round begins with what still waits and the gaps that can still take something:
a gap smaller than the smallest waiting piece is done with. So the ranges grow
few, and once one range holds all, its sweep alone is best fit.

Only a handful of figures per range and the number of rows of each size reach
the driver, never rows. All state is written to the shared folder between
rounds, so a lost executor costs tasks of one round.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetflow.llm.common import PLAIN_LETTERS, keyed_bytes, per_text, stored, worker_memo
from sheetflow.llm.token_counts import byte_letters

MEMO_SIZE = 300_000
WORD = re.compile(rf"([{PLAIN_LETTERS}]+)([.,]?)")


class Ids(dict):
    """Token ids of what stands between white space, as little-endian 32-bit words.

    The tokenizer drops white space and never joins across it. Plain words go
    straight to the merges; everything else to the library as it is.
    """

    def __init__(self, path: str, memo: dict):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.letters, self.words = self.tokenizer.model.tokenize, byte_letters(), memo

    def __missing__(self, chunk: bytes) -> bytes:
        s = chunk.decode()
        m = WORD.fullmatch(s)
        ids = self.word(m[1].lower()) + (self.word(m[2]) if m[2] else b"") if m else self.any(s)
        if len(self) > MEMO_SIZE:
            self.clear()
        self[chunk] = ids
        return ids

    def word(self, s: str) -> bytes:
        ids = self.words.get(s)
        if ids is None:
            if len(self.words) > MEMO_SIZE:
                self.words.clear()
            written = s if s.isascii() else unicodedata.normalize("NFC", s).encode().decode("latin-1").translate(self.letters)
            ids = self.words[s] = np.array([t.id for t in self.merge(written)], "<u4").tobytes()
        return ids

    def any(self, s: str) -> bytes:
        return np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def token_pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32.

    A document is its token ids and then ``end_id``; only one that is longer
    than ``capacity`` is cut. Null or empty text: the end id alone.
    """
    closing = int(end_id).to_bytes(4, "little")

    def work(pairs) -> Iterator[dict[str, list]]:
        # one for all tasks of a worker: to read the vocabulary takes longer than a small task
        known = worker_memo(f"ids {tokenizer}")
        ids = known.get("ids") or known.setdefault("ids", Ids(tokenizer, worker_memo(f"words {tokenizer}")))
        for keys, texts in pairs:
            out: dict[str, list] = {"key": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for k, t in zip(keys, texts, strict=True):
                data = (ids.of(t) if t else b"") + closing
                for i, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    for name, value in zip(out, (k, i, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[name].append(value)
            yield out

    return per_text(keyed_bytes(docs, key, text), work, "key long, piece int, start long, length long, ids_crc32 long")


PIECE = ["key", "piece", "start", "length", "ids_crc32"]
# state: 0 an unplaced piece, 1 a gap, 2 a placed piece. size: the piece's length or the gap's room.
STATE = "state int, size int, rank long, part int, low int, seq long, at int, key long, piece int, start long, length long, ids_crc32 long"


def _sweep(batches, capacity: int) -> Iterator[pa.RecordBatch]:
    """Best fit within one range: rows arrive by size, largest first, gaps before pieces of their size."""
    import heapq

    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    fields = ["state", "size", "rank", "part", "low", "seq", "at", *PIECE]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = pa.schema(list(zip(fields, types, strict=True)))

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema=names)

    gaps: list[tuple[int, int]] = []  # (room, sequence), the smallest on top
    left: list[tuple[int, int]] = []  # heap of rooms left by placements, largest first
    out: list[tuple] = []
    low, missed = capacity, 0
    for batch in batches:
        for state, size, seq, *piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            low = size
            while left and -left[0][0] >= size:
                room, s = heapq.heappop(left)
                gaps.append((-room, s))
            if state == 1:
                gaps.append((size, seq))
            elif gaps:
                room, s = gaps.pop()
                out.append((2, size, None, part, None, s, capacity - room, *piece))
                if room > size:
                    heapq.heappush(left, (size - room, s))
            else:
                out.append((0, size, missed, part, None, None, None, *piece))
                missed += 1
        if len(out) > 20_000:
            yield emit(out)
            out = []
    gaps += [(-room, s) for room, s in sorted(left)]
    # Only gaps at or above this range's end are offered to the ranges below, smallest first.
    offered = [g for g in reversed(gaps) if g[0] >= low]
    smaller = [g for g in gaps if g[0] < low]
    none = (None,) * len(PIECE)
    for rank, (room, s) in enumerate(sorted(offered)):
        out.append((1, room, rank, part, low, s, None, *none))
    out += [(1, room, None, part, low, s, None, *none) for room, s in smaller]
    for i in range(0, len(out), 20_000):
        yield emit(out[i : i + 20_000])


def _by_rank(ranges: list) -> list[tuple]:
    """Which left-over pieces of a range go to which left-over gaps of larger ranges.

    ``ranges``: (part, gaps offered, smallest of them, pieces left, largest of
    them), largest range first. Each gap takes as many pieces as must fit.
    Returns (part, from piece, to piece, part of gaps, from gap, pieces a gap).
    """
    plan, stack = [], []
    for part, n_gaps, room, n_pieces, longest in ranges:
        done = 0
        while done < n_pieces and stack:
            other, at, n, least = stack.pop()
            each = least // longest
            used = min(n, -(-(n_pieces - done) // each))
            to = min(n_pieces, done + used * each)
            plan.append((part, done, to, other, at, each))
            done = to
            if used < n:
                stack.append((other, at + used, n - used, least))
        if n_gaps:
            stack.append((part, 0, n_gaps, room))
    return plan


def pack(pieces: DataFrame, capacity: int = 4096, rows_per_range: int = 25_000) -> DataFrame:
    """The pieces with sequence_id and offset, in few sequences of at most ``capacity`` tokens.

    Ties go by a hash of the row, so a length that many pieces share is spread
    over several ranges. Every piece is placed; lengths must be 1 to ``capacity``.
    An empty table gives an empty table. ``rows_per_range`` is the work of one
    task in a sweep; it changes which equally good gap is taken, not the rules.
    """
    spark = pieces.sparkSession
    items = stored(pieces.select(*PIECE), "pieces")
    n, total = items.agg(F.count("length"), F.sum("length")).first()
    if not n:
        return items.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    placed, gaps, opened = [], None, 0
    waiting = items.select(F.lit(0).alias("state"), F.col("length").cast("int").alias("size"), F.lit(None).cast("long").alias("seq"), *PIECE)
    need, open_gaps = total, 0
    while n:
        more = -(-need // capacity)
        if more:
            fresh = spark.range(opened, opened + more).select(F.lit(1).alias("state"), F.lit(capacity).alias("size"), F.col("id").alias("seq"))
            gaps = fresh if gaps is None else gaps.unionByName(fresh)
            opened += more
            open_gaps += more
        both = waiting.unionByName(gaps, allowMissingColumns=True)
        ranges = max(1, -(-(n + open_gaps) // rows_per_range))
        order = [F.col("size").desc(), F.col("state").desc(), F.xxhash64("seq", "key", "piece")]
        ordered = (both.repartitionByRange(ranges, *order) if ranges > 1 else both.repartition(1)).sortWithinPartitions(*order)
        swept = stored(ordered.mapInArrow(lambda b: _sweep(b, capacity), STATE), "sweep")
        placed.append(swept.filter("state = 2").select(*PIECE, "seq", "at"))
        offered, missed = F.col("rank").isNotNull() & (F.col("state") == 1), F.col("state") == 0
        figures = swept.filter(offered | missed).groupBy("part").agg(
            F.count_if(offered),
            F.min(F.when(offered, F.col("size"))),
            F.count_if(missed),
            F.max(F.when(missed, F.col("size"))),
        )
        figures = sorted(map(tuple, figures.collect()))
        if not sum(f[3] for f in figures):
            break
        matched, waiting, gaps = _match(swept, _by_rank(figures), capacity)
        if matched is not None:
            placed.append(matched)
        # at most two rows for each size there can be
        sizes = waiting.select("state", "size").unionByName(gaps.select("state", "size")).groupBy("state", "size").count().collect()
        wait = {r["size"]: r["count"] for r in sizes if r["state"] == 0}
        room = {r["size"]: r["count"] for r in sizes if r["state"] == 1}
        n, least, widest = sum(wait.values()), min(wait, default=capacity + 1), max(room, default=0)
        gaps = gaps.filter(F.col("size") >= least)
        open_gaps = sum(c for size, c in room.items() if size >= least)
        # Pieces beyond the largest gap can only go to new sequences; open those now.
        need = sum(size * c for size, c in wait.items() if size > widest)
    done = placed[0]
    for p in placed[1:]:
        done = done.unionByName(p)
    return done.select(*PIECE, F.col("seq").alias("sequence_id"), F.col("at").cast("long").alias("offset"))


def _match(swept: DataFrame, plan: list[tuple], capacity: int) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """Pieces placed by rank (None without a plan), pieces that still wait, and the gaps after this round."""
    lost = swept.filter("state = 0")
    gaps = swept.filter("state = 1")
    if not plan:
        return None, lost.select("state", "size", "seq", *PIECE), gaps.select("state", "size", "seq")
    steps = swept.sparkSession.createDataFrame(plan, "of_part int, first long, last long, to_part int, at_gap long, each long")
    of_step = F.expr("part = of_part AND rank >= first AND rank < last")
    aimed = lost.join(steps, of_step, "left")
    aimed = aimed.withColumn("to_rank", F.expr("at_gap + (rank - first) div each"))
    piece = aimed.filter("to_part IS NOT NULL").select("to_part", "to_rank", F.col("size").alias("took"), *PIECE)
    offered = gaps.filter("rank IS NOT NULL").select(F.col("part").alias("to_part"), F.col("rank").alias("to_rank"), "size", "seq")
    gap = Window.partitionBy("to_part", "to_rank")
    inside = gap.orderBy(*PIECE)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = offered.join(piece, ["to_part", "to_rank"], "left")
    filled = joined.select(
        "seq", "size", "took", *PIECE, F.sum("took").over(upto).alias("upto"), F.sum("took").over(gap).alias("all"), F.row_number().over(inside).alias("nth")
    )
    kept = stored(filled, "matched")
    matched = kept.filter("took IS NOT NULL").select(*PIECE, "seq", (capacity - F.col("size") + F.col("upto") - F.col("took")).cast("int").alias("at"))
    waiting = aimed.filter("to_part IS NULL").select("state", "size", "seq", *PIECE)
    after = kept.filter("nth = 1").select(F.lit(1).alias("state"), (F.col("size") - F.coalesce("all", F.lit(0))).cast("int").alias("size"), "seq")
    rest = gaps.filter("rank IS NULL").select("state", "size", "seq").unionByName(after).filter("size > 0")
    return matched, waiting, rest
