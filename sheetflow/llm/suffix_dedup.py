"""Repeated byte spans, by bucket-pointer refinement.

Suffixes are sampled where a q-gram is the smallest around; suffixes with the
same q-gram share a first bucket. Buckets are refined by sorting them on what
stands at later offsets: first on the whole run of windows around the sample,
then on blocks of windows, then on single windows. A bucket that no longer
mixes different contents is settled, and only the others go to the next round,
so each round sorts fewer and finer rows and uses the pointers of the last one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.llm import repeats as R
from sheetflow.llm.common import slices
from sheetflow.operators.keyed import quoted

GRAM = 32
BLOCK = 8


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 200) -> DataFrame:
    """Key, n_bytes, starts, stops (removed byte spans) and kept (the other bytes).

    A byte is removed if a string of ``window`` bytes that covers it starts at
    any other place, in the same text or another one. All occurrences go.
    Matches never cross texts; null text has no bytes. Rows of equal or null
    key are texts of their own; each row of ``docs`` gives one row, other
    columns are ignored. Strings are compared by 64-bit hashes.
    """
    gram = min(GRAM, max(1, window // 2))
    rows = docs.select(R.row_key(quoted(key), quoted(text).cast("string")).alias("doc"), quoted(text).cast("binary").alias("text"))
    runs = R.repeats(rows.mapInArrow(lambda b: _runs(b, window, gram), R.ROWS), True, "runs")
    texts = R.packed(docs, key, text)
    mixed = R.by_document(runs.filter("check"), runs=F.col("check"))
    blocks = R.repeats(texts.join(mixed, "doc").mapInArrow(lambda b: _blocks(b, window, gram), R.ROWS), True, "blocks", once=True)
    both = blocks.filter("check").select("doc", "name", F.lit(1).alias("level"))
    both = both.unionByName(runs.filter("check").select("doc", "name", F.lit(0).alias("level")))
    mixed = R.by_document(both, runs=F.col("level") == 0, blocks=F.col("level") == 1).filter(F.size("blocks") > 0)
    singles = R.repeats(texts.join(mixed, "doc").mapInArrow(lambda b: _singles(b, window, gram), R.ROWS), True, "windows", once=True)
    level = lambda df, n: df.select("doc", "name", F.lit(n).alias("level"))
    gone = level(runs.filter("gone"), 0).unionByName(level(blocks.filter("gone"), 1))
    gone = gone.unionByName(level(R.settle_edges(singles, True), 2))
    gone = gone.unionByName(level(runs.filter("check"), 3))
    found = R.by_document(
        gone, runs=F.col("level") == 0, blocks=F.col("level") == 1, windows=F.col("level") == 2, mixed=F.col("level") == 3
    )
    out = texts.join(found, "doc", "left").mapInArrow(
        lambda b: _removed(b, window, gram), "doc long, n_bytes long, starts array<long>, stops array<long>, kept binary"
    )
    return out.select(F.when(F.col("doc") < R.NO_KEY, F.col("doc")).alias(key), "n_bytes", "starts", "stops", "kept")


def _runs(batches, window: int, gram: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        keys = b.column(0).to_numpy()
        # equal keys in one slice are different texts, so a text's number keeps them apart
        for scan, text, _ in R.scans(b.column(1).to_pylist(), R.byte_values, window, gram, powers):
            yield _per_text(text[scan.owner[scan.begin]], keys, scan.bucket, scan.run)


def _per_text(number: np.ndarray, keys: np.ndarray, bucket: np.ndarray, name: np.ndarray) -> pa.RecordBatch:
    rows = R.distinct_rows(number.astype(np.int64), bucket, name)
    return rows.set_column(2, "doc", pa.array(keys[rows.column(2).to_numpy()]))


def _blocks(batches, window: int, gram: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        keys, asked = b.column(0).to_numpy(), R.Wanted(b.column(2))
        for scan, text, _ in R.scans(R.unpacked(b.column(1)), R.byte_values, window, gram, powers):
            first, _, core, hull = scan.blocks(np.flatnonzero(asked.has(text[scan.owner[scan.begin]], scan.run)), BLOCK)
            if len(core):
                yield _per_text(text[scan.owner[first]], keys, core, hull)


def _singles(batches, window: int, gram: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        keys, runs, blocks = b.column(0).to_numpy(), R.Wanted(b.column(2)), R.Wanted(b.column(3))
        for scan, text, _ in R.scans(R.unpacked(b.column(1)), R.byte_values, window, gram, powers):
            first, last, _, hull = scan.blocks(np.flatnonzero(runs.has(text[scan.owner[scan.begin]], scan.run)), BLOCK)
            use = blocks.has(text[scan.owner[first]], hull)
            start = R._ranges(first[use], last[use] + 1)
            if len(start):
                name = powers.hash(scan.sums, start, start + window)
                yield _per_text(text[scan.owner[start]], keys, name, name)


def _removed(batches, window: int, gram: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        out: dict[str, list] = {n: [] for n in ("n_bytes", "starts", "stops", "kept")}
        runs, blocks, windows, mixed = (R.Wanted(b.column(c)) for c in (2, 3, 4, 5))
        texts = [t or b"" for t in R.unpacked(b.column(1))]
        found = []
        hit = [t if h else None for t, h in zip(texts, (runs.any | blocks.any | windows.any).tolist(), strict=True)]
        for scan, text, shift in R.scans(hit, R.byte_values, window, gram, powers):
            of_run = text[scan.owner[scan.begin]]
            whole = runs.has(of_run, scan.run)
            parts = np.flatnonzero(mixed.has(of_run, scan.run) & ~whole)
            first, last, _, hull = scan.blocks(parts, BLOCK)
            use = blocks.has(text[scan.owner[first]], hull)
            start, name = scan.windows(parts)
            start = start[windows.has(text[scan.owner[start]], name)]
            first = np.concatenate((scan.begin[whole], first[use], start))
            last = np.concatenate((scan.end[whole] - 1, last[use], start))
            move = shift[scan.owner[first]]
            found.append((text[scan.owner[first]], first + move, last + window + move))
        for t, (begin, end) in zip(texts, R.spans_by_text(found, len(texts)), strict=True):
            gone = R.cover(len(t), begin, end) if len(begin) else np.zeros(0, bool)
            starts, stops = R.span_edges(gone)
            kept = np.frombuffer(t, np.uint8)[~gone].tobytes() if starts else t
            for n, v in zip(out, (len(t), starts, stops, kept), strict=True):
                out[n].append(v)
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]], names=["doc", *out])
