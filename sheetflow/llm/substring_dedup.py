"""Repeated word spans, by compaction of a de Bruijn graph.

Edges are the word windows of all texts. Windows that share their smallest gram
(a node of the sparse graph) and follow one another form a path; a node through
which one path only leads is not branching, so the path stays in one piece and
is compared as a whole. Joins on the node and the path's name find the paths
that an earlier document has. At branching nodes the paths are taken apart into
single edges and compared again; source coordinates then mark the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.llm import repeats as R
from sheetflow.llm.common import slices
from sheetflow.operators.keyed import quoted

GRAM = 3


def repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """Key, n_words, starts, stops (removed word spans) and kept (the other words, joined by a blank).

    A word is a run of characters other than ASCII white space, unchanged. It
    is removed if a window of ``window`` words that covers it also starts in a
    row with a smaller key. Rows of equal key do not remove each other's words;
    a null key is greater than all others. Null text has no words. Each row of
    ``docs`` gives one row; other columns are ignored. Windows are compared by
    64-bit hashes.
    """
    rows = docs.select(R.row_key(quoted(key), quoted(text).cast("string")).alias("doc"), quoted(text).cast("binary").alias("text"))
    paths = R.repeats(rows.mapInArrow(lambda b: _paths(b, window), R.ROWS), False, "paths")
    texts = R.packed(docs, key, text)
    branching = R.by_document(paths.filter("check"), ask=F.col("check"))
    edges = texts.join(branching, "doc").mapInArrow(lambda b: _edges(b, window), R.ROWS)
    gone = R.settle_edges(R.repeats(edges, False, "edges", once=True), False)
    both = paths.filter("gone").select("doc", "name", F.lit(True).alias("path")).unionByName(gone.select("doc", "name", F.lit(False).alias("path")))
    found = R.by_document(both, paths=F.col("path"), edges=~F.col("path"))
    out = texts.join(found, "doc", "left").mapInArrow(
        lambda b: _removed(b, window), "doc long, n_words long, starts array<long>, stops array<long>, kept string"
    )
    return out.select(F.when(F.col("doc") < R.NO_KEY, F.col("doc")).alias(key), "n_words", "starts", "stops", "kept")


def _paths(batches, window: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        keys = b.column(0).to_numpy()
        for scan, text, _ in R.scans(b.column(1).to_pylist(), R.word_values, window, GRAM, powers):
            yield R.distinct_rows(keys[text[scan.owner[scan.begin]]], scan.bucket, scan.run)


def _edges(batches, window: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        keys, asked = b.column(0).to_numpy(), R.Wanted(b.column(2))
        for scan, text, _ in R.scans(R.unpacked(b.column(1)), R.word_values, window, GRAM, powers):
            start, edge = scan.windows(np.flatnonzero(asked.has(text[scan.owner[scan.begin]], scan.run)))
            if len(edge):
                yield R.distinct_rows(keys[text[scan.owner[start]]], edge, edge)


def _removed(batches, window: int):
    powers = R.Powers(2 * R.PIECE)
    for b in slices(batches):
        out: dict[str, list] = {n: [] for n in ("n_words", "starts", "stops", "kept")}
        paths, edges = R.Wanted(b.column(2)), R.Wanted(b.column(3))
        texts = R.unpacked(b.column(1))
        found = []
        hit = [t if h else None for t, h in zip(texts, (paths.any | edges.any).tolist(), strict=True)]
        for scan, text, shift in R.scans(hit, R.word_values, window, GRAM, powers):
            whole = paths.has(text[scan.owner[scan.begin]], scan.run)
            first, last = scan.begin[whole], scan.end[whole] - 1
            start, name = scan.windows(np.flatnonzero(~whole))
            start = start[edges.has(text[scan.owner[start]], name)]
            first, last = np.concatenate((first, start)), np.concatenate((last, start))
            move = shift[scan.owner[first]]
            found.append((text[scan.owner[first]], first + move, last + window + move))
        for t, (begin, end) in zip(texts, R.spans_by_text(found, len(texts)), strict=True):
            words = t.split() if t else []
            gone = R.cover(len(words), begin, end) if len(begin) else np.zeros(0, bool)
            starts, stops = R.span_edges(gone)
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if starts else words
            for n, v in zip(out, (len(words), starts, stops, b" ".join(kept).decode()), strict=True):
                out[n].append(v)
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]], names=["doc", *out])
