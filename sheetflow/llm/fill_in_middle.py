"""Fill-in-the-middle form of documents: the lines of a text are dealt to prefix, middle and suffix.

Two cuts, drawn from a digest of the document's key, split the lines of a text.
The three parts are written with a mark each, in one of two orders. All work on
texts is a chain of Arrow kernels over a batch of them: the texts are split
into lists of units, the lists flattened with the number of their parent, each
unit gets its place in its text, the units of one role are filtered out, put
back into lists and joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sheetflow.operators.keyed import quoted

# Bytes of text that go through the kernels at a time; a longer text goes alone.
SLICE = 8 << 20


@dataclass(frozen=True)
class Form:
    """How texts are cut and written.

    ``percent`` of the documents are transformed, ``spm`` percent of those with
    the suffix first. ``seed`` goes into the digest that decides. ``end`` closes
    a unit; a text that holds one of the marks stays as it is, because it could
    not be read back.
    """

    seed: int = 7
    percent: int = 100
    spm: int = 50
    end: str = "\n"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the digest of seed and key; a null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts are together no longer than ``SLICE``, one row at least."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > SLICE:
            yield begin, i - begin
            begin, total = i, 0
        total += n
    if len(sizes) > begin:
        yield begin, len(sizes) - begin


def _units(text: pa.Array, end: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Units per text; and of every unit its text, its place there, and itself."""
    pieces = pc.split_pattern(text, end)
    parent = pc.list_parent_indices(pieces).to_numpy()
    flat = pc.list_flatten(pieces)
    counts = pc.list_value_length(pieces).to_numpy()
    place = np.arange(len(flat)) - (np.cumsum(counts) - counts)[parent]
    last = place == counts[parent] - 1
    # every piece but the last ends with the mark; the last one is a unit unless it is empty
    closed = pc.binary_join_element_wise(flat, pc.if_else(pa.array(last), pa.scalar("", text.type), pa.scalar(end, text.type)), pa.scalar("", text.type))
    real = ~last | (pc.binary_length(flat).to_numpy() > 0)
    n = np.bincount(parent[real], minlength=len(text))
    return n, parent[real], place[real], closed.filter(pa.array(real))


def _joined(units: pa.Array, chosen: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The chosen units joined to one text per list; ``counts`` says how many each text has."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
    lists = pa.LargeListArray.from_arrays(offsets, units.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", units.type))


def _transformed(text: pa.Array, h: list[np.ndarray], form: Form) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array, pa.Array]:
    """(units, form, characters of the prefix, of the middle, output) of each text."""
    n, parent, place, units = _units(text, form.end)
    cuts = np.sort([h[0] % (n + 1), h[1] % (n + 1)], axis=0)
    role = (place >= cuts[0][parent]).astype(int) + (place >= cuts[1][parent])
    prefix, middle, suffix = (_joined(units, role == r, c) for r, c in enumerate((cuts[0], cuts[1] - cuts[0], n - cuts[1])))
    marked = [pc.match_substring(text, mark) for mark in (form.prefix, form.suffix, form.middle)]
    plain = pc.or_(pc.or_(marked[0], marked[1]), marked[2])
    plain = pc.or_(plain, pa.array((n == 0) | (h[2] % 100 >= form.percent)))
    spm = pa.array(h[3] % 100 < form.spm)
    mark = {c: pa.scalar(c, text.type) for c in (form.prefix, form.suffix, form.middle, "")}
    first, second = (pc.binary_join_element_wise(mark[m], part, mark[""]) for m, part in ((form.prefix, prefix), (form.suffix, suffix)))
    whole = pc.binary_join_element_wise(pc.if_else(spm, second, first), pc.if_else(spm, first, second), mark[form.middle], middle, mark[""])
    kind = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(part).cast(pa.int64())) for part in (prefix, middle)]
    return n, kind, *chars, pc.if_else(plain, text, whole)


def fill_in_middle(docs: DataFrame, form: Form = Form(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n (units), form (plain, psm or spm), prefix_chars, middle_chars and output of every row.

    Each row gives one row, also rows of equal or null key; the key may have any
    type and other columns are ignored. A null text counts as empty and stays
    empty, with no units. A text of one unit is cut before or after it. Texts
    are worked on where they are read, a few at a time however long a batch is;
    an empty table gives an empty one.
    """
    rows = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"), *[h.alias(f"h{i}") for i, h in enumerate(draws(quoted(key), form.seed))])
    kind = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string").fields])
    schema = to_arrow_schema(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, length in _slices(pc.binary_length(batch.column(1)).to_numpy()):
                part = batch.slice(at, length)
                h = [part.column(i).to_numpy() for i in range(2, 6)]
                n, *rest = _transformed(part.column(1).cast(pa.large_string()), h, form)
                columns = [part.column(0), pa.array(n), *rest]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, kind).withColumnRenamed("key", key)


def _between(text: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first ``mark`` of each text."""
    halves = pc.split_pattern(text, mark, max_splits=1)
    return pc.list_element(halves, 0), pc.list_element(halves, 1)


def _restored(output: pa.Array, kind: pa.Array, form: Form) -> pa.Array:
    """The texts, from the written ones and their form alone."""
    back = output
    for name, outer, inner in (("psm", form.prefix, form.suffix), ("spm", form.suffix, form.prefix)):
        mine = pc.equal(kind, name)
        if not pc.any(mine).as_py():
            continue
        # a mark begins and ends unlike, so none can appear across the end of a part
        body, middle = _between(pc.utf8_slice_codeunits(output.filter(mine), start=len(outer)), form.middle)
        first, second = _between(body, inner)
        parts = (first, middle, second) if name == "psm" else (second, middle, first)
        back = pc.replace_with_mask(back, mine, pc.binary_join_element_wise(*parts, pa.scalar("", output.type)))
    return back


def restore(made: DataFrame, form: Form = Form()) -> DataFrame:
    """``made`` (with ``output`` and ``form``) plus ``restored``, the text read back from those two.

    The inverse of :func:`fill_in_middle` for every row it gives; other columns are kept.
    """
    kind = T.StructType([*made.schema.fields, T.StructField("restored", T.StringType())])
    schema = to_arrow_schema(kind)
    out, named = made.columns.index("output"), made.columns.index("form")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, length in _slices(pc.binary_length(batch.column(out)).to_numpy()):
                part = batch.slice(at, length)
                back = _restored(part.column(out).cast(pa.large_string()), part.column(named), form)
                yield pa.RecordBatch.from_arrays([*part.columns, back.cast(pa.string())], schema=schema)

    return made.mapInArrow(run, kind)
