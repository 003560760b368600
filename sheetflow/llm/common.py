"""Shared helpers: Arrow batches in tasks, tables in the shared folder, digests of spans."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sheetflow.operators.keyed import quoted
from sheetflow.session import work_dir

# Letters, digits and accented Latin letters without case or composition surprises.
PLAIN_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
SLICE = 2 << 20  # bytes of a batch that are worked on at a time


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage there."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs, whose results are written: it waits for a collection on the driver."""
    spark.sparkContext._jvm.System.gc()


def keyed_bytes(df: DataFrame, key: str, text: str) -> DataFrame:
    """The key and the UTF-8 bytes of the text; other columns are left out."""
    return df.select(quoted(key).alias("key"), quoted(text).cast("string").cast("binary").alias("text"))


def keyed_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """The key and the text; other columns are left out."""
    return df.select(quoted(key).alias("key"), quoted(text).cast("string").alias("text"))


def per_text(df: DataFrame, work: Callable[[Iterator[tuple]], Iterator[dict[str, list]]], schema: str) -> DataFrame:
    """Run ``work`` over (keys, texts) of each Arrow batch of a task.

    ``work`` is a generator over all batches of the task, so that it can set up
    its tables once. It yields columns as plain lists.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    arrow = _arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches if b.num_rows)
        for columns in work(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], arrow.field(n).type) for n in names], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``SLICE`` bytes: one batch may hold all rows of a task, and Python makes several copies of what it works on."""
    for b in batches:
        rows = max(1, SLICE * b.num_rows // max(1, b.nbytes))
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def apart(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have yet."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def keep_rows(df: DataFrame, text: str, judge: Callable[[], Callable[[list], list[bool]]], only: Column | None = None) -> DataFrame:
    """The rows of ``df`` whose text is accepted, with all their columns, where they are read.

    ``judge`` is called once per task and gives a function from the texts of a
    slice, as bytes, to keep or drop. Where ``only`` does not hold, the text is
    handed over as null. A text column is read as it stands in the row; other
    types go to Python a second time, as text.
    """
    name = apart(df, "_judged")
    use = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    at = df.columns.index(text) if text in df.columns and isinstance(df.schema[text].dataType, StringType) else None
    rows = df.withColumn(name, F.when(use, quoted(text).cast("string").cast("binary")) if at is None else use)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = judge()
        for b in slices(batches):
            last = b.num_columns - 1
            texts = b.column(last)
            if at is not None:
                texts = pc.if_else(texts, b.column(at).cast(pa.binary()), pa.scalar(None, pa.binary()))
            keep = pa.array(accept(texts.to_pylist()), pa.bool_())
            yield b.select(list(range(last))).filter(keep)

    return rows.mapInArrow(run, df.schema)


KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def _arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def worker_memo(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    return sys.__dict__.setdefault("_sheetflow_memos", {}).setdefault(name, {})


def span_text(spans: Column) -> Column:
    """Array of structs (kind, start, stop) as kind:start:stop, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
