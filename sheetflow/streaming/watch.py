"""New input files go through the enrichment stage as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sheetflow.operators.enrich import RetryPolicy, enrich
from sheetflow.session import work_dir
from sheetflow.sources.runlog import SLICES


def watch(
    spark: SparkSession,
    folder: str,
    schema: str,
    key: str,
    call: Callable[[dict], dict],
    result: str,
    log: str,
    order: Sequence[str] = ("_row",),
    policy: str = "any",
    retry: RetryPolicy = RetryPolicy(),
    partitions: int | None = None,
    checkpoint: str | None = None,
    source: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
    once: bool = True,
    log_fmt: str = "parquet",
    waves: int = 1,
    slices: int = SLICES,
) -> StreamingQuery:
    """Follow ``folder``: each batch of new files is enriched into ``log``.

    A repeated batch calls nothing again, because the log settles its keys. A
    batch reads only those slices of the log that its own keys lie in, however
    long the log has become. ``once`` works off what is there and stops;
    otherwise it keeps running. ``fmt`` is the format of the folder, ``log_fmt``
    that of the log.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(folder)
    stream = source(stream) if source else stream

    def on_batch(batch: DataFrame, _epoch: int) -> None:
        enrich(batch, key, call, result, log, order, policy, retry, partitions, log_fmt, waves, slices)

    place = checkpoint or work_dir(spark, "watch")
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", place)
    return (writer.trigger(availableNow=True) if once else writer).start()
