"""Calling a supplied function once per new key, with retries and a log."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sheetflow.functions.jsontext import json_from_text, json_items, valid_items
from sheetflow.functions.outcome import classify_llm_error, model_error_kind, token_cost
from sheetflow.functions.strings import filled
from sheetflow.operators.keyed import first_seen, latest, lookup, pending, quoted
from sheetflow.session import work_dir
from sheetflow.sources.logs import adopt_log, read_log
from sheetflow.sources.runlog import SLICE, SLICES, RunLog, slice_of


class CallFailed(Exception):
    """Raised by a call to report an error of a named kind."""

    def __init__(self, message: str, kind: str = "unknown"):
        super().__init__(message)
        self.kind = kind


@dataclass(frozen=True)
class RetryPolicy:
    """``times`` further attempts after the first.

    Waits ``delay`` times the attempt number, at most ``cap`` seconds. With
    ``retry_on`` only failures of those kinds are tried again. ``keep`` joins
    the messages of ``all`` attempts, or gives the ``last`` one. ``classify``
    names the kind of an exception that does not name its own.
    """

    times: int = 1
    delay: float = 1.0
    cap: float | None = 5.0
    retry_on: tuple[str, ...] | None = None
    keep: str = "last"
    classify: Callable[[Exception], str] | None = None

    def kind(self, failure: Exception) -> str:
        own = getattr(failure, "kind", None)
        return own or (self.classify(failure) if self.classify else "unknown")

    def wait(self, attempt: int) -> float:
        pause = self.delay * attempt
        return pause if self.cap is None else min(pause, self.cap)

    def run(self, call: Callable[[dict], dict], row: dict) -> tuple[dict | None, str | None, str | None, int]:
        """(result, error, kind, attempts)."""
        messages, kind, attempt = [], None, 0
        for attempt in range(1, self.times + 2):
            try:
                return call(row), None, None, attempt
            except Exception as failure:  # a failed call is a result, not a failed task
                kind = self.kind(failure)
                messages.append(str(failure))
            if attempt > self.times or (self.retry_on is not None and kind not in self.retry_on):
                break
            time.sleep(self.wait(attempt))
        shown = messages[-1] if self.keep == "last" else "; ".join(f"attempt {i}: {m}" for i, m in enumerate(messages, 1))
        return None, shown, kind, attempt


# Rows whose results are handed on together.
HANDED_ON = 100

OUTCOME = "status string, error_type string, error_message string, attempts int, duration_ms long, called_at string"

# Kinds of model failures that are tried again.
MODEL_RETRY = RetryPolicy(
    times=2, delay=5.0, cap=None, retry_on=("rate_limit", "timeout", "network_error"), classify=model_error_kind
)


def new_tasks(
    df: DataFrame, key: str, order: Sequence[str], log: DataFrame | None = None, policy: str = "any", log_key: str | None = None, good: str = "success", status: str = "status"
) -> DataFrame:
    """First row of each filled key that the log does not settle."""
    keyed = df.withColumn(key, filled(quoted(key))).filter(quoted(key).isNotNull())
    once = first_seen(keyed, key, order)
    return once if log is None else pending(once, log, key, policy, log_key, status, good)


def call_each(
    tasks: DataFrame, call: Callable[[dict], dict], result: str, retry: RetryPolicy = RetryPolicy(), partitions: int | None = None, key: str | None = None
) -> DataFrame:
    """Run ``call`` on each row; adds the result columns and the outcome.

    Outcome columns: status, error_type, error_message, attempts, duration_ms,
    called_at. ``partitions`` bounds how many calls run at a time. Spark may
    repeat calls when it repeats a task, so read the log by latest row.
    """
    fields = T.StructType.fromDDL(result)
    schema = T.StructType([*tasks.schema.fields, *fields.fields, *T.StructType.fromDDL(OUTCOME).fields])
    wanted, arrow = [f.name for f in fields.fields], to_arrow_schema(schema)

    def outcome(row: dict) -> dict:
        start = time.monotonic()
        found, error, kind, attempts = retry.run(call, row)
        return {
            **row,
            **{name: (found or {}).get(name) for name in wanted},
            "status": "success" if error is None else "failed",
            "error_type": kind or "",
            "error_message": error or "",
            "attempts": attempts,
            "duration_ms": int((time.monotonic() - start) * 1000),
            "called_at": datetime.now(timezone.utc).isoformat(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HANDED_ON):
                rows = batch.slice(at, HANDED_ON).to_pylist()
                yield pa.RecordBatch.from_pylist([outcome(row) for row in rows], schema=arrow)

    if partitions:
        tasks = tasks.repartition(partitions, quoted(key)) if key else tasks.repartition(partitions)
    return tasks.mapInArrow(run, schema)


def enrich(
    df: DataFrame,
    key: str,
    call: Callable[[dict], dict],
    result: str,
    log: str | None = None,
    order: Sequence[str] = ("_row",),
    policy: str = "any",
    retry: RetryPolicy = RetryPolicy(),
    partitions: int | None = None,
    fmt: str = "parquet",
    waves: int = 4,
    slices: int = SLICES,
) -> DataFrame:
    """Dedupe keys, skip logged ones, call, append to the log, return the log.

    Without a log path the result rows come back unwritten. With one, the keys
    fall into ``slices`` by hash, and the slices are worked off in ``waves``.
    Each wave is committed to the log when its calls are over: a run that fails
    keeps the waves before, and the next one plans what is then still pending.
    A wave reads the slices of the log that its own keys lie in. A plain folder
    of log files is taken over as the first run.
    """
    spark = df.sparkSession
    if log is None:
        return call_each(new_tasks(df, key, order), call, result, retry, partitions, key)
    journal = RunLog(spark, log, fmt)
    if journal.is_plain():
        adopt_log(spark, log, fmt, key, slices)
    # written once, so that the waves do not work out the tasks again
    staged = work_dir(spark, "tasks")
    tasks = new_tasks(df, key, order)
    tasks.withColumn(SLICE, slice_of(quoted(key), slices)).write.partitionBy(SLICE).parquet(staged)
    laid = spark.read.schema(T.StructType([*tasks.schema.fields, T.StructField(SLICE, T.IntegerType())])).parquet(staged)
    present = sorted(r[0] for r in laid.select(SLICE).distinct().collect())
    run = journal.next_run()
    for wave in range(waves):
        mine = [n for n in present if n % waves == wave]
        if mine or not journal.exists():
            todo = laid.filter(F.col(SLICE).isin(mine)).drop(SLICE)
            if journal.exists():
                todo = pending(todo, journal.rows(key, mine, slices), key, policy)
            journal.append(call_each(todo, call, result, retry, partitions, key), run, wave, key, slices)
    return read_log(spark, log, fmt=fmt)


def attach(df: DataFrame, log: DataFrame, key: str, columns: Sequence[str], prefer_success: bool = False, spread: int = 1) -> DataFrame:
    """Join the latest logged result of each key back to every row that asks for it."""
    prefer = (F.col("status") == "success") if prefer_success else None
    last = latest(log, key, prefer=prefer).select(quoted(key).alias("_key"), *[quoted(c) for c in columns])
    return lookup(df.withColumn("_key", filled(quoted(key))), last, "_key", spread=spread).drop("_key")


def auto_extract(
    df: DataFrame,
    key: str,
    call: Callable[[dict], dict],
    rules: Callable[[DataFrame], DataFrame],
    kind: str,
    ask: Sequence[str] = (),
    log: str | None = None,
    order: Sequence[str] = ("_row",),
    retry: RetryPolicy = RetryPolicy(),
    partitions: int | None = None,
    policy: str = "success",
    waves: int = 4,
) -> DataFrame:
    """The rows with ``items`` and ``method``: the model's items where it has any, else those of the ``rules``.

    ``call`` sees the key and the columns in ``ask`` and gives ``items`` (of type
    ``kind``); ``rules`` adds ``items`` to the rows it is given. The outcome of a call is
    settled in a log, below the shared folder where none is named, before the
    rules are planned; so the rules work on the rows that it left empty and on
    no others. With a log that is kept, keys that have succeeded are not asked
    again.
    """
    tasks = df.select(*[quoted(c) for c in dict.fromkeys([key, *order, *ask])])
    done = enrich(tasks, key, call, f"items {kind}", log or work_dir(df.sparkSession, "model"), order, policy, retry, partitions, waves=waves)
    last = latest(done, key, prefer=F.col("status") == "success")
    found = last.filter((F.col("status") == "success") & (F.size("items") > 0)).select(quoted(key).alias("_key"), "items")
    asked = df.withColumn("_key", filled(quoted(key)))
    by_model = lookup(asked, found, "_key", "inner").withColumn("method", F.lit("langextract"))
    left = lookup(asked, found.select("_key", F.lit(True).alias("_found")), "_key").filter(F.col("_found").isNull()).drop("_found")
    by_rules = rules(left).withColumns({"items": F.col("items").cast(kind), "method": F.lit("regexp")})
    return by_model.unionByName(by_rules).drop("_key")


# -- model replies ------------------------------------------------------------


def prompt_text(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` places of a prompt; a blank URL is written as 无."""
    import re

    pieces: list[Column] = []
    for i, part in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            filled_in = values.get(part)
            pieces.append(F.lit("{" + part + "}") if filled_in is None else filled_in)
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


def scan_input(url1: Column | str, url2: Column | str) -> Column:
    """``struct<url1, url2, problem>``: blanks as 无, and an error when both are blank."""
    a, b = filled(url1), filled(url2)
    both = a.isNull() & b.isNull()
    return F.struct(
        F.coalesce(a, F.lit("无")).alias("url1"),
        F.coalesce(b, F.lit("无")).alias("url2"),
        F.when(both, F.lit("两个 URL 均为空")).alias("problem"),
    )


def model_outcome(
    df: DataFrame,
    reply: str,
    error: str,
    fields: Sequence[str],
    tokens_in: str | None = None,
    tokens_out: str | None = None,
    price_in: float = 2.75,
    price_out: float = 22.0,
    validator: Callable[[Column], Column] | None = None,
    kind: str | None = None,
) -> DataFrame:
    """Judge model calls from their reply or error text.

    Adds status, items, results_count, error_type, error_message, total_tokens
    and cost. A call error is classified; a reply without JSON is
    json_parse_error; one without a complete item is validation_error. A
    failed call reports no usage. ``kind`` names a column that already has the
    class of a call error.
    """
    failure = quoted(error)
    usage = [F.when(failure.isNull(), F.lit(None).cast("long") if c is None else quoted(c)) for c in (tokens_in, tokens_out)]
    read = df.withColumn("_found", F.when(failure.isNull(), json_from_text(quoted(reply))))
    read = read.withColumn("_items", valid_items(json_items("_found"), list(fields), validator))
    named = classify_llm_error(failure) if kind is None else quoted(kind)
    error_type = (
        F.when(failure.isNotNull(), named)
        .when(F.col("_found").isNull(), "json_parse_error")
        .when(F.coalesce(F.size("_items"), F.lit(0)) <= 0, "validation_error")
    )
    judged = read.withColumn("error_type", error_type)
    good = F.col("error_type").isNull()
    message = (
        F.when(failure.isNotNull(), failure)
        .when(F.col("error_type") == "json_parse_error", "Failed to extract JSON from response")
        .when(F.col("error_type") == "validation_error", "No valid result items found")
    )
    return judged.withColumns(
        {
            "status": F.when(good, "success").otherwise("failed"),
            "items": F.when(good, F.col("_items")),
            "results_count": F.when(good, F.size("_items")).otherwise(0),
            "error_message": message,
            "total_tokens": usage[0] + usage[1],
            "cost": token_cost(*usage, price_in, price_out),
        }
    ).drop("_found", "_items")


def ask_model(
    df: DataFrame,
    prompt: Column,
    call: Callable[[str], dict],
    fields: Sequence[str],
    price_in: float = 2.75,
    price_out: float = 22.0,
    problem: Column | None = None,
    retry: RetryPolicy = MODEL_RETRY,
    partitions: int | None = None,
    validator: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Prompt each row, call, and judge the replies: rows of a model log.

    ``call`` takes the prompt and gives ``reply`` and, where known,
    ``prompt_tokens`` and ``completion_tokens``. A row with a ``problem`` fails
    as invalid_input without a call. The rows should be distinct and not yet
    logged (:func:`new_tasks`); append the result to the log.
    """
    none = F.lit(None).cast("string")
    tasks = df.withColumns({"_prompt": prompt, "_problem": none if problem is None else problem})

    def ask(row: dict) -> dict:
        if row["_problem"]:
            raise CallFailed(row["_problem"], "invalid_input")
        return call(row["_prompt"])

    called = call_each(tasks, ask, "reply string, prompt_tokens long, completion_tokens long", retry, partitions)
    failed = called.withColumn("_failure", F.when(F.col("status") == "failed", F.col("error_message")))
    named = failed.withColumnRenamed("error_type", "_kind").drop("status", "error_message", "attempts")
    judged = model_outcome(
        named, "reply", "_failure", fields, "prompt_tokens", "completion_tokens", price_in, price_out, validator, "_kind"
    )
    return judged.withColumns(
        {"results_json": F.to_json("items"), "elapsed_time": F.col("duration_ms") / 1000}
    ).drop("_prompt", "_problem", "_failure", "_kind", "reply", "items", "duration_ms")
