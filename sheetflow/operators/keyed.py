"""Operators by key: lookups, first and last row, resume, top-n, grouped text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetflow.functions.strings import as_column, cell, filled, non_empty, strip
from sheetflow.session import settle

# Rows without a key go to this many surrogate keys.
NULL_BUCKETS = 1024
# Rows that a task of a grouping takes on, so that its memory does not grow with the table.
ROWS_A_TASK = 500_000


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def names(spec: str | Sequence[str]) -> list[str]:
    return [spec] if isinstance(spec, str) else list(spec)


def _row_hash(df: DataFrame) -> Column:
    """Repeatable hash of the row, the same when a task runs again."""
    if "_row" in df.columns:
        return F.xxhash64("_row")
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return F.xxhash64(*[quoted(c) for c in plain])


def _surrogate(df: DataFrame, key: str) -> Column:
    """Stand-in for a null key, so that such rows do not meet in one task."""
    kind, bucket = df.schema[key].dataType, F.pmod(_row_hash(df), F.lit(NULL_BUCKETS))
    if isinstance(kind, T.StringType):
        return F.concat(F.lit("no key "), bucket.cast("string"))
    return bucket.cast(kind) if isinstance(kind, T.NumericType) else F.lit(None).cast(kind)


def lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left", spread: int = 1) -> DataFrame:
    """Equi-join of many rows with a table that has one row per key.

    Rows without a key are spread over stand-in keys that never match. Hot
    keys are split by adaptive skew handling; ``spread`` above 1 also salts
    the left side and repeats each right row that many times. Size alone
    decides, at run time, whether the right side is broadcast.
    """
    keys = names(on)
    wanted = [c for c in right.columns if c not in keys]
    side = right.select(*[quoted(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[quoted(c) for c in wanted])
    ask = [F.coalesce(quoted(k), _surrogate(left, k)) for k in keys]
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & (ask[i] == F.col(f"_key{i}")) & quoted(k).isNotNull()
    if spread > 1:
        salt = F.pmod(_row_hash(left), F.lit(spread))
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long")))
    else:
        # Always 0. As a further join key it gives the right side a shuffle of
        # its own, also where it was grouped by the key: only a join straight
        # on two shuffles can split a hot key.
        salt = F.pmod(F.xxhash64(*ask), F.lit(1))
        copy = F.pmod(F.xxhash64(*[F.col(f"_key{i}") for i in range(len(keys))]), F.lit(1))
    joined = left.withColumn("_salt", salt).join(side.withColumn("_copy", copy), match & (F.col("_salt") == F.col("_copy")), how)
    return joined.drop("_salt", "_copy", *[f"_key{i}" for i in range(len(keys))])


def _winner(df: DataFrame, keys: list[str], pick, rank: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    won = df.groupBy(*[quoted(k) for k in keys]).agg(pick(F.struct(*[quoted(c) for c in rest]), rank).alias("_won"))
    return won.select(*[quoted(k) for k in keys], "_won.*").select(*[quoted(c) for c in df.columns])


def first_seen(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``. Pre-aggregates before the shuffle."""
    return _winner(df, names(key), F.min_by, F.struct(*[quoted(c) for c in order]))


def latest(
    log: DataFrame, key: str | Sequence[str], order: str | Sequence[str] = "_seq", prefer: Column | None = None
) -> DataFrame:
    """One row per key: the last in ``order``; rows that meet ``prefer`` go first."""
    rank = [quoted(c) for c in names(order)]
    if prefer is not None:
        rank = [F.coalesce(prefer, F.lit(False)).alias("_prefer"), *rank]
    return _winner(log, names(key), F.max_by, F.struct(*rank))


def overlay(history: DataFrame, current: DataFrame, key: str | Sequence[str], order: str | Sequence[str] = "_seq") -> DataFrame:
    """Latest row per key of both; any current row wins over history."""
    both = history.withColumn("_now", F.lit(0)).unionByName(current.withColumn("_now", F.lit(1)), allowMissingColumns=True)
    return latest(both, key, ["_now", *names(order)]).drop("_now")


def successful(log: DataFrame, status: str = "status", good: str = "success", payload: str | None = None) -> DataFrame:
    """Rows whose status says success, with a payload when one is named."""
    kept = log.filter(F.lower(quoted(status)) == good.lower())
    return kept.filter(non_empty(quoted(payload))) if payload else kept


def found_rows(log: DataFrame) -> DataFrame:
    """Search log rows with a result: found, with a query and a URL."""
    kept = log.filter((F.lower("FOUND") == "true") & non_empty("query") & non_empty("url"))
    return kept.withColumns({"query": strip("query"), "url": strip("url")})


def exclude_urls(df: DataFrame, pattern: str | None, url: str = "url") -> DataFrame:
    return df.filter(~F.coalesce(quoted(url), F.lit("")).rlike(pattern)) if pattern else df


def pending(
    df: DataFrame,
    log: DataFrame,
    key: str,
    policy: str = "any",
    log_key: str | None = None,
    status: str = "status",
    good: str = "success",
) -> DataFrame:
    """Rows whose key the log does not settle yet.

    ``any``: a key counts as done once it was tried; ``success``: only once
    it succeeded.
    """
    if policy not in ("any", "success"):
        raise ValueError(f"policy must be any or success, not {policy!r}")
    done = successful(log, status, good) if policy == "success" else log
    source = quoted(log_key or key)
    settled = done.filter(non_empty(source)).select(strip(source).alias(key)).distinct().withColumn("_settled", F.lit(True))
    # a lookup and not an anti join: it splits frequent keys and spreads rows without one
    return lookup(df, settled, key).filter(F.col("_settled").isNull()).select(*[quoted(c) for c in df.columns])


def rows_done(
    search_log: DataFrame,
    snapshots: DataFrame,
    row_key: Sequence[str] = ("sheet", "row"),
    error: str = "search_error",
    urls: Sequence[str] = ("url1", "url2", "url3"),
) -> DataFrame:
    """Keys of rows that have an error-free search with every URL snapshotted.

    Any such log row is enough. A row without URLs is done.
    """
    good = (
        snapshots.filter(filled("snapshot_path").isNotNull() & filled("snapshot_error").isNull())
        .select(F.col("url").alias("_url"))
        .distinct()
        .withColumn("_ok", F.lit(True))
    )
    listed = F.array(*[quoted(u) for u in urls])
    attempts = (
        search_log.filter(filled(quoted(error)).isNull() & quoted(row_key[-1]).isNotNull())
        .select(*row_key, F.array_sort(F.array_distinct(F.filter(listed, lambda u: cell(u) != ""))).alias("_urls"))
        .distinct()
    )
    exploded = attempts.withColumn("_url", F.explode_outer("_urls"))
    checked = lookup(exploded, good, "_url")
    complete = checked.groupBy(*row_key, "_urls").agg(F.bool_and(F.col("_url").isNull() | F.coalesce("_ok", F.lit(False))).alias("_done"))
    return complete.filter("_done").select(*row_key).distinct()


def extraction_status(urls: DataFrame, snapshots: DataFrame, artifacts: DataFrame, method: str = "auto", force: bool = False) -> DataFrame:
    """``urls`` (with ``url_hash``) plus status no_snapshot, already_extracted or ready.

    ``snapshots`` has ``url_hash``; ``artifacts`` has ``url_hash`` and ``method``.
    """
    if method not in ("auto", "langextract", "regexp"):
        raise ValueError(f"unknown method {method!r}")
    kept = artifacts if method == "auto" else artifacts.filter(F.col("method") == method)
    stages = snapshots.select("url_hash", F.lit(1).alias("_stage")).unionByName(kept.select("url_hash", F.lit(2).alias("_stage")))
    state = stages.groupBy("url_hash").agg(
        F.bool_or(F.col("_stage") == 1).alias("_snap"), F.bool_or(F.col("_stage") == 2).alias("_art")
    )
    status = (
        F.when(~F.coalesce("_snap", F.lit(False)), "no_snapshot")
        .when(F.coalesce("_art", F.lit(False)) & F.lit(not force), "already_extracted")
        .otherwise("ready")
    )
    return lookup(urls, state, "url_hash").withColumn("status", status).drop("_snap", "_art")


def top_n(df: DataFrame, by: str | Sequence[str], order: Sequence[str], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key, numbered from 1; each task keeps only ``n`` per key before the shuffle."""
    w = Window.partitionBy(*[quoted(c) for c in names(by)]).orderBy(*[quoted(c) for c in order])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def position(c: Column | str) -> Column:
    """Result position; what does not parse counts as 0."""
    return F.coalesce(as_column(c).try_cast("int"), F.lit(0))


def tasks_for(df: DataFrame) -> int:
    """Tasks for a grouping of all rows: as the session says, more where each would get too many rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], nth: str = "nth", tasks: int | None = None) -> DataFrame:
    """Rows numbered from 1 within their group, however large the group is.

    The rows are sorted into ranges by group and order, so a large group lies
    in several ranges; each range counts its own rows, and the counts of the
    ranges before it are added. ``tasks`` is the number of ranges.
    """
    groups = [quoted(c) for c in by]
    place = [*groups, *[quoted(c) for c in order]]
    count = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # settled, for Spark draws the bounds of the ranges anew whenever it computes them
    ranged = settle(rows.repartitionByRange(count, *place).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *groups).orderBy(*[quoted(c) for c in order])
    local = (ranged.repartition(count, "_range") if tasks else ranged).withColumn("_local", F.row_number().over(inside))
    sizes = ranged.groupBy("_range", *groups).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("_range", *groups, F.sum("_size").over(before).alias("_start")).filter("_start IS NOT NULL")
    start = start.select(F.col("_range").alias("_r"), F.col("_start"), *[quoted(c).alias(f"_by{i}") for i, c in enumerate(by)])
    same = reduce(lambda x, y: x & y, [quoted(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], F.col("_range") == F.col("_r"))
    # only the first group of a range can have begun before it: one row a range at most
    joined = local.join(F.broadcast(start), same, "left")
    return joined.select(*[quoted(c) for c in rows.columns], (F.col("_local") + F.coalesce("_start", F.lit(0))).alias(nth))


def distinct_values(
    df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], apart: Column | None = None, tied: bool = False, tasks: int | None = None
) -> DataFrame:
    """Distinct values of each group, one per row, numbered from 1 in order: the groups, ``value`` and ``nth``.

    Rows that differ in ``apart`` do not count as repeats. ``tied`` says that a
    value always has the same place, which spares looking for its first one.
    Repeats are dropped twice: among those of one task of the input, spread
    over all ``tasks``, then among what is left, so that a frequent value does
    not meet in one task and no task holds more than its share of the rows.
    """
    tasks = tasks or tasks_for(df)
    groups = [quoted(c) for c in by]
    place = quoted(order[0]) if len(order) == 1 else F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order)])
    rows = df.select(*groups, quoted(value).alias("_v"), place.alias("_o"), *([] if apart is None else [apart.alias("_a")]))
    same = [quoted(c) for c in rows.columns if tied or c != "_o"]

    def once(rows: DataFrame, *keys: Column) -> DataFrame:
        spread = rows.repartition(tasks, *keys)
        return spread.dropDuplicates() if tied else spread.groupBy(*keys).agg(F.min("_o").alias("_o"))

    few = once(rows.withColumn("_p", F.spark_partition_id()), *same, F.col("_p")).drop("_p")
    return numbered(once(few, *same), by, ["_o", "_v"], tasks=tasks).select(*groups, F.col("_v").alias(value), "nth")


def joined_cells(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    order: Sequence[str],
    sep: str,
    out: str = "text",
    apart: Column | None = None,
    tied: bool = False,
    length: int = 10_000,
) -> DataFrame:
    """Distinct values of each group joined into texts, in order.

    A rendering of :func:`distinct_values`: row ``part`` (from 0) of a group
    holds its values from ``part * length`` on, at most ``length`` of them. The
    rule is the same for every group, and the parts in order are the whole.
    """
    by, tasks = list(by), tasks_for(df)
    values = distinct_values(df, by, value, order, apart, tied, tasks)
    cut = values.select(*[quoted(c) for c in by], F.floor((F.col("nth") - 1) / length).cast("int").alias("part"), "nth", quoted(value).alias("_v"))
    listed = F.array_sort(F.collect_list(F.struct("nth", "_v")))
    text = F.array_join(F.transform(listed, lambda x: x["_v"].cast("string")), sep)
    cells = [*[quoted(c) for c in by], F.col("part")]
    return cut.repartition(tasks, *cells).groupBy(*cells).agg(text.alias(out))


def merge_values(values: Column | str, sep: str = ";") -> Column:
    """Array of texts as one text: trimmed, blanks dropped, first of equals kept."""
    arr = F.col(values) if isinstance(values, str) else values
    kept = F.filter(F.transform(arr, cell), lambda v: v != "")
    return F.array_join(F.array_distinct(kept), sep)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key columns are all null."""
    return df.dropna(how="all", subset=list(keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first few keys that occur more than once."""
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return sample_head(counted.filter("n > 1"), n, keys)


def check_unique(df: DataFrame, keys: Sequence[str], label: str = "table") -> None:
    found = [tuple(r)[:-1] for r in duplicate_keys(df, keys).collect()]
    if found:
        raise ValueError(f"{label}: key {list(keys)} is not unique, for example {found}")


def sample_head(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """A few rows to show; with ``order`` always the same ones."""
    return (df.orderBy(*[quoted(c) for c in order]) if order else df).limit(n)


def in_input_order(df: DataFrame, row: str = "_row") -> DataFrame:
    """Order for a report; apply at the sink only."""
    return df.orderBy(row)


def order_by_source(df: DataFrame, columns: Sequence[str] = ("source_sheet", "source_row", "source_column")) -> DataFrame:
    return df.orderBy(*columns)
