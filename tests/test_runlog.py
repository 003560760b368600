"""Logs with run numbers: what counts, in which order, and what is read."""

import glob
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sheetflow.operators.enrich import RetryPolicy, enrich
from sheetflow.operators.keyed import latest
from sheetflow.sources import logs
from sheetflow.sources.runlog import RunLog, slice_of
from sheetflow.streaming.watch import watch

NONE = RetryPolicy(times=0)


def slices(spark, keys, of=64):
    return {r["k"]: r["s"] for r in spark.createDataFrame([(k,) for k in keys], "k string").select("k", slice_of(F.col("k"), of).alias("s")).collect()}


def named(journal, *columns):
    return rows(journal.rows(), *columns)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_waves_before_a_failure_are_in_the_log(spark, tmp_path, fmt):
    keys = [f"key {i}" for i in range(200)]
    of, waves = 16, 4
    slot = slices(spark, keys, of)
    bad = next(k for k in keys if slot[k] % waves == 2)
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def call(row, fail=True):
        if fail and row["url"] == bad:
            raise SystemExit("the machine is gone")  # no failed call: it ends the task
        with open(f"{calls}/{row['url']}", "a") as f:
            f.write(".")
        return {"size": len(row["url"])}

    df, log = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "_row int, url string"), str(tmp_path / "log")
    with pytest.raises(Exception, match="machine is gone|crashed|exited"):
        enrich(df, "url", call, "size long", log, retry=NONE, waves=waves, slices=of, fmt=fmt)
    kept = {k for k in keys if slot[k] % waves < 2}
    assert {r["url"] for r in logs.read_log(spark, log, fmt=fmt).collect()} == kept and 0 < len(kept) < len(keys)
    assert [(c.run, c.wave) for c in RunLog(spark, log).commits()] == [(1, 0), (1, 1)]
    tried = set(os.listdir(calls))
    again = enrich(df, "url", lambda row: call(row, False), "size long", log, retry=NONE, waves=waves, slices=of, fmt=fmt)
    assert {r["url"] for r in again.collect()} == set(keys) and again.count() == len(keys)
    # what was committed is not called again
    assert all(os.path.getsize(f"{calls}/{k}") == 1 for k in kept) and kept <= tried
    assert {c.run for c in RunLog(spark, log).commits()} == {1, 2}


def test_a_batch_reads_its_own_slices(spark, tmp_path, monkeypatch):
    inbox, log, place = (str(tmp_path / n) for n in ("in", "log", "progress"))
    read = []
    plain = RunLog.rows

    def spied(self, key=None, slices=None, of=64):
        df = plain(self, key, slices, of)
        if slices is not None:
            read.append(df.inputFiles())
        return df

    monkeypatch.setattr(RunLog, "rows", spied)

    def turn(keys):
        spark.createDataFrame([(k,) for k in keys], "url string").coalesce(1).write.mode("append").parquet(inbox)
        watch(spark, inbox, "url string", "url", lambda row: {"n": 1}, "n int", log, order=["url"], retry=NONE, checkpoint=place, slices=32).awaitTermination()

    turn([f"u{i}" for i in range(300)])
    assert read == []
    turn(["u7", "new"])
    files = glob.glob(f"{log}/rows/*/*/*.parquet")
    wanted = set(slices(spark, ["u7", "new"], 32).values())
    assert 0 < len(read[0]) < len(files) / 8
    assert {int(f.split("_slice=")[1].split("/")[0]) for f in read[0]} <= wanted
    assert logs.read_log(spark, log).count() == 301


def test_only_committed_rows_count(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    logs.append_log(df, path)
    df.write.parquet(f"{path}/rows/00000002-00000-unfinished")
    with open(f"{path}/commits/.00000002-00000-unfinished", "w") as f:
        f.write('{"name": "half a li')
    assert rows(logs.read_log(spark, path), "k", "v") == [("a", 1), ("b", 2)]
    assert RunLog(spark, path).next_run() == 2


def test_a_log_whose_first_commit_was_lost(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("a", 1)], "url string, n int").write.parquet(f"{path}/rows/00000001-00000-unfinished")
    os.mkdir(f"{path}/commits")
    open(f"{path}/commits/.00000001-00000-unfinished", "w").close()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "_row int, url string")
    assert rows(enrich(df, "url", lambda row: {"n": 2}, "n int", path, retry=NONE), "url", "n") == [("a", 2), ("b", 2)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("key", [None, "k"])
def test_order_survives_compaction_and_copies(spark, tmp_path, fmt, key):
    path = str(tmp_path / "log")
    for run in range(4):
        part = [(f"k{i % 7}", f"{run}-{i}") for i in range(run, 40)]
        logs.append_log(spark.createDataFrame(part, "k string, v string").coalesce(1), path, fmt)
    read = lambda p: logs.read_log(spark, p, fmt=fmt)
    last, n = rows(latest(read(path), "k"), "k", "v"), read(path).count()
    assert all(v.startswith("3-") for _, v in last)
    logs.compact_log(spark, path, key, fmt, files=2, purge=key is not None)
    assert rows(latest(read(path), "k"), "k", "v") == last and read(path).count() == (n if key is None else 7)
    assert len(RunLog(spark, path).commits()) == 1 and len(glob.glob(f"{path}/rows/*")) == (5 if key is None else 1)
    logs.append_log(spark.createDataFrame([("k0", "new")], "k string, v string"), path, fmt)
    copy = str(tmp_path / "copy")
    # written anew in another order, with other times
    for source in sorted(glob.glob(f"{path}/**", recursive=True), reverse=True):
        if os.path.isfile(source):
            target = copy + source[len(path) :]
            os.makedirs(os.path.dirname(target), exist_ok=True)
            shutil.copyfile(source, target)
    want = [("k0", "new") if k == "k0" else (k, v) for k, v in last]
    assert rows(latest(read(copy), "k"), "k", "v") == want == rows(latest(read(path), "k"), "k", "v")


def test_compaction_keeps_the_slices(spark, tmp_path):
    journal = RunLog(spark, str(tmp_path / "log"))
    for run in range(3):
        journal.append(spark.createDataFrame([(f" k{i} ", run) for i in range(50)], "k string, v int"), key="k", slices=8)
    journal.compact("k")
    (one,) = journal.commits()
    assert one.slices == list(range(8)) and journal.rows().count() == 50
    part = journal.rows("k", [3], 8)
    assert 0 < part.count() < 20 and {r["s"] for r in part.select(slice_of(F.col("k"), 8).alias("s")).collect()} == {3}
    # asked for other slices than those it is laid out by, a log is read whole
    assert journal.rows("k", [3], 16).count() == 50 == journal.rows("v", [3], 8).count()


def test_columns_drift(spark, tmp_path):
    journal = RunLog(spark, str(tmp_path / "log"))
    journal.append(spark.createDataFrame([("a", 1)], "k string, v int"))
    journal.append(spark.createDataFrame([("b", "x", True)], "k string, v string, w boolean"))
    assert named(journal, "k", "v", "w") == [("a", "1", None), ("b", "x", True)]


def test_empty_appends(spark, tmp_path):
    journal = RunLog(spark, str(tmp_path / "log"))
    none = spark.createDataFrame([], "k string, v int")
    assert journal.compact() is None
    with pytest.raises(ValueError, match="not a log"):
        journal.rows()
    assert journal.append(none, key="k") is not None and journal.rows().count() == 0
    assert journal.append(none, key="k") is None and len(journal.commits()) == 1


def test_plain_folders_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("a", "failed"), ("b", "success")], "url string, status string").coalesce(1).write.parquet(path)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "_row int, url string")
    back = enrich(df, "url", lambda row: {"n": 1}, "n int", path, retry=NONE, policy="success")
    assert rows(latest(back, "url"), "url", "status") == [("a", "success"), ("b", "success"), ("c", "success")] and back.count() == 4
