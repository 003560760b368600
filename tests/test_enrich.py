import os
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sheetflow.operators.enrich import MODEL_RETRY, CallFailed, RetryPolicy, ask_model, attach, auto_extract, call_each, enrich, new_tasks, prompt_text, scan_input
from sheetflow.session import checkpoint_root, settle, work_dir
from sheetflow.sources.logs import read_log
from sheetflow.streaming.watch import watch

TASKS = [(1, "a"), (2, "b"), (3, "a"), (4, " "), (5, None), (6, "bad"), (7, " b ")]


@pytest.fixture
def tasks(spark):
    return spark.createDataFrame(TASKS, "_row int, url string")


def noted(folder):
    """A call that leaves a file per attempt, and fails for some keys."""

    def call(row):
        name = row["url"]
        with open(os.path.join(folder, name), "a") as f:
            f.write(".")
        with open(os.path.join(folder, name)) as f:
            tries = len(f.read())
        if name == "bad" or (name == "b" and tries == 1):
            raise CallFailed(f"no {name}", "timeout")
        return {"size": len(name), "label": None}

    return call


def tries(folder):
    return {f: os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder)}


def test_new_tasks(spark, tasks):
    assert rows(new_tasks(tasks, "url", ["_row"])) == [(1, "a"), (2, "b"), (6, "bad")]
    log = spark.createDataFrame([("a", "failed"), ("b", "success")], "url string, status string")
    assert rows(new_tasks(tasks, "url", ["_row"], log)) == [(6, "bad")]
    assert rows(new_tasks(tasks, "url", ["_row"], log, "success")) == [(1, "a"), (6, "bad")]


def test_retries(tasks, tmp_path):
    out = call_each(new_tasks(tasks, "url", ["_row"]), noted(str(tmp_path)), "size long, label string", RetryPolicy(times=1, delay=0, keep="all"), partitions=2, key="url")
    got = rows(out, "url", "size", "label", "status", "error_type", "error_message", "attempts")
    assert got == [("a", 1, None, "success", "", "", 1), ("b", 1, None, "success", "", "", 2), ("bad", None, None, "failed", "timeout", "attempt 1: no bad; attempt 2: no bad", 2)]


def test_retry_only_named_kinds(tasks, tmp_path):
    policy = RetryPolicy(times=3, delay=0, retry_on=("rate_limit",))
    call_each(new_tasks(tasks, "url", ["_row"]), noted(str(tmp_path)), "size long", policy).collect()
    assert tries(tmp_path) == {"a": 1, "b": 1, "bad": 1}
    assert [RetryPolicy(delay=2.0).wait(k) for k in (1, 2, 3)] == [2.0, 4.0, 5.0] and RetryPolicy(delay=5.0, cap=None).wait(3) == 15.0


@pytest.mark.parametrize("policy, second", [("any", {"a": 1, "b": 1, "bad": 1, "c": 1}), ("success", {"a": 1, "b": 2, "bad": 2, "c": 1})])
def test_resume(spark, tasks, tmp_path, policy, second):
    folder, log = str(tmp_path / "calls"), str(tmp_path / "log")
    os.mkdir(folder)
    none = RetryPolicy(times=0)
    first = enrich(tasks, "url", noted(folder), "size long", log, policy=policy, retry=none)
    assert first.count() == 3 and tries(folder) == {"a": 1, "b": 1, "bad": 1}
    more = tasks.unionByName(spark.createDataFrame([(9, "c")], "_row int, url string"))
    again = enrich(more, "url", noted(folder), "size long", log, policy=policy, retry=none)
    assert tries(folder) == second
    # every input key is logged or still pending
    assert {r.url for r in again.collect()} == {"a", "b", "bad", "c"}
    joined = attach(more, again, "url", ["size", "status"], prefer_success=True)
    assert joined.count() == 8 and rows(joined.filter("_row IN (1, 3, 4)"), "_row", "size", "status") == [(1, 1, "success"), (3, 1, "success"), (4, None, None)]


def test_watch(spark, tmp_path):
    inbox, folder, log = str(tmp_path / "in"), str(tmp_path / "calls"), str(tmp_path / "log")
    os.mkdir(folder)
    place = str(tmp_path / "progress")

    def turn():
        watch(spark, inbox, "_row int, url string", "url", noted(folder), "size long", log, retry=RetryPolicy(times=0), checkpoint=place).awaitTermination()
        return rows(read_log(spark, log), "url", "status")

    spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad")], "_row int, url string").write.mode("append").parquet(inbox)
    assert turn() == [("a", "success"), ("bad", "failed")]
    assert turn() == [("a", "success"), ("bad", "failed")]
    spark.createDataFrame([(4, "a"), (5, "c")], "_row int, url string").write.mode("append").parquet(inbox)
    assert turn() == [("a", "success"), ("bad", "failed"), ("c", "success")] and tries(folder) == {"a": 1, "bad": 1, "c": 1}


def test_scan_input(one):
    assert tuple(one(scan_input(F.lit(" "), F.lit("http://x")))) == ("无", "http://x", None)
    assert one(scan_input(F.lit(None).cast("string"), F.lit("")))["problem"] == "两个 URL 均为空"


def test_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root and work_dir(spark, "x").startswith(root + "/x-")
    settled = settle(spark.range(5).withColumn("u", F.uuid()))
    assert settled.collect() == settled.collect()


def test_model_stage(spark):
    def call(prompt):
        if "slow" in prompt:
            raise RuntimeError("Request timed out")
        if "key" in prompt:
            raise RuntimeError("401")
        return {"reply": '[{"a": "%s"}]' % prompt, "prompt_tokens": 1_000_000, "completion_tokens": 0}

    df = spark.createDataFrame([("x", None), ("slow", None), ("key", None), ("none", "blank")], "name string, problem string")
    out = ask_model(df, prompt_text("ask {name} {other}", {"name": F.col("name")}), call, ["a"], problem=F.col("problem"), retry=replace(MODEL_RETRY, delay=0.0))
    got = {r.name: (r.status, r.error_type, r.results_json, r.cost) for r in out.collect()}
    assert got == {
        "x": ("success", None, '[{"a":"ask x {other}"}]', 2.75),
        "slow": ("failed", "timeout", None, None),
        "key": ("failed", "auth_error", None, None),
        "none": ("failed", "invalid_input", None, None),
    }


def test_model_retries():
    made = []

    def flaky(row):
        made.append(row)
        raise RuntimeError("Rate limit" if len(made) < 3 else "401")

    policy = replace(MODEL_RETRY, times=5, delay=0.0)
    assert policy.run(flaky, {})[1:] == ("401", "auth_error", 3) and len(made) == 3


def test_model_first_then_rules(spark, tmp_path):
    """The rules are planned over what the settled model log leaves, and see no other row."""
    seen = str(tmp_path / "seen")
    os.mkdir(seen)
    kind = "array<struct<name:string>>"

    def model(row):
        if row["url"] == "bad":
            raise CallFailed("429", "rate_limit")
        return {"items": [{"name": f"model {row['url']}"}] if row["url"].startswith("m") else []}

    @F.udf(kind)
    def found(text):
        open(os.path.join(seen, text), "w").close()
        return [] if text == "t4" else [{"name": f"rules {text}"}]

    def rules(rows):
        return rows.withColumn("items", found("text"))

    given = [(1, "m1", "t1"), (2, "x", "t2"), (3, "bad", "t3"), (4, "y", "t4"), (5, None, "t5"), (6, " m1 ", "t6")]
    df = spark.createDataFrame(given, "_row int, url string, text string")
    log = str(tmp_path / "log")
    out = auto_extract(df, "url", model, rules, kind, log=log, retry=RetryPolicy(times=0))
    got = {r["_row"]: (r["method"], [i["name"] for i in r["items"]]) for r in out.collect()}
    assert got == {
        1: ("langextract", ["model m1"]), 2: ("regexp", ["rules t2"]), 3: ("regexp", ["rules t3"]), 4: ("regexp", []), 5: ("regexp", ["rules t5"]), 6: ("langextract", ["model m1"]),
    }
    assert set(os.listdir(seen)) == {"t2", "t3", "t4", "t5"} and out.columns == ["_row", "url", "text", "items", "method"]
    # what a call does not ask for does not go into the log
    assert "text" not in read_log(spark, log).columns
    # the log keeps the model's answers: only what failed is asked again
    again = auto_extract(df, "url", lambda row: {"items": [{"name": "second"}]}, rules, kind, log=log, retry=RetryPolicy(times=0))
    assert {r["_row"]: r["method"] for r in again.collect()} == {1: "langextract", 2: "regexp", 3: "langextract", 4: "regexp", 5: "regexp", 6: "langextract"}
