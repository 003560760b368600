"""Run logs: what is pending, what came last, resuming, counting."""

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetflow.functions.curl import parse_block, parse_curl, render_curl
from sheetflow.functions.institutions import extract_auto
from sheetflow.functions.strings import sha1_hex
from sheetflow.operators import reports
from sheetflow.operators.enrich import (
    MODEL_RETRY,
    CallFailed,
    RetryPolicy,
    ask_model,
    attach,
    call_each,
    enrich,
    model_outcome,
    new_tasks,
    prompt_text,
    scan_input,
)
from sheetflow.operators.keyed import extraction_status, latest, overlay, pending, rows_done, successful
from sheetflow.plans.registry import query
from sheetflow.plans.texts import REPLY, by_type, sql_by_type
from sheetflow.session import work_dir
from sheetflow.sources.logs import append_log, compact_log, read_log, write_csv_bom
from sheetflow.sources.textfiles import read_blocks, read_lines
from sheetflow.streaming.watch import watch


def event_log(t):
    """Events as a run log of users: an error is a failed try, later rows are newer."""
    return t.events.select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("success").alias("status"),
        "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "value",
        "event_id",
        F.struct("ts", "event_id").alias("_seq"),
    )


LOG = """WITH log AS (SELECT CAST(user_id AS VARCHAR) AS key, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'success' END AS status,
  event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, event_id, ts FROM events)"""


@query(
    """WITH done AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 90)
SELECT c_custkey AS _row, CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM done)"""
)
def pending_any(t):
    # all other events are those of names that are no task
    mine = (F.col("event_type") == "purchase") & (F.col("value") > 90)
    tried = t.events.select(F.concat(F.when(mine, " ").otherwise("other "), F.col("user_id").cast("string")).alias("user"))
    tasks = t.customer.select(F.col("c_custkey").alias("_row"), F.col("c_custkey").cast("string").alias("key"))
    return pending(tasks, tried, "key", "any", log_key="user")


@query(
    LOG
    + """ SELECT c_custkey AS _row, CAST(c_custkey AS VARCHAR) AS key FROM customer
WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT key FROM log WHERE status = 'success' AND value > 100)"""
)
def pending_success(t):
    tasks = t.customer.select(F.col("c_custkey").alias("_row"), F.col("c_custkey").cast("string").alias("key"))
    half = (F.col("status") == "success") & (F.col("value") <= 100)
    return pending(tasks, event_log(t).withColumn("status", F.when(half, "partial").otherwise(F.col("status"))), "key", "success")


SEARCH_LOG = """sl AS (SELECT event_type AS sheet, event_id AS row, 'user ' || user_id AS keywords, CAST(ts AS VARCHAR) AS search_time, CAST(floor(value) AS BIGINT) AS search_duration_ms,
  CASE WHEN k % 4 = 0 THEN '' ELSE '[' || array_to_string(list_transform(range(k % 5), lambda i: '{"url":"' || i || '"}'), ',') || ']' END AS search_result_json,
  CASE WHEN k % 7 = 0 THEN 'HTTP 500' ELSE '' END AS search_error,
  CASE WHEN k % 4 > 0 AND k % 5 > 0 THEN 'http://u/' || (k % 50) ELSE '' END AS url1, CASE WHEN k % 4 > 0 AND k % 5 > 1 THEN 'http://u/' || (k % 20) ELSE '' END AS url2,
  CASE WHEN k % 4 > 0 AND k % 5 > 3 THEN 'http://hot/' ELSE '' END AS url3, ts, event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
SNAP_LOG = """nl AS (SELECT CASE WHEN value <= 3 THEN 'http://gone/' || (k % 40) WHEN k % 3 = 0 THEN 'http://hot/' ELSE 'http://u/' || (k % 40) END AS url, CASE WHEN event_type <> 'error' THEN 'aa/bb/' || k ELSE '' END AS snapshot_path,
  CASE WHEN event_type IN ('error', 'view') THEN 'timeout ' || k ELSE '' END AS snapshot_error, ts, event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def keyword_logs(t):
    """A search log and a snapshot log whose keys repeat, with one hot URL."""
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    seq = F.struct("ts", "event_id").alias("_seq")
    k = F.col("k")
    some = k % 4 > 0

    def link(test, value):
        return F.when(some & test, value).otherwise("")

    entries = F.transform(F.slice(F.sequence(F.lit(0), F.lit(4)), F.lit(1), k % 5), lambda i: F.concat(F.lit('{"url":"'), i.cast("string"), F.lit('"}')))
    search = e.select(
        F.col("event_type").alias("sheet"),
        F.col("event_id").alias("row"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("keywords"),
        F.col("ts").cast("string").alias("search_time"),
        F.floor("value").alias("search_duration_ms"),
        F.when(~some, "").otherwise(F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]"))).alias("search_result_json"),
        F.when(k % 7 == 0, "HTTP 500").otherwise("").alias("search_error"),
        link(k % 5 > 0, F.concat(F.lit("http://u/"), (k % 50).cast("string"))).alias("url1"),
        link(k % 5 > 1, F.concat(F.lit("http://u/"), (k % 20).cast("string"))).alias("url2"),
        link(k % 5 > 3, F.lit("http://hot/")).alias("url3"),
        seq,
    )
    snap = e.select(
        # pages that nobody asks for
        F.when(F.col("value") <= 3, F.concat(F.lit("http://gone/"), (k % 40).cast("string"))).when(k % 3 == 0, "http://hot/").otherwise(F.concat(F.lit("http://u/"), (k % 40).cast("string"))).alias("url"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("aa/bb/"), k.cast("string"))).otherwise("").alias("snapshot_path"),
        F.when(F.col("event_type").isin("error", "view"), F.concat(F.lit("timeout "), k.cast("string"))).otherwise("").alias("snapshot_error"),
        seq,
    )
    return search, snap


@query(
    f"""WITH {SEARCH_LOG}, {SNAP_LOG}, good AS (SELECT DISTINCT url FROM nl WHERE snapshot_path <> '' AND snapshot_error = '')
SELECT DISTINCT sheet, row FROM sl WHERE search_error = '' AND (url1 = '' OR url1 IN (FROM good)) AND (url2 = '' OR url2 IN (FROM good)) AND (url3 = '' OR url3 IN (FROM good))"""
)
def rows_finished(t):
    return rows_done(*keyword_logs(t))


@query(LOG + " SELECT key, status, event_type, k, value, event_id FROM log QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1")
def latest_log(t):
    return latest(event_log(t), "key").drop("_seq")


@query(
    LOG
    + """ SELECT key, status, event_type, k, value, event_id FROM log
QUALIFY row_number() OVER (PARTITION BY key ORDER BY CASE WHEN status = 'success' THEN 0 ELSE 1 END, ts DESC, event_id DESC) = 1"""
)
def latest_success_first(t):
    """A success outlives later failures."""
    return latest(event_log(t), "key", prefer=F.col("status") == "success").drop("_seq")


@query(
    LOG
    + """, tagged AS (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-25' AND event_type IN ('click', 'error') THEN 1 ELSE 0 END AS now FROM log)
SELECT key, status, event_type, k, value, event_id FROM tagged QUALIFY row_number() OVER (PARTITION BY key ORDER BY now DESC, ts DESC, event_id DESC) = 1"""
)
def overlay_log(t):
    """The current run is laid over history, even where history has newer rows."""
    log = event_log(t)
    current = (F.col("_seq.ts") >= F.lit("2024-01-25").cast("timestamp")) & F.col("event_type").isin("click", "error")
    return overlay(log.filter(~current), log.filter(current), "key").drop("_seq")


@query(
    """WITH u AS (SELECT page_id, url, sha1(url) AS url_hash, url LIKE 'https:%' AS snap, url LIKE '%/en/%' AS rules, url LIKE '%.com/%' AS model FROM pages),
a AS (SELECT page_id, url_hash, CASE WHEN NOT snap THEN 'no_snapshot' WHEN rules OR model THEN 'already_extracted' ELSE 'ready' END AS auto,
  CASE WHEN NOT snap THEN 'no_snapshot' WHEN rules THEN 'already_extracted' ELSE 'ready' END AS regexp,
  CASE WHEN NOT snap THEN 'no_snapshot' ELSE 'ready' END AS forced FROM u) SELECT * FROM a"""
)
def artifact_status(t):
    u = t.pages.select("page_id", "url", sha1_hex("url").alias("url_hash"))
    snaps = u.filter("url LIKE 'https:%'")
    arts = u.filter("url LIKE '%/en/%'").select("url_hash", F.lit("regexp").alias("method")).unionByName(
        u.filter("url LIKE '%.com/%'").select("url_hash", F.lit("langextract").alias("method"))
    )
    base = u.select("page_id", "url_hash")
    out = extraction_status(base, snaps, arts, "auto").withColumnRenamed("status", "auto")
    out = extraction_status(out, snaps, arts, "regexp").withColumnRenamed("status", "regexp")
    return extraction_status(out, snaps, arts, "auto", force=True).withColumnRenamed("status", "forced")


@query(
    LOG
    + """ SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
 0::BIGINT AS pending, round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 1) AS percent FROM log"""
)
def run_counts(t):
    return reports.run_stats(event_log(t))


@query(
    LOG
    + """ SELECT count(*) AS success, sum(k)::BIGINT AS prompt_tokens, sum(2 * k)::BIGINT AS completion_tokens, sum(3 * k)::BIGINT AS total_tokens,
 sum(k)::DOUBLE / 4 AS cost, sum(k)::DOUBLE / 2 AS elapsed_time, sum(k)::DOUBLE / 2 / count(*) AS seconds_per_success FROM log WHERE status = 'success'"""
)
def usage_totals(t):
    k = F.col("k")
    log = event_log(t).withColumns(
        {"prompt_tokens": k, "completion_tokens": 2 * k, "total_tokens": 3 * k, "cost": k.cast("double") / 4, "elapsed_time": k.cast("double") / 2}
    )
    return reports.usage_stats(log)


@query("SELECT event_type AS method, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def method_counts(t):
    return reports.method_stats(successful(event_log(t).withColumn("state", F.when(F.col("status") == "failed", "failed").otherwise("Success")), "state"), "event_type")


# -- enrichment ---------------------------------------------------------------


def describe_host(row):
    """Stands for a remote call: fails on some hosts, and once on others."""
    host = row["url"].split("/")[2]
    if host.endswith(".net"):
        raise CallFailed("Read timed out", "timeout")
    return {"host": host, "size": len(row["url"])}


@query(
    """WITH tasks AS (SELECT regexp_replace(url, '[?#].*$', '') AS url, page_id AS _row FROM pages),
once AS (SELECT url, min(_row) AS _row FROM tasks GROUP BY url),
todo AS (SELECT * FROM once WHERE url NOT IN (SELECT url FROM tasks WHERE url LIKE '%/fr/%')),
h AS (SELECT *, split_part(url, '/', 3) AS host FROM todo)
SELECT url, _row, CASE WHEN host LIKE '%.net' THEN NULL ELSE host END AS host, CASE WHEN host LIKE '%.net' THEN NULL ELSE length(url) END AS size,
  CASE WHEN host LIKE '%.net' THEN 'failed' ELSE 'success' END AS status, CASE WHEN host LIKE '%.net' THEN 'timeout' ELSE '' END AS error_type,
  CASE WHEN host LIKE '%.net' THEN 'attempt 1: Read timed out; attempt 2: Read timed out' ELSE '' END AS error_message,
  CASE WHEN host LIKE '%.net' THEN 2 ELSE 1 END AS attempts FROM h"""
)
def enrich_resume(t):
    """Distinct URLs that the log has not seen, each called once, with one retry."""
    tasks = t.pages.select(F.regexp_replace("url", "[?#].*$", "").alias("url"), F.col("page_id").alias("_row"))
    log = tasks.filter("url LIKE '%/fr/%'").select("url")
    once = new_tasks(tasks, "url", ["_row"], log)
    called = call_each(once, describe_host, "host string, size long", RetryPolicy(times=1, delay=0.0, keep="all"), partitions=8, key="url")
    return called.drop("duration_ms", "called_at")


@query(
    """WITH u AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS bare FROM pages)
SELECT page_id, bare AS url, CASE WHEN split_part(bare, '/', 3) LIKE '%.net' THEN NULL ELSE split_part(bare, '/', 3) END AS host,
  CASE WHEN split_part(bare, '/', 3) LIKE '%.net' THEN 'failed' ELSE 'success' END AS status FROM u"""
)
def enrich_log(t):
    """Two runs on one log: the second calls only new URLs; the log joins back to every page."""
    path = work_dir(t.spark, "enrich-log")
    asked = t.pages.select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"), F.col("page_id").alias("_row"))
    retry = RetryPolicy(times=0)
    enrich(asked.filter("url LIKE 'https:%'"), "url", describe_host, "host string", path, retry=retry)
    log = enrich(asked, "url", describe_host, "host string", path, retry=retry)
    return attach(asked.select("page_id", "url"), log, "url", ["host", "status"])


@query("SELECT url, count(*) AS n, 'success' AS status FROM pages GROUP BY url")
def watch_folder(t):
    """A streamed folder ends up in the log once per URL, also when it is read twice."""
    path = work_dir(t.spark, "watch-log")
    inbox = work_dir(t.spark, "watch-inbox")
    t.pages.select("page_id", "url").write.parquet(inbox)
    for _ in range(2):
        watch(
            t.spark, inbox, "page_id long, url string", "url", lambda row: {"size": len(row["url"])}, "size long", path, order=["page_id"], retry=RetryPolicy(times=0)
        ).awaitTermination()
    return read_log(t.spark, path).groupBy("url", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH r AS (SELECT event_id, event_type AS e, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, {sql_by_type(REPLY)} AS reply FROM events),
o AS (SELECT *, CASE WHEN e = 'view' AND value > 60 THEN 'rate_limit' WHEN e = 'error' AND value <= 50 THEN 'json_parse_error' WHEN e = 'click' THEN NULL
  WHEN k < 0 THEN 'validation_error' END AS error_type FROM r)
SELECT event_id, CASE WHEN error_type IS NULL THEN 'success' ELSE 'failed' END AS status, error_type,
 CASE error_type WHEN 'rate_limit' THEN 'HTTP 429' WHEN 'json_parse_error' THEN 'Failed to extract JSON from response' END AS error_message,
 CASE WHEN error_type IS NOT NULL THEN 0 WHEN e = 'click' THEN 2 ELSE 1 END AS results_count,
 CASE WHEN error_type = 'rate_limit' THEN NULL ELSE k / 1000000.0::DOUBLE * 1.0::DOUBLE + 10 / 1000000.0::DOUBLE * 8.0::DOUBLE END AS cost FROM o"""
)
def model_replies(t):
    """Outcome of model calls from reply, error and token use."""
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    failed = F.when((F.col("event_type") == "view") & (F.col("value") > 60), "HTTP 429")
    calls = e.select("event_id", by_type(REPLY).alias("reply"), failed.alias("failure"), "k", F.lit(10).alias("out"))
    judged = model_outcome(calls, "reply", "failure", ["k"], "k", "out", 1.0, 8.0)
    return judged.select("event_id", "status", "error_type", "error_message", "results_count", "cost")


@query(
    """SELECT page_id, 'Journal {x} J' || page_id || ': ' || CASE WHEN url LIKE 'https:%' THEN url ELSE '无' END || ' or 无' AS prompt,
 CASE WHEN url LIKE 'https:%' THEN NULL ELSE '两个 URL 均为空' END AS problem FROM pages"""
)
def scan_prompts(t):
    p = t.pages.select("page_id", scan_input(F.when(F.col("url").startswith("https:"), F.col("url")), F.lit(" ")).alias("s"))
    name = F.concat(F.lit("J"), F.col("page_id").cast("string"))
    text = prompt_text("Journal {x} {journal_name}: {url1} or {url2}", {"journal_name": name, "url1": F.col("s.url1"), "url2": F.col("s.url2")})
    return p.select("page_id", text.alias("prompt"), F.col("s.problem").alias("problem"))


def scan_reply(prompt):
    """Stands for a model: prose around JSON, sometimes an error, sometimes nothing of use."""
    if ".net/" in prompt:
        raise RuntimeError("429 Too Many Requests")
    if "/fr/" in prompt:
        return {"reply": "I found nothing.", "prompt_tokens": len(prompt)}
    if "/es/" in prompt:
        return {"reply": '{"name": "x"}', "prompt_tokens": len(prompt), "completion_tokens": 5}
    return {"reply": f'Sure: [{{"name": "N", "unit": "{prompt[5:20]}"}}, {{"name": "no unit"}}] ok', "prompt_tokens": len(prompt), "completion_tokens": 10}


@query(
    """WITH p AS (SELECT page_id, url, 'Scan ' || CASE WHEN url LIKE 'https:%' THEN url ELSE '' END AS prompt FROM pages),
k AS (SELECT *, CASE WHEN url NOT LIKE 'https:%' THEN 'invalid_input' WHEN prompt LIKE '%.net/%' THEN 'rate_limit' WHEN prompt LIKE '%/fr/%' THEN 'json_parse_error'
  WHEN prompt LIKE '%/es/%' THEN 'validation_error' END AS kind FROM p)
SELECT page_id, CASE WHEN kind IS NULL THEN 'success' ELSE 'failed' END AS status, CASE WHEN kind IS NULL THEN 1 ELSE 0 END AS results_count, kind AS error_type,
 CASE kind WHEN 'invalid_input' THEN '两个 URL 均为空' WHEN 'rate_limit' THEN '429 Too Many Requests' WHEN 'json_parse_error' THEN 'Failed to extract JSON from response'
   WHEN 'validation_error' THEN 'No valid result items found' END AS error_message,
 CASE WHEN kind IS NULL OR kind IN ('json_parse_error', 'validation_error') THEN length(prompt) END AS prompt_tokens,
 CASE WHEN kind IS NULL THEN length(prompt) + 10 WHEN kind = 'validation_error' THEN length(prompt) + 5 END AS total_tokens,
 CASE WHEN kind IS NULL THEN length(prompt) / 1000000.0::DOUBLE * 1.0::DOUBLE + 10 / 1000000.0::DOUBLE * 8.0::DOUBLE
   WHEN kind = 'validation_error' THEN length(prompt) / 1000000.0::DOUBLE * 1.0::DOUBLE + 5 / 1000000.0::DOUBLE * 8.0::DOUBLE END AS cost,
 CASE WHEN kind IS NULL THEN '[{"name":"N","unit":"' || prompt[6:20] || '"}]' END AS results_json FROM k"""
)
def model_scan(t):
    """Prompts, calls and judged replies of a scan of all pages."""
    pages = t.pages.select("page_id", F.when(F.col("url").startswith("https:"), F.col("url")).otherwise("").alias("url1"))
    asked = ask_model(
        pages,
        F.concat(F.lit("Scan "), "url1"),
        scan_reply,
        ["name", "unit"],
        1.0,
        8.0,
        problem=scan_input("url1", F.lit(""))["problem"],
        retry=replace(MODEL_RETRY, delay=0.0),
        partitions=8,
    )
    return asked.select("page_id", "status", "results_count", "error_type", "error_message", "prompt_tokens", "total_tokens", "cost", "results_json")


@query(
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'langextract' ELSE 'regexp' END AS method,
 CASE WHEN event_type = 'click' THEN 'model ' || user_id ELSE 'rules ' || user_id END AS name FROM events"""
)
def method_fallback(t):
    """The model's items where it has any, else the rules'."""
    kind = F.col("event_type")

    def items(label):
        return F.array(F.struct(F.concat(F.lit(label), F.col("user_id").cast("string")).alias("name")))

    nothing = F.filter(items(""), lambda x: F.lit(False))
    model = F.when(kind == "click", items("model ")).when(kind == "view", nothing)
    picked = extract_auto(model, items("rules "))
    return t.events.select("event_id", picked.alias("p")).select("event_id", "p.method", F.col("p.items")[0]["name"].alias("name"))


# -- files --------------------------------------------------------------------


def drifted(t, fmt: str):
    """Two appends of the events whose rule columns differ."""
    path = work_dir(t.spark, f"drift-{fmt}")
    rows = t.events.select(F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("url"), F.lit("true").alias("SUCCESS"), "event_type", "user_id")
    click = F.col("event_type") == "click"
    append_log(rows.filter(click).select("url", "SUCCESS", F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("price")), path, fmt)
    append_log(rows.filter(~click).select("url", "SUCCESS", F.col("event_type").alias("title")), path, fmt)
    return read_log(t.spark, path, fmt=fmt).select("url", "SUCCESS", "price", "title")


DRIFT = """SELECT 'k' || event_id AS url, 'true' AS SUCCESS, CASE WHEN event_type = 'click' THEN 'p' || user_id {other} END AS price,
 CASE WHEN event_type <> 'click' THEN event_type {other} END AS title FROM events"""


@query(DRIFT.format(other=""))
def log_drift_parquet(t):
    return drifted(t, "parquet")


@query(DRIFT.format(other="ELSE ''"))
def log_drift_csv(t):
    return drifted(t, "csv")


@query(
    """WITH log AS (SELECT DISTINCT ON (user_id, event_type = 'error') CASE WHEN event_type = 'error' THEN 'lost "' ELSE 'user "' END || user_id || '"' AS journal_name, event_type AS status, CAST(json_extract_string(props, '$.k') AS BIGINT) AS total_tokens,
   '[' || props || ',' || chr(10) || '"é"]' AS results_json FROM events ORDER BY user_id, event_type = 'error', ts DESC, event_id DESC)
SELECT *, '' AS error_type FROM log"""
)
def log_files(t):
    """A log appended as CSV in two runs, read back, latest row per name."""
    path = work_dir(t.spark, "csv-log")
    rows = t.events.select(
        F.concat(F.when(F.col("event_type") == "error", 'lost "').otherwise('user "'), F.col("user_id").cast("string"), F.lit('"')).alias("journal_name"),
        F.col("event_type").alias("status"),
        F.get_json_object("props", "$.k").alias("total_tokens"),
        F.concat(F.lit("["), "props", F.lit(',\n"é"]')).alias("results_json"),
        F.concat_ws(" ", F.col("ts").cast("string"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("search_time"),
        F.lit(None).cast("string").alias("error_type"),
    )
    early = F.substring("search_time", 1, 10) < "2024-01-15"
    for part in (rows.filter(early), rows.filter(~early)):
        append_log(part, path, "csv")
    back = read_log(t.spark, path, "model_search", "csv")
    last = latest(back, "journal_name", ["search_time", "_seq"])
    return last.select("journal_name", "status", "total_tokens", "results_json", "error_type")


def in_files(t, text, path):
    """A text of each page written to four files, in order of the pages."""
    t.pages.repartitionByRange(4, "page_id").sortWithinPartitions("page_id").select(text).write.text(path)


def in_place(number):
    """Whether ``seq`` is the place of the page among those of its file."""
    return (F.col("seq") == F.row_number().over(Window.partitionBy("file").orderBy(number))).alias("in_place")


@query("SELECT page_id, page_id || ' ' || url AS line, true AS in_place FROM pages")
def line_files(t):
    """URLs written as text between blank lines and read back; each line has its number."""
    path = work_dir(t.spark, "lines")
    in_files(t, F.concat(F.lit("  "), F.col("page_id").cast("string"), F.lit(" "), "url", F.lit("\r\n  ")), path)
    lines = read_lines(t.spark, path).withColumn("page_id", F.split("line", " ")[0].cast("long"))
    return lines.select("page_id", "line", in_place("page_id"))


@query(
    LOG
    + """, runs AS (SELECT key, status, event_type, event_id, CASE WHEN event_type = 'click' THEN 3 ELSE event_id % 2 + 1 END AS run FROM log)
SELECT key, status, event_type, event_id FROM runs QUALIFY row_number() OVER (PARTITION BY key ORDER BY run DESC, event_id DESC) = 1"""
)
def log_compacted(t):
    """Two runs are rewritten as one commit with a row per key, a third run follows: the latest rows are those of the runs."""
    path = work_dir(t.spark, "compacted-log")
    rows = event_log(t).select("key", "status", "event_type", "event_id")
    click = F.col("event_type") == "click"
    for run in (0, 1):
        append_log(rows.filter(~click & (F.col("event_id") % 2 == run)).orderBy("event_id"), path)
    compact_log(t.spark, path, "key", purge=True)
    append_log(rows.filter(click).orderBy("event_id"), path)
    return latest(read_log(t.spark, path), "key").drop("_seq")


@query("SELECT CAST(event_id AS VARCHAR) AS \"序号\", event_type, props || chr(10) || '\"é\"' AS props FROM events")
def csv_with_bom(t):
    """Events written as CSV for spreadsheet programs, read back without the byte order mark."""
    path = work_dir(t.spark, "bom")
    write_csv_bom(t.events.select(F.col("event_id").alias("序号"), "event_type", F.concat("props", F.lit('\n"é"')).alias("props")), path)
    return read_log(t.spark, path, fmt="csv").drop("_seq")


CURL = """concat(CASE WHEN url LIKE 'https:%' THEN concat('name=Page ', page_id, '\n') ELSE '' END, CASE WHEN url LIKE '%/en/%' THEN 'expected_json_key=status\n' ELSE '' END,
 'curl ''', url, ''' \\\\\n  -H ''accept: text/html'' \\\\\n  -H ''Cookie: x=1'' \\\\\n  -b ''sid=', page_id, '; t=a=b; keep=1''', CASE WHEN url LIKE '%.com/%' THEN ' \\\\\n  --data-raw ''q=1''' ELSE '' END)"""


@query(
    """SELECT true AS in_place, CASE WHEN url LIKE 'https:%' THEN 'Page ' || page_id ELSE 'Command for ' || url[1:50] || '...' END AS name,
 CASE WHEN url LIKE '%/en/%' THEN 'status' END AS expected_json_key, url, CASE WHEN url LIKE '%.com/%' THEN 'POST' ELSE 'GET' END AS method,
 'text/html' AS accept, CAST(page_id AS VARCHAR) AS sid, 'a=b' AS t, CASE WHEN url LIKE '%.com/%' THEN 'q=1' END AS data,
 'curl ''' || url || ''' \\' || chr(10) || '  -H ''accept: text/html'' \\' || chr(10) || '  -b ''sid=' || page_id || '; keep=1''' ||
   CASE WHEN url LIKE '%.com/%' THEN ' \\' || chr(10) || '  --data-raw ''q=1''' ELSE '' END AS smaller
FROM pages"""
)
def curl_files(t):
    """Command blocks written as text, read back, taken apart and written smaller."""
    path = work_dir(t.spark, "blocks")
    block = F.concat(F.lit("[CURL_START]\n"), F.expr(CURL), F.lit("\n[CURL_END]\n# between"))
    in_files(t, block, path)
    blocks = read_blocks(t.spark, path).withColumn("b", parse_block("block")).filter("b IS NOT NULL")
    parts = blocks.withColumn("r", parse_curl("b.command"))
    return parts.select(
        in_place(F.col("r.cookies")["sid"].cast("long")),
        "b.name",
        "b.expected_json_key",
        "r.url",
        "r.method",
        F.col("r.headers")["accept"].alias("accept"),
        F.col("r.cookies")["sid"].alias("sid"),
        F.col("r.cookies")["t"].alias("t"),
        "r.data",
        render_curl("r", F.array(F.lit("sid"), F.lit("keep"))).alias("smaller"),
    )
