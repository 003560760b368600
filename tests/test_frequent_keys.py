"""A third of the rows under one key, a third without one: joins must split, results stay whole."""

import pytest
from pyspark.sql import functions as F

from sheetflow.operators import keyed, reports
from sheetflow.operators.enrich import attach

N = 60_000

EAGER_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def split(spark):
    before = {k: spark.conf.get(k, None) for k in EAGER_SPLITS}
    for k, v in EAGER_SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def sheet(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 2000).cast("string")))
    return spark.range(0, N, 1, 4).select(F.col("id").alias("_row"), key.alias("q"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


@pytest.fixture
def log(spark):
    keys = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("_seq"))
    return keys.unionByName(spark.sql("SELECT 'hot' AS key, -1L AS _seq"))


def search(sheet, log):
    results = log.select(F.col("key").alias("query"), F.lit("true").alias("FOUND"), F.lit("1").alias("position"), F.col("key").alias("url"), "_seq")
    return reports.assemble_search(sheet, results, "{{q}}", "hit:url"), "hit1"


def extract(sheet, log):
    results = log.select(F.col("key").alias("url"), F.lit("true").alias("SUCCESS"), F.col("key").alias("hit"), "_seq")
    return reports.assemble_extract(sheet, results, ["q"]), "q-hit"


def stages(sheet, log):
    tries = log.select(F.sha1("key").alias("hash"), F.lit("success").alias("status"), F.lit("").alias("error_type"), "_seq")
    found = log.select(F.sha1("key").alias("url_hash"), F.lit("regexp").alias("method"), F.lit('{"host_institutions": [{"name": "x"}]}').alias("content"))
    journals = sheet.select("_row", F.col("q").alias("name"), F.col("q").alias("url"))
    out = reports.combine_extracted(journals, tries, tries, reports.load_artifacts(found))
    return out.withColumn("hit", F.when(F.col("匹配机构") == "x", "x")), "hit"


def snapshots(sheet, log):
    results = log.select(
        F.lit("s").alias("sheet"), F.col("key").alias("keywords"), F.lit("").alias("search_time"), F.lit(1).alias("search_duration_ms"),
        F.lit("[1]").alias("search_result_json"), F.lit("").alias("search_error"), F.col("key").alias("url1"), F.lit("").alias("url2"), F.lit("").alias("url3"), "_seq",
    )
    shots = log.select(F.col("key").alias("url"), F.lit("p").alias("snapshot_path"), F.lit("").alias("snapshot_error"), "_seq")
    return reports.assemble_snapshots(sheet, results, shots, "A"), "快照1"


def results(sheet, log):
    rows = log.select(F.col("key").alias("journal_name"), F.lit("success").alias("status"), F.lit('[{"主办单位": "x"}]').alias("results_json"), F.lit("").alias("search_time"), F.lit("").alias("error_type"), F.lit("").alias("error_message"))
    out = reports.report_rows(sheet.withColumnRenamed("q", "journal_name"), rows)
    return out.withColumn("hit", F.nullif("主办单位", F.lit(""))), "hit"


def methods(sheet, log):
    rows = log.select(F.col("key").alias("journal_name"), F.lit("success").alias("status"), F.lit('[{"主办单位": "x"}]').alias("results_json"), F.lit("").alias("url1"), F.lit("").alias("url2"), "_seq")
    out = reports.combine_methods(sheet.withColumnRenamed("q", "刊名"), None, rows, rows, "scan,search")
    return out.withColumn("hit", F.nullif("AI核心_主办单位", F.lit(""))), "hit"


def joined_back(sheet, log):
    return attach(sheet, log.withColumnRenamed("key", "q").withColumn("hit", F.lit("x")), "q", ["hit"]), "hit"


@pytest.mark.parametrize("report", [search, extract, stages, snapshots, results, methods, joined_back])
def test_hot_keys_are_split(spark, split, sheet, log, report):
    df, hit = report(sheet, log)
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.count(keyed.quoted(hit)).alias("hits"))
    row = counts.collect()[0]
    assert (row["rows"], row["hits"]) == (N, 2 * N // 3)
    final = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "skew=true" in final


def test_salting_by_hand(spark, split, sheet, log):
    right = log.select(F.col("key").alias("q"), F.lit("x").alias("hit"))
    df = keyed.lookup(sheet, right, "q", spread=8)
    assert df.count() == N and df.filter("hit IS NOT NULL").count() == 2 * N // 3
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in text
