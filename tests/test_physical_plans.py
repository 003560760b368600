"""What the plans must and must not contain."""

import pytest
from conftest import DATA

import __spark_entry__  # noqa: F401  registers the queries
from sheetflow.plans.registry import QUERIES

# Queries that hand work to Python: page texts, workbooks, supplied calls.
PYTHON = {
    "page_text", "page_text_hard", "page_paragraphs", "page_institutions", "xlsx_cells", "enrich_resume", "model_scan",
}
# Queries that write and read files while they are built.
FILES = {"enrich_log", "watch_folder", "log_files", "line_files", "curl_files", "log_drift_parquet", "log_drift_csv", "log_compacted", "method_fallback_pages", "diff_ordered", "diff_report", "report_files", "csv_with_bom"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILES))
def test_no_pairing_joins_and_no_hidden_python(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("ArrowEvalPython" in text or "InPandas" in text or "InArrow" in text) == (name in PYTHON)


def test_top_n_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["topn_wide"](spark, DATA))
    before = text.index("Partial")
    assert "WindowGroupLimit" in text[before - 400 : before]
    shuffle = text.index("Exchange hashpartitioning(query")
    assert shuffle < before


def test_columns_are_pruned(spark):
    text = plan(QUERIES["pending_success"](spark, DATA))
    assert "FileScan parquet [c_custkey" in text and "c_acctbal" not in text and "c_name" not in text


def test_only_the_old_keys_are_read_for_added_rows(spark):
    text = plan(QUERIES["diff_added"](spark, DATA))
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert len(scans) == 2 and "LeftAnti" in text
    assert "o_totalprice" in scans[0] and "FileScan parquet [o_orderkey" in scans[1] and "o_totalprice" not in scans[1]
    assert all("DataFilters: [isnotnull(o_orderdate" in s for s in scans)


def test_null_safe_keys_stay_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["diff_null_keys"](spark, DATA))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text


def test_grouped_text_shuffles_its_input_once(spark):
    df = QUERIES["order_parts"](spark, DATA)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the rows are numbered over a settled table: the source is not read again, and one join adds the counts of earlier ranges
    assert final.count("FileScan") == 0 and final.count("Scan ExistingRDD") == 1
    assert final.count("SortMergeJoin") + final.count("BroadcastHashJoin") == 1
