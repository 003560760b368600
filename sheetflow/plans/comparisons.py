"""Keyed comparisons of two versions of a table."""

from functools import reduce

from pyspark.sql import functions as F

from sheetflow.operators.diff import diff
from sheetflow.operators.keyed import duplicate_keys
from sheetflow.plans.registry import query
from sheetflow.session import work_dir
from sheetflow.sources.logs import read_log, write_report

OLD_SQL = """old AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_orderdate
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')"""
NEW_SQL = """new AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice,
         CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '2-HIGH' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate, o_custkey
  FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01')"""
BOTH = f"WITH {OLD_SQL}, {NEW_SQL}"


def versions(t):
    """Two versions of the orders: the new one lost early orders, gained late ones, and changed cells."""
    o = t.orders
    old = o.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_orderdate"
    )
    low, high = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "2-HIGH"
    new = o.filter(F.col("o_orderdate") >= F.lit("1995-06-01").cast("timestamp")).select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(low, "").when(~high, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "P", F.expr("o_orderdate + INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        "o_custkey",
    )
    return old, new


def compared(t, verify=False):
    return diff(*versions(t), keys=["o_orderkey"], ignore=["o_orderdate"], verify=verify)


@query(BOTH + " SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def diff_added(t):
    return compared(t).added


@query(BOTH + " SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)")
def diff_deleted(t):
    return compared(t).deleted


MIXED = "CASE WHEN o_orderstatus = 'P' THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END"


@query(BOTH + f" SELECT * FROM new WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT {MIXED} FROM old)")
def diff_mixed_keys(t):
    """Keys that are text in one version and numbers in the other are compared as text."""
    old, new = versions(t)
    text = F.col("o_orderkey").cast("string")
    named = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), text)).otherwise(text)
    return diff(old.withColumn("o_orderkey", named), new, keys=["o_orderkey"]).added


MODIFIED = (
    BOTH
    + """, j AS (SELECT o.o_orderkey, o.o_orderstatus s1, n.o_orderstatus s2, o.o_totalprice p1, n.o_totalprice p2,
                        o.o_orderpriority q1, n.o_orderpriority q2 FROM old o JOIN new n USING (o_orderkey)),
cells AS (
  SELECT o_orderkey, 0 AS _col, 'o_orderstatus' AS "变化的列", s1 AS "旧值", s2 AS "新值" FROM j WHERE coalesce(s1, '') <> coalesce(s2, '')
  UNION ALL SELECT o_orderkey, 1, 'o_totalprice', CAST(p1 AS VARCHAR), CAST(p2 AS VARCHAR) FROM j WHERE p1 IS DISTINCT FROM p2
  UNION ALL SELECT o_orderkey, 2, 'o_orderpriority', q1, q2 FROM j WHERE coalesce(q1, '') <> coalesce(q2, ''))"""
)


@query(MODIFIED + ' SELECT o_orderkey, _col, "变化的列", "旧值", "新值" FROM cells')
def diff_modified(t):
    return compared(t, verify=True).modified


@query(
    MODIFIED
    + """, c AS (SELECT (SELECT count(*) FROM new ANTI JOIN old USING (o_orderkey)) AS a,
               (SELECT count(*) FROM old ANTI JOIN new USING (o_orderkey)) AS d,
               (SELECT count(DISTINCT o_orderkey) FROM cells) AS m)
SELECT 1 AS _line, '文件1 (旧)' AS "项目", 'orders old' AS "内容" UNION ALL SELECT 2, '文件2 (新)', 'orders new'
UNION ALL SELECT 3, '唯一键', 'o_orderkey'
UNION ALL SELECT 4, '对比结果', CASE WHEN a + d + m > 0 THEN '发现差异' ELSE '数据完全一致' END FROM c
UNION ALL SELECT 5, '新增行数', CAST(a AS VARCHAR) FROM c UNION ALL SELECT 6, '删除行数', CAST(d AS VARCHAR) FROM c
UNION ALL SELECT 7, '修改行数', CAST(m AS VARCHAR) FROM c
UNION ALL SELECT 8, '仅旧表的列', '' UNION ALL SELECT 9, '仅新表的列', 'o_custkey'"""
)
def diff_summary(t):
    return compared(t).summary("orders old", "orders new")


@query(MODIFIED + ' SELECT o_orderkey, "变化的列", "旧值", "新值" FROM cells')
def diff_ordered(t):
    """Changed cells by key and column, read from the one pass that also checks the keys."""
    return compared(t).settled().ordered()["修改的详情"]


REPORT = (
    MODIFIED
    + """, a AS (SELECT * FROM new ANTI JOIN old USING (o_orderkey)), d AS (SELECT * FROM old ANTI JOIN new USING (o_orderkey))
SELECT '新增的行' AS section, CAST(o_orderkey AS VARCHAR) AS name, o_orderstatus || ' ' || coalesce(o_orderpriority, '') || ' ' || o_custkey AS text FROM a
UNION ALL SELECT '删除的行', CAST(o_orderkey AS VARCHAR), o_orderstatus || ' ' || coalesce(o_orderpriority, '') FROM d
UNION ALL SELECT '修改的详情', o_orderkey || ' ' || "变化的列", coalesce("旧值", '') || ' > ' || coalesce("新值", '') FROM cells
UNION ALL SELECT '差异总览', '新增行数', CAST((SELECT count(*) FROM a) AS VARCHAR) UNION ALL SELECT '差异总览', '删除行数', CAST((SELECT count(*) FROM d) AS VARCHAR)
UNION ALL SELECT '差异总览', '修改行数', CAST((SELECT count(DISTINCT o_orderkey) FROM cells) AS VARCHAR)
UNION ALL SELECT '差异总览', '对比结果', CASE WHEN (SELECT count(*) FROM a) + (SELECT count(*) FROM d) + (SELECT count(*) FROM cells) > 0 THEN '发现差异' ELSE '数据完全一致' END
UNION ALL SELECT '差异总览', '文件1 (旧)', 'a' UNION ALL SELECT '差异总览', '文件2 (新)', 'b' UNION ALL SELECT '差异总览', '唯一键', 'o_orderkey'
UNION ALL SELECT '差异总览', '仅旧表的列', '' UNION ALL SELECT '差异总览', '仅新表的列', 'o_custkey'"""
)


def told(parts):
    """The sections of a report in one shape."""
    key, blank = F.col("o_orderkey").cast("string"), F.lit("")
    row = ["o_orderstatus", F.coalesce("o_orderpriority", blank)]
    texts = {
        "差异总览": (F.col("项目"), F.col("内容")),
        "新增的行": (key, F.concat_ws(" ", *row, F.col("o_custkey").cast("string"))),
        "删除的行": (key, F.concat_ws(" ", *row)),
        "修改的详情": (F.concat_ws(" ", key, "变化的列"), F.concat(F.coalesce("旧值", blank), F.lit(" > "), F.coalesce("新值", blank))),
    }
    shown = [df.select(F.lit(name).alias("section"), texts[name][0].alias("name"), texts[name][1].alias("text")) for name, df in parts.items()]
    return reduce(lambda x, y: x.unionByName(y), shown)


@query(REPORT)
def diff_report(t):
    """Every section of the report, worked out in one pass and written once."""
    return told(compared(t).report("a", "b"))


@query(REPORT)
def report_files(t):
    """The report as one CSV file set per section, read back."""
    path = work_dir(t.spark, "report")
    written = write_report(compared(t).report("a", "b"), path, always=("差异总览",))
    return told({name: read_log(t.spark, f"{path}/{name}", fmt="csv") for name in written})


@query(
    """WITH old AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg, CASE WHEN c_acctbal >= -900 THEN c_custkey END AS k,
                           c_nationkey, c_acctbal FROM customer),
new AS (SELECT seg, k, CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS BIGINT) END AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal
        FROM old WHERE seg IS NULL OR seg <> 'MACHINERY')
SELECT o.seg, o.k, 0 AS _col, 'c_nationkey' AS "变化的列", CAST(o.c_nationkey AS VARCHAR) AS "旧值", CAST(n.c_nationkey AS VARCHAR) AS "新值"
FROM old o JOIN new n ON o.seg IS NOT DISTINCT FROM n.seg AND o.k IS NOT DISTINCT FROM n.k
WHERE NOT (o.seg IS NULL AND o.k IS NULL) AND CAST(o.c_nationkey AS VARCHAR) IS DISTINCT FROM CAST(n.c_nationkey AS VARCHAR)"""
)
def diff_null_keys(t):
    """Null key parts match each other; columns of unlike type compare as text."""
    old = t.customer.select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"),
        F.when(F.col("c_acctbal") >= -900, F.col("c_custkey")).alias("k"),
        "c_nationkey",
        "c_acctbal",
    )
    new = old.filter("seg IS NULL OR seg <> 'MACHINERY'").select(
        "seg",
        "k",
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("long")).alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
    )
    return diff(old, new, keys=["seg", "k"]).modified


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 5")
def duplicate_sample(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
