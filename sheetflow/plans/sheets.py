"""Grids, headers and row ranges."""

from pyspark.sql import functions as F

from sheetflow.functions.strings import render_template, template_vars
from sheetflow.operators.grid import flatten_header, meta_value, promote_header, promote_headers, require_columns, skip_blank, slice_rows, stop_at_blank
from sheetflow.operators.keyed import in_input_order
from sheetflow.plans.registry import query
from sheetflow.sources.workbook import read_sheet, to_workbooks

CUSTOMER_TEXT = """SELECT CAST(c_custkey + 2 AS INTEGER) AS _row, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
 CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"""


def customer_cells(t):
    """The customers as a cell grid under a header row."""
    c = t.customer
    header = t.spark.range(1).select(
        F.inline(F.array(*[F.struct(F.lit(1).alias("row"), F.lit(i).alias("col"), F.lit(f" {name} ").alias("value")) for i, name in enumerate(c.columns, 1)]))
    )
    body = c.select(
        (F.col("c_custkey") + 2).cast("int").alias("row"),
        F.inline(F.array(*[F.struct(F.lit(i).alias("col"), F.col(name).cast("string").alias("value")) for i, name in enumerate(c.columns, 1)])),
    )
    return header.unionByName(body)


@query(CUSTOMER_TEXT)
def grid_promote(t):
    return promote_header(customer_cells(t))


@query(
    """SELECT CAST(s_suppkey + 1 AS INTEGER) AS col,
  n_name || '/' || CASE WHEN s_acctbal < 0 THEN '' ELSE n_name END || '/' || s_name AS path
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def header_paths(t):
    """One column per supplier: the nation spans two header rows, unless the merge leaves the header."""
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("col", (F.col("s_suppkey") + 1).cast("int"))
    cells = s.select(
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("row"), F.col("col"), F.col("n_name").alias("value")),
                F.struct(F.lit(2).alias("row"), F.col("col"), F.lit(None).cast("string").alias("value")),
                F.struct(F.lit(3).alias("row"), F.col("col"), F.col("s_name").alias("value")),
                F.struct(F.lit(4).alias("row"), F.col("col"), F.col("s_acctbal").cast("string").alias("value")),
            )
        )
    )
    merges = s.select(
        F.lit(1).alias("min_row"),
        F.col("col").alias("min_col"),
        F.when(F.col("s_acctbal") < 0, 4).otherwise(2).alias("max_row"),
        F.col("col").alias("max_col"),
    )
    return flatten_header(cells, merges, rows=3)


@query("SELECT c_custkey, c_name || ' of ' || c_mktsegment || ' in ASIA' AS query FROM customer")
def meta_template(t):
    """A template from the settings sheet, rendered for every row once the columns it needs are there."""
    meta = t.region.select(F.concat(F.lit(" "), "r_name").alias("key"), F.concat(F.lit("{{c_name}} of {{c_mktsegment}} in "), "r_name").alias("value"))
    template = meta_value(meta, "ASIA")
    sheet = require_columns(t.customer, template_vars(template))
    return sheet.select("c_custkey", render_template(template, sheet.columns).alias("query"))


@query("SELECT c_custkey AS _row, c_name FROM customer")
def input_order(t):
    return in_input_order(t.customer.select(F.col("c_custkey").alias("_row"), "c_name").repartition(8, "c_name"))


def customer_sheet(t):
    """Customers as a sheet whose name cell is blank where the balance is very low."""
    return t.customer.select(
        (F.col("c_custkey") + 2).alias("_row"),
        F.when(F.col("c_acctbal") < -950, F.lit(" \t")).otherwise(F.col("c_name")).alias("name"),
        "c_nationkey",
        "c_mktsegment",
    )


SHEET_SQL = """WITH sheet AS (SELECT c_custkey + 2 AS _row, CASE WHEN c_acctbal < -950 THEN ' ' || chr(9) ELSE c_name END AS name, c_nationkey, c_mktsegment FROM customer)"""


@query(SHEET_SQL + " SELECT * FROM sheet WHERE _row >= 4 AND trim(name, ' ' || chr(9)) <> ''")
def grid_slice(t):
    """A bounded range passes over blank names; its end lies beyond the table."""
    return skip_blank(slice_rows(customer_sheet(t), "4-9000000000", first_row=2), "name")


@query(SHEET_SQL + " SELECT * FROM sheet WHERE _row < coalesce((SELECT min(_row) FROM sheet WHERE trim(name, ' ' || chr(9)) = ''), 9000000000)")
def grid_stop_at_blank(t):
    return stop_at_blank(slice_rows(customer_sheet(t), "2+"), ["name"])


@query(
    SHEET_SQL
    + """, f AS (SELECT CAST(c_nationkey AS VARCHAR) AS file, _row, name, c_mktsegment FROM sheet),
stops AS (SELECT file, min(_row) AS stop FROM f WHERE trim(name, ' ' || chr(9)) = '' GROUP BY file)
SELECT f.* FROM f LEFT JOIN stops USING (file) WHERE stop IS NULL OR _row < stop"""
)
def grid_stop_per_file(t):
    """Each file stops at its own first blank row."""
    files = customer_sheet(t).select(F.col("c_nationkey").cast("string").alias("file"), "_row", "name", "c_mktsegment")
    return stop_at_blank(files, ["name"], gaps=False)


GAPS = "SELECT * FROM sheet WHERE c_nationkey <> 7"


@query(
    SHEET_SQL
    + f""", g AS ({GAPS}), stop AS (SELECT min(_row + 1) AS s FROM g WHERE _row + 1 NOT IN (SELECT _row FROM g))
SELECT * FROM g WHERE _row < (SELECT s FROM stop) AND _row < coalesce((SELECT min(_row) FROM g WHERE trim(name, ' ' || chr(9)) = ''), 9000000000)"""
)
def grid_stop_at_gap(t):
    """Rows that are missing altogether end the sheet like blank ones."""
    return stop_at_blank(customer_sheet(t).filter("c_nationkey <> 7"), ["name"])


@query(
    SHEET_SQL
    + f""", f AS (SELECT CAST(_row % 3 AS VARCHAR) AS file, _row // 3 AS _row, name, c_mktsegment FROM ({GAPS})),
ends AS (SELECT file, _row AS s FROM f WHERE trim(name, ' ' || chr(9)) = ''
 UNION ALL SELECT file, _row + 1 FROM f WHERE (file, _row + 1) NOT IN (SELECT (file, _row) FROM f)),
stops AS (SELECT file, min(s) AS s FROM ends GROUP BY file)
SELECT f.* FROM f JOIN stops USING (file) WHERE _row < s"""
)
def grid_gap_per_file(t):
    """Each file stops at its own first gap or blank row."""
    rows = customer_sheet(t).filter("c_nationkey <> 7")
    files = rows.select((F.col("_row") % 3).cast("string").alias("file"), F.floor(F.col("_row") / 3).alias("_row"), "name", "c_mktsegment")
    return stop_at_blank(files, ["name"])


@query(
    SHEET_SQL
    + f""", f AS (SELECT CAST(_row % 100 AS VARCHAR) AS file, _row // 100 AS _row, name, c_mktsegment FROM ({GAPS}) WHERE _row // 100 >= 1),
ends AS (SELECT file, _row AS s FROM f WHERE trim(name, ' ' || chr(9)) = ''
 UNION ALL SELECT file, _row + 1 FROM f WHERE (file, _row + 1) NOT IN (SELECT (file, _row) FROM f)
 UNION ALL SELECT DISTINCT file, 1 FROM f WHERE (file, 1) NOT IN (SELECT (file, _row) FROM f)),
stops AS (SELECT file, min(s) AS s FROM ends GROUP BY file)
SELECT f.* FROM f JOIN stops USING (file) WHERE _row < s"""
)
def grid_leading_gap(t):
    """A file whose first asked row is missing gives nothing, whatever comes after it."""
    rows = customer_sheet(t).filter("c_nationkey <> 7")
    files = rows.select((F.col("_row") % 100).cast("string").alias("file"), F.floor(F.col("_row") / 100).alias("_row"), "name", "c_mktsegment")
    return stop_at_blank(slice_rows(files, "1+"), ["name"], first=1)


@query(
    """SELECT 'f' || c_custkey % 4 AS file, 's' AS sheet, CAST(c_custkey // 4 + 2 AS INTEGER) AS _row, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
 CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, CASE WHEN c_custkey % 4 <> 3 THEN c_mktsegment END AS c_mktsegment FROM customer"""
)
def grid_mixed_headers(t):
    """Four files with the customers' columns in four orders, one file without the last of them."""
    c = t.customer
    number = F.col("c_custkey") % 4

    def cells(values, row):
        entries = [F.struct(((F.lit(i) * 2 + number) % 5 + 1).cast("int").alias("col"), v.alias("value"), F.lit(name).alias("_name")) for i, (name, v) in enumerate(values.items())]
        found = c.select(F.concat(F.lit("f"), number.cast("string")).alias("file"), F.lit("s").alias("sheet"), row.cast("int").alias("row"), number.alias("_n"), F.inline(F.array(*entries)))
        return found.filter("_n <> 3 OR _name <> 'c_mktsegment'").drop("_n", "_name")

    header = cells({name: F.lit(f" {name} ") for name in c.columns}, F.lit(1)).distinct()
    body = cells({name: F.col(name).cast("string") for name in c.columns}, F.floor(F.col("c_custkey") / 4) + 2)
    return promote_headers(header.unionByName(body))


@query(
    """SELECT CAST(c_custkey % 500 + 2 AS INTEGER) AS _row, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
 CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR) ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal, c_mktsegment FROM customer"""
)
def xlsx_cells(t):
    """Customers written as workbooks of 500 rows, decoded, and given their header again."""
    books = to_workbooks(t.customer.withColumn("_at", F.col("c_custkey")), "_at", rows_per_file=500)
    return read_sheet(books).drop("file", "sheet")
