import pytest
from conftest import rows
from pyspark.sql import functions as F

from sheetflow.operators import grid
from sheetflow.operators.grid import promote_header, promote_headers, slice_rows, stop_at_blank

CELLS = "row int, col int, value string"


def test_row_ranges():
    assert grid.parse_rows(" 3+ ") == (3, None) and grid.parse_rows("3-9") == (3, 9)
    assert grid.parse_rows("3") == (3, None) and grid.parse_rows("3", "one") == (3, 3)
    for spec, single in (("9-3", "open"), ("x", "open"), ("3", "error"), ("", "open"), ("-", "open")):
        with pytest.raises(ValueError):
            grid.parse_rows(spec, single)


def test_slice(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "_row")
    assert [r[0] for r in grid.slice_rows(df, "3-5").collect()] == [3, 4, 5]
    assert grid.slice_rows(df, "8-99").count() == 3 and grid.slice_rows(df, "4", single="one").count() == 1
    with pytest.raises(ValueError, match="before the first data row"):
        grid.slice_rows(df, "1+", first_row=2)


def test_promote(spark):
    cells = spark.createDataFrame([(1, 1, "x"), (2, 1, " a "), (2, 2, " "), (2, 3, "b"), (2, 4, "a"), (3, 1, "1"), (3, 3, "2"), (5, 2, "lost"), (5, 4, "9")], CELLS)
    sheet = grid.promote_header(cells, 2)
    assert sheet.columns == ["_row", "a", "b"] and rows(sheet) == [(3, None, "2"), (5, "9", None)]
    clash = spark.createDataFrame([("f", 1, 1, "a"), ("g", 1, 1, "b")], "file string, " + CELLS)
    with pytest.raises(ValueError, match="different headers"):
        grid.promote_header(clash)


def test_flatten(spark):
    cells = spark.createDataFrame([(1, 1, "A"), (1, 3, "B"), (2, 1, "x"), (2, 2, "y"), (3, 1, "1"), (3, 2, "2"), (3, 3, "3"), (4, 1, "data")], CELLS)
    merges = spark.createDataFrame([(1, 1, 1, 2), (1, 3, 2, 3), (3, 1, 4, 1)], "min_row int, min_col int, max_row int, max_col int")
    assert rows(grid.flatten_header(cells, merges)) == [(1, "A/x/1"), (2, "A/y/2"), (3, "B/B/3")]
    assert rows(grid.flatten_header(cells, None)) == [(1, "A/x/1"), (2, "/y/2"), (3, "B//3")]


def test_stop(spark):
    df = spark.createDataFrame([(2, "a", None), (3, "b", "x"), (4, " ", "x"), (5, "c", "x"), (6, None, " "), (7, "d", "x")], "_row int, n string, o string")
    assert rows(grid.stop_at_blank(df, ["n"]), "_row") == [(2,), (3,)]
    assert rows(grid.stop_at_blank(df, mode="all"), "_row") == [(2,), (3,), (4,), (5,)]
    assert grid.stop_at_blank(df.filter("_row < 4"), ["n"]).count() == 2
    assert rows(grid.skip_blank(df, "n"), "_row") == [(2,), (3,), (5,), (7,)]
    for bad in ({"mode": "some"}, {"columns": ["n", "o"]}):
        with pytest.raises(ValueError):
            grid.stop_at_blank(df, **bad)


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`刊名` int, b int")
    assert grid.resolve_column(df, ["期刊名称", "刊名"]) == "刊名" and grid.resolve_column(df, ["x"]) is None
    assert grid.column_at(df, "b") == "b" and grid.require_columns(df, ["b"]) is df
    for call in (lambda: grid.resolve_column(df, ["x"], required=True), lambda: grid.column_at(df, "C"), lambda: grid.require_columns(df, ["b", "z"])):
        with pytest.raises(ValueError):
            call()


def test_meta(spark):
    meta = spark.createDataFrame([(" search ", ' "{{a}}" '), ("empty", None)], "key string, value string")
    assert grid.meta_value(meta, "search") == '"{{a}}"'
    for key in ("empty", "none"):
        with pytest.raises(ValueError):
            grid.meta_value(meta, key)


def test_methods():
    assert grid.method_set(" Scan, extract,") == {"scan", "extract"}
    for bad in ("", ",", "scan,other"):
        with pytest.raises(ValueError):
            grid.method_set(bad)


def test_missing_first_row_stops_at_once(spark):
    rows_ = [("a", 5, "x"), ("a", 6, "y"), ("b", 3, "x"), ("b", 4, "y"), ("b", 6, "z"), ("c", 1, "x"), ("c", 3, "y"), ("d", 3, "x"), ("d", 4, " "), ("d", 5, "z"), (None, 3, "n")]
    df = spark.createDataFrame(rows_, "file string, _row int, name string")
    got = rows(stop_at_blank(slice_rows(df, "3+"), ["name"], first=3), "file", "_row")
    assert got == sorted([("b", 3), ("b", 4), ("c", 3), ("d", 3), (None, 3)], key=repr)
    # without it a sheet begins where its first row stands
    assert rows(stop_at_blank(df, ["name"]), "file", "_row") == sorted([("a", 5), ("a", 6), ("b", 3), ("b", 4), ("c", 1), ("d", 3), (None, 3)], key=repr)
    one = df.filter("file = 'a'").drop("file")
    assert stop_at_blank(one, ["name"], first=3).isEmpty() and stop_at_blank(one, ["name"], first=5).count() == 2 == stop_at_blank(one, ["name"]).count()
    assert stop_at_blank(one, ["name"], first=3, gaps=False).count() == 2
    assert stop_at_blank(df.filter("false"), ["name"], first=3).isEmpty()


def test_gaps_over_many_ranges(spark):
    n, missing = 3000, 2345
    df = spark.range(n).filter(F.col("id") != missing).select((F.col("id") % 2).cast("string").alias("file"), F.floor(F.col("id") / 2).alias("_row"), F.lit("x").alias("name"))
    got = stop_at_blank(df.repartition(6), ["name"], first=0).groupBy("file").agg(F.max("_row").alias("last")).collect()
    assert {r["file"]: r["last"] for r in got} == {"0": n // 2 - 1, "1": missing // 2 - 1}


def test_each_sheet_by_its_own_header(spark):
    cells = [
        ("a", "s", 1, 1, " id "), ("a", "s", 1, 2, "name"), ("a", "s", 1, 3, None), ("a", "s", 2, 1, "1"), ("a", "s", 2, 2, "x"), ("a", "s", 2, 3, "lost"),
        ("b", "s", 1, 1, "name"), ("b", "s", 1, 2, "id"), ("b", "s", 1, 3, "name"), ("b", "s", 2, 1, "old"), ("b", "s", 2, 2, "2"), ("b", "s", 2, 3, "y"), ("b", "s", 4, 2, "3"),
        ("c", "s", 1, 1, "more"), ("c", "s", 2, 1, "z"), ("d", "s", 2, 1, "no header"),
    ]
    df = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    out = promote_headers(df)
    assert out.columns == ["file", "sheet", "_row", "id", "more", "name"]
    assert rows(out) == [("a", "s", 2, "1", None, "x"), ("b", "s", 2, "2", None, "y"), ("b", "s", 4, "3", None, None), ("c", "s", 2, None, "z", None)]
    assert rows(promote_headers(df, columns=["name"]), "file", "_row", "name") == [("a", 2, "x"), ("b", 2, "y")]
    with pytest.raises(ValueError, match="different headers"):
        promote_header(df)
