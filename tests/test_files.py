import glob
import zipfile

import pytest
from conftest import rows

from sheetflow.operators.keyed import latest
from sheetflow.sources import logs, textfiles, workbook


def test_csv_log_keeps_awkward_text(spark, tmp_path):
    path = str(tmp_path / "log")
    text = ' a "quoted", line\nnext\r\n[{"k": "é"}] \\ '
    schema = "journal_name string, status string, total_tokens string, results_json string, extra string"
    logs.append_log(spark.createDataFrame([("n", "failed", "x", None, "1")], schema).coalesce(1), path, "csv")
    logs.append_log(spark.createDataFrame([("n", "success", "12", text, "2")], schema).coalesce(1), path, "csv")
    back = logs.read_log(spark, path, "model_search", "csv")
    assert set(logs.LOG_COLUMNS["model_search"]) | {"extra", "_seq"} == set(back.columns)
    got = sorted(tuple(r) for r in back.select("status", "total_tokens", "results_json", "cost", "error_type", "extra").collect())
    assert got == [("failed", None, "", None, "", "1"), ("success", 12, text, None, "", "2")]
    assert rows(latest(back, "journal_name"), "status") == [("success",)]


def test_parquet_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(3):
        logs.append_log(spark.createDataFrame([("k", i)], "k string, v int"), path)
    back = logs.read_log(spark, path)
    assert back.count() == 3 and rows(latest(back, "k"), "k", "v") == [("k", 2)]


def test_bom(spark, tmp_path):
    path = str(tmp_path / "out")
    logs.write_csv_bom(spark.createDataFrame([("a", None), ("b", " x")], "`序号` string, n string").coalesce(1), path)
    with open(glob.glob(path + "/*.csv")[0], "rb") as f:
        assert f.read().decode("utf-8") == "﻿序号,n\na,\nb, x\n"
    assert rows(logs.read_log(spark, path, fmt="csv"), "序号", "n") == [("a", ""), ("b", " x")]


def test_lines_across_splits(spark, tmp_path):
    lines = [f"  line {i} {'x' * (i % 37)}\r" if i % 5 else " \r" for i in range(4000)]
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("\n".join(lines), encoding="utf-8")
    expected = [line.strip() for line in lines if line.strip()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = textfiles.read_lines(spark, str(tmp_path))
        got = df.collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name in ("a", "b"):
        mine = sorted((r["seq"], r["line"]) for r in got if r["file"].endswith(f"{name}.txt"))
        assert mine == list(enumerate(expected, 1))


def test_lines_are_numbered_where_they_are_read(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(500)))
    (tmp_path / "empty.txt").write_text("\n \n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = textfiles.read_lines(spark, str(tmp_path))
        assert {(r["seq"], r["line"]) for r in df.collect()} == {(i + 1, f"{n}{i}") for i in range(500) for n in "abc"}
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # the lines are not shuffled: only the small table of splits moves
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_blocks_are_numbered_by_their_markers(spark, tmp_path):
    body = "\nfirst\n[CURL_END]\n" + "".join(f"[CURL_START]\nc{i}\n" + ("[CURL_END]\n" if i % 3 else "") for i in range(90))
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = textfiles.read_blocks(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = sorted((i + 1, f"c{i}") for i in range(90) if i % 3)
    for name in ("a", "b"):
        assert sorted((r["seq"], r["block"].strip()) for r in got if r["file"].endswith(f"{name}.txt")) == expected


BLOCKS = """stray [CURL_END]
[CURL_END]
  [CURL_START]
name=one
curl 'http://1'
 [CURL_END]
between
[CURL_START]
[CURL_END]
[CURL_START]
lost, started again
[CURL_START]
curl 'http://2' -H 'a: [CURL_END]'
  -b 'x=1'
[CURL_END]
[CURL_START] not alone
curl 'no'
[CURL_END]
[CURL_START]
curl 'unclosed'
"""


@pytest.mark.parametrize("split", ["128m", "60"])
def test_blocks(spark, tmp_path, split):
    (tmp_path / "curl.txt").write_text(BLOCKS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = [r["block"] for r in textfiles.read_blocks(spark, str(tmp_path)).orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [[x.strip() for x in b.strip().split("\n")] for b in got] == [["name=one", "curl 'http://1'"], ["curl 'http://2' -H 'a: [CURL_END]'", "-b 'x=1'"]]


def test_workbook(spark, tmp_path):
    rows_in = [["id", " name ", None, "x&y"], [1, "a<b", 2.5, None], [2, None, None, "日本 "]]
    (tmp_path / "one.xlsx").write_bytes(workbook.encode_workbook(rows_in, "数据", ["A1:B1", "C1:C2"]))
    cells = workbook.read_xlsx_cells(spark, str(tmp_path / "*.xlsx"), "数据")
    assert rows(cells, "row", "col", "value") == [(1, 1, "id"), (1, 2, " name "), (1, 4, "x&y"), (2, 1, "1"), (2, 2, "a<b"), (2, 3, "2.5"), (3, 1, "2"), (3, 4, "日本 ")]
    assert workbook.read_xlsx_cells(spark, str(tmp_path), 0, rows=(2, 2)).count() == 3
    merges = workbook.read_xlsx_merges(spark, str(tmp_path))
    assert rows(merges, "sheet", "min_row", "min_col", "max_row", "max_col") == [("数据", 1, 1, 1, 2), ("数据", 1, 3, 2, 3)]
    files = spark.read.format("binaryFile").load(str(tmp_path))
    sheet = workbook.read_sheet(files)
    assert sorted(tuple(r) for r in sheet.select("_row", "id", "name", "x&y").collect()) == [(2, "1", "a<b", None), (3, "2", None, "日本 ")]
    with pytest.raises(Exception, match="no sheet"):
        workbook.read_xlsx_cells(spark, str(tmp_path), "missing").count()


def test_workbook_types(spark, tmp_path):
    """Shared strings, dates, flags, formulas and explicit cell places, as other writers save them."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = (
        '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="D2" s="1"><v>45292.5</v></c><c r="E2" t="b"><v>1</v></c></row>'
        '<row r="5"><c r="AA5" t="str"><f>1+1</f><v>two</v></c><c r="AB5"><v>1E3</v></c><c r="AC5" s="2"><v>45292</v></c><c r="AD5"><v>0.1</v></c></row>'
    )
    with zipfile.ZipFile(tmp_path / "t.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" sheetId="1" r:id="r1"/><sheet name="b" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>zero</t></si><si><r><t>on</t></r><r><t>e</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="yyyy&quot;年&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
    got = rows(workbook.read_xlsx_cells(spark, str(tmp_path), "b"), "row", "col", "value")
    assert got == [(2, 2, "one"), (2, 4, "2024-01-01 12:00:00"), (2, 5, "True"), (5, 27, "two"), (5, 28, "1000"), (5, 29, "2024-01-01 00:00:00"), (5, 30, "0.1")]
    assert workbook.read_xlsx_cells(spark, str(tmp_path)).count() == 0


def test_artifacts_on_disk(spark, tmp_path):
    import hashlib

    from sheetflow.operators.reports import load_artifacts

    for url, method, text in (("http://a", "langextract", "{broken"), ("http://a", "regexp", '{"host_institutions": [\n{"name": "R"}]}'), ("http://b", "regexp", '{"host_institutions": []}')):
        h = hashlib.sha1(url.encode()).hexdigest()
        folder = tmp_path / h[:2] / h[2:4] / h[4:]
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"host-{method}.json").write_text(text)
        (folder / "dom.html").write_text("<p>x</p>")
    found = textfiles.read_artifacts(spark, str(tmp_path))
    best = load_artifacts(found).select("url_hash", "method", "items")
    got = {r.url_hash: (r.method, [i["name"] for i in r["items"]]) for r in best.collect()}
    assert got == {hashlib.sha1(b"http://a").hexdigest(): ("regexp", ["R"]), hashlib.sha1(b"http://b").hexdigest(): ("regexp", [])}
    pages = textfiles.read_hashed(spark, str(tmp_path), "dom.html")
    assert rows(pages, "name", "content") == [("dom.html", "<p>x</p>")] * 2


def test_save_workbooks(spark, tmp_path):
    df = spark.range(0, 250).selectExpr("id AS _row", "id * 2 AS twice", "concat('n', id) AS name")
    folder = str(tmp_path / "books")
    assert workbook.save_workbooks(workbook.to_workbooks(df, "_row", 100), folder) == 3
    back = workbook.read_sheet(spark.read.format("binaryFile").load(folder))
    assert rows(back, "twice", "name") == sorted(((str(2 * i), f"n{i}") for i in range(250)), key=repr)
