import pytest
from conftest import rows
from pyspark.sql import functions as F

from sheetflow.operators import reports


def test_output_names():
    assert reports.parse_outputs("来源链接:url, 域名:domain") == [("来源链接", "url"), ("域名", "domain")]
    for bad in ("", "a", "a:", ":b"):
        with pytest.raises(ValueError):
            reports.parse_outputs(bad)


def test_wide_column_order(spark):
    df = spark.createDataFrame([("q", 1, "u1", ""), ("q", 2, "u2", "d2")], "query string, rank int, url string, domain string")
    wide = reports.widen_topn(df, "query", 3, [("来源链接", "url"), ("域名", "domain")])
    assert wide.columns == ["query", "来源链接1", "域名1", "来源链接2", "域名2", "来源链接3", "域名3"]
    assert rows(wide) == [("q", "u1", None, "u2", "d2", None, None)]


def test_placement():
    columns, urls, fields = ["x", "来源链接1", "y", "来源链接2"], ["来源链接1", "来源链接2"], ["学者姓名", "所在学校"]
    assert reports.place_columns(columns, urls, fields) == ["x", "来源链接1", "来源链接1-学者姓名", "来源链接1-所在学校", "y", "来源链接2", "来源链接2-学者姓名", "来源链接2-所在学校"]
    assert reports.place_columns(columns, urls, fields, "append") == [*columns, "来源链接1-学者姓名", "来源链接1-所在学校", "来源链接2-学者姓名", "来源链接2-所在学校"]
    with pytest.raises(ValueError):
        reports.place_columns(columns, urls, fields, "left")


def test_snapshot_status(one):
    def entry(url, path, error):
        return F.struct(F.lit(url).alias("url"), F.lit(path).alias("path"), F.lit(error).alias("error"))

    tries = F.array(entry("a", "p", ""), entry("b", "p", "slow"), entry("c", "", ""))
    assert tuple(one(reports.snapshot_status(F.lit(3), tries))) == ("1/3", "b: slow\nc: 尚未快照")
    assert tuple(one(reports.snapshot_status(F.lit(1), tries))) == ("1/1", "")
    assert tuple(one(reports.snapshot_status(F.lit(0), tries))) == ("0/0", "搜索无结果")
    # a result without a URL counts as expected but has no line
    assert tuple(one(reports.snapshot_status(F.lit(2), F.array(entry("", "", ""), entry("a", "p", ""))))) == ("1/2", "")


@pytest.mark.parametrize(
    "items, snap, ext, shown",
    [
        ([], None, None, "无匹配"),
        (["x"], None, None, "成功"),
        (None, None, None, "待快照"),
        (None, ("failed", "timeout"), None, "快照失败 (timeout)"),
        (None, ("success", ""), None, "待提取"),
        (None, ("success", ""), ("failed", None), "提取失败 (unknown)"),
        (None, ("success", ""), ("success", ""), "数据缺失"),
    ],
)
def test_stage_status(one, items, snap, ext, shown):
    text = lambda v: F.lit(v).cast("string")
    listed = F.lit(None).cast("array<string>") if items is None else F.array(*[F.lit(i) for i in items]).cast("array<string>")
    snap, ext = snap or (None, None), ext or (None, None)
    status = reports.stage_status(listed, text(snap[0]), text(snap[1]), text(ext[0]), text(ext[1]), F.lit("u"))
    assert one(status) == shown
    assert one(reports.is_status_row(status)) is (shown != "成功")


def test_artifacts(spark):
    content = '{"host_institutions": [{"name": "%s"}]}'
    df = spark.createDataFrame(
        [("1", "regexp", content % "r"), ("1", "langextract", content % "m"), ("2", "regexp", content % "r"), ("2", "langextract", '{"host'), ("3", "regexp", "{}"), ("4", "langextract", "oops"), ("5", "other", content % "o")],
        "url_hash string, method string, content string",
    )
    got = {r.url_hash: (r.method, [i["name"] for i in r["items"]]) for r in reports.load_artifacts(df).collect()}
    assert got == {"1": ("langextract", ["m"]), "2": ("regexp", ["r"]), "3": ("regexp", [])}


def test_keyword_cells(spark):
    df = spark.createDataFrame([(1, " PRESS ", "B", 1), (1, "press", "A", 2), (1, "press", "B", 3), (1, "maker", "M", 4), (1, "", "N", 5), (1, "maker", "M", 6), (1, "own", " ", 7)], "_row int, keyword string, name string, at int")
    assert rows(reports.by_keyword(df)) == [(1, "Press", 0, "B;A"), (1, "其他", 0, "maker: M;未知: N;maker: M")]
    wide = reports.keyword_pivot(df)
    assert wide.columns == ["_row", "part", *[f"关键词_{k}" for k in [*reports.KEYWORD_COLUMNS, "其他"]]]


def test_list_values_are_flattened(spark):
    log = spark.createDataFrame(
        [("n", "success", '[{"主办单位": ["A", " B "], "关键句子": "s"}, {"主办单位": "B", "关键句子": "[not json"}]', 1), ("n", "failed", "[]", 2), ("m", "success", "[]", 3), ("k", "success", "{oops", 4)],
        "journal_name string, status string, results_json string, _seq int",
    )
    assert rows(reports.model_answers(log, ["主办单位", "关键句子"])) == [("n", "A;B", "s;[not json")]


def test_methods_left_out(spark):
    sheet = spark.createDataFrame([(2, "N", "U")], "_row int, `Journal Name` string, `人工单位` string")
    out = reports.combine_methods(sheet, None, None, None, "scan")
    row = out.collect()[0].asDict()
    assert row["原始_Journal Name"] == "N" and row["人工_人工判断单位"] == "U" and row["AI精准_关联单位"] == "" and row["关键词_其他"] == ""
    with pytest.raises(ValueError):
        reports.combine_methods(sheet.drop("Journal Name"), None, None, None)


def test_search_without_results(spark):
    df = spark.createDataFrame([("q", '{"meta_data": {"number_of_results": 5}, "organic_results": []}', None), ("r", None, "HTTP 500")], "query string, payload string, error string")
    assert rows(reports.explode_search(df), "query", "FOUND", "ERROR", "number_of_results", "url") == [("q", "false", "", "5", ""), ("r", "false", "HTTP 500", "", "")]


def test_run_counts_of_nothing(spark):
    empty = spark.createDataFrame([], "status string")
    assert rows(reports.run_stats(empty)) == [(0, 0, 0, 0, 0, None)]


def test_provenance_in_numeric_order(spark):
    df = spark.createDataFrame([("u", "s", "10", "b"), ("u", "s", "9", "a"), ("u", "t", "x", None), ("v", "s", "1", "c")], "url string, sheet string, row string, keywords string")
    assert rows(reports.url_provenance(df)) == [("u", 0, "s\nt", "x\n9\n10", "a\nb"), ("v", 0, "s", "1", "c")]
    parts = reports.url_provenance(df, length=1).filter("url = 'u'").collect()
    assert sorted(x for p in parts for x in (p["rows"] or "").split("\n") if x) == ["10", "9", "x"]


def test_rows_of_two_files_do_not_mix(spark):
    """Equal row numbers in two files: fields, institutions and keyword texts stay with their own file."""
    place = ["file", "_row"]
    sheet = spark.createDataFrame([("f1", 2, "http://a", "J"), ("f2", 2, "http://b", "K"), ("f2", 3, "http://a", "J")], "file string, _row int, `主页链接` string, `刊名` string")
    log = spark.createDataFrame([("http://a", "true", "A", 1), ("http://b", "true", "B", 2)], "url string, SUCCESS string, name string, _seq int")
    out = reports.assemble_extract(sheet, log, ["主页链接"], row=place)
    assert rows(out, "file", "_row", "主页链接-name") == [("f1", 2, "A"), ("f2", 2, "B"), ("f2", 3, "A")]
    found = [(F.sha1(F.lit(u)).alias("url_hash"), F.array(F.struct(F.lit(n).alias("name"), F.lit("Press").alias("matched_keyword"))).alias("items")) for u, n in (("http://a", "A"), ("http://b", "B"))]
    artifacts = spark.range(1).select(*found[0]).unionByName(spark.range(1).select(*found[1]))
    items = reports.sheet_items(sheet, artifacts, row=place)
    assert rows(items, "file", "_row", "name") == [("f1", 2, "A"), ("f2", 2, "B"), ("f2", 3, "A")]
    wide = reports.combine_methods(sheet, items, None, None, "extract", row=place)
    assert rows(wide, "file", "_row", "原始_刊名", "关键词_Press") == [("f1", 2, "J", "A"), ("f2", 2, "K", "B"), ("f2", 3, "J", "A")]
    assert rows(reports.keyword_names(items, place), "file", "_row", "name", "nth") == [("f1", 2, "A", 1), ("f2", 2, "B", 1), ("f2", 3, "A", 1)]
    urls = reports.journal_urls(sheet, "刊名", ["主页链接"], place)
    assert rows(urls, "file", "_row", "url") == [("f1", 2, "http://a"), ("f2", 2, "http://b"), ("f2", 3, "http://a")]


def test_the_last_artefact_of_a_url_and_method_counts(spark):
    """Also where several pages have the same URL, and in whatever order the rows arrive."""
    given = [("h", "regexp", f'{{"host_institutions": [{{"name": "N{i}"}}]}}', i) for i in range(3)]
    bare = []
    for order in (given, given[::-1], [given[1], given[2], given[0]]):
        df = spark.createDataFrame(order, "url_hash string, method string, content string, _seq long").coalesce(1)
        assert [[i["name"] for i in r["items"]] for r in reports.load_artifacts(df).collect()] == [["N2"]]
        bare += [[i["name"] for i in r["items"]] for r in reports.load_artifacts(df.drop("_seq")).collect()]
    assert bare == [bare[0]] * 3
