from urllib.parse import quote_plus as python_quote

import pytest
from pyspark.sql import functions as F

from sheetflow.functions import links, strings
from sheetflow.functions.jsontext import decode_unicode, decode_unicode_json


def test_strip_is_like_python(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = [b + "a" + b + "b" + b for b in blanks] + ["", " \t", "x", "　日 本　"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", strings.strip("t").alias("s"), strings.non_empty("t").alias("ink")).collect()
    assert [(r.s, r.ink) for r in got] == [(r.t.strip(), bool(r.t.strip())) for r in got]


def test_column_letters():
    assert [strings.col_index(x) for x in ("A", "z", "AA", "AZ", "BA")] == [0, 25, 26, 51, 52]
    assert strings.col_index("C", base=1) == 3
    for bad in ("", "A1", "é"):
        with pytest.raises(ValueError):
            strings.col_index(bad)


def test_keywords(one):
    columns = ["a", "b", "c"]
    schema, row = "a string, b int, c string", (" x\ny ", 7, "  ")
    assert one(strings.build_keywords("A*,B,C", columns), schema, row) == '"x y" 7'
    assert one(strings.build_keywords("C", columns), schema, row) == ""
    with pytest.raises(ValueError):
        strings.keyword_columns(" , ", columns)


def test_templates(one):
    schema, row = "`姓名` string, unit string, n int", (' 王"小 ', None, 3)
    columns = ["姓名", "unit", "n"]
    assert strings.template_vars("{{姓名}} {{ unit }} {{n}}") == ["姓名", "n"]
    assert one(strings.render_template(' "{{姓名}}" {{unit}} n={{n}}{{zz}} ', columns), schema, row) == '"王"小"  n=3'
    assert one(strings.render_template("{{unit}}", columns), schema, row) == ""
    assert one(strings.render_rules('{"who":"如果不是\\"{{姓名}}\\"","n":"{{n}}"}', columns), schema, row) == {"who": '如果不是"王"小"', "n": "3"}


def test_quote_plus_is_like_python(spark):
    texts = ["a b", "*~-_.", "é/日本&=?#%+", "", '"q"\n', "'()!@:;,$[]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strings.quote_plus("t")).collect()] == [python_quote(t) for t in texts]


def test_render_q(one):
    q = F.lit("a b&c")
    assert one(strings.render_q("http://x?q={q}&r={q}", q)) == "http://x?q=a+b%26c&r=a+b%26c"
    assert one(strings.render_q('{"q":"{q}"}', q, encode=False)) == '{"q":"a b&c"}'


def test_names_and_paths(one):
    assert one(strings.safe_name(F.lit("a b/c\\d"))) == "a_b_c_d"
    assert one(strings.stamp(F.lit("2025-01-25 14:30:22").cast("timestamp"))) == "250125.143022"
    assert one(strings.prefix_path("p/", F.lit(""))) is None
    assert one(strings.sha1_hex(F.lit("日本"))) == __import__("hashlib").sha1("日本".encode()).hexdigest()


@pytest.mark.parametrize(
    "url, direct, ext",
    [
        ("http://x/a.PDF?y=1", True, ".pdf"),
        ("http://x/a%2Edocx", True, ".docx"),
        ("http://x/a.b.zip;p=1#f", True, ".zip"),
        ("http://x/.png", True, ".pdf"),
        ("http://x/q?file=a.pdf", False, ".png"),
        ("http://x.pdf", False, ".png"),
        ("http://x/a.pdf/", False, ".png"),
        ("http://x/%zz a b.gif", True, ".gif"),
        ("", False, ".png"),
    ],
)
def test_download_kind(one, url, direct, ext):
    assert tuple(one(links.download_kind(F.lit(url)))) == (direct, ext)


def test_hash_path(one):
    digest = one(strings.sha1_hex(F.lit("http://x")))
    assert one(links.snapshot_path(F.lit("http://x"), ".html")) == f"{digest[:2]}/{digest[2:4]}/{digest[4:]}.html"
    assert one(links.only_http(F.lit("ftp://x"))) == "" and one(links.only_http(F.lit("https://x"))) == "https://x"


def test_unicode_escapes(one):
    assert one(decode_unicode(F.lit('\\u7f51页 "q" \\n \\ud83d\\ude00'))) == '网页 "q" \\n 😀'
    assert one(decode_unicode(F.lit("C:\\users"))) == "C:\\users"
    deep = '{"\\\\u540d": ["\\\\u7f51", {"a": "\\\\u9875"}]}'
    decoded = one(decode_unicode_json(F.lit(deep)))
    assert __import__("json").loads(decoded) == {"名": ["网", {"a": "页"}]}
