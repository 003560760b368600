import json
import re

import pytest
from pyspark.sql import functions as F

from sheetflow.functions import curl, jsontext, outcome
from sheetflow.operators.enrich import model_outcome
from sheetflow.operators.reports import flatten_lookup, lookup_stats, url_check


def expected_json(text):
    """The rules again, in Python."""

    def load(t, kinds):
        try:
            value = json.loads(t)
        except ValueError:
            return None
        return value if isinstance(value, kinds) else None

    found = load(text.strip(), (list, dict))
    for pattern, kinds in ((r"```(?:json)?\s*([\s\S]*?)```", (list, dict)), (r"\[\s*\{[\s\S]*?\}\s*\]", list), (r'\{\s*"[\s\S]*?\}', dict)):
        for m in re.findall(pattern, text):
            if found is None:
                found = load(m.strip(), kinds)
    return [found] if isinstance(found, dict) else found


REPLIES = [
    '[{"a": 1}, {"b": null}]',
    ' {"a": {"b": 2}} ',
    'Here: ```json\n[{"a": "x"}]\n``` done',
    "```\n{broken}\n``` then ```json\n{\"a\": 3}\n```",
    'prose [ {"a": 1} , {"a": 2} ] prose [{"b": 1}]',
    'prose [ {"a": 1 ] but {"c": 3} here',
    'only {"a": "x"} here',
    '{"a": 1} tail',
    '{"a": 1}] x',
    '{"a": 1},{"a": 2}',
    "[1, 2] tail",
    "no json",
    "17",
    "",
    '{"a": [1, {"b": 2}], "c": "}"}',
]


def test_json_from_text(spark):
    df = spark.createDataFrame([(t,) for t in REPLIES], "t string")
    got = [r[0] for r in df.select(jsontext.json_from_text("t")).collect()]
    assert [None if g is None else json.loads(g) for g in got] == [expected_json(t) for t in REPLIES]


def test_valid_items(one):
    items = jsontext.json_items(F.lit('[{"a":"1","b":null},{"a":"2"},{"b":"3"}]'))
    assert [i["a"] for i in one(jsontext.valid_items(items, ["a", "b"]))] == ["1"]
    assert len(one(jsontext.valid_items(items, ["a"], validator=lambda x: F.map_contains_key(x, "b")))) == 2


def test_model_outcome(spark):
    data = [(1, '[{"a":"1"}]', None), (2, "nothing", None), (3, '[{"b":1}]', None), (4, None, "Error 429"), (5, None, "Unauthorized")]
    df = spark.createDataFrame([(i, r, e, 1_000_000, 500_000) for i, r, e in data], "id int, reply string, failure string, tin long, tout long")
    got = {r.id: (r.status, r.error_type, r.results_count, r.total_tokens, r.cost) for r in model_outcome(df, "reply", "failure", ["a"], "tin", "tout").collect()}
    assert got[1] == ("success", None, 1, 1_500_000, 13.75)
    assert got[2][:3] == ("failed", "json_parse_error", 0) and got[3][1] == "validation_error"
    assert got[4] == ("failed", "rate_limit", 0, None, None) and got[5][1] == "auth_error"


@pytest.mark.parametrize(
    "message, model, fetch, retry",
    [
        ("Rate limit", "rate_limit", "unknown", False),
        ("Read timed out", "timeout", "unknown", True),
        ("net::ERR Connection refused", "network_error", "network_error", True),
        ("HTTP 404", "unknown_error", "http_error", False),
        ("401", "auth_error", "unknown", False),
        ("Malformed URL", "unknown_error", "invalid_url", False),
    ],
)
def test_classes(one, message, model, fetch, retry):
    text = F.lit(message)
    assert one(outcome.classify_llm_error(text)) == model
    assert one(outcome.classify_fetch_error(text))["error_type"] == fetch
    assert one(outcome.classify_fetch_error(text, timed_out=F.lit(True)))["error_type"] == "timeout"
    assert one(outcome.is_network_error(text)) is retry


@pytest.mark.parametrize(
    "status, body, ok",
    [(200, '{"a":""}', True), (200, "[1]", False), (200, '{"a":1} x', False), (500, '{"a":"","b":[],"c":{},"d":null}', False), (500, '{"a":0}', True), (500, '{"a":false}', True), (503, '{"a":1}', False)],
)
def test_response_ok(one, status, body, ok):
    got = one(outcome.response_ok(F.lit(status), F.lit(body)))
    assert got["ok"] is ok and (got["error"] is None) is ok


@pytest.mark.parametrize(
    "status, body, key, regex, ok",
    [
        (200, "x", None, None, True),
        (404, "{}", "", None, False),
        (200, "{}", "", None, True),
        (200, "x", "", None, False),
        (200, '{"a": null}', "a", None, True),
        (200, '["a"]', "a", None, True),
        (200, '{"b": 1}', "a", None, False),
        (200, "hello 42", None, r"\d+", True),
        (200, "hello", None, r"\d+", False),
    ],
)
def test_validate_response(one, status, body, key, regex, ok):
    lit = lambda v: F.lit(v).cast("string")
    assert one(outcome.validate_response(F.lit(status), F.lit(body), lit(key), lit(regex)))["ok"] is ok


def test_cost_and_size(one):
    assert one(outcome.token_cost(F.lit(None).cast("long"), F.lit(1), 1, 1)) is None
    assert one(outcome.size_kb(F.lit(1536))) == 1.5


def test_curl_parts(one):
    text = "curl 'https://example.org/cookies' \\\n  -H 'accept: application/json' \\\n  -b 'test_cookie=test_value; another_cookie=another_value'"
    r = one(curl.parse_curl(F.lit(text)))
    assert (r["url"], r["method"], r["data"]) == ("https://example.org/cookies", "GET", None)
    assert r["headers"] == {"accept": "application/json"} and r["cookies"]["test_cookie"] == "test_value"
    again = one(curl.render_curl(curl.parse_curl(F.lit(text))))
    assert one(curl.parse_curl(F.lit(again))) == r
    assert one(curl.parse_curl(F.lit("curl 'u' -X \"POST\" -b 'a=1; a=2; z'")))["cookies"] == {"a": "2"}


def test_block(one):
    b = one(curl.parse_block(F.lit("name= N 1\nexpected_keyword_re=ok|fine\n\ncurl 'http://u' \\\n -H 'a: b'")))
    assert (b["name"], b["expected_json_key"], b["expected_keyword_re"], b["problem"]) == ("N 1", None, "ok|fine", None)
    assert b["command"] == "curl 'http://u' \\ -H 'a: b'"
    assert one(curl.parse_block(F.lit("curl http://u")))["name"] == "Unnamed Command"
    assert one(curl.parse_block(F.lit("name=x"))) is None
    assert one(curl.parse_block(F.lit("expected_json_key=\nexpected_keyword_re=x\ncurl 'u'")))["problem"] is not None


def test_lookup_rows(spark):
    data = [
        ("a", '{"code":"0","data":{"users":[{"name":"N","user_id":"1"},{"name":"M"}]}}'),
        ("b", '{"code":0,"data":{"users":[]}}'),
        ("c", '{"code":0}'),
        ("d", '{"code":9}'),
        ("e", "<html>"),
        ("f", None),
        ("g", '{"code":0,"data":{"users":["x",{"name":"Z"},5]}}'),
        ("h", '[{"code":0}]'),
    ]
    flat = flatten_lookup(spark.createDataFrame(data, "input string, response string"))
    got = sorted(tuple(r) for r in flat.select("input", "name", "user_id").collect())
    assert got == [("a", "M", ""), ("a", "N", "1"), ("b", "【无匹配】", ""), ("c", "【无匹配】", ""), ("d", "【调用失败】", ""), ("e", "【调用失败】", ""), ("f", "【调用失败】", ""), ("g", "Z", ""), ("h", "【调用失败】", "")]
    assert {r.outcome: r.n for r in lookup_stats(flat).collect()} == {"ok": 2, "no_match": 2, "fail": 4}


def test_url_check(spark):
    schema = "seq int, url string, final_url string, status_code int, size_bytes long, reason string, error string"
    df = spark.createDataFrame([(1, "u", "v", 200, 1024, "OK", None), (2, "u", None, 404, 10, "Not Found", None), (3, "u", None, None, None, None, "Timeout: x\ny")], schema)
    got = [tuple(r)[2:] for r in url_check(df).collect()]
    assert got == [("v", "成功", "200", 1.0, ""), ("u", "失败", "404", 0.01, "Not Found"), ("u", "失败", "N/A", 0.0, "Timeout: x")]
