"""Columns that judge a call: error classes, response checks, cost, size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetflow.functions.jsontext import is_json, is_json_array, is_json_object
from sheetflow.functions.strings import as_column

# Phrases that mark a network failure worth another attempt.
NETWORK_PHRASES = [
    "read timed out",
    "timeout",
    "connection error",
    "connection timeout",
    "connection refused",
    "network is unreachable",
    "name resolution failed",
    "connection aborted",
    "connection reset",
]

# Error class -> words, first class that matches wins.
MODEL_ERRORS = {
    "rate_limit": ["rate", "limit", "429"],
    "timeout": ["timeout", "timed out"],
    "network_error": ["connection", "network"],
    "auth_error": ["auth", "unauthorized", "401"],
}
FETCH_ERRORS = {
    "network_error": ["net::", "NS_ERROR"],
    "http_error": ["HTTP", "404", "500"],
}
FETCH_ERRORS_ANY_CASE = {"invalid_url": ["invalid", "malformed"]}
FETCH_MESSAGE_LENGTH = 200


def has_any(text: Column, words: list[str]) -> Column:
    """Any of the words occurs as plain text."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def _ladder(start, text: Column, classes: dict[str, list[str]]):
    for name, words in classes.items():
        start = start.when(has_any(text, words), F.lit(name))
    return start


def classify_llm_error(message: Column | str) -> Column:
    return _ladder(F, F.lower(as_column(message)), MODEL_ERRORS).otherwise("unknown_error")


def model_error_kind(failure: Exception) -> str:
    """The same classes for an exception at hand, for deciding on another attempt."""
    message = str(failure).lower()
    return next((kind for kind, words in MODEL_ERRORS.items() if any(w in message for w in words)), "unknown_error")


def classify_fetch_error(message: Column | str, timed_out: Column | None = None) -> Column:
    """``struct<error_type, error_message>``; the message is cut for the log."""
    text = as_column(message)
    start = F if timed_out is None else F.when(timed_out, F.lit("timeout"))
    kind = _ladder(_ladder(start, text, FETCH_ERRORS), F.lower(text), FETCH_ERRORS_ANY_CASE).otherwise("unknown")
    return F.struct(kind.alias("error_type"), F.substring(text, 1, FETCH_MESSAGE_LENGTH).alias("error_message"))


def is_network_error(message: Column | str) -> Column:
    return has_any(F.lower(as_column(message)), NETWORK_PHRASES)


def token_cost(tokens_in: Column | str, tokens_out: Column | str, price_in: float, price_out: float) -> Column:
    """Price per million tokens; no usage, no cost."""
    return as_column(tokens_in) / F.lit(1e6) * F.lit(float(price_in)) + as_column(tokens_out) / F.lit(1e6) * F.lit(float(price_out))


def size_kb(size: Column | str) -> Column:
    return F.round(as_column(size) / F.lit(1024.0), 2)


def response_ok(status: Column | str, body: Column | str) -> Column:
    """``struct<ok, error>`` of an extract call.

    200 must carry a JSON object; 500 passes when the object has a value that
    is not null, empty text, an empty list or an empty object.
    """
    code, text = as_column(status), as_column(body)
    readable = F.substring(text, 1, 500)
    has_value = F.exists(
        F.map_values(F.from_json(text, "map<string,string>")),
        lambda v: v.isNotNull() & ~F.regexp_replace(v, r"\s", "").isin("", "[]", "{}"),
    )
    obj = is_json_object(text)
    ok = F.when(code == 200, obj).when(code == 500, obj & F.coalesce(has_value, F.lit(False))).otherwise(False)
    error = F.when(ok, F.lit(None).cast("string")).when(
        code == 200, F.concat(F.lit("JSON 解析失败. 响应内容: "), readable)
    ).otherwise(F.concat(F.lit("HTTP "), code.cast("string"), F.lit(": "), readable))
    return F.struct(ok.alias("ok"), error.alias("error"))


def validate_response(status: Column | str, body: Column | str, key: Column | None = None, regex: Column | None = None) -> Column:
    """``struct<ok, reason>`` of a recorded response against its expectation.

    An empty expected key asks only for valid JSON; with neither key nor
    pattern, status 200 is enough.
    """
    code, text = as_column(status), as_column(body)
    none = F.lit(None).cast("string")
    key = none if key is None else key
    regex = none if regex is None else regex
    present = F.when(is_json_object(text), F.array_contains(F.json_object_keys(text), key)).when(
        is_json_array(text), F.coalesce(F.array_contains(F.from_json(text, "array<string>"), key), F.lit(False))
    ).otherwise(False)
    reason = (
        F.when(code != 200, F.concat(F.lit("HTTP状态码错误: "), code.cast("string")))
        .when(key.isNotNull() & ~is_json(text), F.lit("响应内容不是有效的JSON格式"))
        .when(
            key.isNotNull() & (key != "") & ~present,
            F.concat(F.lit("响应JSON中缺少期望的键: '"), key, F.lit("'")),
        )
        .when(
            key.isNull() & regex.isNotNull() & ~F.coalesce(F.rlike(text, regex), F.lit(False)),
            F.concat(F.lit("响应文本中未找到匹配 '"), regex, F.lit("' 的内容")),
        )
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))
