"""Request commands kept as text: blocks, parts, and the smaller command."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetflow.functions.strings import as_column, strip

# The setting prefixes of a block.
SETTINGS = {"name": "name=", "expected_json_key": "expected_json_key=", "expected_keyword_re": "expected_keyword_re="}

_URL = r"curl\s+'([^']+)'"


def _none_if_missing(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_block(c: Column | str) -> Column:
    """``struct<name, expected_json_key, expected_keyword_re, command, problem>``.

    The whole struct is null for a block without a command. The two
    expectations exclude each other; ``problem`` says so.
    """
    lines = F.filter(F.transform(F.split(as_column(c), "\n"), strip), lambda x: x != "")

    def setting(prefix: str) -> Column:
        hits = F.filter(lines, lambda x: x.startswith(prefix))
        return strip(F.substring(F.try_element_at(hits, F.lit(-1)), F.lit(len(prefix) + 1), F.lit(1 << 30)))

    def plain(x: Column) -> Column:
        test = F.lit(True)
        for prefix in SETTINGS.values():
            test = test & ~x.startswith(prefix)
        return test

    body = F.filter(lines, plain)
    start = F.array_position(F.transform(body, lambda x: x.startswith("curl ")), F.lit(True))
    command = F.when(start > 0, F.array_join(F.slice(body, start.cast("int"), F.size(body)), " "))
    url = _none_if_missing(F.regexp_extract(command, _URL, 1))
    named = F.coalesce(
        _none_if_missing(setting(SETTINGS["name"])),
        F.concat(F.lit("Command for "), F.substring(url, 1, 50), F.lit("...")),
        F.lit("Unnamed Command"),
    )
    key, regex = setting(SETTINGS["expected_json_key"]), setting(SETTINGS["expected_keyword_re"])
    problem = F.when(key.isNotNull() & regex.isNotNull(), F.lit("expected_json_key and expected_keyword_re exclude each other"))
    return F.when(
        command.isNotNull(),
        F.struct(
            named.alias("name"),
            key.alias("expected_json_key"),
            regex.alias("expected_keyword_re"),
            command.alias("command"),
            problem.alias("problem"),
        ),
    )


def _last_wins(pairs: Column) -> Column:
    """Map from (k, v) pairs: first position of a key, last value."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]))


def parse_curl(c: Column | str) -> Column:
    """``struct<url, method, headers, cookies, data>`` of a command."""
    text = as_column(c)
    url = _none_if_missing(F.regexp_extract(text, _URL, 1))
    header = r"-H\s+'([^:]+):\s*([^']+)'"
    header_pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(header), F.lit(1)).alias("k"),
        F.regexp_extract_all(text, F.lit(header), F.lit(2)).alias("v"),
    )
    jar = F.split(F.regexp_extract(text, r"-b\s+'([^']+)'", 1), "; ")
    cookie_pairs = F.transform(
        F.filter(jar, lambda p: F.contains(p, F.lit("="))),
        lambda p: F.struct(
            strip(F.substring_index(p, "=", 1)).alias("k"),
            strip(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v"),
        ),
    )
    data = _none_if_missing(F.regexp_extract(text, r"--data-raw\s+'([^']+)'", 1))
    post = data.isNotNull() | F.contains(text, F.lit("-X POST")) | F.contains(text, F.lit('-X "POST"'))
    return F.struct(
        url.alias("url"),
        F.when(post, F.lit("POST")).otherwise("GET").alias("method"),
        _last_wins(header_pairs).alias("headers"),
        _last_wins(cookie_pairs).alias("cookies"),
        data.alias("data"),
    )


def render_curl(request: Column | str, kept: Column | None = None) -> Column:
    """Command text from its parts, with only the cookies named in ``kept``."""
    r = as_column(request)
    cookies = F.map_entries(r["cookies"])
    if kept is not None:
        cookies = F.filter(cookies, lambda e: F.array_contains(kept, e["key"]))
    headers = F.transform(
        F.filter(F.map_entries(r["headers"]), lambda e: F.lower(e["key"]) != "cookie"),
        lambda e: F.concat(F.lit("  -H '"), e["key"], F.lit(": "), e["value"], F.lit("'")),
    )
    jar = F.array_join(F.transform(cookies, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    no_parts = F.array().cast("array<string>")
    parts = F.concat(
        F.array(F.concat(F.lit("curl '"), r["url"], F.lit("'"))),
        headers,
        F.when(F.size(cookies) > 0, F.array(F.concat(F.lit("  -b '"), jar, F.lit("'")))).otherwise(no_parts),
        F.when(r["data"].isNotNull(), F.array(F.concat(F.lit("  --data-raw '"), r["data"], F.lit("'")))).otherwise(no_parts),
    )
    return F.array_join(parts, " \\\n")
