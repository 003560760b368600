"""JSON inside text columns: checks, extraction from prose, required fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetflow.functions.strings import as_column, json_inner, let, strip

ITEMS = "array<map<string,string>>"


def is_json(c: Column | str) -> Column:
    """The whole text is one JSON value.

    The parser itself stops after the first value. As an array element the
    text must give exactly one more element, with and without a neighbour.
    """
    text = as_column(c)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    followed = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce(F.try_parse_json(text).isNotNull() & (alone == 1) & (followed == 2), F.lit(False))


def is_json_object(c: Column | str) -> Column:
    text = as_column(c)
    return F.coalesce(strip(text).startswith("{"), F.lit(False)) & is_json(text)


def is_json_array(c: Column | str) -> Column:
    text = as_column(c)
    return F.coalesce(strip(text).startswith("["), F.lit(False)) & is_json(text)


def _first(candidates: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(candidates, test), F.lit(0))


def json_from_text(c: Column | str) -> Column:
    """The JSON array held in a reply, as text; null when there is none.

    Tried in turn: the whole text, fenced blocks, array-looking spans,
    object-looking spans. A lone object is wrapped into an array.
    """
    text = as_column(c)
    whole = strip(text)
    fenced = F.transform(F.regexp_extract_all(text, F.lit(r"```(?:json)?\s*([\s\S]*?)```"), F.lit(1)), strip)
    arrays = F.regexp_extract_all(text, F.lit(r"\[\s*\{[\s\S]*?\}\s*\]"), F.lit(0))
    objects = F.regexp_extract_all(text, F.lit(r'\{\s*"[\s\S]*?\}'), F.lit(0))
    found = F.coalesce(
        F.when(is_json_array(whole) | is_json_object(whole), whole),
        _first(fenced, lambda x: is_json_array(x) | is_json_object(x)),
        _first(arrays, is_json_array),
        _first(objects, is_json_object),
    )
    return let(found, lambda f: F.when(f.startswith("{"), F.concat(F.lit("["), f, F.lit("]"))).otherwise(f))


def json_items(c: Column | str) -> Column:
    """Items of a JSON array text as ``array<map<string,string>>``."""
    return F.from_json(as_column(c), ITEMS)


def valid_items(items: Column | str, fields: list[str], validator: Callable[[Column], Column] | None = None) -> Column:
    """Items that have every required field (a null value counts as present).

    ``validator`` maps an item to a boolean column and replaces the field test.
    """

    def complete(item: Column) -> Column:
        keep = F.lit(True)
        for name in fields:
            keep = keep & F.map_contains_key(item, name)
        return keep

    return F.filter(as_column(items), validator or complete)


def decode_unicode(c: Column | str) -> Column:
    """Plain text with its literal ``\\uXXXX`` sequences turned into characters."""
    text = as_column(c)
    escaped = F.regexp_replace(json_inner(text), r"\\\\u([0-9a-fA-F]{4})", r"\\u$1")
    decoded = F.get(F.from_json(F.concat(F.lit('["'), escaped, F.lit('"]')), "array<string>"), F.lit(0))
    return F.when(F.contains(text, F.lit("\\u")), F.coalesce(decoded, text)).otherwise(text)


def decode_unicode_json(c: Column | str) -> Column:
    """JSON text whose doubly escaped ``\\\\uXXXX`` become single escapes.

    Reading the result decodes keys and values at every depth.
    """
    return F.regexp_replace(as_column(c), r"\\\\u([0-9a-fA-F]{4})", r"\\u$1")


def nested_json(c: Column | str, field: str, items: str) -> Column:
    """List inside a JSON text that is itself a string field of a JSON text."""
    inner = F.coalesce(F.get_json_object(as_column(c), f"$.{field}"), F.lit("{}"))
    return F.coalesce(json_items(F.get_json_object(inner, f"$.{items}")), F.array().cast(ITEMS))
