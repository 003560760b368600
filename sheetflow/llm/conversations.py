"""Repair of conversation structure by lightest derivations.

A conversation should read ``(system? (user assistant)+)?``. Its rows are kept,
given another role or deleted, and turns without text are put in; the cheapest
way counts, and of equally cheap ways the one whose audit (the letters of its
edits, in order) comes first. Edits are deductions over items: from "all before
row i is repaired and ends like this" and "row i" follows "all before row i + 1
is repaired and ends like that". An agenda pops items by (cost, audit). Each
deduction adds to the cost and appends to the audit, so its value is never less
than those of its premises and a popped item is final; the work ends when the
goal is popped.

Rows are numbered over range-sorted parts and cut into chunks. A chunk gives
the lightest derivation between any two of its ends, and neighbouring chunks
are joined as often as it takes, so no task works on a whole long conversation.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sheetflow.llm.common import stored
from sheetflow.operators.keyed import lookup, numbered, quoted

# Costs of the edits, blanks, and marks that end a text.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
BLANKS = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")

# What stands before a place: nothing yet, a system turn, a user turn, an assistant turn.
STATES = 4
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# A conversation may end after nothing or after an assistant turn.
GOOD = (0, 3)
# Faults of a row; blank and repeated rows must go.
SOUND, BLANK, DUPLICATE, TRUNCATED = "0123"

CHUNK = 128  # rows
JOIN = 64  # chunks joined at a time

Value = tuple[int, str]


def deductions(rows: str, i: int, q: int) -> Iterator[tuple[tuple, tuple | None, int, str]]:
    """(conclusion, second premise, cost, letter) of each deduction from the item "before row i, after q"."""
    for role in "ua":
        if (q, role) in AFTER:
            yield ("at", i, AFTER[q, role]), None, INSERT, "I"
    if 2 * i == len(rows):
        return
    row, initial, fault = ("row", i), rows[2 * i], rows[2 * i + 1]
    yield ("at", i + 1, q), row, DELETE, "D"
    if fault in (BLANK, DUPLICATE):
        return
    more = CUT if fault == TRUNCATED else 0
    if (q, initial) in AFTER:
        yield ("at", i + 1, AFTER[q, initial]), row, more, "K"
    for role in "ua":
        if (q, role) in AFTER:
            yield ("at", i + 1, AFTER[q, role]), row, REROLE + more, "R"


def lightest(rows: str, start: int, whole: bool) -> dict[int, Value]:
    """Lightest (cost, audit) by which the rows lead from ``start`` to each state behind them.

    ``rows`` has two characters a row, role initial and fault. With ``whole``
    the end of the rows is that of the conversation: the goal follows from the
    states it may end in, and the agenda stops there.
    """
    n = len(rows) // 2
    done: dict[tuple, Value] = {}
    # the rows are axioms of the least value, so they are final before any item that needs them
    agenda: list[tuple[int, str, tuple]] = [(0, "", ("row", i)) for i in range(n)] + [(0, "", ("at", 0, start))]
    heapq.heapify(agenda)
    waiting: dict[tuple, list[tuple[tuple, tuple, int, str]]] = {}
    ends: dict[int, Value] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in done:
            continue
        done[item] = cost, audit
        if item[0] == "goal":
            return {item[1]: (cost, audit)}
        if item[0] == "row":
            ready = waiting.pop(item, [])
        else:
            _, i, q = item
            if i == n:
                ends[q] = cost, audit
                if whole and q in GOOD:
                    heapq.heappush(agenda, (cost, audit, ("goal", q)))
            ready = [(item, *d) for d in deductions(rows, i, q)]
        for first, conclusion, second, weight, letter in ready:
            if second is not None and second not in done:
                waiting.setdefault(second, []).append((first, conclusion, second, weight, letter))
            elif conclusion not in done:
                base, before = done[first]
                heapq.heappush(agenda, (base + weight, before + letter, conclusion))
    return ends


@lru_cache(maxsize=50_000)
def between(rows: str, first: bool, whole: bool) -> tuple[list[int], list[str]]:
    """Costs (-1: no way) and audits from each state to each, as lists of 16; only from the first state if ``first``."""
    costs, audits = [-1] * STATES**2, [""] * STATES**2
    for start in range(1 if first else STATES):
        for q, (cost, audit) in lightest(rows, start, whole).items():
            costs[start * STATES + q], audits[start * STATES + q] = cost, audit
    return costs, audits


def joined(left: tuple[list[int], list[str]], right: tuple[list[int], list[str]]) -> tuple[list[int], list[str]]:
    """The ways through two neighbouring chunks. Equally cheap ways between the same ends are never one the start of another, so audits may be compared piece by piece."""
    costs, audits = [-1] * STATES**2, [""] * STATES**2
    for a in range(STATES):
        for b in range(STATES):
            ways = [(left[0][x] + right[0][y], left[1][x] + right[1][y]) for m in range(STATES) if left[0][x := a * STATES + m] >= 0 and right[0][y := m * STATES + b] >= 0]
            if ways:
                costs[a * STATES + b], audits[a * STATES + b] = min(ways)
    return costs, audits


def broken(initials: str) -> int:
    """Neighbours that may not follow each other."""
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


@dataclass(frozen=True)
class Repair:
    """``conversations``: one row per conversation; ``turns``: the repaired turns, each with its place."""

    conversations: DataFrame
    turns: DataFrame


WAYS = "conv string, chunk long, illegal long, first string, last string, costs array<long>, audits array<string>"


def _ways(chunks: DataFrame) -> DataFrame:
    """The ways through each chunk, from its rows as text."""
    schema = to_arrow_schema(T.StructType.fromDDL(WAYS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, chunk, rows in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first = chunk == 0
                costs, audits = between(rows, first, first and len(rows) < 2 * CHUNK)
                out.append((conv, chunk, broken(rows[::2]), rows[0], rows[-2], costs, audits))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return chunks.mapInArrow(run, WAYS)


def _joined(ways: DataFrame) -> DataFrame:
    """Each run of ``JOIN`` neighbouring chunks as one."""
    listed = F.array_sort(F.collect_list(F.struct("chunk", "illegal", "first", "last", "costs", "audits")))
    runs = ways.groupBy("conv", F.expr(f"chunk div {JOIN}").alias("run")).agg(listed.alias("listed"))
    schema = to_arrow_schema(T.StructType.fromDDL(WAYS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for conv, number, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ends = "".join(p["first"] + p["last"] for p in parts)
                illegal = sum(p["illegal"] for p in parts) + sum(broken(ends[i : i + 2]) for i in range(1, len(ends) - 1, 2))
                all_ways = [(p["costs"], p["audits"]) for p in parts]
                while len(all_ways) > 1:
                    all_ways = [joined(*all_ways[i : i + 2]) if i + 1 < len(all_ways) else all_ways[i] for i in range(0, len(all_ways), 2)]
                row = (conv, number, illegal, ends[0], ends[-1], *all_ways[0])
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return runs.mapInArrow(run, WAYS)


EDITS = "conv string, nth long, place long, letter string, given string"


def _edits(audits: DataFrame) -> DataFrame:
    """What the audits say of each turn that stays: its row's number (null: put in), its place and the role a turn there is given."""
    schema = to_arrow_schema(T.StructType.fromDDL(EDITS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for conv, audit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                letters = np.array(list(audit), dtype="U1")
                stays = letters != "D"
                nth, place = np.cumsum(letters != "I")[stays], np.arange(stays.sum())
                letters = letters[stays]
                # an odd number of turns begins with a system turn, which is a kept one
                given = np.where((place - len(place)) % 2 == 0, "user", "assistant")
                columns = [pa.array([conv] * len(place)), pa.array(nth, mask=letters == "I"), pa.array(place + 1), pa.array(letters), pa.array(given)]
                if len(place):
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return audits.mapInArrow(run, EDITS)


def _md5(*parts: Column) -> Column:
    return F.md5(F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Conversations in order of their turns (null first, then by role and digest of the text), judged and repaired.

    A row's first fault counts: blank, duplicate (role and text stand earlier in
    the conversation) or truncated (no end mark last). conversations: ``key``,
    gaps (turn numbers missing between the least and the largest), blank,
    duplicate, truncated, illegal (neighbours that may not follow each other),
    cost and audit (K keep, R other role, D delete, I insert). turns: ``key``,
    place (from 1), ``role``, ``text`` and edit.

    A null role or text counts as one space; rows of null key are one
    conversation; rows may repeat; other columns are ignored. The key may have
    any type that can be cast to text. An empty table gives empty ones. Texts
    are shuffled once, to the turns that keep them; all else works on digests
    and numbers. An audit is one text, which bounds a conversation to as many
    rows as a text can have characters.
    """
    role_, text_ = (F.coalesce(quoted(c).cast("string"), F.lit(" ")) for c in (role, text))
    # a key without nulls, so that rows of null key meet in joins
    conv = F.coalesce(F.concat(F.lit("="), quoted(key).cast("string")), F.lit("")).alias("conv")
    name = _md5(quoted(turn).isNull(), quoted(turn), role_, text_).alias("id")
    bare = F.rtrim(text_, F.lit(BLANKS))
    initial = F.when(F.substring(role_, 1, 1).isin("s", "u", "a"), F.substring(role_, 1, 1)).otherwise("x")
    facts = rows.select(
        conv,
        quoted(key).alias("key"),
        quoted(turn).alias("turn"),
        role_.alias("role"),
        name,
        _md5(role_, text_).alias("said"),
        initial.alias("initial"),
        F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(SOUND).alias("fault"),
        # tells equal rows apart, which are interchangeable, so that many of them need not meet in one task
        F.monotonically_increasing_id().alias("_tie"),
    )
    order = stored(numbered(facts, ["conv"], ["turn", "role", "id", "_tie"]).drop("_tie"), "conversation-rows")
    begin = order.groupBy("conv", "said").agg(F.min("nth").alias("_begin"))
    again = (F.col("fault") != BLANK) & (F.col("nth") > F.col("_begin"))
    judged = lookup(order, begin, ["conv", "said"]).withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault")))
    judged = judged.select("conv", "key", "turn", "nth", "initial", "fault")

    code = F.array_sort(F.collect_list(F.struct("nth", F.concat("initial", "fault").alias("code"))))
    cut = judged.groupBy("conv", F.expr(f"(nth - 1) div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.transform(code, lambda r: r["code"]), "").alias("rows"),
        F.first("key", ignorenulls=True).alias("key"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        *[F.count_if(F.col("fault") == f).alias(n) for f, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))],
    )
    chunks = stored(cut, "conversation-chunks")
    ways = stored(_ways(chunks.select("conv", "chunk", "rows")), "conversation-ways")
    last = chunks.agg(F.max("chunk")).first()[0] or 0
    while last > 0:
        ways = stored(_joined(ways), "conversation-ways")
        last //= JOIN
    best = F.array_min(F.filter(F.transform(F.array(*map(F.lit, GOOD)), lambda q: F.struct(F.element_at("costs", q + 1).alias("cost"), F.element_at("audits", q + 1).alias("audit"))), lambda w: w["cost"] >= 0))
    found = ways.select("conv", "illegal", best.alias("best")).select("conv", "illegal", "best.*")
    counts = ["blank", "duplicate", "truncated"]
    sums = chunks.groupBy("conv").agg(F.first("key", ignorenulls=True).alias("key"), F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in counts])
    distinct = order.filter(F.col("turn").isNotNull()).groupBy("conv").agg(F.countDistinct("turn").alias("turns"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    told = sums.join(distinct, "conv", "left").join(found, "conv")
    conversations = told.select(F.col("key").alias(key), gaps, *counts, "illegal", "cost", "audit")

    # written, for it is read twice, and so that its real size decides how it is joined
    edits = stored(_edits(found.filter("audit <> ''").select("conv", "audit")), "conversation-edits")
    # a kept row is the first of its equals, so its id names it
    kept = edits.filter("letter <> 'I'").join(order.select("conv", "nth", "id"), ["conv", "nth"]).drop("nth")
    texts = rows.select(conv, name, quoted(key).alias("key"), role_.alias("role"), text_.alias("text")).groupBy("conv", "id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("key", "role", "text")])
    old = texts.join(kept, ["conv", "id"]).select("key", "place", F.when(F.col("letter") == "K", F.col("role")).otherwise(F.col("given")).alias("role"), "text", "letter")
    new = edits.filter("letter = 'I'").join(sums.select("conv", "key"), "conv").select("key", "place", F.col("given").alias("role"), F.lit("").alias("text"), "letter")
    turns = old.unionByName(new).select(F.col("key").alias(key), "place", F.col("role").alias(role), F.col("text").alias(text), F.col("letter").alias("edit"))
    return Repair(conversations, turns)


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults planted by the checksum of key and turn: one in twenty each is dropped, emptied, loses its end marks, is repeated or becomes the user's."""
    space = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(key), F.lit(":"), space(turn)).cast("binary")) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    hurt = rows.select(quoted(key), quoted(turn), F.when(kind == 4, "user").otherwise(space(role)).alias(role), body.alias(text), copies.alias("_copies"))
    return hurt.withColumn("_copies", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop("_copies")
