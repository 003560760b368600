"""Benchmark decontamination with a generalised suffix automaton.

The automaton is built over the words of all normalised test items. Training
words stream through it; at every word it knows the longest match that ends
there. A match as long as a window means that the window occurs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.llm.common import keep_rows, keyed_bytes, per_text, stored
from sheetflow.operators.keyed import quoted

# A-Z to lower case; of the ASCII range only letters and digits are part of words.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences, with the windows and items each state stands for."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int]] = []
        self.items = [item for item, words in items if words]
        short: list[tuple[int, int, int]] = []
        for n, (_, words) in enumerate((i, w) for i, w in items if w):
            last = 0
            for w in words:
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
                ends.append((last, n))
            if len(words) < window:
                short.append((last, len(words), n))
        self.shortest = min((min(len(w), window) for _, w in items if w), default=window)
        self._mark(ends, short)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        """A state of its own for the shorter strings of ``q``, those that end a match from ``p``."""
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def _mark(self, ends: list[tuple[int, int]], short: list[tuple[int, int, int]]) -> None:
        link, length, window = self.link, self.length, self.window
        has: dict[int, set[int]] = {}
        for state, n in ends:
            # up to the state that holds the window itself; items of longer strings are its items too
            while state > 0 and length[state] >= window and n not in has.setdefault(state, set()):
                has[state].add(n)
                state = link[state]
        self.holder: dict[int, int] = {}  # state -> the state that holds its last `window` words
        for state in has:
            at = state
            while length[link[at]] >= window:
                at = link[at]
            self.holder[state] = at
        held = set(self.holder.values())
        self.found = {s: has[s] for s in held}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for state, n_words, n in short:
            self.short.setdefault(state, []).append((n_words, n))

    def stream(self, ids: list[int], base: int, spans: list[tuple[int, int]], items: set[int]) -> None:
        """Follow word numbers; note the spans that occurrences of windows cover and their items."""
        nxt, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        state = size = 0
        for i, c in enumerate(ids, base):
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            if size >= window:
                if spans and spans[-1][1] >= i - window + 1 and spans[-1][0] <= i - window + 1:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((i - window + 1, i + 1))
                items |= self.found[self.holder[state]]
            if short:
                at = state
                while at:
                    for n_words, n in short.get(at, ()):
                        if n_words <= size:
                            spans.append((i - n_words + 1, i + 1))
                            items.add(n)
                    at = link[at]


def _match(automaton: Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans (may overlap) and item numbers of one text. Runs of known words too short for a window are passed over."""
    spans: list[tuple[int, int]] = []
    items: set[int] = set()
    ids = np.fromiter(map(automaton.vocabulary.get, words, repeat(-1)), np.int32, len(words))
    known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
    edge = np.flatnonzero(known[1:] != known[:-1])
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= automaton.shortest
    for b, e in zip(begin[long].tolist(), end[long].tolist(), strict=True):
        automaton.stream(ids[b:e].tolist(), b, spans, items)
    return spans, items


def benchmark_hits(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = 13, shard_words: int = 1_000_000,
) -> DataFrame:
    """Key, n_words, starts and stops (word spans of occurring windows, merged) and items (their ids).

    Words are lower-cased runs of ASCII letters, digits and all characters
    beyond ASCII. A window is ``window`` consecutive words of an item; an item
    with fewer words is one window; an item without words is none. Null text
    has no words; every row of ``docs`` gives one row, other columns are
    ignored. Items of equal id count once, whatever their texts; those without
    an id have windows like others and count as one item, a null in ``items``.
    No items: nothing is hit.

    The items are cut by a hash of their id into shards of about
    ``shard_words`` words; each shard's automaton is broadcast, so its size is
    bounded however large the benchmark is. With one shard there is no shuffle.
    With more, the rows are numbered in the shared folder, for keys do not tell
    them apart, and what the shards find is merged by number.
    """
    automata = _automata(items, item_key, item_text, window, shard_words)
    texts = keyed_bytes(docs, key, text)
    if len(automata) == 1:
        return per_text(texts, _task(automata[0]), HITS).withColumnRenamed("key", key)
    texts = stored(texts.withColumn("number", F.monotonically_increasing_id()), "numbered")
    numbered = texts.select(F.col("number").alias("key"), "text")
    parts = [per_text(numbered, _task(a), HITS) for a in automata]
    # one row per shard and number: a group is as large as there are shards
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    rows = together.withColumn("row", F.struct("starts", "stops", "items")).withColumnRenamed("key", "number")
    merged = rows.groupBy("number").agg(F.first("n_words").alias("n_words"), F.collect_list("row").alias("rows"))
    merged = merged.join(texts.select("number", "key"), "number")
    spans = F.array_sort(F.flatten(F.transform("rows", lambda r: F.arrays_zip(r["starts"], r["stops"]))))
    union = F.aggregate(spans, F.array().cast("array<struct<starts:long,stops:long>>"), _join_span)
    return merged.withColumn("spans", union).select(
        F.col("key").alias(key),
        "n_words",
        F.col("spans.starts").alias("starts"),
        F.col("spans.stops").alias("stops"),
        F.array_sort(F.array_distinct(F.flatten(F.col("rows.items")))).alias("items"),
    )


def _automata(items: DataFrame, item_key: str, item_text: str, window: int, shard_words: int) -> list:
    """Broadcast automata over all items, each of bounded size."""
    listed = items.select(quoted(item_key).cast("string").alias("id"), quoted(item_text).cast("string").cast("binary").alias("text"))
    # items without an id are dealt by their texts
    dealt = F.xxhash64(F.coalesce("id", "text"))
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-(size // 4) // shard_words))
    out = []
    for shard in range(shards):
        rows = listed.filter(F.pmod(dealt, F.lit(shards)) == shard).collect()
        found = Automaton([(r["id"], normal_words(r["text"])) for r in rows], window)
        out.append(items.sparkSession.sparkContext.broadcast(found))
    return out


HITS = "key long, n_words long, starts array<long>, stops array<long>, items array<string>"


def _join_span(done, span):
    last = F.element_at(done, -1)
    longer = F.struct(last["starts"].alias("starts"), F.greatest(last["stops"], span["stops"]).alias("stops"))
    meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stops"] >= span["starts"])
    return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))


def _task(automaton):
    def work(pairs) -> Iterator[dict[str, list]]:
        a = automaton.value
        for keys, texts in pairs:
            out: dict[str, list] = {n: [] for n in ("key", "n_words", "starts", "stops", "items")}
            for k, t in zip(keys, texts, strict=True):
                words = normal_words(t)
                spans, found = _match(a, words) if words else ([], set())
                merged: list[list[int]] = []
                for b, e in sorted(spans):
                    if merged and merged[-1][1] >= b:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([b, e])
                out["key"].append(k)
                out["n_words"].append(len(words))
                out["starts"].append([m[0] for m in merged])
                out["stops"].append([m[1] for m in merged])
                out["items"].append(sorted({a.items[n] for n in found}, key=lambda i: (i is None, i or "")))
            yield out

    return work


def contamination(hits: DataFrame, share: int = 20) -> DataFrame:
    """``hits`` with n_hit, n_items, items_sha256 and contaminated: hit words are 1 / ``share`` of all words or more."""
    n_hit = F.aggregate(F.zip_with("starts", "stops", lambda b, e: e - b), F.lit(0).cast("long"), lambda a, x: a + x)
    return (
        hits.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("items"), ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    )


def keep_clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = 13, share: int = 20, shard_words: int = 1_000_000,
) -> DataFrame:
    """Rows that are not contaminated (see ``contamination``), with all their columns; the others go."""
    automata = _automata(items, item_key, item_text, window, shard_words)

    def judge():
        def clean(t: bytes | None) -> bool:
            words = normal_words(t)
            hit: set[int] = set()
            for a in automata if words else ():
                for b, e in _match(a.value, words)[0]:
                    hit.update(range(b, e))
            return not hit or share * len(hit) < len(words)

        return lambda texts: [clean(t) for t in texts]

    return keep_rows(docs, text, judge)


def without_spans(texts: list[bytes | None], starts: list[list[int]], stops: list[list[int]]) -> list[str | None]:
    """Texts without the words of their spans; for the texts themselves and not only the digests."""
    out: list[str | None] = []
    for t, b, e in zip(texts, starts, stops, strict=True):
        if t is None or not b:
            out.append(None if t is None else t.decode())
            continue
        places, at, flat = [], 0, t.translate(NORMAL)
        for w in flat.split():
            at = flat.index(w, at)
            places.append((at, at + len(w)))
            at += len(w)
        pieces, done = [], 0
        for first, last in zip(b, e, strict=True):
            pieces.append(t[done : places[first][0]])
            done = places[last - 1][1]
        out.append(b"".join([*pieces, t[done:]]).decode())
    return out


def remove_benchmark(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Key and text with every occurring window cut out; a contaminated text becomes null.

    Takes the limits of ``benchmark_hits`` and ``share`` of ``contamination``.
    Every row gives one row, also where keys are null or repeat: the rows are
    numbered in the shared folder. A null text stays null; no items leave every
    text as it is, and an empty table gives an empty one.
    """
    share = limits.pop("share", 20)
    texts = stored(keyed_bytes(docs, key, text).withColumn("number", F.monotonically_increasing_id()), "numbered")
    judged = contamination(benchmark_hits(texts.select("number", "text"), items, "number", "text", **limits), share)
    both = texts.join(judged, "number")

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            new = without_spans(*(b.column(i).to_pylist() for i in (1, 2, 3)))
            gone = b.column(4).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if g else t for g, t in zip(gone, new, strict=True)], pa.string())], names=["key", "text"]
            )

    out = both.select("key", "text", "starts", "stops", "contaminated").mapInArrow(cut, "key long, text string")
    return out.select(F.col("key").alias(key), F.col("text").alias(text))
