"""Size-aware similarity join of word n-gram sets, heavy and light.

Two sets are linked when their Jaccard similarity reaches a threshold. Light
(small) sets enumerate the subsets of every size that a link can have in
common; equal subsets meet. Heavy (large) sets are entered into inverted lists
which are scanned. Where light ends is chosen by cost, from the sizes there are.

An inverted list belongs to a block of the n-grams rather than a single one:
a hash deals the n-grams into one block more than linked sets can differ in, so
linked sets agree in a whole block at least. A frequent passage therefore makes
no long list; only texts that agree in all of a block meet. Blocks without
n-grams make no lists: sets that may agree in nothing else are also listed by
their blocks with one n-gram left out, or as many as it takes.

Equal sets are one node from the start. Lists are scanned in two steps, neither
of which writes out all pairs of a list. First the set that is in most lists
stands for each list and the others are compared with it. What is linked then
is one component. Second, only in lists that still hold several components,
sets of different components are compared. Both steps compare sketches first,
which never miss a link: one bit for each of many cells, the parity of the
n-grams dealt to it, so sets that differ in d n-grams differ in d bits at most.
Only the texts of pairs that pass are fetched, and compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetflow.llm import repeats as R
from sheetflow.llm.common import apart, release, slices, stored
from sheetflow.llm.components import components
from sheetflow.operators.keyed import lookup, quoted

U = np.uint64
LIGHT = 63  # class number of light lists; heavy classes are below
GROWTH = 1.5  # of size classes
CELLS = 16  # sketch cells per block, a bit each
PARTS = 2  # of the lists of a shuffle partition, of which a task holds one at a time
GATHER = 1 << 19  # list rows gathered at a time, or the 2000 sets that come first
ITEM = 1024  # sets compared with as many others in one piece of work
BITS = 16  # of the filter in front of a fetch of texts, for each text wanted
MAPS = 8192  # most bitmaps of that filter, of 4096 bytes each


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-grams are linked when den * intersection >= num * union."""

    words: int = 3
    num: int = 90
    den: int = 100

    def differ(self, both: int) -> int:
        """Most elements in which linked sets can differ, by the sum of their sizes."""
        return (self.den - self.num) * both // (self.den + self.num)

    def common(self, size: int) -> int:
        """Fewest elements that a linked set has in common with one of ``size``."""
        return -(-self.num * size // self.den)

    def class_start(self, c: int) -> int:
        start = 1
        for _ in range(c):
            start = max(start + 1, int(np.ceil(start * GROWTH)))
        return start

    def classes(self, size: int) -> list[tuple[int, int]]:
        """(class, blocks) that a set of this size is listed in: its own, and the next if a linked set can be there."""
        c = 0
        while self.class_start(c + 1) <= size:
            c += 1
        own = (c, self.differ(2 * (self.class_start(c + 1) - 1)) + 1)
        if size * self.den < self.num * self.class_start(c + 1):
            return [own]
        return [own, (c + 1, self.differ(2 * (self.class_start(c + 2) - 1)) + 1)]

    def left_out(self, size: int, c: int, counts: np.ndarray) -> int:
        """How many n-grams a set with so many in each block leaves out of a block to meet linked sets that agree with it in empty blocks only.

        Say they agree in ``a`` of the blocks, all empty, and ``m`` of the others
        hold something in common. All others differ, so of the ``differ`` n-grams
        at most ``over`` more than one each are left to the ``m``.
        """
        largest = min(size * self.den // self.num, self.class_start(c + 1) - 1)
        some = np.sort(counts[counts > 0])
        over = self.differ(size + largest) - len(some)
        if over < 0:
            return 0
        m = len(some) - int(np.searchsorted(np.cumsum(some), size - self.common(size), side="right"))
        return 1 + over // m

    def subsets(self, size: int) -> int:
        """How many subsets a light set of this size enumerates."""
        from math import comb

        return sum(comb(size, d) for d in range(size - self.common(size) + 1))

    def light_limit(self, sizes: dict[int, int]) -> int:
        """The largest light size: where enumerating costs less, in rows and in elements to be compared, than listing."""
        listed = {s: sum(p for _, p in self.classes(s)) + s for s in range(1, 65)}
        best, limit = None, 0
        for x in range(65):
            light = sum(n * self.subsets(s) for s, n in sizes.items() if s <= x)
            # light sets near the limit are listed too, for their links with heavy ones
            heavy = sum(n * listed[s] for s, n in sizes.items() if s <= 64 and s >= self.common(x + 1))
            if best is None or light + heavy < best:
                best, limit = light + heavy, x
            if self.subsets(x + 1) > 10_000:
                break
        return limit


def shingles(text: bytes, rule: Rule, powers: R.Powers) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of all words together if they are fewer, of nothing if there are none."""
    words = R.word_values(text.lower(), powers) if text else np.zeros(0, U)
    if not len(words):
        return words
    sums = powers.sums(words)
    at = np.arange(max(1, len(words) - rule.words + 1))
    return np.unique(powers.hash(sums, at, np.minimum(at + rule.words, len(words))))


def set_id(grams: np.ndarray) -> int:
    """A name for a set: equal sets have equal names."""
    total = (int(R.mix(grams).sum()) + len(grams) * int(R.BASE)) & (2**64 - 1)
    return total - 2**64 if total >= 2**63 else total


NODES = "doc long, key long, hash long, node long, size long, class int, own binary, next binary"


def _sketch(grams: np.ndarray, blocks: int) -> bytes:
    """The parity of the n-grams in each of many cells."""
    cells = CELLS * blocks
    odd = np.bincount((R.mix(grams + U(177)) % U(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _nodes(batches, rule: Rule):
    """Name and size of each row's set, its class, and its sketches for the classes it is listed in."""
    powers = R.Powers(2 * R.PIECE)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    for b in slices(batches):
        found: list[tuple] = []
        for t in b.column(1).to_pylist():
            grams = shingles(t, rule, powers)
            if not len(grams):
                found.append((None, 0, None, None, None))
                continue
            (c, blocks), *more = rule.classes(len(grams))
            found.append((set_id(grams), len(grams), c, _sketch(grams, blocks), _sketch(grams, more[0][1]) if more else None))
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *columns], names=[part.split()[0] for part in NODES.split(", ")])


def _dealt(grams: np.ndarray, blocks: int) -> np.ndarray:
    """The block that a hash deals each n-gram to."""
    return (R.mix(grams + U(77)) % U(blocks)).astype(np.int64)


def _blocks(grams: np.ndarray, blocks: int) -> np.ndarray:
    """For each of ``blocks`` blocks the sum of the n-grams that a hash deals to it."""
    sums = np.zeros(blocks, U)
    np.add.at(sums, _dealt(grams, blocks), grams)
    return sums


def _heavy(grams: np.ndarray, rule: Rule) -> list[np.ndarray]:
    """The inverted lists of a set."""
    rows = []
    for c, blocks in rule.classes(len(grams)):
        sums, of = _blocks(grams, blocks), _dealt(grams, blocks)
        counts = np.bincount(of, minlength=blocks)
        at = np.flatnonzero(counts) if len(grams) > blocks else np.arange(blocks)
        rows.append(_listed(R.mix(sums[at] + (at.astype(U) + U(1)) * R.BASE), c))
        for out in range(1, rule.left_out(len(grams), c, counts) + 1):
            more = np.flatnonzero(counts > out)
            gone = [[sum(x) & (2**64 - 1) for x in combinations(grams[of == k].tolist(), out)] for k in more.tolist()]
            at = np.repeat(more, [len(x) for x in gone])
            left = sums[at] - np.array([x for g in gone for x in g], U)
            rows.append(_listed(R.mix(left + (at.astype(U) + U(1)) * R.BASE), c))
    return rows


LISTED = "part int, lists binary, nodes binary, counts binary, shared boolean"


def _lists(batches, rule: Rule, limit: int, parts: int):
    """The lists that sets are in, gathered from many sets for each of ``parts`` equal ranges of lists (see ``_shared``).

    A list's last six bits are its class. Of several sets of one list the first
    goes to the list's part and is marked as sharing it; the others are known to
    share it and go to any part, so no list fills one.
    """
    powers = R.Powers(2 * R.PIECE)
    start = rule.common(limit + 1)
    for b in batches:
        seen: set[int] = set()
        lists, nodes, held = [], [], 0
        for t in (t for part in slices([b]) for t in part.column(1).to_pylist()):
            grams = shingles(t, rule, powers)
            n = len(grams)
            name = set_id(grams) if n else None
            if name is None or name in seen:
                continue
            seen.add(name)
            rows = []
            if n <= limit:
                total = grams.sum()
                for out in range(n - rule.common(n) + 1):
                    gone = np.array([sum(map(int, c)) & (2**64 - 1) for c in combinations(grams.tolist(), out)], U)
                    size = U((n - out) * int(R.BASE) & (2**64 - 1))
                    rows.append(_listed(R.mix(total - gone + size), LIGHT))
            if n >= start:
                rows += _heavy(grams, rule)
            if rows:
                lists.append(np.concatenate(rows))
                nodes.append(name)
                held += len(lists[-1])
            if len(lists) >= 2000 or held >= GATHER:
                yield _gathered(lists, nodes, parts)
                lists, nodes, held = [], [], 0
        if lists:
            yield _gathered(lists, nodes, parts)


def _gathered(lists: list[np.ndarray], nodes: list[int], parts: int) -> pa.RecordBatch:
    """One row per part and mark: the lists, set by set, the sets, and how many lists each has there."""
    both = np.concatenate(lists)
    of = np.repeat(np.arange(len(nodes), dtype=np.int32), [len(x) for x in lists])
    order = np.argsort(both, kind="stable")
    both, of = both[order], of[order]
    again = np.concatenate(([False], both[1:] == both[:-1]))
    shared = again | np.concatenate((again[1:], [False]))
    names = np.array(nodes, np.int64)
    place = np.where(again, R.mix(both + names[of].view(U)), both)
    group = 2 * ((place >> U(32)) * U(parts) >> U(32)).astype(np.int32) + shared
    del place, again, shared
    order = np.lexsort((of, group))
    both, of, group = both[order], of[order], group[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
    columns: list[list] = [[], [], [], [], []]
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        here, counts = np.unique(of[begin:end], return_counts=True)
        values = (int(group[begin]) // 2, both[begin:end].tobytes(), names[here].tobytes(), counts.astype(np.uint32).tobytes(), bool(group[begin] % 2))
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "lists", "nodes", "counts", "shared"])


def _shared(batches):
    """List and set where a list has several sets, or is marked; each once. Rows arrive sorted by part; one part is held at a time."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if held and held[0][0] != row[0]:
                yield _of_part(held)
                held = []
            held.append(row)
    if held:
        yield _of_part(held)


def _of_part(rows: list[tuple]) -> pa.RecordBatch:
    lists = np.frombuffer(b"".join(r[1] for r in rows), np.int64)
    counts = [np.frombuffer(r[3], np.uint32) for r in rows]
    nodes = np.repeat(np.frombuffer(b"".join(r[2] for r in rows), np.int64), np.concatenate(counts))
    marked = np.repeat([r[4] for r in rows], [int(c.sum()) for c in counts])
    order = np.argsort(lists, kind="stable")
    lists = lists[order]
    near = lists[1:] == lists[:-1]
    keep = marked[order] | np.concatenate((near, [False])) | np.concatenate(([False], near))
    lists, nodes, marked = lists[keep], nodes[order[keep]], marked[order[keep]]
    # equal sets from several tasks are one
    order = np.lexsort((nodes, lists))
    lists, nodes, marked = lists[order], nodes[order], marked[order]
    if len(lists):
        new = np.concatenate(([True], (lists[1:] != lists[:-1]) | (nodes[1:] != nodes[:-1])))
        marked = np.logical_or.reduceat(marked, np.flatnonzero(new))
        lists, nodes = lists[new], nodes[new]
        near = lists[1:] == lists[:-1]
        keep = marked | np.concatenate((near, [False])) | np.concatenate(([False], near))
        lists, nodes = lists[keep], nodes[keep]
    return pa.RecordBatch.from_arrays([pa.array(lists), pa.array(nodes)], names=["list", "node"])


def _listed(hashes: np.ndarray, c: int) -> np.ndarray:
    return (hashes & ~U(63)) | U(c)


def _linked(batches, rule: Rule):
    """The pairs that are linked, by their exact sets; rows of equal ``a`` mostly follow one another."""
    powers = R.Powers(2 * R.PIECE)
    last, x = None, None
    for b in slices(batches):
        a, c = b.column(0).to_pylist(), b.column(1).to_pylist()
        keep = []
        for node, first, second in zip(a, b.column(2).to_pylist(), R.unpacked(b.column(3)), strict=True):
            if x is None or node != last:
                last, x = node, shingles(R.unpacked([first])[0], rule, powers)
            y = shingles(second, rule, powers)
            both = len(x) + len(y)
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            same = int((x[at] == y).sum())
            keep.append(rule.den * same >= rule.num * (both - same))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _alike(batches, rule: Rule):
    """The pairs whose sketches differ in few enough cells; pairs without sketches pass."""
    for batch in batches:
        a, b, both, x, y = (column.to_pylist() for column in batch.columns)
        keep = []
        for total, one, other in zip(both, x, y, strict=True):
            apart_by = 0 if one is None or other is None else (int.from_bytes(one) ^ int.from_bytes(other)).bit_count()
            keep.append(apart_by <= rule.differ(total))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _compare(batches, rule: Rule):
    """Within one piece of work, the pairs of different components whose sketches differ in few enough cells.

    Rows arrive sorted by piece (list, i, j); a piece holds the sets of blocks
    i and j of the list, about ITEM of each.
    """
    held: list[tuple] = []
    told: set[tuple[int, int]] = set()  # pairs are often near in many lists

    def work(rows):
        component = np.array([r[1] for r in rows])
        if len(rows) < 2 or (component == component[0]).all():
            return
        node, size, side = (np.array([r[k] for r in rows]) for k in (0, 2, 3))
        cells = np.frombuffer(b"".join(r[4] for r in rows), f"u{CELLS // 8}").reshape(len(rows), -1)
        i, j = rows[0][5][1:]
        left = np.flatnonzero(side == i)
        right = np.flatnonzero(side == j)
        a, b = [], []
        for x in left.tolist():
            others = right[right > x] if i == j else right
            others = others[component[others] != component[x]]
            most = (rule.den - rule.num) * (size[others] + size[x]) // (rule.den + rule.num)
            others, most = others[np.abs(size[others] - size[x]) <= most], most[np.abs(size[others] - size[x]) <= most]
            if len(others):
                near = others[np.bitwise_count(cells[others] ^ cells[x]).sum(axis=1) <= most]
                a += [node[x]] * len(near)
                b += node[near].tolist()
        new = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True)) - told
        if len(told) > 1_000_000:
            told.clear()
        told.update(new)
        if new:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*new, strict=True)], names=["a", "b"])

    for batch in batches:
        for node, component, size, side, sketch, bucket, i, j in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            piece = (bucket, i, j)
            if held and held[0][5] != piece:
                yield from work(held)
                held = []
            held.append((node, component, size, side, sketch, piece))
    if held:
        yield from work(held)


def _fetched(docs: DataFrame, key: str, text: str, pairs: DataFrame, about: DataFrame) -> DataFrame:
    """node and text, compressed, of the sets in ``pairs``.

    Other texts are left where they are read: a filter of ``BITS`` bits for each
    wanted row, but at most ``MAPS`` bitmaps (32 MB), is broadcast. It lets some
    more rows pass, the more the fuller it is; the join decides.
    """
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stored(about.join(ends, "node", "left_semi").select("node", "doc", "hash"), "wanted")
    maps = min(MAPS, max(1, -(-BITS * wanted.count() // 32768)))
    spot = lambda doc, mark: F.pmod(F.xxhash64(doc, mark), F.lit(maps * 32768)) + 1
    bits = wanted.select(spot(F.col("doc"), F.col("hash")).alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("map"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    body, name, at, map_, all_ = quoted(text).cast("string"), *(apart(docs, n) for n in ("_spot", "_at", "_map", "_bits"))
    rows = docs.withColumn(name, spot(R.row_key(quoted(key), body), F.xxhash64(body)))
    rows = rows.withColumns({map_: F.bitmap_bucket_number(name), at: F.bitmap_bit_position(name)})
    rows = rows.join(F.broadcast(bits.select(F.col("map").alias(map_), F.col("bits").alias(all_))), map_)
    byte = F.conv(F.hex(F.substring(F.col(all_), (F.col(at) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = rows.filter(F.getbit(byte, (F.col(at) % 8).cast("int")) == 1).select(*[quoted(c) for c in docs.columns])
    texts = R.packed(rows, key, text, hashed=True).join(wanted, ["doc", "hash"])
    return stored(texts.dropDuplicates(["node"]).select("node", "text"), "sets")


def _exact(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The linked ones of ``pairs`` (a, b): what is shuffled to them is compressed text, far smaller than its n-grams."""
    of_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    both = lookup(of_b, sets.select(F.col("node").alias("a"), F.col("text").alias("x")), "a", "inner")
    return both.select("a", "b", "x", "y").mapInArrow(lambda b: _linked(b, rule), "a long, b long")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Key, n_shingles and component_id (the smallest key reachable by links) of every row.

    Words are runs of characters other than ASCII white space, A-Z in lower
    case. A text with fewer words than an n-gram has one element, all of it; a
    text without words, or a null one, has none, and is linked with nothing.
    Rows of equal text are linked. Rows of equal key each give a row; a null
    key is never the smallest. Other columns are ignored. N-grams are compared
    by 64-bit hashes.
    """
    nodes, sets = _joined(docs, key, text, rule)
    least = sets.groupBy("component").agg(F.min("key").alias("least"))
    named = stored(lookup(sets, least, "component").select("node", "least"), "named")
    out = lookup(nodes, named, "node")
    return out.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.coalesce("least", "key").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row of each group of similar texts, with all its columns: the one with the smallest key.

    Of rows with equal key and text one stays. Texts without words are groups
    of their own.
    """
    nodes, sets = _joined(docs, key, text, rule)
    first = nodes.filter("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc", "hash")).alias("first"))
    first = lookup(sets.select("node", "component"), first, "node", "inner").groupBy("component").agg(F.min("first").alias("first"))
    chosen = first.select("first.*").union(nodes.filter("node IS NULL").select("doc", "hash")).distinct()
    doc, mark = apart(docs, "_doc"), apart(docs, "_hash")
    body = quoted(text).cast("string")
    rows = docs.withColumns({doc: R.row_key(quoted(key), body), mark: F.xxhash64(body)})
    kept = rows.join(chosen.select(F.col("doc").alias(doc), F.col("hash").alias(mark)), [doc, mark])
    return kept.dropDuplicates([doc, mark]).select(*[quoted(c) for c in docs.columns])


def _joined(docs: DataFrame, key: str, text: str, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Rows (doc, key, hash of the text, node, size), and nodes with their smallest doc and key and their component."""
    body = quoted(text).cast("string")
    rows = docs.select(
        R.row_key(quoted(key), body).alias("doc"), body.cast("binary").alias("text"), quoted(key).cast("long").alias("key"), F.xxhash64(body).alias("hash")
    )
    nodes = stored(rows.mapInArrow(lambda b: _nodes(b, rule), NODES), "nodes")
    sizes = nodes.filter("size BETWEEN 1 AND 64").groupBy("size").count().collect()
    limit = rule.light_limit({r["size"]: r["count"] for r in sizes})
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = rows.select("doc", "text").mapInArrow(lambda b: _lists(b, rule, limit, PARTS * parts), LISTED)
    listed = listed.repartitionById(parts, F.expr(f"part div {PARTS}").cast("int")).sortWithinPartitions("part")
    shared = stored(listed.mapInArrow(_shared, "list long, node long"), "lists").distinct()
    release(docs.sparkSession)
    one = nodes.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("doc", "hash")).alias("first"), F.min("key").alias("key"), F.max("size").alias("size")
    )
    sketches = nodes.filter("node IS NOT NULL").groupBy("node").agg(F.any_value(F.struct("class", "own", "next")).alias("s"))
    about = shared.groupBy("node").agg(F.count("list").alias("lists")).join(one, "node").join(sketches, "node")
    about = stored(about.select("node", "size", "lists", "first.doc", "first.hash", "s.*"), "about")

    def sketched(node: str, sketch: str) -> DataFrame:
        pick = F.struct("class", "own", "next").alias(sketch)
        return about.select(F.col("node").alias(node), F.col("size").alias(f"size_{sketch}"), pick)

    def of_class(sketch: str) -> Column:
        at = F.col(sketch)
        return F.when(F.col("class") == at["class"], at["own"]).when(F.col("class") == at["class"] + 1, at["next"])

    # first step: one set stands for each list; in light lists the smallest, in heavy ones the one in most lists
    entries = stored(lookup(shared, about.select("node", "size", "lists"), "node", "inner"), "entries")
    light = F.col("list").bitwiseAND(F.lit(63)) == LIGHT
    weight = F.when(light, -F.col("size")).otherwise(F.col("lists"))
    stands = entries.groupBy("list").agg(F.max_by("node", F.struct(weight, "node")).alias("a"), F.max_by("size", F.struct(weight, "node")).alias("size_a"), F.count("node").alias("n"))
    stands = stored(stands.filter("n > 1"), "stands")
    both = F.col("size") + F.col("size_a")
    can = F.abs(F.col("size") - F.col("size_a")) * (rule.den + rule.num) <= (rule.den - rule.num) * both
    star = lookup(entries, stands, "list", "inner").filter(can & (F.col("a") != F.col("node")))
    star = star.groupBy(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).agg(F.min(F.col("list").bitwiseAND(F.lit(63))).alias("class"))
    star = lookup(lookup(star, sketched("a", "x"), "a", "inner"), sketched("b", "y"), "b", "inner")
    star = star.select("a", "b", (F.col("size_x") + F.col("size_y")).alias("both"), of_class("x").alias("x"), of_class("y").alias("y"))
    star = stored(star.mapInArrow(lambda b: _alike(b, rule), "a long, b long"), "star")
    links = stored(_exact(star, _fetched(docs, key, text, star, about), rule), "links")
    release(docs.sparkSession)
    member = components(links)

    # second step: lists with several components, cut into pieces of work; of lists of the same sets one does
    known = lookup(entries.filter(~light), member.select("node", F.col("component").alias("c")), "node")
    known = stored(known.select("list", "node", "size", F.coalesce("c", "node").alias("component")), "known")
    mixed = known.groupBy("list").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("node").alias("n"), F.bit_xor(F.xxhash64("node")).alias("who")
    )
    mixed = mixed.filter("low <> high").groupBy("n", "who").agg(F.min("list").alias("list"))
    mixed = mixed.select("list", F.ceil(F.col("n") / ITEM).cast("int").alias("cuts"))
    held = lookup(known, mixed, "list", "inner")
    held = held.withColumn("side", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")).withColumn("class", F.col("list").bitwiseAND(F.lit(63)).cast("int"))
    held = lookup(stored(held, "held"), sketched("node", "x"), "node", "inner").withColumn("sketch", of_class("x"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    held = held.select("node", "component", "size", "side", "sketch", "list", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    pieces = held.repartition(parts, "list", "i", "j").sortWithinPartitions("list", "i", "j", "node")
    near = pieces.mapInArrow(lambda b: _compare(b, rule), "a long, b long").distinct()
    near = stored(near.join(star, ["a", "b"], "left_anti"), "near")
    more = links.limit(0) if near.isEmpty() else stored(_exact(near, _fetched(docs, key, text, near, about), rule), "links")
    if not more.isEmpty():
        member = components(links.unionByName(more))

    of_set = one.join(member, "node", "left").select("node", "key", F.coalesce("component", "node").alias("component"))
    return nodes, stored(of_set, "components")
