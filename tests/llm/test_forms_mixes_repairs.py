"""Fill-in-the-middle, source mixing and conversation repair against their plain versions."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from sheetflow.llm import conversations, fill_in_middle, mixing, queries
from sheetflow.llm.fill_in_middle import Form

rng = random.Random(5)
LONG = "\n".join(" ".join(str(rng.randrange(10**6)) for _ in range(rng.randrange(12))) for _ in range(60_000))
ODD = [
    (9001, None, None),
    (9002, "", "src1"),
    (9003, " \n\t ", "zz"),
    (9004, "one", None),
    (9005, "a\n\nb\n", "src1"),
    (9005, "a\n\nb\n", "src1"),
    (9006, "\n\n\n", ""),
    (9007, "x <S> y\nz", "src1"),
    (9008, "x <P\n> y<\nS><<\nM>\n<", "é"),
    (9009, LONG, "long"),
    (None, LONG[:3000], "long"),
    (None, "é\U0001f600\r\nü\x85 w", "long"),
    (9010, "two words", "\U0001f600"),
]


@pytest.fixture(scope="module")
def rows(spark):
    found = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in found] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows with further columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    more = ["key", "h", "h1", "no", "size", "n", "form", "output", "part", "at", "_s", "shard", "target", "block"]
    return df.withColumns({c: F.lit(None).cast("string") for c in more}).cache()


def same(df, expected, *columns):
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    assert Counter(map(repr, got)) == Counter(map(repr, expected))


# -- fill in the middle -------------------------------------------------------


@pytest.mark.parametrize("form", [Form(), Form(seed=3, percent=40, spm=90)])
def test_fill_in_middle(docs, rows, form):
    made = fill_in_middle.fill_in_middle(docs, form)
    expected = brute.fill_in_middle([r[:2] for r in rows], form.seed, form.percent, form.spm)
    same(made, expected)
    assert {"plain", "psm", "spm"} == {r[2] for r in expected}
    back = fill_in_middle.restore(made, form).select("output", "restored", "form", "doc_id")
    same(back, [(e[-1], r[1] or "", e[2], r[0]) for e, r in zip(expected, rows, strict=True)])


def test_fill_in_middle_in_slices(docs, rows, monkeypatch):
    monkeypatch.setattr(fill_in_middle, "SLICE", 2000)
    same(fill_in_middle.fill_in_middle(docs), brute.fill_in_middle([r[:2] for r in rows]))


def test_other_marks_units_and_keys(spark):
    form = Form(end=". ", prefix="[pre]", suffix="[suf]", middle="[mid]")
    text = "One. Two. Three. <P> Four"
    df = spark.createDataFrame([(f"k{i}", text) for i in range(40)] + [("k", "a [mid] b. c")], "name string, body string")
    made = fill_in_middle.fill_in_middle(df, form, "name", "body")
    found = fill_in_middle.restore(made, form).collect()
    assert all(r["restored"] == (text if r["n"] == 4 else "a [mid] b. c") for r in found)
    assert {r["form"] for r in found if r["n"] == 4} == {"psm", "spm"} and [r["form"] for r in found if r["n"] == 2] == ["plain"]
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(df.filter("false"), form, "name", "body"), form).collect() == []


def test_batches_are_cut_by_bytes():
    assert list(fill_in_middle._slices(np.array([1, 2, 3]))) == [(0, 3)]
    big = fill_in_middle.SLICE
    assert list(fill_in_middle._slices(np.array([1, big, 1, big + 5, 2]))) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1)]
    assert list(fill_in_middle._slices(np.array([], int))) == []


# -- mixing -------------------------------------------------------------------


def pieces_of(mixed, key="doc_id"):
    found = defaultdict(set)
    for r in mixed.pieces.collect():
        assert (r["epoch"], r["start"]) not in {(e, s) for _, e, s, _ in found[r["part"], r["at"]]}
        found[r["part"], r["at"]].add((r["shard"], r["epoch"], r["start"], r["words"]))
    return [(r[key], r["source"], r["size"], r["target"], frozenset(found[r["part"], r["at"]])) for r in mixed.documents.collect()]


def plainly(found):
    return Counter(repr((k, s, n, round(t, 6), sorted(p))) for k, s, n, t, p in found)


@pytest.mark.parametrize("block, shard_words", [(64, 1 << 20), (50, 3000), (4096, 20_000), (10**6, 5000)])
def test_mix(docs, rows, block, shard_words):
    mixed = mixing.mix(docs, block_words=block, shard_words=shard_words)
    total = sum(len(brute.words(t)) for _, t, _ in rows)
    targets = brute.mixture(rows, block, 1)
    shards = -(-sum(round(t) for t in {s: t for _, s, _, t, _ in targets}.values()) // shard_words)
    expected = brute.mixture(rows, block, shards)
    assert plainly(pieces_of(mixed)) == plainly(expected)
    assert abs(sum({s: t for _, s, _, t, _ in expected}.values()) - total) < 1e-3


def test_mix_meets_its_targets(docs):
    found = mixing.taken(mixing.mix(docs, block_words=100)).collect()
    sums, targets, sizes = Counter(), {}, {}
    for r in found:
        sums[r["source"]] += r["taken"]
        targets[r["source"]], sizes[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(sums[s] - targets[s]) <= 0.5 and targets[s] <= 3 * sizes[s] for s in targets)


def test_mix_does_not_depend_on_the_layout(docs):
    listed = lambda df: sorted(repr((r["shard"], r["place"], r["doc_id"], r["epoch"], r["start"], r["words"])) for r in mixing.mix(df, block_words=64, shard_words=5000).pieces.collect())
    assert listed(docs) == listed(docs.orderBy("text").repartition(7))


def test_shards_are_equal_and_shuffled(docs):
    found = mixing.mix(docs, block_words=10, shard_words=4000).pieces.collect()
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r)
    words = [sum(r["words"] for r in s) for s in by_shard.values()]
    assert len(by_shard) > 10 and max(words) - min(words) < 600
    for s in by_shard.values():
        assert sorted(r["place"] for r in s) == list(range(1, len(s) + 1))
    # the larger sources lie in every shard
    assert all(len({r["source"] for r in s}) > 10 for s in by_shard.values())


def test_weights_by_name(spark):
    df = spark.createDataFrame([(i, "a b c d", s) for i in range(60) for s in ("x", "y", None)], "doc_id long, text string, source string")
    mixed = mixing.taken(mixing.mix(df, weights={"x": 1, "y": 0, None: 5}, block_words=7))
    got = {r["source"]: (r["t"], r["w"]) for r in mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("w")).collect()}
    assert got == {"x": (120.0, 120), "y": (0.0, 0), None: (600.0, 600)}
    with pytest.raises(KeyError):
        mixing.mix(df, weights={"x": 1, "y": 2})


def test_nothing_to_mix(docs, spark):
    empty = mixing.mix(docs.filter("false"))
    assert mixing.taken(empty).collect() == [] and empty.pieces.collect() == []
    blank = mixing.mix(spark.createDataFrame([(1, None, "x"), (2, " ", None)], "doc_id long, text string, source string"))
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in mixing.taken(blank).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_shares():
    assert mixing.shares([10, 100, 100], [1, 2, 3]) == [30.0, 72.0, 108.0]
    assert mixing.shares([1, 1, 1000], [1, 2, 3]) == [3.0, 3.0, 996.0]
    assert mixing.shares([0, 0], [1, 2]) == [0.0, 0.0] and mixing.shares([], []) == []
    assert mixing.shares([5, 5], [0, 1]) == [0.0, 10.0]


def test_splitting_tree():
    quota = np.array([1000, 3, 0, 250, 77])
    found = list(mixing.split_quotas(quota, 13, 7, 0, 13))
    assert [s for s, *_ in found] == list(range(13))
    assert sum(own for *_, own in found).tolist() == quota.tolist()
    assert max(own.sum() for *_, own in found) - min(own.sum() for *_, own in found) <= 1
    assert all((found[i][1] + found[i][2] == found[i + 1][1]).all() for i in range(12))
    # any part of the tree can be worked out by itself
    some = list(mixing.split_quotas(quota, 13, 7, 5, 8))
    assert [(s, b.tolist(), o.tolist()) for s, b, o in some] == [(s, b.tolist(), o.tolist()) for s, b, o in found[5:8]]


def test_split_draws_are_hypergeometric():
    draws = np.array([next(mixing.split_quotas(np.array([60, 40]), 2, seed, 0, 1))[2] for seed in range(4000)])
    assert abs(draws[:, 0].mean() - 30) < 0.2
    assert abs(draws[:, 0].var() - 50 * 0.6 * 0.4 * 50 / 99) < 0.5


def test_blocks_are_permuted(spark):
    for n in (1, 2, 7, 100):
        spots = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("long"), 7, F.lit(0)).alias("v")).collect()
        assert sorted(r["v"] for r in spots) == list(range(n))
    assert [r["v"] for r in spots] != list(range(100))


# -- conversations ------------------------------------------------------------

SAID = ["Yes.", "No", "What? ", "a.b!\x0b", "", " \n", None, "Yes.", "?", "x" * 3000]


def talk(n, convs, turns):
    return [(rng.choice(convs), rng.choice(turns), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys"]), rng.choice(SAID)) for _ in range(n)]


TALKS = talk(400, [None, *range(60)], [None, *range(9)]) + talk(300, [700], range(200)) + [(800, t, "ua"[t % 2], f"{t}.") for t in range(900)] + [(900, None, "user", "Hi.")] * 40


def talks(spark, found):
    df = spark.createDataFrame(found, "conv_id long, turn long, role string, text string").repartition(5)
    return df.withColumns({c: F.lit(0) for c in ("conv", "nth", "id", "said", "fault", "key", "initial", "place", "chunk", "_tie")})


def judged(spark, found):
    out = conversations.repair(talks(spark, found))
    turns = defaultdict(list)
    for r in sorted(out.turns.collect(), key=lambda r: r["place"]):
        turns[r["conv_id"]].append((r["role"], r["text"]))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return sorted(repr((*r, tuple(turns[r["conv_id"]]))) for r in out.conversations.select(*columns).collect())


def test_repair(spark):
    assert judged(spark, TALKS) == sorted(map(repr, brute.conversations(TALKS)))


def test_repair_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 4)
    monkeypatch.setattr(conversations, "JOIN", 3)
    assert judged(spark, TALKS) == sorted(map(repr, brute.conversations(TALKS)))


def test_edits_tell_the_audit(spark):
    found = conversations.repair(talks(spark, TALKS))
    audits = {r["conv_id"]: r["audit"] for r in found.conversations.collect()}
    edits = defaultdict(dict)
    for r in found.turns.collect():
        edits[r["conv_id"]][r["place"]] = r["edit"]
    for conv, audit in audits.items():
        assert "".join(edits[conv][p] for p in sorted(edits[conv])) == audit.replace("D", "")


def test_empty_talks(spark):
    found = conversations.repair(talks(spark, TALKS[:1]).filter("false"))
    assert found.conversations.collect() == [] and found.turns.collect() == []


def test_keys_of_other_types(spark):
    df = spark.createDataFrame([("x", 2.5, "user", "Hi."), ("x", 3.5, "assistant", "Yes."), (None, None, "assistant", "So.")], "name string, at double, who string, said string")
    found = conversations.repair(df, "name", "at", "who", "said")
    assert sorted((r["name"] or "", r["audit"], r["cost"]) for r in found.conversations.collect()) == [("", "IK", 3), ("x", "KK", 0)]
    assert [(r["who"], r["said"]) for r in found.turns.filter("name = 'x'").orderBy("place").collect()] == [("user", "Hi."), ("assistant", "Yes.")]


@pytest.mark.parametrize("name", ["op13_conversation_repair"])
def test_registered_query(spark, name):
    found = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    done = {r[0]: r for r in brute.conversations(brute.damaged(found))}
    empty = (0, 0, 0, 0, 0, 0, "", ())
    expected = [(c, *(done.get(c, (c, *empty))[1:8]), brute.sha("\n".join(f"{r}:{t}" for r, t in done.get(c, (c, *empty))[8]))) for c in {r[0] for r in found}]
    same(queries.QUERIES[name](spark, DATA), expected)


def test_damage(spark):
    found = [(c, t, r, "A.b!") for c in [None, *range(30)] for t in [None, *range(12)] for r in ("user", None)]
    same(conversations.damaged(talks(spark, found)), brute.damaged(found))
