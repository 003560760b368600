"""Each operator against its plain version, over the small tables and odd rows."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from conftest import DATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetflow.llm import common, decontaminate, jaccard, language, packing, pii, queries, repeats, secret_scan, substring_dedup, suffix_dedup, token_counts, topk
from sheetflow.llm.components import components

rng = random.Random(7)
LONG = " ".join(rng.choice(["alpha", "beta", "gamma", "été", "Größe"]) + str(rng.randrange(900)) for _ in range(30_000))
ODD = [
    (9001, None),
    (9002, ""),
    (9003, " \n\t "),
    (9004, "one"),
    (9005, "one"),
    (9005, "one"),
    (9006, "Two words"),
    (9007, "12 + 34 = ?"),
    (9008, LONG),
    (None, LONG[:5000]),
    (None, LONG[2500:9000]),
    (9009, "ab" * 400),
    (9010, "Des. " * 700),
    (9011, "a<|endoftext|>b  c \n\n d\x0be\x85f　g <|startoftext|> İstanbul é don't 't \U0001f600 x\x1cy"),
    (9012, "token: abc secret=token: abcdef password = 'hunter22' AKIA" + "Z" * 16 + " " + "0123456789abcdef" * 3),
    (9013, "é a.b@c.de_f@g.h, 1.2.3.4.5.6.7.8 300.1.1.1 4111 1111-1111 1111 +1 (555) 123-4567 4111111111111111111 " + "7" * 3000),
    (9014, LONG[:40_000] + " inserted " + LONG[40_000:80_000]),
]


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in table] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The rows with further columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    more = ["key", "doc", "node", "size", "name", "bucket", "spans", "digest", "n_words", "score", "starts", "_judged", "rank"]
    return df.withColumns({c: F.lit(None).cast("string") for c in more}).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def same(df, expected, columns=None):
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    assert Counter(map(repr, got)) == Counter(map(repr, expected))


def test_jaccard(docs, rows, none):
    same(jaccard.similar_groups(docs), brute.groups(rows))
    assert jaccard.similar_groups(none).collect() == []


def near_copies():
    """Families whose members differ by a few words, of small and larger sets."""
    out = []
    for size in (4, 8, 11, 16, 24, 40, 90, 300):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            for _ in range(12):
                text = list(base)
                for _ in range(rng.randrange(1 + size // 25)):
                    text[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
                if rng.random() < 0.5:
                    text.append(f"y{rng.randrange(3)}")
                out.append((len(out), " ".join(text)))
    return out


@pytest.mark.parametrize("words, num", [(3, 90), (5, 80)])
def test_jaccard_families(spark, words, num):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.similar_groups(df, rule=jaccard.Rule(words, num, 100))
    expected = brute.groups(rows, words, num)
    assert 1 < max(Counter(c for _, _, c in expected).values())
    same(found, expected)


@pytest.mark.parametrize("num, sizes", [(80, (8, 10)), (80, (9, 11)), (80, (12, 15)), (80, (14, 17)), (90, (9, 10)), (70, (7, 10))])
def test_linked_sets_share_a_list(num, sizes):
    """Also those that agree in blocks without n-grams only."""
    rule, draw = jaccard.Rule(5, num, 100), np.random.default_rng(5)
    small, large = sizes
    lost = agree_in_empty = 0
    for _ in range(2000):
        grams = draw.integers(0, 2**64, large, np.uint64)
        a, b = np.sort(grams[:small]), np.sort(grams[:large])
        x, y = (set(np.concatenate(jaccard._heavy(s, rule)).tolist()) for s in (a, b))
        lost += not x & y
        blocks = {c: k for c, k in rule.classes(len(a)) if (c, k) in rule.classes(len(b))}
        same = [(p == q, p == 0) for k in blocks.values() for p, q in zip(jaccard._blocks(a, k), jaccard._blocks(b, k), strict=True)]
        agree_in_empty += all(empty for equal, empty in same if equal)
    assert agree_in_empty and not lost


def test_pairs_that_agree_in_empty_blocks_are_linked(spark):
    """Texts of 8 and 10 five-word shingles, 8 of them in common."""
    draw = random.Random(11)
    rows = []
    for _ in range(400):
        words = [f"w{draw.randrange(10**9)}" for _ in range(14)]
        rows += [(len(rows), " ".join(words[:12])), (len(rows) + 1, " ".join(words))]
    found = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), rule=jaccard.Rule(5, 80, 100))
    same(found.select("doc_id", "component_id"), [(k, k - k % 2) for k, _ in rows])


def test_light_limit_follows_cost():
    rule = jaccard.Rule()
    assert rule.light_limit({}) == 0
    assert 9 < rule.light_limit({s: 10 for s in range(1, 64)}) < 30
    assert rule.subsets(8) == 1 and rule.subsets(12) == 13


def test_keep_one(docs, rows, none):
    kept = jaccard.keep_one(docs, rule=jaccard.Rule(5, 80, 100))
    assert kept.columns == docs.columns
    classes = defaultdict(set)
    for (k, t), (_, n, c) in zip(rows, brute.groups(rows, 5, 80), strict=True):
        classes[c if n and c is not None else (k, t)].add((k, t))
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(found) == len(classes)
    assert all(len(c & set(found)) == 1 for c in classes.values())
    assert jaccard.keep_one(none).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (300, 200), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_language(spark, rows, none):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op2_language_id(spark, DATA).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [k for k, r in found.items() if r["held_out"]]
    assert len(found) == len(truth) and held
    assert sum(found[k]["lang_pred"] == truth[k] for k in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    model = language.fit(docs.filter(~language.held_out()))
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    by_text = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()}
    assert by_text[9001] == by_text[9002] == by_text[9003] == by_text[9007] == ("und", 0.0)
    assert by_text[9010][0] in model.languages
    kept = language.keep_identified(odd, model, least=0.0)
    assert {r["doc_id"] for r in kept.collect()} & {9001, 9002, 9003, 9007} == set()
    empty = none.withColumn("lang", F.lit("en"))
    assert language.fit(empty) is None
    assert language.identify(none, None).collect() == []
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}


def test_packing(docs, rows, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = [(k, *p) for k, t in rows for p in brute.pieces(library.encode(t or "", add_special_tokens=False).ids)]
    packed = packing.pack(packing.token_pieces(docs, path), rows_per_range=60).collect()
    assert Counter(tuple(r)[:5] for r in packed) == Counter(expected)
    used = defaultdict(list)
    for r in packed:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(used) <= 1 + 1.02 * -(-sum(p[3] for p in expected) // 4096)
    assert packing.pack(packing.token_pieces(none, path)).collect() == []


def test_packing_of_tiny_pieces(spark):
    pieces = spark.range(3000).select(F.col("id").alias("key"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") % 7 + 1).alias("length"), F.col("id").alias("ids_crc32"))
    used = packing.pack(pieces, capacity=64, rows_per_range=200).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("key").alias("rows")).collect()
    assert sum(r["rows"] for r in used) == 3000 and max(r["n"] for r in used) <= 64
    total = sum(i % 7 + 1 for i in range(3000))
    assert len(used) <= 1.03 * total / 64 + 1


def digest_words(df):
    return df.select("doc_id", "n_words", queries._covered("starts", "stops"), F.sha2("kept", 256))


def test_substring_dedup(docs, rows, none, monkeypatch):
    same(digest_words(substring_dedup.repeated_words(docs)), brute.repeated_words(rows))
    assert substring_dedup.repeated_words(none).collect() == []


def test_suffix_dedup(docs, rows, none):
    found = suffix_dedup.repeated_bytes(docs)
    digest = found.select("doc_id", "n_bytes", queries._covered("starts", "stops"), F.size("starts"), F.sha2("kept", 256))
    same(digest, brute.repeated_bytes(rows))
    assert suffix_dedup.repeated_bytes(none).collect() == []


def test_runs_cover_every_window():
    values = np.array([rng.randrange(5) for _ in range(3000)], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    scan = repeats.Scan(values, np.array([10, 1990, 1000]), 13, 3, repeats.Powers(4000))
    windows = repeats._ranges(scan.begin, scan.end)
    assert windows.tolist() == [*range(10, 1988), *range(2000, 2988)]
    first, last, core, hull = scan.blocks(np.arange(len(scan.begin)), 4)
    assert repeats._ranges(first, last + 1).tolist() == windows.tolist()
    by_content = defaultdict(set)
    for f, e, c in zip(first.tolist(), last.tolist(), core.tolist(), strict=True):
        for w in range(f, e + 1):
            by_content[values[w : w + 13].tobytes()].add(c)
    assert all(len(c) == 1 for c in by_content.values())


def test_sweep_over_small_batches():
    """Batches and partitions may be cut anywhere."""
    import pyarrow as pa

    rows = sorted((rng.randrange(6), rng.randrange(4), rng.randrange(9)) for _ in range(60))
    rows = [r for r in rows if r[0] != 3] + [(3, 1, 1)]
    rows.sort()
    size = Counter(r[:2] for r in rows)
    for everywhere in (True, False):
        want = {r for r in rows if (size[r[:2]] > 1 if everywhere else r[2] > min(x[2] for x in rows if x[:2] == r[:2]))}
        for step in (1, 2, 7, 60):
            batches = []
            for i in range(0, len(rows), step):
                part = list(zip(*rows[i : i + step], strict=True))
                arrays = [pa.array(c, pa.int64()) for c in part] + [pa.array([False] * len(part[0]))]
                batches.append(pa.RecordBatch.from_arrays(arrays, names=["bucket", "name", "doc", "twice"]))
            gone = [(r["doc"], r["name"]) for b in repeats.sweep(batches, everywhere) for r in b.to_pylist() if r["gone"]]
            assert Counter(gone) == Counter((r[2], r[1]) for r in rows if r in want)


def test_top_k(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows = [(k, list(e)) for k, e in rows]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # one common vector
    rows += [(2000, None), (2050, [None] * 64), (2100, [float("nan")] * 64), (2150, [float("inf")] + [0.0] * 63), (None, rows[1][1]), (rows[5][0], rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    known = {k: [int(np.floor(256 * float(x))) for x in e] for k, e in rows if k is not None and e and all(x is not None and np.isfinite(x) for x in e)}
    expected = []
    for k, q in known.items():
        if k % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in known.items() if i != k)[:5]
            expected += [(k, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    vectors = df.withColumn("vector", topk.grid_vector(F.col("embedding")))
    same(topk.top_k(vectors, F.col("vec_id") % 50 == 0, pivots=8, rows_per_block=32), expected)
    assert topk.top_k(vectors.filter("false"), F.col("vec_id") % 50 == 0).collect() == []
    assert len(topk.top_k(vectors.filter("vec_id < 3"), F.lit(True)).collect()) == 6
    assert topk._scores(np.array([[2**40, 1]]), np.array([[2**20, 3]])).tolist() == [[2**60 + 3]]


def test_top_k_with_repeated_ids(spark):
    """Every row is a candidate: against the SQL of the query over ids and rows that repeat."""
    import duckdb

    found = [(rng.randrange(130), [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for _ in range(400)]
    found += found[:150] + [(0, [1.0, 1.0, 1.0, 1.0]), (1, [0.5] * 4), (1, [1.0] * 4), (100, None), (None, [1.0] * 4)] + [(i, [0.25] * 4) for i in range(60)]
    con = duckdb.connect()
    con.sql("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", found)
    expected = con.sql(queries.CHECKS["op5_exact_top_k"].replace("embedding IS NOT NULL", "embedding IS NOT NULL AND vec_id IS NOT NULL")).fetchall()
    vectors = spark.createDataFrame(found, "vec_id long, embedding array<float>").withColumn("vector", topk.grid_vector(F.col("embedding")))
    same(topk.top_k(vectors, F.col("vec_id") % 50 == 0, pivots=5, rows_per_block=16), expected)
    few = vectors.filter("vec_id IN (0, 1)").limit(6)
    assert {r["vec_id"] for r in topk.top_k(few, F.col("vec_id") == 0).collect()} <= {1}


def test_secret_scan(docs, rows, none):
    expected = [(k, brute.spans(brute.secrets(t))) for k, t in rows]
    found = secret_scan.secret_spans(docs)
    same(found.select("doc_id", queries.span_text(F.col("spans"))), expected)
    assert secret_scan.secret_spans(none).collect() == []
    new = secret_scan.redacted(docs)
    assert new.columns == docs.columns
    same(new, [(k, None if t is None else brute.redacted(t)) for k, t in rows], ["doc_id", "text"])


def test_ledger_scans_only_what_it_lacks(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame([(1, "token=abcdef"), (2, "token=abcdef"), (3, "plain")], "doc_id long, text string")
    secret_scan.scan_unseen(first, ledger)
    assert secret_scan.ledger_rows(spark, ledger).count() == 2 * 3
    secret_scan.scan_unseen(first.union(spark.createDataFrame([(4, "new")], first.schema)), ledger)
    assert secret_scan.ledger_rows(spark, ledger).count() == 3 * 3
    rules = (*secret_scan.RULES[:2], secret_scan.Rule("hex", "[0-9a-f]{6,}", lambda m: True, "abcdef", version=2))
    found = {r["doc_id"]: r["spans"] for r in secret_scan.secret_spans(first, rules=rules, ledger=ledger).collect()}
    assert secret_scan.ledger_rows(spark, ledger).count() == 3 * 3 + 2
    assert [(s["kind"], s["start"], s["stop"]) for s in found[2]] == [("assign", 0, 12), ("hex", 6, 12)] and found[3] == []


def test_personal_data(docs, rows, none):
    found = pii.personal_spans(docs)
    expected = [(k, brute.spans(brute.personal(t))) for k, t in rows]
    same(found.select("doc_id", queries.span_text(F.col("base"))), expected)
    assert all(r["base"] == r["spans"][: len(r["base"])] for r in found.collect())
    assert pii.personal_spans(none).collect() == []


def test_disclosing_terms(spark):
    """A name that stands only with one address, in texts of their own, discloses it; common words and copies do not."""
    texts = [f"note{i} zorbelius topic{i} common words here mail{i} z@example.com end{i}" for i in range(6)]
    texts += [f"plain{i} common words here topic{i} mail{i}" for i in range(60)]
    texts += ["the very same letter from quintus to w@example.com"] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_spans(df).collect()}
    terms = {i: [s["value"] for s in r["spans"][len(r["base"]) :]] for i, r in found.items()}
    assert "zorbelius" in terms[0] and "zorbelius" in terms[5] and "common" not in terms[0]
    assert all(not t for i, t in terms.items() if i >= 6)
    clean = pii.personal_spans(df).filter("doc_id = 0").select(pii.sanitise().alias("t")).first()["t"]
    assert "zorbelius" not in clean and "[email]" in clean and "z@example.com" not in clean


def test_terms_stand_where_the_text_has_them(spark):
    """Lowering may lengthen a text; places are those of the text as it is, also far into a very long one."""
    far = " ".join(f"w{i}" for i in range(200_000))
    texts = [f"İİ {'Word. ' * i} ZorbelIUS at z@example.com says İ{i} zorbelius" for i in range(6)] + [f"{far} Zorbelius, z@example.com"] + [f"plain at says {i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"][len(r["base"]) :] for r in pii.personal_spans(df).collect()}
    for i in range(7):
        named = [s for s in found[i] if s["value"].lower() == "zorbelius"]
        assert len(named) == (2 if i < 6 else 1) and all(texts[i][s["start"] : s["stop"]] == s["value"] for s in found[i])
    clean = pii.personal_spans(df).filter("doc_id < 6").select(pii.sanitise().alias("t")).collect()
    assert all("zorbelius" not in r["t"].lower() and "[email]" in r["t"] for r in clean)


def test_signatures_disclose(spark):
    """A name that stands in one template in different letters discloses the address, however short it is; in copies it does not."""
    texts = [f"letter{i} about matter{i} Regards Zorbelius z@example.com" for i in range(6)]
    texts += [f"letter{i} on topic{i} 王伟 Q w@example.cn" for i in range(6)]
    texts += [f"plain{i} letter{i} about or on Regards" for i in range(60)]
    texts += ["The one letter of Quintus x@example.org", "the one  letter of quintus, x@example.org"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: {s["value"].lower() for s in r["spans"][len(r["base"]) :]} for r in pii.personal_spans(df).collect()}
    assert all(found[i] == {"zorbelius"} for i in range(6))
    assert all(found[i] >= {"王伟", "q"} for i in range(6, 12))
    assert not any(found[i] for i in range(12, len(texts)))


def test_token_counts(docs, rows, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = []
    for k, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((k, len((t or "").encode()), n, n > 1024))
    same(token_counts.count_tokens(docs, path), expected)
    assert token_counts.count_tokens(none, path).collect() == []


def test_plain_letters_split_as_in_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter = token_counts.Counter(path, token_counts.whole_tokens(path))
    library = Tokenizer.from_file(path)
    import re

    letters = [chr(c) for c in range(0x250) if not token_counts.HARD.search(chr(c)) and chr(c) not in " \n"]
    for a in letters:
        for s in (f"x{a}y {a} {a}1{a}, '{a}", f"{a}\n{a}{a}."):
            assert counter.text(s) == len(library.encode(s, add_special_tokens=False).ids), s
    ids = packing.Ids(public_tokenizers.path("word_bpe_49k.json"), {})
    for a in letters:
        s = f"x{a}Y {a} {a}, {a}1."
        assert np.frombuffer(ids.of(s.encode()), "<u4").tolist() == ids.tokenizer.encode(s, add_special_tokens=False).ids, s
    assert re.compile(r"[\x09-\x0d\x20]+").sub("", "\x0b") == ""


def test_decontamination(spark, docs, rows, none):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, "Two, WORDS!"), (901, ""), (902, None), (None, "one"), (903, "beta1 gamma2"), (900, "12 34")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.hits(rows, items)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same(decontaminate.contamination(decontaminate.benchmark_hits(docs, bench)), expected, columns)
    unique = docs.filter("doc_id IS NOT NULL AND doc_id <> 9005")
    sharded = decontaminate.contamination(decontaminate.benchmark_hits(unique, bench, shard_words=700))
    same(sharded, [e for e in expected if e[0] not in (None, 9005)], columns)
    clean = decontaminate.keep_clean(docs, bench)
    same(clean, [r for r, e in zip(rows, expected, strict=True) if not e[5]], ["doc_id", "text"])
    assert decontaminate.benchmark_hits(none, bench).collect() == []
    assert {r["items"] == [] for r in decontaminate.benchmark_hits(docs, bench.filter("false")).collect()} == {True}
    removed = {r["doc_id"]: r["text"] for r in decontaminate.remove_benchmark(unique, bench, share=1).collect()}
    # "one" is an item too, though it has no id
    assert removed[9006] is None and removed[9004] is None


def test_shards_keep_every_row(spark):
    """Rows without a key, and of equal key, are rows of their own however many shards there are."""
    rows = [(None, "alpha beta gamma"), (None, "one two"), (7, "one two three"), (7, "one two three"), (7, ""), (8, None), (None, None)]
    items = [(i, t) for i, t in enumerate(["alpha beta", "one two", "three", "beta gamma delta", "gamma"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for words in (1, 4, 1000):
        same(decontaminate.contamination(decontaminate.benchmark_hits(df, bench, shard_words=words)), brute.hits(rows, items), columns)


def test_items_without_an_id(spark):
    """Their windows are windows; together they count as one item, which has no name to list."""
    rows = [(1, "alpha beta gamma"), (None, "one two"), (None, "one two three"), (7, None), (7, "delta")]
    items = [(None, "alpha beta"), (None, "one two"), (5, "three"), (None, None), (6, "beta gamma")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for words in (1, 1000):
        same(decontaminate.contamination(decontaminate.benchmark_hits(df, bench, shard_words=words)), brute.hits(rows, items), columns)
    assert [r["doc_id"] for r in decontaminate.keep_clean(df, bench).orderBy("doc_id").collect()] == [7, 7]
    for words in (1, 1000):
        removed = decontaminate.remove_benchmark(df, bench, share=1000, shard_words=words)
        same(removed, [(1, None), (None, None), (None, None), (7, None), (7, "delta")])
        same(decontaminate.remove_benchmark(df, bench.filter("item_id = 5"), share=2, shard_words=words), [(1, "alpha beta gamma"), (None, "one two"), (None, "one two "), (7, None), (7, "delta")])


def test_sketches_miss_no_link():
    """Sets that differ in d n-grams differ in d bits at most, and linked pairs always pass."""
    import pyarrow as pa

    rule, rng = jaccard.Rule(), np.random.default_rng(5)
    for size in (12, 60, 400):
        for gone in range(0, 2 * rule.differ(2 * size) + 2):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, gone, dtype=np.uint64)]))
            blocks = rule.classes(size)[0][1]
            x, y = jaccard._sketch(a, blocks), jaccard._sketch(b, blocks)
            differ = (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_count()
            assert differ <= len(np.setxor1d(a, b))
            batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "both": [len(a) + len(b)], "x": [x], "y": [y]})
            passed = sum(out.num_rows for out in jaccard._alike([batch], rule))
            same = len(np.intersect1d(a, b))
            assert passed or rule.den * same < rule.num * (len(a) + len(b) - same)


def test_rows_are_kept_slice_by_slice(spark):
    docs = spark.range(0, 4000, 1, 1).select("id", F.concat(F.repeat(F.lit("text "), 400), F.col("id").cast("string")).alias("text"))
    docs = docs.withColumn("text", F.when(F.col("id") != 7, F.col("text")))

    def judge():
        return lambda texts: [len(texts) < 2000 and t is not None for t in texts]

    few = common.keep_rows(docs, "text", judge, F.col("id") % 2 == 1)
    assert sorted(r["id"] for r in few.select("id").collect()) == [k for k in range(1, 4000, 2) if k != 7]
    assert few.columns == docs.columns
    # the text goes to Python once
    assert "as binary" not in few._jdf.queryExecution().executedPlan().toString()
    # other types than text, and names in other case
    numbers = docs.select("id", F.col("id").alias("text"))
    for rows, name in ((numbers, "text"), (docs.withColumn("text", F.col("text").cast("binary")), "text"), (docs, "TEXT")):
        assert common.keep_rows(rows, name, lambda: lambda texts: [t is not None and t.endswith(b"8") for t in texts]).count() == 400


def test_sets_are_made_slice_by_slice():
    n, rule = 6000, jaccard.Rule(5, 80, 100)
    texts = pa.array([b"w" * 4000 + b" %d" % (i % (n // 2)) for i in range(n)], pa.binary())
    numbers = pa.array(range(n), pa.int64())
    batch = pa.RecordBatch.from_arrays([numbers, texts, numbers, numbers], names=["doc", "text", "key", "hash"])
    out = list(jaccard._nodes([batch], rule))
    assert max(b.num_rows for b in out) < 2000
    assert [k for b in out for k in b.column(0).to_pylist()] == list(range(n))
    # equal texts of one batch stay one set, though slices part them
    names = np.concatenate([np.frombuffer(x, np.int64) for b in jaccard._lists([batch.select([0, 1])], rule, 0, 1) for x in b.column(2).to_pylist()])
    assert len(set(names.tolist())) == len(names) == n // 2


def test_lists_are_gathered_by_their_rows(monkeypatch):
    rule, local = jaccard.Rule(5, 80, 100), random.Random(3)
    texts = [" ".join(str(local.randrange(10**6)) for _ in range(3000)).encode() for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts, pa.binary())], names=["doc", "text"])

    def lists():
        return [[(x, sum(map(len, b.column(1).to_pylist())) // 8) for x in b.column(2).to_pylist()] for b in jaccard._lists([batch], rule, 0, 1)]

    whole = lists()
    monkeypatch.setattr(jaccard, "GATHER", 5000)
    parts = lists()
    assert len(whole) == 1 and len(parts) > 5 and max(n for b in parts for _, n in b) < 10_000
    assert sum(b[0][1] for b in whole) == sum(b[0][1] for b in parts)


def test_scans_of_short_texts_are_small():
    texts = [bytes(rng.randrange(97, 123) for _ in range(900)) * 10 for _ in range(100)]
    held = [(scan, text) for scan, text, _ in repeats.scans(texts, repeats.byte_values, 200, 32, repeats.Powers(10))]
    assert max(len(scan.owner) for scan, _ in held) < 120_000
    assert np.concatenate([text for _, text in held]).tolist() == list(range(100))


def test_hashes_of_every_gram():
    values = repeats.byte_values(bytes(rng.randrange(256) for _ in range(500)), None)
    powers = repeats.Powers(10)
    sums = powers.sums(values)
    for width in (1, 32, 500):
        at = np.arange(500 - width + 1)
        assert powers.every(sums, width).tolist() == powers.hash(sums, at, at + width).tolist()


@pytest.mark.parametrize("module, first, limits", [(suffix_dedup, "_runs", (200, 32)), (substring_dedup, "_paths", (13,))])
def test_repeats_work_on_slices_of_a_batch(module, first, limits, monkeypatch):
    n, local = 60, random.Random(5)
    texts = [" ".join(str(local.randrange(10**6)) for _ in range(300)).encode() for _ in range(n // 2)]
    texts += [t[:500] + b" " + t for t in texts]
    small = [zstandard.compress(t) for t in texts]
    held, scans = [], repeats.scans
    monkeypatch.setattr(repeats, "scans", lambda texts, *more: held.append(len(texts)) or scans(texts, *more))

    def work():
        held.clear()
        batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts, pa.binary())], names=["doc", "text"])
        found = {(r["doc"], r["name"]) for b in getattr(module, first)([batch], *limits) for r in b.to_pylist()}
        names = pa.array([sorted(x for d, x in found if d == doc)[:3] if doc % 3 else None for doc in range(n)], pa.list_(pa.int64()))
        none = pa.array([None] * n, pa.list_(pa.int64()))
        batch = pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary()), names, none, none, none], names=list("abcdef"))
        return found, [r for b in module._removed([batch], *limits) for r in b.to_pylist()], max(held)

    whole = work()
    monkeypatch.setattr(common, "SLICE", 5000)
    parts = work()
    assert whole[:2] == parts[:2] and sum(bool(r["starts"]) for r in whole[1]) == n * 2 // 3
    assert whole[2] == n and parts[2] < 10
