"""The pipeline against its stages done by hand on the small table."""

from collections import defaultdict

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from conftest import DATA
from tokenizers import Tokenizer

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def packed(spark):
    return corpus_pipeline.run(spark, DATA).collect()


def test_pipeline(spark, packed):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [(k, t) for k, t in docs if t and any(c.isalpha() for c in t)]
    groups = brute.groups(docs, 5, 80)
    docs = [(k, t) for (k, t), (_, n, c) in zip(docs, groups, strict=True) if not n or c == k]
    docs = [(k, t) for (k, t), h in zip(docs, brute.hits(docs, items), strict=True) if not h[5]]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [(k, *p) for k, t in docs for p in brute.pieces(library.encode(brute.redacted(t), add_special_tokens=False).ids)]
    assert sorted(tuple(r)[:5] for r in packed) == sorted(expected)
    used = defaultdict(list)
    for r in packed:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.filter("false"), DATA)
        assert empty.columns == docs.columns and empty.collect() == []
    odd = docs.limit(3).unionByName(docs.limit(1).selectExpr("doc_id", "CAST(NULL AS STRING) AS text", "CAST(NULL AS STRING) AS lang", "source", "n_chars"))
    out = odd
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, DATA)
    assert out.count() >= 1


def test_registered():
    names = set(entry.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
