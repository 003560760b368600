import pytest
from conftest import rows
from pyspark.sql import functions as F

from sheetflow.operators import keyed


@pytest.fixture
def many(spark):
    """A third of the rows share one key, a third has none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 10).cast("string")))
    return spark.range(3000).select(F.col("id").alias("_row"), key.alias("key"))


@pytest.mark.parametrize("spread", [1, 4])
def test_lookup(spark, many, spread):
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("no key 0", 3), (None, 4)], "key string, v int")
    got = keyed.lookup(many, right, "key", spread=spread)
    assert got.columns == ["_row", "key", "v"] and got.count() == 3000
    assert rows(got.groupBy("key").agg(F.max("v").alias("v"), F.count("v").alias("n")).filter("v IS NOT NULL"), "key", "v", "n") == [("hot", 1, 1000), ("k1", 2, 100)]
    inner = keyed.lookup(many, right, "key", "inner", spread)
    assert inner.count() == 1100


def test_lookup_by_number(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (0, "c")], "k long, x string")
    right = spark.createDataFrame([(i, i * 10) for i in range(1100)], "k long, y long")
    assert rows(keyed.lookup(left, right, "k"), "x", "y") == [("a", 10), ("b", None), ("c", 0)]


def test_null_keys_do_not_meet(spark, many):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.createDataFrame([("hot", 1)], "key string, v int")
        joined = keyed.lookup(many, right, "key")
        sizes = joined.filter("key IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None)], "k string, o int, v string")
    assert rows(keyed.first_seen(df, "k", ["o"])) == [("a", 1, "x"), ("b", 2, None)]
    assert rows(keyed.latest(df, "k", "o")) == [("a", 3, "y"), ("b", 2, None)]
    assert rows(keyed.latest(df, "k", "o", prefer=F.col("v") == "x")) == [("a", 1, "x"), ("b", 2, None)]
    assert rows(keyed.latest(df.select("k"), "k", [])) == [("a",), ("b",)]
    now = spark.createDataFrame([("a", 0, "n"), ("c", 0, "c")], "k string, o int, v string")
    assert rows(keyed.overlay(df, now, "k", "o")) == [("a", 0, "n"), ("b", 2, None), ("c", 0, "c")]


@pytest.mark.parametrize("policy, left", [("any", {"c"}), ("success", {"b", "c"})])
def test_pending(spark, policy, left):
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    log = spark.createDataFrame([(" a ", "success"), ("b", "failed"), ("a", "failed"), ("", "success"), (None, "success")], "key string, status string")
    got = {r.key for r in keyed.pending(tasks, log, "key", policy).collect()}
    assert got == left
    with pytest.raises(ValueError):
        keyed.pending(tasks, log, "key", "often")


def test_rows_done(spark):
    search = spark.createDataFrame(
        [("s", 1, "", "a", "b", ""), ("s", 2, "", "a", "c", ""), ("s", 2, "", "a", "", ""), ("s", 3, "HTTP", "a", "", ""), ("s", 4, None, "", None, ""), ("s", 5, "", "zz", "", ""), ("t", 1, "", "a", "", "x")],
        "sheet string, row int, search_error string, url1 string, url2 string, url3 string",
    )
    snaps = spark.createDataFrame([("a", "p", ""), ("b", "p", None), ("c", "p", "failed"), ("c", "", ""), ("zz", None, None)], "url string, snapshot_path string, snapshot_error string")
    assert rows(keyed.rows_done(search, snaps)) == [("s", 1), ("s", 2), ("s", 4)]


def test_extraction_status(spark):
    urls = spark.createDataFrame([("h1",), ("h2",), ("h3",)], "url_hash string")
    snaps, arts = urls.filter("url_hash <> 'h1'"), spark.createDataFrame([("h1", "regexp"), ("h2", "regexp")], "url_hash string, method string")

    def status(*args):
        return [r[1] for r in rows(keyed.extraction_status(urls, snaps, arts, *args))]

    assert status("auto") == ["no_snapshot", "already_extracted", "ready"]
    assert status("langextract") == ["no_snapshot", "ready", "ready"]
    assert status("auto", True) == ["no_snapshot", "ready", "ready"]
    with pytest.raises(ValueError):
        status("other")


def test_top_n(spark):
    df = spark.createDataFrame([("q", "2", 1), ("q", "x", 2), ("q", "1", 3), ("q", None, 4), ("r", "9", 5)], "query string, position string, _seq int")
    best = keyed.top_n(df.withColumn("_pos", keyed.position("position")), "query", ["_pos", "_seq"], 2)
    assert rows(best, "query", "_seq", "rank") == [("q", 2, 1), ("q", 4, 2), ("r", 5, 1)]


def test_found_rows(spark):
    df = spark.createDataFrame([("q ", "True", " u "), ("q", "false", "u"), ("", "true", "u"), ("q", "true", " ")], "query string, FOUND string, url string")
    assert rows(keyed.found_rows(df), "query", "url") == [("q", "u")]
    kept = keyed.exclude_urls(spark.createDataFrame([("http://a/x",), ("http://b/y",), (None,)], "url string"), r"a/.")
    assert rows(kept) == [("http://b/y",), (None,)]


@pytest.mark.parametrize("length", [1000, 7])
def test_joined_cells(spark, length):
    df = spark.range(300).select((F.col("id") % 2).alias("g"), F.concat(F.lit("v"), (F.col("id") % 30).cast("string")).alias("v"), F.col("id").alias("o"))
    cells = keyed.joined_cells(df, ["g"], "v", ["o"], ",", length=length).collect()
    for g in (0, 1):
        expected = [f"v{i}" for i in range(30) if i % 2 == g]
        texts = [r["text"].split(",") for r in cells if r["g"] == g]
        assert sorted(sum(texts, [])) == sorted(expected)
        assert all(t == [v for v in expected if v in t] for t in texts)
        assert (len(texts) == 1) == (length == 1000)


def test_joined_cells_kept_apart(spark):
    df = spark.createDataFrame([(None, "b", 1), (None, "a", 2), (None, "b", 3), ("x", None, 4)], "g string, v string, o int")
    assert rows(keyed.joined_cells(df, ["g"], "v", ["o"], ";")) == [("x", 0, ""), (None, 0, "b;a")]
    assert rows(keyed.joined_cells(df, ["g"], "v", ["o"], ";", apart=F.col("o")).filter("g IS NULL")) == [(None, 0, "b;a;b")]


@pytest.mark.parametrize("tied", [False, True])
def test_tasks_of_a_grouping_follow_its_rows(spark, monkeypatch, tied):
    """A task gets its share of the rows, however few partitions the session asks for; a frequent value and long groups stay whole."""
    monkeypatch.setattr(keyed, "ROWS_A_TASK", 100)
    number = F.when(F.col("id") % 2 == 0, 0).otherwise(F.floor(F.col("id") / 3))
    df = spark.range(0, 6000, 1, 3).select((F.col("id") % 3 % 2).alias("g"), F.lpad(number.cast("string"), 5, "0").alias("v")).withColumn("o", F.col("v"))
    assert keyed.tasks_for(df) == 60
    values = keyed.distinct_values(df, ["g"], "v", ["o"], tied=tied)
    expected = {g: sorted({f"{0 if i % 2 == 0 else i // 3:05d}" for i in range(6000) if i % 3 % 2 == g}) for g in (0, 1)}
    assert rows(values, "g", "v", "nth") == sorted(((g, v, n) for g, l in expected.items() for n, v in enumerate(l, 1)), key=repr)
    assert values.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0] < sum(map(len, expected.values())) / 4


def test_merge_values(one):
    assert one(keyed.merge_values(F.array(F.lit(" a"), F.lit(None), F.lit(""), F.lit("b"), F.lit("a\n")))) == "a;b"


def test_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (1, 1)], "a int, b int")
    with pytest.raises(ValueError, match=r"\(1, 1\)"):
        keyed.check_unique(df, ["a", "b"])
    keyed.check_unique(df.distinct(), ["a", "b"])
    assert rows(keyed.drop_null_keys(spark.createDataFrame([(None, None, 1), (None, 1, 2)], "a int, b int, c int"), ["a", "b"])) == [(None, 1, 2)]
    assert keyed.sample_head(df, 2).count() == 2
