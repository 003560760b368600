import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sheetflow.operators.diff import SettledDiff, common_columns, diff
from sheetflow.sources.logs import read_log, write_report

STAFF = "`员工ID` int, `姓名` string, `部门` string, `薪水` int, `入职日期` string"
OLD = [(101, "甲", "A", 8000, "2020"), (102, "乙", "B", 15000, "2020"), (103, "丙", "A", 16000, "2020"), (104, "丁", "B", 7000, "2020")]
NEW = [(101, "甲", "A", 8500, "2020"), (102, "乙", "B", 15000, "2021"), (103, "丙", "A", 18000, "2020"), (105, "戊", "B", 9000, "2020")]


@pytest.fixture
def staff(spark):
    return diff(spark.createDataFrame(OLD, STAFF), spark.createDataFrame(NEW, STAFF), ["员工ID"], ["入职日期"])


def test_demo(staff):
    assert rows(staff.added, "员工ID") == [(105,)]
    assert rows(staff.deleted, "员工ID") == [(104,)]
    assert rows(staff.modified, "员工ID", "变化的列", "旧值", "新值") == [(101, "薪水", "8000", "8500"), (103, "薪水", "16000", "18000")]
    assert rows(staff.counts) == [(1, 1, 2)]
    lines = {r["项目"]: r["内容"] for r in staff.summary("a", "b", at="2024-01-01 00:00:00").collect()}
    assert lines["对比结果"] == "发现差异" and lines["修改行数"] == "2" and lines["唯一键"] == "员工ID" and lines["对比时间"] == "2024-01-01 00:00:00"


def test_report_leaves_out_empty_sections(spark, staff, tmp_path):
    path = str(tmp_path / "report")
    written = write_report(staff.report("old.xlsx", "new.xlsx"), path, always=("差异总览",))
    assert written == ["差异总览", "新增的行", "删除的行", "修改的详情"]
    back = read_log(spark, f"{path}/修改的详情", fmt="csv")
    assert rows(back, "员工ID", "变化的列", "旧值", "新值") == [("101", "薪水", "8000", "8500"), ("103", "薪水", "16000", "18000")]
    same = spark.createDataFrame(OLD, STAFF)
    assert write_report(diff(same, same, ["员工ID"]).report(), path + "2", always=("差异总览",)) == []


def test_duplicate_and_missing_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="not unique"):
        diff(a, a, ["k"])
    with pytest.raises(ValueError, match="lacks key columns"):
        diff(a, a, ["zzz"])


def test_nulls_blanks_and_types(spark):
    old = spark.createDataFrame([(1, None, 1, float("nan"), "nan"), (2, "", 1, 2.0, "a"), (3, "t", 7, None, None)], "k int, a string, n int, d double, t string")
    new = spark.createDataFrame([(1, "", "1", None, None), (2, "x", "2", 2.0, "a"), (3, "t", None, 1.5, "")], "k int, a string, n string, d double, t string")
    changed = rows(diff(old, new, ["k"]).modified, "k", "变化的列", "旧值", "新值")
    assert changed == [(1, "t", "nan", None), (2, "a", "", "x"), (2, "n", "1", "2"), (3, "d", None, "1.5"), (3, "n", "7", None)]


def test_null_key_parts_match(spark):
    schema = "a string, b int, v int"
    old = spark.createDataFrame([(None, 1, 1), ("x", None, 2), (None, None, 3), (None, None, 4)], schema)
    new = spark.createDataFrame([(None, 1, 9), ("x", None, 2), (None, None, 5)], schema)
    d = diff(old, new, ["a", "b"])
    assert rows(d.modified, "a", "b", "旧值", "新值") == [(None, 1, "1", "9")]
    assert rows(d.counts) == [(0, 0, 1)] and d.added.isEmpty() and d.deleted.isEmpty()


def test_one_sided_columns(spark):
    old, new = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int"), spark.createDataFrame([(1, 2, 4)], "k int, a int, c int")
    d = diff(old, new, ["k"])
    assert common_columns(old, new, ["k"]) == ["a"]
    assert d.modified.isEmpty() and (d.only_old, d.only_new) == (["b"], ["c"])
    none = diff(old.select("k", "b"), new.select("k", "c"), ["k"])
    assert none.modified.isEmpty() and rows(none.counts) == [(0, 0, 0)]


TABLE = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["", "p", None]), st.integers(0, 2)), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=TABLE, new=TABLE)
def test_against_dictionaries(spark, old, new):
    def frame(d):
        return spark.createDataFrame([(k, *v) for k, v in d.items()], "k int, s string, n int")

    d = diff(frame(old), frame(new), ["k"])
    both = old.keys() & new.keys()
    assert {r.k for r in d.added.collect()} == new.keys() - old.keys()
    assert {r.k for r in d.deleted.collect()} == old.keys() - new.keys()
    expected = {(k, "s") for k in both if (old[k][0] or "") != (new[k][0] or "")} | {(k, "n") for k in both if old[k][1] != new[k][1]}
    assert {(r["k"], r["变化的列"]) for r in d.modified.collect()} == expected
    assert rows(d.counts) == [(len(new.keys() - old.keys()), len(old.keys() - new.keys()), len({k for k, _ in expected}))]
    assert rows(diff(frame(old), frame(old), ["k"]).counts) == [(0, 0, 0)]


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3, 4]), st.sampled_from([None, "a", "b"]), st.sampled_from([None, "", "x", "y"])), max_size=9), st.integers(0, 9))
def test_settled_diff_is_the_same(spark, cells, cut):
    schema = "k int, l string, v string, w string"
    tables = [spark.createDataFrame([(*key, v, v) for key, v in {(k, g): v for k, g, v in part}.items()], schema) for part in (cells[:cut], cells[cut:])]
    d = diff(*tables, ["k", "l"], ["w"])
    one = d.settled()
    assert rows(one.added) == rows(d.added) and rows(one.deleted) == rows(d.deleted)
    assert rows(one.modified) == rows(d.modified) and rows(one.counts) == rows(d.counts)
    assert one.added.schema == d.added.schema and one.modified.columns == d.modified.columns


def test_settled_diff_of_unlike_types(spark):
    old = spark.createDataFrame([(1, float("nan"), {"a": 1}), (2, 2.0, None), (7, 0.0, None)], "k int, d double, m map<string,int>")
    new = spark.createDataFrame([("1", None, "x"), ("2", 2.5, "y"), ("z", 0.5, None)], "k string, d double, e string")
    d = diff(old, new, ["k"]).settled()
    assert rows(d.modified, "k", "变化的列", "旧值", "新值") == [(2, "d", "2.0", "2.5")]
    assert rows(d.added, "k", "e") == [("z", None)] and [r["k"] for r in d.deleted.collect()] == [7] and d.only_old == ["m"]


def test_settled_diff_checks_the_keys_in_its_pass(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string")
    b = a.dropDuplicates(["k"])
    with pytest.raises(ValueError, match=r"old table: key \['k'\] is not unique, for example \[\(1,\)\]"):
        diff(a, b, ["k"], verify=False).settled()
    with pytest.raises(ValueError, match="new table"):
        diff(b, a, ["k"], verify=False).report()


def test_a_report_takes_one_pass(spark, staff, monkeypatch):
    """One grouping of both tables, no join; every section is read from what it wrote."""
    made = []
    plain = SettledDiff._tagged
    monkeypatch.setattr(SettledDiff, "_tagged", lambda self: made.append(plain(self)) or made[-1])
    report = staff.report("a", "b")
    assert len(made) == 1
    text = final_plan(made[0])
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    for name, df in report.items():
        assert "FileScan parquet" in final_plan(df) and "Join" not in final_plan(df), name
    assert "PartitionFilters: [isnotnull(_kind" in final_plan(report["新增的行"])


def test_sections_are_in_order(spark):
    old = spark.createDataFrame([(i, "a", "b") for i in range(200)], "k int, v string, w string").repartition(7)
    new = spark.createDataFrame([(i, "x" if i % 2 else "a", "y") for i in range(50, 260)], "k int, v string, w string").repartition(5)
    sections = diff(old, new, ["k"]).settled().ordered()
    changed = [(r["k"], r["变化的列"]) for r in sections["修改的详情"].collect()]
    assert changed == [(k, c) for k in range(50, 200) for c in (["v", "w"] if k % 2 else ["w"])]
    assert [r["k"] for r in sections["新增的行"].collect()] == list(range(200, 260))
    assert [r["k"] for r in sections["删除的行"].collect()] == list(range(50))
