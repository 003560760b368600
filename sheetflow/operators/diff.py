"""Keyed comparison of two tables: added, deleted and changed cells, summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetflow.operators.keyed import drop_null_keys, duplicate_keys, quoted
from sheetflow.session import work_dir

# Report wording.
CHANGED_COLUMN, OLD_VALUE, NEW_VALUE = "变化的列", "旧值", "新值"
ITEM, CONTENT = "项目", "内容"
DIFFERENT, EQUAL = "发现差异", "数据完全一致"


def common_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> list[str]:
    """Columns of both tables in the old order, without keys and ignored ones."""
    skip = {*keys, *ignore}
    return [c for c in old.columns if c in new.columns and c not in skip]


def _comparable(c: Column, kind: T.DataType, as_text: bool) -> Column:
    """Null, NaN and '' compare as equal."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
    if as_text or isinstance(kind, T.StringType):
        c = F.nullif(c.cast("string"), F.lit(""))
    return c


CELL = f"array<struct<_col:int,`{CHANGED_COLUMN}`:string,`{OLD_VALUE}`:string,`{NEW_VALUE}`:string>>"


def _changes(cells: list[tuple[str, Column, Column, Column]]) -> Column:
    """The changed cells of a row, in the order of the columns."""
    entries = [
        F.when(
            changed,
            F.struct(
                F.lit(at).alias("_col"),
                F.lit(name).alias(CHANGED_COLUMN),
                o.cast("string").alias(OLD_VALUE),
                n.cast("string").alias(NEW_VALUE),
            ),
        )
        for at, (name, o, n, changed) in enumerate(cells)
    ]
    return F.array_compact(F.array(*entries)).cast(CELL)


class KeyedDiff:
    """The parts of a comparison, each a lazy DataFrame.

    A null key part matches another null; keys of unlike type match as text; rows whose key is null in every part
    are left out. Keys must be unique on both sides.
    """

    def __init__(self, old: DataFrame, new: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (), verify: bool = True):
        self.keys = list(keys)
        for label, df in (("old", old), ("new", new)):
            missing = [k for k in self.keys if k not in df.columns]
            if missing:
                raise ValueError(f"{label} table lacks key columns {missing}")
        self.old, self.new = drop_null_keys(old, self.keys), drop_null_keys(new, self.keys)
        self.columns = common_columns(old, new, self.keys, ignore)
        self.only_old = [c for c in old.columns if c not in new.columns]
        self.only_new = [c for c in new.columns if c not in old.columns]
        if verify:
            self._verify()

    def _verify(self) -> None:
        sides = [df.select(F.lit(label).alias("_side"), *[self._key(quoted(k), k).alias(k) for k in self.keys]) for label, df in (("old", self.old), ("new", self.new))]
        found = duplicate_keys(sides[0].unionByName(sides[1]), ["_side", *self.keys]).collect()
        if found:
            raise ValueError(f"key {self.keys} is not unique, for example {[tuple(r)[:-1] for r in found]}")

    def _key(self, c: Column, name: str) -> Column:
        """Keys of unlike type are compared as text."""
        alike = self.old.schema[name].dataType == self.new.schema[name].dataType
        return c if alike else c.cast("string")

    def _missing_in(self, a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = a.alias("a"), b.select(*[quoted(k) for k in self.keys]).alias("b")
        return a.join(b, reduce(lambda x, y: x & y, [self._key(F.col(f"a.`{k}`"), k).eqNullSafe(self._key(F.col(f"b.`{k}`"), k)) for k in self.keys]), "left_anti")

    @property
    def added(self) -> DataFrame:
        return self._missing_in(self.new, self.old)

    @property
    def deleted(self) -> DataFrame:
        return self._missing_in(self.old, self.new)

    def _paired(self, how: str) -> DataFrame:
        def side(df: DataFrame, tag: str) -> DataFrame:
            picked = [quoted(c).alias(f"{tag}{i}") for i, c in enumerate([*self.keys, *self.columns])]
            return df.select(*picked, F.lit(True).alias(f"{tag}_in"))

        a, b = side(self.old, "o"), side(self.new, "n")
        on = reduce(lambda x, y: x & y, [self._key(a[f"o{i}"], k).eqNullSafe(self._key(b[f"n{i}"], k)) for i, k in enumerate(self.keys)])
        return a.join(b, on, how)

    def _cells(self, old=lambda i, _: F.col(f"o{i}"), new=lambda i, _: F.col(f"n{i}")) -> list[tuple[str, Column, Column, Column]]:
        """(column, old, new, changed) for each compared column; ``old`` and ``new`` give a column by place and name."""
        cells = []
        for i, name in enumerate(self.columns, len(self.keys)):
            o, n = old(i, name), new(i, name)
            kinds = self.old.schema[name].dataType, self.new.schema[name].dataType
            as_text = kinds[0] != kinds[1]
            same = _comparable(o, kinds[0], as_text).eqNullSafe(_comparable(n, kinds[1], as_text))
            cells.append((name, o, n, ~same))
        return cells

    @property
    def modified(self) -> DataFrame:
        """One row per changed cell: keys, column, old and new text."""
        cells = self._cells()
        if not cells:
            empty = self.old.select(*[quoted(k) for k in self.keys]).limit(0)
            return empty.withColumns({c: F.lit("") for c in (CHANGED_COLUMN, OLD_VALUE, NEW_VALUE)}).withColumn("_col", F.lit(0))
        any_change = reduce(lambda x, y: x | y, [changed for *_, changed in cells])
        rows = self._paired("inner").filter(any_change)
        shown = rows.withColumn("_cell", F.explode(_changes(cells)))
        return shown.select(*[F.col(f"o{i}").alias(k) for i, k in enumerate(self.keys)], F.col("_cell.*"))

    @property
    def counts(self) -> DataFrame:
        """One row: added, deleted and modified rows, from a single outer join."""
        cells = self._cells()
        both = F.col("o_in") & F.col("n_in")
        any_change = reduce(lambda x, y: x | y, [changed for *_, changed in cells], F.lit(False))
        return self._paired("full_outer").agg(
            F.count_if(F.col("o_in").isNull()).alias("added"),
            F.count_if(F.col("n_in").isNull()).alias("deleted"),
            F.count_if(both & any_change).alias("modified"),
        )

    def summary(self, old_label: str = "old", new_label: str = "new", at: str | None = None) -> DataFrame:
        """(项目, 内容) lines of the report's first sheet."""
        one = self.counts
        differs = (F.col("added") + F.col("deleted") + F.col("modified")) > 0
        lines = [
            ("对比时间", F.lit(at)),
            ("文件1 (旧)", F.lit(old_label)),
            ("文件2 (新)", F.lit(new_label)),
            ("唯一键", F.lit(", ".join(self.keys))),
            ("对比结果", F.when(differs, DIFFERENT).otherwise(EQUAL)),
            ("新增行数", F.col("added").cast("string")),
            ("删除行数", F.col("deleted").cast("string")),
            ("修改行数", F.col("modified").cast("string")),
            ("仅旧表的列", F.lit(", ".join(self.only_old))),
            ("仅新表的列", F.lit(", ".join(self.only_new))),
        ]
        shown = [F.struct(F.lit(i).alias("_line"), F.lit(k).alias(ITEM), v.cast("string").alias(CONTENT)) for i, (k, v) in enumerate(lines) if not (k == "对比时间" and at is None)]
        return one.select(F.inline(F.array(*shown)))

    def ordered(self) -> dict[str, DataFrame]:
        """Report sections in reading order: by key, then by column."""
        keys = [quoted(k) for k in self.keys]
        changed = self.modified.orderBy(*keys, "_col").drop("_col")
        return {
            "新增的行": self.added.orderBy(*keys),
            "删除的行": self.deleted.orderBy(*keys),
            "修改的详情": changed,
        }

    def settled(self, path: str | None = None) -> SettledDiff:
        """The same comparison worked out in one pass and written; its parts are read back from there."""
        return SettledDiff(self, path or work_dir(self.old.sparkSession, "diff"))

    def report(self, old_label: str = "old", new_label: str = "new", at: str | None = None, path: str | None = None) -> dict[str, DataFrame]:
        """All sections, from one pass over both tables."""
        done = self.settled(path)
        overview = done.summary(old_label, new_label, at).orderBy("_line").drop("_line")
        return {"差异总览": overview, **done.ordered()}


ADDED, DELETED, MODIFIED, REPEATED = "added", "deleted", "modified", "repeated"


class SettledDiff(KeyedDiff):
    """A comparison written to a folder, one part of it for each kind of difference.

    Both tables are grouped by key together: a key of one side only is added
    or deleted, one of both sides is compared, and one that a side has twice
    is an error, found in the same pass. Nothing is joined, so that null keys
    need no care and a key that many rows repeat is counted before the shuffle.
    """

    def __init__(self, plain: KeyedDiff, path: str):
        self.keys, self.columns, self.only_old, self.only_new = plain.keys, plain.columns, plain.only_old, plain.only_new
        self.old, self.new, self.path = plain.old, plain.new, path
        tagged = self._tagged()
        tagged.write.partitionBy("_kind").parquet(path)
        self._parts = tagged.sparkSession.read.schema(tagged.schema).parquet(path)
        names = [f"k{i}" for i in range(len(self.keys))]
        for label in ("old", "new"):
            found = self._part(REPEATED).filter(F.col(f"_{label}s") > 1).select(*names).orderBy(*names).limit(5).collect()
            if found:
                raise ValueError(f"{label} table: key {self.keys} is not unique, for example {[tuple(r) for r in found]}")

    def _part(self, kind: str) -> DataFrame:
        return self._parts.filter(F.col("_kind") == kind)

    def _tagged(self) -> DataFrame:
        """One row per key that differs: its kind, the whole row where it is on one side only, else the changed cells."""

        def side(df: DataFrame, mine: str, other: str, missing: T.StructType) -> DataFrame:
            keys = [self._key(quoted(k), k).alias(f"k{i}") for i, k in enumerate(self.keys)]
            return df.select(*keys, F.struct(*[quoted(c) for c in df.columns]).alias(mine), F.lit(None).cast(missing).alias(other))

        both = side(self.old, "o", "n", self.new.schema).unionByName(side(self.new, "n", "o", self.old.schema))
        names = [f"k{i}" for i in range(len(self.keys))]
        one = both.groupBy(*names).agg(*[F.first(c, ignorenulls=True).alias(c) for c in "on"], F.count("o").alias("_olds"), F.count("n").alias("_news"))
        cells = self._cells(lambda _, c: F.col("o").getField(c), lambda _, c: F.col("n").getField(c))
        changes = _changes(cells) if cells else F.array().cast(CELL)
        kind = (
            F.when((F.col("_olds") > 1) | (F.col("_news") > 1), REPEATED)
            .when(F.col("_olds") == 0, ADDED)
            .when(F.col("_news") == 0, DELETED)
            .when(F.size("_cells") > 0, MODIFIED)
        )
        told = one.withColumn("_cells", F.when((F.col("_olds") > 0) & (F.col("_news") > 0), changes)).withColumn("_kind", kind).filter("_kind IS NOT NULL")
        single = {"o": DELETED, "n": ADDED}
        rows = [F.when(F.col("_kind") == k, F.col(c)).alias(c) for c, k in single.items()]
        shown = [F.when(F.col("_kind") == MODIFIED, F.col("o").getField(k)).alias(f"_old{i}") for i, k in enumerate(self.keys)]
        return told.select(*names, *shown, *rows, "_cells", "_olds", "_news", "_kind")

    @property
    def added(self) -> DataFrame:
        return self._part(ADDED).select("n.*")

    @property
    def deleted(self) -> DataFrame:
        return self._part(DELETED).select("o.*")

    @property
    def modified(self) -> DataFrame:
        return self._part(MODIFIED).select(*[F.col(f"_old{i}").alias(k) for i, k in enumerate(self.keys)], F.inline("_cells"))

    @property
    def counts(self) -> DataFrame:
        """One row: added, deleted and modified rows, counted where they are written."""
        return self._parts.agg(*[F.count_if(F.col("_kind") == k).alias(k) for k in (ADDED, DELETED, MODIFIED)])

    def settled(self, path: str | None = None) -> SettledDiff:
        return self


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], ignore: Sequence[str] = (), verify: bool = True) -> KeyedDiff:
    """A lazy comparison; ``verify`` looks for repeated keys at once. :meth:`KeyedDiff.settled` does both in one pass."""
    return KeyedDiff(old, new, keys, ignore, verify)
