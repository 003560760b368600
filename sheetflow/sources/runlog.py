"""Append-only logs with run numbers: rows in folders, and a manifest line for each folder that counts.

    <log>/rows/<run>-<wave>-<token>/[_slice=<n>/]part-…   rows, with their run and place
    <log>/commits/<run>-<wave>-<token>.json               what was committed, and its columns

Rows count once their manifest line stands there, so a reader never sees half
of an append and a failed one leaves nothing behind that counts. Run and place
are columns of the rows: the order of a log does not rest on file times or
names, and survives copies and compaction. The line also names the columns, so
that no file is opened to learn them, and the slices of keys that the folder
holds, so that a reader who wants some keys reads their slices only. One run
writes at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetflow.functions.strings import strip

# Columns that a log adds to its rows.
RUN, PLACE, SLICE = "_run", "_place", "_slice"
# Parts of the key space, by hash.
SLICES = 64

CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
    "nullValue": "",
}


def slice_of(key: Column, slices: int = SLICES) -> Column:
    """Slice of a key; equal keys have equal slices, whatever blanks stand around them."""
    return F.pmod(F.xxhash64(strip(key)), F.lit(slices)).cast("int")


@dataclass(frozen=True)
class Commit:
    """One manifest line. ``slices`` is None where the rows are not laid out by slice."""

    name: str
    run: int
    wave: int
    fmt: str
    schema: str
    key: str | None = None
    of: int | None = None
    slices: list[int] | None = None
    replaces: list[str] = field(default_factory=list)


class RunLog:
    """A log below ``path``. Reading and listing go through the file system that Spark reads with."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    # -- files ----------------------------------------------------------------

    def _at(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _names(self, path: str) -> list[str]:
        fs, target = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def _commit(self, commit: Commit) -> None:
        """The line appears under its name in one step."""
        fs, unfinished = self._at(f"{self.path}/commits/.{commit.name}")
        out = fs.create(unfinished)
        out.write(bytearray(json.dumps(asdict(commit)).encode()))
        out.close()
        if not fs.rename(unfinished, self._at(f"{self.path}/commits/{commit.name}.json")[1]):
            raise OSError(f"could not commit {commit.name}")

    def exists(self) -> bool:
        """Whether something was ever committed; an unfinished line is no commit."""
        return any(n.endswith(".json") for n in self._names(f"{self.path}/commits"))

    def is_plain(self) -> bool:
        """A folder with files of its own and no manifest."""
        return not self.exists() and any(n[0] not in "._" and n not in ("rows", "commits") for n in self._names(self.path))

    def commits(self) -> list[Commit]:
        """The lines that count, in order; those that a compaction replaced do not."""
        if not self.exists():
            return []
        lines = self.spark.read.text(f"{self.path}/commits/*.json").collect()
        found = sorted((Commit(**json.loads(r["value"])) for r in lines), key=lambda c: c.name)
        gone = {name for c in found for name in c.replaces}
        return [c for c in found if c.name not in gone]

    def next_run(self) -> int:
        return max((c.run for c in self.commits()), default=0) + 1

    # -- writing --------------------------------------------------------------

    def append(
        self, df: DataFrame, run: int | None = None, wave: int = 0, key: str | None = None, slices: int = SLICES, replaces: Sequence[str] = (), stamped: bool = False
    ) -> Commit | None:
        """Write the rows, then commit them.

        With ``key`` they are laid out by the slices of that column. Without
        rows there is nothing to commit, but for the first commit, which gives
        the log its columns. ``stamped`` rows have their run and place already.
        """
        known = self.commits()
        run = run or max((c.run for c in known), default=0) + 1
        rows = df.drop("_seq")
        if not stamped:
            rows = rows.drop(RUN, PLACE).withColumns({RUN: F.lit(run).cast("long"), PLACE: F.monotonically_increasing_id()})
        if self.fmt == "csv":
            rows = rows.select(*[F.col(f"`{c}`").cast("string") for c in rows.columns])
        name = f"{run:08d}-{wave:05d}-{uuid.uuid4().hex[:12]}"
        place, schema = f"{self.path}/rows/{name}", rows.schema.json()
        laid = rows if key is None else rows.withColumn(SLICE, slice_of(F.col(f"`{key}`"), slices))
        writer = laid.write.mode("append").options(**(CSV if self.fmt == "csv" else {}))
        (writer if key is None else writer.partitionBy(SLICE)).format(self.fmt).save(place)
        found = None if key is None else sorted(int(n.split("=")[1]) for n in self._names(place) if n.startswith(f"{SLICE}="))
        if found == [] and known:
            self._delete(place)
            return None
        commit = Commit(name, run, wave, self.fmt, schema, key, None if key is None else slices, found, list(replaces))
        self._commit(commit)
        return commit

    # -- reading --------------------------------------------------------------

    def paths(self, commit: Commit, key: str | None = None, slices: Iterable[int] | None = None, of: int = SLICES) -> list[str]:
        """Folders of a commit that can hold the wanted slices; all of it, where it is laid out otherwise."""
        place = f"{self.path}/rows/{commit.name}"
        if commit.slices is None or slices is None or (commit.key, commit.of) != (key, of):
            return [] if commit.slices == [] else [place]
        return [f"{place}/{SLICE}={n}" for n in sorted(set(slices) & set(commit.slices))]

    def rows(self, key: str | None = None, slices: Iterable[int] | None = None, of: int = SLICES) -> DataFrame:
        """All rows with their run and place, or those in the slices of ``key``; columns meet by name.

        A column that has another type in a later append is read as text.
        """
        wanted = None if slices is None else list(slices)
        groups: dict[tuple[str, str], list[str]] = {}
        for c in self.commits():
            groups.setdefault((c.schema, c.fmt), []).extend(self.paths(c, key, wanted, of))
        if not groups:
            raise ValueError(f"{self.path} is not a log, or has no commit yet")
        parts = []
        for (schema, fmt), paths in groups.items():
            kind = T.StructType.fromJson(json.loads(schema))
            reader = self.spark.read.schema(kind).options(recursiveFileLookup="true", **(CSV if fmt == "csv" else {}))
            part = reader.format(fmt).load(paths) if paths else self.spark.createDataFrame([], kind)
            parts.append(part.withColumns({c: F.col(c).cast("long") for c in (RUN, PLACE)}))
        kinds: dict[str, set[str]] = {}
        for part in parts:
            for name, kind in part.dtypes:
                kinds.setdefault(name, set()).add(kind)
        mixed = {name for name, found in kinds.items() if len(found) > 1}
        out = None
        for part in parts:
            even = part.withColumns({c: F.col(f"`{c}`").cast("string") for c in part.columns if c in mixed})
            out = even if out is None else out.unionByName(even, allowMissingColumns=True)
        return out

    def compact(self, key: str | None = None, files: int | None = None, purge: bool = False) -> Commit | None:
        """Rewrite the log as one commit, with ``key`` only the last row of each key, in as many files a slice as tasks hold it.

        Rows keep their run and place. The old rows stop counting when the new
        ones are committed; ``purge`` also removes their files, which readers
        that began before may still need.
        """
        old = self.commits()
        if not old:
            return None
        rows = self.rows()
        laid = {(c.key, c.of) for c in old}
        by, of = laid.pop() if len(laid) == 1 else (None, None)
        if key is not None:
            last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(RUN, PLACE))
            rows = rows.groupBy(strip(F.col(f"`{key}`")).alias("_k")).agg(last.alias("_r")).select("_r.*")
        if files:
            rows = rows.repartition(files, slice_of(F.col(f"`{by}`"), of)) if by else rows.repartition(files)
        done = self.append(rows, max(c.run for c in old), 0, by, of or SLICES, [c.name for c in old], stamped=True)
        if purge and done is not None:
            for c in old:
                self._delete(f"{self.path}/commits/{c.name}.json")
                self._delete(f"{self.path}/rows/{c.name}")
        return done
