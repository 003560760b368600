"""Secret scan over an incremental ledger of blobs.

Every version of a text is addressed by the digest of its content. A ledger in
the shared folder records which rule version has seen which blob, and what it
found. Only unseen pairs are scanned; findings join back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.llm.common import apart
from sheetflow.operators.keyed import quoted
from sheetflow.session import work_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` that ``keep`` accepts."""

    kind: str
    pattern: str
    keep: Callable[[re.Match], bool]
    mark: str  # characters of which one must occur, checked first
    flags: int = re.ASCII
    version: int = 1


# The patterns and least lengths of the three kinds, in their order.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
        ":=",
        re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20, "A"),
    # a run as long as this is found at its own start, shorter ones need no visit
    Rule("hex", r"[0-9a-f]{24,}", lambda m: True, "0123456789abcdef"),
)

SPAN = "struct<kind:string,start:int,stop:int>"
FOUND = f"digest binary, kind string, version int, spans array<{SPAN}>"


def digests(versions: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and content address of every row; a null text has that of the empty one."""
    return versions.select(quoted(key).alias(key), _address(quoted(text)).alias("digest"))


def _address(text):
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def scan_unseen(versions: DataFrame, ledger: str, text: str = "text", rules=RULES) -> None:
    """Scan the blobs of ``versions`` that the ledger lacks for a rule's version, and append what was found.

    One row per (blob, rule, version), also where nothing was found. A blob's
    text is shuffled once, as one copy per task that holds it. A failed run
    appends nothing; running again scans the same pairs.
    """
    blobs = versions.select(_address(quoted(text)).alias("digest"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    known = ledger_rows(versions.sparkSession, ledger)
    wanted = [(r.kind, r.version) for r in rules]
    if known is not None:
        pairs = F.struct("kind", F.col("version"))
        seen = known.filter(F.concat_ws(":", "kind", "version").isin([f"{k}:{v}" for k, v in wanted]))
        seen = seen.groupBy("digest").agg(F.collect_set(pairs).alias("seen"))
        blobs = blobs.join(seen, "digest", "left").filter(F.coalesce(F.size("seen"), F.lit(0)) < len(wanted))
    else:
        blobs = blobs.withColumn("seen", F.lit(None).cast("array<struct<kind:string,version:int>>"))
    each = blobs.groupBy("digest").agg(F.first("text").alias("text"), F.first("seen").alias("seen"))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        compiled = [(r, re.compile(r.pattern, r.flags)) for r in rules]
        for b in batches:
            out: list[tuple] = []
            for digest, t, seen in zip(*(c.to_pylist() for c in b.columns), strict=True):
                done = {(s["kind"], s["version"]) for s in seen or ()}
                for rule, pattern in compiled:
                    if (rule.kind, rule.version) not in done:
                        out.append((digest, rule.kind, rule.version, find(rule, pattern, t)))
            if out:
                columns = list(zip(*out, strict=True))
                types = [pa.binary(), pa.string(), pa.int32(), pa.list_(kind)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["digest", "kind", "version", "spans"])

    each.mapInArrow(run, FOUND).write.mode("append").parquet(ledger)


def find(rule: Rule, pattern: re.Pattern, text: str) -> list[dict]:
    if not any(c in text for c in rule.mark):
        return []
    return [{"kind": rule.kind, "start": m.start(), "stop": m.end()} for m in pattern.finditer(text) if rule.keep(m)]


def ledger_rows(spark, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None before its first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(FOUND).parquet(ledger)


def found_by_blob(versions: DataFrame, text: str = "text", rules=RULES, ledger: str | None = None) -> DataFrame:
    """digest and spans (kind, start, stop in code points, by start and then rule order) of every blob with a finding.

    ``ledger`` names the ledger's folder; without one, the run starts an empty
    one in the shared folder.
    """
    spark = versions.sparkSession
    ledger = ledger or work_dir(spark, "ledger")
    scan_unseen(versions, ledger, text, rules)
    wanted = [f"{r.kind}:{r.version}" for r in rules]
    found = ledger_rows(spark, ledger).filter(F.concat_ws(":", "kind", "version").isin(wanted) & (F.size("spans") > 0))
    # one row per blob and rule, more only if runs overlapped; no group is larger than the rule set
    found = found.dropDuplicates(["digest", "kind", "version"]).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("found"))
    number = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    places = F.transform("found", lambda s: F.struct(s["start"].alias("start"), number[s["kind"]].alias("n"), s.alias("s")))
    return found.select("digest", F.transform(F.array_sort(places), lambda s: s["s"]).alias("spans"))


def secret_spans(
    versions: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES, ledger: str | None = None
) -> DataFrame:
    """Key and spans of every row; see ``found_by_blob``.

    Null text counts as empty. Each row of ``versions`` gives one row, also
    rows of equal key or text; other columns are ignored.
    """
    found = found_by_blob(versions, text, rules, ledger)
    none = F.array().cast(f"array<{SPAN}>")
    return digests(versions, key, text).join(found, "digest", "left").select(key, F.coalesce("spans", none).alias("spans"))


def redacted(docs: DataFrame, text: str = "text", length: str | None = None, mark: str = "[secret]", rules=RULES, ledger: str | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans are replaced as one.

    Rows without a secret stay as they are. ``length`` names a column that
    holds the text's number of characters; it follows the text.
    """
    found = found_by_blob(docs, text, rules, ledger)
    at, where = apart(docs, "_digest"), apart(docs, "_spans")
    found = found.select(F.col("digest").alias(at), F.transform("spans", lambda s: F.struct(s["start"].alias("b"), s["stop"].alias("e"))).alias(where))
    body = quoted(text).cast("string")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a, s):
        new = F.concat(a["out"], F.substring(body, a["at"] + 1, s["b"] - a["at"]), F.lit(mark))
        out = F.when(s["b"] >= a["at"], new).otherwise(a["out"])
        return F.struct(out.alias("out"), F.greatest(a["at"], s["e"]).alias("at"))

    done = F.aggregate(F.array_sort(where), start, step, lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.char_length(body))))
    joined = docs.withColumn(at, _address(quoted(text))).join(found, at, "left")
    new = joined.withColumn(text, F.when(F.col(where).isNotNull(), done).otherwise(quoted(text)))
    if length:
        kind = docs.schema[length].dataType
        new = new.withColumn(length, F.when(F.col(where).isNotNull(), F.char_length(quoted(text)).cast(kind)).otherwise(quoted(length)))
    return new.select(*[quoted(c) for c in docs.columns])
