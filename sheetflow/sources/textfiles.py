"""Text inputs: numbered lines, and blocks between two markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetflow.functions.strings import strip
from sheetflow.session import work_dir

# Markers of a command block.
BLOCK_START = "[CURL_START]"
BLOCK_END = "[CURL_END]"


def _pieces(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Records with their file and the start of their split."""
    return spark.read.options(**options).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"))


def _numbered(records: DataFrame) -> DataFrame:
    """Records of split files with ``seq``, their number in their file from 1, given where they are read.

    A task numbers its records one after the other. A first pass takes the
    first number and the count of each split; what is to be added to a split's
    numbers is a table of one row per split, which is all that is shuffled. It
    is written, so that its real size decides whether it is broadcast.
    """
    spark = records.sparkSession
    placed = records.withColumn("_at", F.monotonically_increasing_id())
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = placed.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    splits = splits.select("file", "_block", "_first", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    path = work_dir(spark, "splits")
    splits.write.parquet(path)
    known = spark.read.schema(splits.schema).parquet(path)
    inside = F.col("_at") - F.col("_first")
    changed = F.raise_error(F.concat(F.lit("the splits of the input changed between two reads: "), "file"))
    seq = F.when((inside >= 0) & (inside < F.col("_n")), F.col("_before") + inside + 1).otherwise(changed.cast("long"))
    return placed.join(known, ["file", "_block"], "left").withColumn("seq", seq).drop("_block", "_at", "_first", "_n", "_before")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, line): trimmed non-blank lines, numbered from 1 in each file.

    A file may be split: each split counts its own lines, the counts of the
    splits before it give the offset, so no task sees a whole file and no line
    is shuffled.
    """
    lines = _pieces(spark, path).withColumn("line", strip("value")).filter("line <> ''")
    return _numbered(lines.select("file", "_block", "line")).select("file", "seq", "line")


def read_blocks(spark: SparkSession, path: str, start: str = BLOCK_START, end: str = BLOCK_END) -> DataFrame:
    """(file, seq, block): text between the marker lines; unclosed blocks drop out.

    ``seq`` says at which start marker of the file the block begins, from 1. The
    start marker is the record separator, so large files split into many
    tasks. The marker must not occur inside other lines.
    """
    records = _numbered(_pieces(spark, path, lineSep=start))
    body = rf"(?s)^[ \t\r]*\n(.*?)(?<=\n)[ \t]*\Q{end}\E[ \t\r]*(?:\n|$)"
    return (
        # what stands before the first marker of a file is no block
        records.filter("seq > 1")
        .withColumn("block", F.regexp_extract("value", body, 1))
        .filter(F.trim("block") != "")
        .select("file", (F.col("seq") - 1).alias("seq"), "block")
    )


def read_hashed(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(url_hash, name, content): small files below hash-sharded folders.

    The two folder levels and the rest of the path together give the digest.
    """
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    path = F.col("_metadata.file_path")
    digest = F.concat(*[F.regexp_extract(path, "([0-9a-f]{2})/([0-9a-f]{2})/([0-9a-f]{36})/[^/]*$", i) for i in (1, 2, 3)])
    return files.select(digest.alias("url_hash"), F.regexp_extract(path, "([^/]*)$", 1).alias("name"), F.col("value").alias("content"))


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(url_hash, method, content) of the extraction results kept as one JSON file per URL and method."""
    found = read_hashed(spark, root, "host-*.json")
    return found.select("url_hash", F.regexp_extract("name", "^host-(.*)\\.json$", 1).alias("method"), "content")
