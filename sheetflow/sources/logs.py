"""Append-only result logs and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetflow.sources.runlog import CSV, PLACE, RUN, SLICES, RunLog

# Log columns, and the types of those that are not text.
LOG_COLUMNS = {
    "search": [
        "row_number", "query", "search_time", "duration_ms", "FOUND", "ERROR", "number_of_results",
        "number_of_organic_results", "position", "url", "displayed_url", "description", "title", "domain",
    ],
    "extract": ["url_column", "row_number", "url", "ai_extract_rules", "extract_time", "duration_ms", "SUCCESS", "ERROR"],
    "keyword_search": [
        "sheet", "row", "keywords", "search_time", "search_duration_ms", "search_result_json", "search_error",
        "url1", "url2", "url3",
    ],
    "keyword_snapshot": [
        "url", "sheets", "rows", "keywords", "snapshot_path", "snapshot_error", "snapshot_time", "is_direct_download",
        "file_size_bytes",
    ],
    "snapshot_result": [
        "original_url", "source_sheet", "source_row", "source_column", "snapshot_status", "snapshot_image",
        "snapshot_html", "snapshot_time", "duration_ms", "image_size_bytes", "html_size_bytes", "error_message",
    ],
    "snapshot": ["url", "hash", "dom_size", "mhtml_size", "snapshot_time", "status", "error_type", "error_message"],
    "institution": [
        "hash", "url", "snapshot_time", "extract_time", "status", "institutions_count", "extract_method", "error_type",
        "error_message",
    ],
    "model_search": [
        "journal_name", "search_time", "status", "results_count", "prompt_tokens", "completion_tokens", "total_tokens",
        "cost", "elapsed_time", "error_type", "error_message", "results_json",
    ],
    "model_scan": [
        "journal_name", "url1", "url2", "scan_time", "status", "results_count", "prompt_tokens", "completion_tokens",
        "total_tokens", "cost", "elapsed_time", "error_type", "error_message", "results_json",
    ],
    "url_check": ["序号", "URL", "最终URL", "成功状态", "响应状态码", "响应体大小(KB)", "错误原因"],
    "lookup": ["input", "name", "user_id"],
}
LONGS = {
    "row_number", "row", "source_row", "duration_ms", "search_duration_ms", "file_size_bytes", "image_size_bytes",
    "html_size_bytes", "dom_size", "mhtml_size", "institutions_count", "results_count", "prompt_tokens",
    "completion_tokens", "total_tokens", "序号",
}
DOUBLES = {"cost", "elapsed_time", "响应体大小(KB)"}

BOM = "\ufeff"


def log_type(column: str) -> str:
    return "bigint" if column in LONGS else "double" if column in DOUBLES else "string"


def read_log(spark: SparkSession, path: str, kind: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A log with its extra columns kept, and ``_seq`` that orders the appends.

    Columns of the kind that a file lacks are added as nulls; numbers that do
    not parse become null. A text cell of a CSV file is "" where the file has
    nothing. A log of :func:`append_log` is read by its manifest and ordered by
    run and place; a plain folder of files is ordered by their times.
    """
    journal = RunLog(spark, path, fmt)
    if journal.exists():
        raw, seq = journal.rows(), F.struct(F.col(RUN).alias("run"), F.col(PLACE).alias("place"))
        return _typed(raw, seq, kind, fmt, (RUN, PLACE))
    where = ["_metadata.file_modification_time", "_metadata.file_name"]
    if fmt == "csv":
        raw = _read_csv(spark, path)
        where, place = ["_time", "_file"], F.col("_place")
    else:
        # appends may differ in their columns
        raw = spark.read.option("mergeSchema", "true").format(fmt).load(path)
        place = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
    seq = F.struct(F.col(where[0]).alias("time"), F.col(where[1]).alias("file"), place.alias("place"))
    return _typed(raw, seq, kind, fmt, ("_time", "_file", "_place") if fmt == "csv" else ())


def _typed(raw: DataFrame, seq, kind: str | None, fmt: str, inner: tuple[str, ...]) -> DataFrame:
    own = [c for c in raw.columns if c not in inner]
    names = list(dict.fromkeys([*(LOG_COLUMNS[kind] if kind else []), *own]))
    types = dict(raw.dtypes)
    fields = []
    for name in names:
        known = F.col(f"`{name}`") if name in types else F.lit(None).cast("string")
        if types.get(name, "string") == "string":
            wanted = log_type(name) if kind else "string"
            known = known.try_cast(wanted) if wanted != "string" else F.coalesce(known, F.lit("")) if fmt == "csv" else known
        fields.append(known.alias(name))
    return raw.select(*fields, seq.alias("_seq"))


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every file by its own header: files of equal header are read together, and columns meet by name.

    The driver reads the first line of each file, wherever Spark can read it; a
    header must not have line breaks.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    by_header: dict[str, list[str]] = {}
    for status in fs.globStatus(root) or []:
        listed = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        for f in listed:
            if f.isDirectory() or not f.getLen() or f.getPath().getName()[0] in "._":
                continue
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(f.getPath()), "UTF-8"))
            by_header.setdefault(reader.readLine(), []).append(f.getPath().toString())
            reader.close()
    if not by_header:
        by_header = {"": [path]}
    parts = []
    for _, files in sorted(by_header.items()):
        part = spark.read.options(**CSV).csv(files)
        meta = {"_time": F.col("_metadata.file_modification_time"), "_file": F.col("_metadata.file_name"), "_place": F.monotonically_increasing_id()}
        parts.append(part.withColumns(meta).withColumnsRenamed({c: c.lstrip(BOM) for c in part.columns}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows to a log as a new run; every CSV part carries its own header."""
    RunLog(df.sparkSession, path, fmt).append(df)


def adopt_log(spark: SparkSession, path: str, fmt: str = "parquet", key: str | None = None, slices: int = SLICES) -> None:
    """Make a plain folder of log files a log with run numbers: its rows become the first run, in the order of the files."""
    RunLog(spark, path, fmt).append(read_log(spark, path, fmt=fmt).orderBy("_seq"), key=key, slices=slices)


def compact_log(spark: SparkSession, path: str, key: str | None = None, fmt: str = "parquet", files: int | None = None, purge: bool = False) -> None:
    """Rewrite a log as one commit, with ``key`` only its last rows; see :meth:`RunLog.compact`."""
    RunLog(spark, path, fmt).compact(key, files, purge)


def write_csv_bom(df: DataFrame, path: str) -> None:
    """CSV whose parts start with a byte order mark, for spreadsheet programs."""
    first, *rest = df.columns
    df.toDF(BOM + first, *rest).write.mode("overwrite").options(**CSV).csv(path)


def write_report(sections: dict[str, DataFrame], path: str, always: tuple[str, ...] = (), fmt: str = "csv") -> list[str]:
    """One dataset per section; empty sections are left out.

    Sections named in ``always`` (a summary) go along with the others but do
    not count: when only they remain, nothing is written.
    """
    filled = [name for name, df in sections.items() if name not in always and not df.isEmpty()]
    if not filled:
        return []
    written = [name for name in sections if name in always or name in filled]
    for name in written:
        if fmt == "csv":
            write_csv_bom(sections[name], f"{path}/{name}")
        else:
            sections[name].write.mode("overwrite").format(fmt).save(f"{path}/{name}")
    return written
