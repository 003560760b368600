"""Joining logs back to the sheet: wide results, statuses, report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetflow.functions.jsontext import is_json, is_json_array, is_json_object, json_items
from sheetflow.functions.links import is_http
from sheetflow.functions.strings import build_keywords, cell, filled, non_empty, prefix_path, render_template, sha1_hex, strip
from sheetflow.operators.grid import method_set, require_columns, resolve_column
from sheetflow.operators.keyed import distinct_values, exclude_urls, found_rows, joined_cells, latest, lookup, merge_values, names, position, quoted, successful, top_n

# Report wording.
NO_MATCH, CALL_FAILED = "【无匹配】", "【调用失败】"
NO_URL, NO_INSTITUTION, DONE = "无URL", "无匹配", "成功"
WAIT_SNAPSHOT, SNAPSHOT_FAILED = "待快照", "快照失败"
WAIT_EXTRACT, EXTRACT_FAILED, DATA_MISSING = "待提取", "提取失败", "数据缺失"
NOTHING_FOUND, NO_RESULT, NOT_YET = "搜索无结果", "搜索成功但无结果", "尚未快照"
PENDING_NOTE, UNKNOWN = "待处理", "未知"

# Keyword columns of the comparison report, in order.
KEYWORD_COLUMNS = [
    "On behalf of",
    "journal of",
    "publication of",
    "Affiliate",
    "Edited",
    "Own",
    "In association with",
    "responsible",
    "supervise",
    "sponsor",
    "Patronage",
    "Compile",
    "partnership",
    "Societies",
    "In cooperation with",
    "The backing of",
    "administrated",
    "Copyright ©",
    "©",
    "Press",
    "Funded",
]
OTHER = "其他"

# Item fields of the two model reports.
SEARCH_FIELDS = ["期刊名称", "主办单位", "关键句子", "判断依据", "来源链接"]
SCAN_FIELDS = ["期刊名称", "关联单位", "关键句子", "信息位置", "来源链接1", "来源链接2"]

# Accepted names of the sheet's columns.
ALIASES = {
    "name": ["期刊名称", "Journal Name", "刊名"],
    "intro": ["期刊官方简介链接", "简介链接"],
    "home": ["期刊主页链接", "主页链接"],
    "host": ["主办单位官方链接", "主办链接"],
    "manual_unit": ["人工判断单位", "人工单位"],
    "manual_sentence": ["人工判断关键语句", "人工语句", "关键语句"],
}

EXTRACT_BASE = ["url", "url_column", "row_number", "ai_extract_rules", "extract_time", "duration_ms", "SUCCESS", "ERROR", "_seq"]


# -- reshape ------------------------------------------------------------------


def unpivot_urls(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("_row",), http_only: bool = False) -> DataFrame:
    """(ids, column, url): one row per filled URL cell."""
    require_columns(df, columns)
    cells = df.select(*[quoted(c) for c in ids], *[filled(quoted(c)).alias(c) for c in columns])
    long = cells.unpivot(list(ids), list(columns), "column", "url").filter("url IS NOT NULL")
    return long.filter(is_http("url")) if http_only else long


def url_order(columns: Sequence[str]) -> Column:
    """Place of the ``column`` value among the sheet's URL columns."""
    return F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))


def parse_outputs(spec: str) -> list[tuple[str, str]]:
    """``"链接:url,域名:domain"`` as (output name, log field) pairs."""
    pairs = []
    for item in filter(None, (p.strip() for p in spec.split(","))):
        out, colon, field = item.partition(":")
        if not (colon and out.strip() and field.strip()):
            raise ValueError(f"bad column mapping {item!r}; use name:field")
        pairs.append((out.strip(), field.strip()))
    if not pairs:
        raise ValueError("no columns given")
    return pairs


def widen_topn(df: DataFrame, by: str | Sequence[str], n: int, outputs: Sequence[tuple[str, str]], rank: str = "rank") -> DataFrame:
    """``name1, other1, name2, other2, …`` per key from ranked rows; blanks become null."""
    keys = [by] if isinstance(by, str) else list(by)
    wide = [
        F.max(F.when(F.col(rank) == i, F.nullif(quoted(field).cast("string"), F.lit("")))).alias(f"{out}{i}")
        for i in range(1, n + 1)
        for out, field in outputs
    ]
    return df.groupBy(*[quoted(k) for k in keys]).agg(*wide)


def place_columns(columns: Sequence[str], url_columns: Sequence[str], fields: Sequence[str], mode: str = "after_url") -> list[str]:
    """Column order with each result column after its URL column, or all at the end."""
    if mode == "append":
        return [*columns, *[f"{u}-{f}" for u in url_columns for f in fields]]
    if mode != "after_url":
        raise ValueError(f"unknown placement {mode!r}")
    placed = []
    for c in columns:
        placed.append(c)
        if c in url_columns:
            placed.extend(f"{c}-{f}" for f in fields)
    return placed


# -- search and extract reports ----------------------------------------------


def search_results(log: DataFrame, n: int, exclude: str | None = None) -> DataFrame:
    """Best ``n`` results per query; excluded URLs do not use up a place."""
    kept = exclude_urls(found_rows(log), exclude).withColumn("_pos", position("position"))
    return top_n(kept, "query", ["_pos", "_seq"], n)


def assemble_search(
    df: DataFrame, log: DataFrame, template: str, columns: str, n: int = 1, exclude: str | None = None, spread: int = 1
) -> DataFrame:
    """The sheet with the top results of its rendered query as new columns."""
    wide = widen_topn(search_results(log, n, exclude), "query", n, parse_outputs(columns)).withColumnRenamed("query", "_query")
    asked = df.withColumn("_query", F.nullif(render_template(template, df.columns), F.lit("")))
    return lookup(asked, wide, "_query", spread=spread).drop("_query")


def result_fields(log: DataFrame) -> list[str]:
    """Rule columns of an extract log: all but the fixed ones."""
    return [c for c in log.columns if c not in EXTRACT_BASE]


def assemble_extract(
    df: DataFrame, log: DataFrame, url_columns: Sequence[str], mode: str = "after_url", row: str | Sequence[str] = "_row", spread: int = 1
) -> DataFrame:
    """The sheet with the extracted fields of each URL column.

    All URL columns go through one narrow join; the wide sheet is shuffled
    once, by row, however many URL columns there are. ``row`` names the column,
    or the columns (file, sheet and row), that tell the rows apart.
    """
    fields = result_fields(log)
    good = successful(log, "SUCCESS", "true").filter(non_empty("url"))
    known = latest(good.select(strip("url").alias("url"), *[quoted(f) for f in fields], "_seq"), "url").drop("_seq")
    rows = names(row)
    hits = lookup(unpivot_urls(df, url_columns, rows), known, "url", "inner", spread)
    wide = [
        F.max(F.when(F.col("column") == u, quoted(f))).alias(f"{u}-{f}")
        for u in url_columns
        for f in fields
    ]
    per_row = hits.groupBy(*[quoted(r) for r in rows]).agg(*wide)
    order = place_columns(df.columns, url_columns, fields, mode)
    return df.join(per_row, rows, "left").select(*[quoted(c) for c in order])


def explode_search(df: DataFrame, payload: str = "payload", error: str = "error", n: int = 0) -> DataFrame:
    """Search replies as log rows: an error row, a no-result row, or one row per result."""
    text = quoted(payload)
    meta = F.from_json(F.get_json_object(text, "$.meta_data"), "map<string,string>")
    results = F.from_json(F.get_json_object(text, "$.organic_results"), "array<map<string,string>>")
    if n > 0:
        results = F.slice(results, 1, n)
    failed = filled(quoted(error)).isNotNull()
    kept = df.drop(payload, error).columns
    rows = df.select(
        *[quoted(c) for c in kept],
        F.when(failed, quoted(error)).otherwise("").alias("ERROR"),
        *[F.when(failed, "").otherwise(F.coalesce(meta[m], F.lit("0"))).alias(m) for m in ("number_of_results", "number_of_organic_results")],
        F.posexplode_outer(F.when(~failed, results)).alias("_at", "_item"),
    )
    item = F.col("_item")
    fields = ["position", "url", "displayed_url", "description", "title", "domain"]
    return rows.select(
        *[quoted(c) for c in kept],
        F.when(item.isNotNull(), "true").otherwise("false").alias("FOUND"),
        "ERROR",
        "number_of_results",
        "number_of_organic_results",
        *[F.coalesce(F.try_element_at(item, F.lit(f)), F.lit("")).alias(f) for f in fields],
        "_at",
    )


# -- keyword search with page pictures ---------------------------------------


def snapshot_status(expected: Column, tries: Column) -> Column:
    """``struct<status, errors>`` from up to three (url, path, error) entries."""
    looked_at = F.filter(F.slice(tries, F.lit(1), F.greatest(expected, F.lit(0))), lambda t: cell(t["url"]) != "")
    good = lambda t: (cell(t["path"]) != "") & (cell(t["error"]) == "")
    lines = F.transform(
        F.filter(looked_at, lambda t: ~good(t)),
        lambda t: F.concat(t["url"], F.lit(": "), F.coalesce(F.nullif(cell(t["error"]), F.lit("")), F.lit(NOT_YET))),
    )
    count = F.size(F.filter(looked_at, good))
    nothing = expected == 0
    return F.struct(
        F.when(nothing, "0/0").otherwise(F.concat_ws("/", count.cast("string"), expected.cast("string"))).alias("status"),
        F.when(nothing, NOTHING_FOUND).otherwise(F.array_join(lines, "\n")).alias("errors"),
    )


def search_snapshots(search_log: DataFrame, snapshot_log: DataFrame, sheet: str | None = None, prefix: str = "") -> DataFrame:
    """One row per keyword text: search outcome, snapshot status, links and paths."""
    rows = search_log.filter(non_empty("keywords")).withColumn("keywords", strip("keywords"))
    if sheet is not None:
        rows = rows.filter(F.col("sheet") == sheet)
    urls = ["url1", "url2", "url3"]
    shown_columns = ["keywords", "search_time", "search_duration_ms", "search_result_json", "search_error", *urls]
    last = latest(rows.select(*shown_columns, "_seq"), "keywords").drop("_seq")
    long = last.select("keywords", F.posexplode(F.array(*urls)).alias("_at", "url")).filter(non_empty("url"))
    shots = latest(snapshot_log.filter(non_empty("url")).select("url", "snapshot_path", "snapshot_error", "_seq"), "url").drop("_seq")
    tried = lookup(long, shots, "url")
    slots = [
        F.max(F.when(F.col("_at") == i, F.struct(F.col("url"), F.col("snapshot_path").alias("path"), F.col("snapshot_error").alias("error")))).alias(f"_t{i}")
        for i in range(3)
    ]
    merged = last.join(tried.groupBy("keywords").agg(*slots), "keywords", "left")
    results = F.col("search_result_json")
    count = F.when(is_json_array(results), F.json_array_length(results)).otherwise(0)
    expected = F.least(F.coalesce(count, F.lit(0)), F.lit(3))
    tries = F.array(*[F.coalesce(F.col(f"_t{i}"), F.struct(F.lit("").alias("url"), F.lit("").alias("path"), F.lit("").alias("error"))) for i in range(3)])
    no_error = cell("search_error") == ""
    shown = F.when(no_error & (cell(results) == ""), NO_RESULT).otherwise(F.col("search_error"))
    out = merged.withColumn("_s", snapshot_status(expected, tries))
    links = []
    for i in range(3):
        links.append(F.nullif(F.col(f"url{i + 1}"), F.lit("")).alias(f"链接{i + 1}"))
        links.append(prefix_path(prefix, F.col(f"_t{i}.path")).alias(f"快照{i + 1}"))
    return out.select(
        F.col("keywords").alias("关键词"),
        F.col("search_time").alias("搜索时间"),
        F.col("search_duration_ms").alias("搜索耗时"),
        results.alias("搜索结果"),
        shown.alias("搜索错误"),
        F.col("_s.status").alias("快照状态"),
        F.col("_s.errors").alias("快照错误"),
        *links,
    )


def assemble_snapshots(
    df: DataFrame, search_log: DataFrame, snapshot_log: DataFrame, keywords: str, sheet: str | None = None, prefix: str = "", row: str = "_row", spread: int = 1
) -> DataFrame:
    """The sheet with search and snapshot columns; status is worked out once per keyword text."""
    found = search_snapshots(search_log, snapshot_log, sheet, prefix).withColumnRenamed("关键词", "_kw")
    asked = df.withColumn("原始行号", F.col(row)).withColumn("_kw", F.nullif(build_keywords(keywords, [c for c in df.columns if c != row]), F.lit("")))
    joined = lookup(asked, found.withColumn("关键词", F.col("_kw")), "_kw", spread=spread).drop("_kw")
    added = [c for c in found.columns if c != "_kw"]
    return joined.select(*[quoted(c) for c in df.columns], "原始行号", "关键词", *added)


# -- extracted institutions ---------------------------------------------------


def load_artifacts(artifacts: DataFrame, priority: Sequence[str] = ("langextract", "regexp"), item_type: str | None = None) -> DataFrame:
    """(url_hash, items, method): the best readable artefact per URL.

    ``artifacts`` has url_hash, method and the JSON ``content``; content that
    does not parse falls through to the next method. Of several of one URL and
    method the last by ``_seq`` counts, where there is that column; else one
    that does not depend on the order of the rows.
    """
    from sheetflow.functions.institutions import INSTITUTION

    items = F.from_json(F.get_json_object("content", "$.host_institutions"), f"array<{item_type or INSTITUTION}>")
    order = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("method"))
    place = [F.col("_seq")] if "_seq" in artifacts.columns else []
    readable = (
        artifacts.filter(F.col("method").isin(*priority) & is_json_object("content"))
        .select("url_hash", F.coalesce(items, F.array().cast(f"array<{item_type or INSTITUTION}>")).alias("items"), "method", F.struct(-order, *place, F.xxhash64("content")).alias("_rank"))
    )
    best = F.max_by(F.struct("items", "method"), "_rank")
    return readable.groupBy("url_hash").agg(best.alias("b")).select("url_hash", "b.items", "b.method")


def stage_status(items: Column, snap_status: Column, snap_error: Column, ext_status: Column, ext_error: Column, url: Column | None = None) -> Column:
    """How far a URL has come; artefact first, then snapshot, then extraction."""

    def failed(label: str, kind: Column) -> Column:
        return F.concat(F.lit(f"{label} ("), F.coalesce(kind, F.lit("unknown")), F.lit(")"))

    ladder = F.when(F.lit(False), "") if url is None else F.when(url.isNull(), NO_URL)
    return (
        ladder.when(items.isNotNull() & (F.size(items) == 0), NO_INSTITUTION)
        .when(items.isNotNull(), DONE)
        .when(snap_status.isNull(), WAIT_SNAPSHOT)
        .when(snap_status != "success", failed(SNAPSHOT_FAILED, snap_error))
        .when(ext_status.isNull(), WAIT_EXTRACT)
        .when(ext_status != "success", failed(EXTRACT_FAILED, ext_error))
        .otherwise(DATA_MISSING)
    )


def journal_urls(df: DataFrame, name: str, url_columns: Sequence[str], row: str | Sequence[str] = "_row") -> DataFrame:
    """(row, name, url, at): http URLs of each row without repeats; one null URL when there is none."""
    cells = F.array(*[filled(quoted(c)) for c in url_columns])
    urls = F.array_distinct(F.filter(cells, lambda u: u.isNotNull() & is_http(u)))
    return df.filter(cell(quoted(name)) != "").select(*[quoted(r) for r in names(row)], filled(quoted(name)).alias("name"), F.posexplode_outer(urls).alias("at", "url"))


def combine_extracted(journals: DataFrame, snapshots: DataFrame, extracts: DataFrame, artifacts: DataFrame, spread: int = 1) -> DataFrame:
    """One row per institution, or one status row per URL.

    ``journals`` comes from :func:`journal_urls`; the logs have ``hash`` and
    ``_seq``; ``artifacts`` comes from :func:`load_artifacts`.
    """
    def tries(log: DataFrame, tag: str) -> DataFrame:
        return log.select(F.col("hash").alias("url_hash"), F.struct("status", "error_type").alias(f"_{tag}"), F.struct("_seq").alias(f"_{tag}_seq"))

    # the stages of a URL come together before the many rows that ask for it,
    # so that these rows meet a single join, which can split a frequent URL
    both = tries(snapshots, "s").unionByName(tries(extracts, "e"), allowMissingColumns=True)
    last = both.groupBy("url_hash").agg(F.max_by("_s", "_s_seq").alias("_s"), F.max_by("_e", "_e_seq").alias("_e"))
    state = artifacts.select("url_hash", "items").join(last, "url_hash", "full_outer").select(
        "url_hash",
        "items",
        *[F.col(f"_{tag}.{field}").alias(f"_{tag}{field[0]}") for tag in ("s", "e") for field in ("status", "error_type")],
    )
    joined = lookup(journals.withColumn("url_hash", sha1_hex("url")), state, "url_hash", spread=spread)
    status = stage_status(F.col("items"), F.col("_ss"), F.col("_se"), F.col("_es"), F.col("_ee"), F.col("url"))
    kept = [c for c in journals.columns if c not in ("name", "url")]
    rows = joined.withColumn("_status", status).select("*", F.posexplode_outer("items").alias("item_at", "_i"))

    def shown(field: str, alias: str) -> Column:
        return F.coalesce(F.col(f"_i.{field}"), F.lit("")).alias(alias)

    return rows.select(
        *kept,
        "item_at",
        F.col("name").alias("期刊名称"),
        F.coalesce("url", F.lit("")).alias("来源链接"),
        F.when(F.col("_i").isNull(), F.col("_status")).otherwise(F.coalesce("_i.name", F.lit(""))).alias("匹配机构"),
        shown("matched_keyword", "匹配关键词"),
        shown("source_sentence", "匹配句子"),
        shown("extraction_method", "提取方法"),
        F.coalesce("url_hash", F.lit("")).alias("链接hash"),
    )


def is_status_row(c: Column | str) -> Column:
    """The institution cell holds a stage status instead of a name."""
    text = F.col(c) if isinstance(c, str) else c
    fixed = text.isin(NO_URL, NO_INSTITUTION, WAIT_SNAPSHOT, WAIT_EXTRACT, DATA_MISSING)
    return fixed | text.startswith(SNAPSHOT_FAILED + " (") | text.startswith(EXTRACT_FAILED + " (")


# -- comparison of methods ----------------------------------------------------


def _by_keyword(items: DataFrame, rows: Sequence[str]) -> tuple[DataFrame, Column]:
    known = F.create_map(*[x for k in KEYWORD_COLUMNS for x in (F.lit(k.lower()), F.lit(k))])
    named = items.filter(non_empty("name")).select(*[quoted(r) for r in rows], strip("keyword").alias("_given"), strip("name").alias("name"), "at")
    found = F.try_element_at(known, F.lower("_given"))
    tagged = named.withColumn("keyword", F.coalesce(found, F.lit(OTHER)))
    other = F.col("keyword") == OTHER
    shown = F.when(other, F.concat_ws(": ", F.coalesce(F.nullif("_given", F.lit("")), F.lit(UNKNOWN)), F.col("name"))).otherwise(F.col("name"))
    return tagged.withColumn("name", shown), F.when(other, F.col("at"))


def keyword_names(items: DataFrame, row: str | Sequence[str] = "_row") -> DataFrame:
    """(row, keyword, name, nth): institution names per keyword column, numbered in order.

    ``items`` has row (one column or several), keyword, name and ``at``, their order within the row.
    Known keywords merge distinct names; the others come as ``keyword: name`` under 其他, with
    未知 for a missing keyword and every entry kept.
    """
    rows = names(row)
    tagged, apart = _by_keyword(items, rows)
    return distinct_values(tagged, [*rows, "keyword"], "name", ["at"], apart)


def by_keyword(items: DataFrame, row: str | Sequence[str] = "_row", length: int = 10_000) -> DataFrame:
    """(row, keyword, part, text): the names of :func:`keyword_names` as texts of at most ``length`` names."""
    rows = names(row)
    tagged, apart = _by_keyword(items, rows)
    return joined_cells(tagged, [*rows, "keyword"], "name", ["at"], ";", apart=apart, length=length)


def keyword_pivot(items: DataFrame, row: str | Sequence[str] = "_row", length: int = 10_000) -> DataFrame:
    """One column per keyword, in the fixed order, then 其他; a row for each ``part`` that a keyword has."""
    cells = by_keyword(items, row, length)
    texts = F.map_from_entries(F.collect_list(F.struct("keyword", "text")))
    rows = [quoted(r) for r in names(row)]
    one = cells.groupBy(*rows, "part").agg(texts.alias("_texts"))
    wide = [F.coalesce(F.try_element_at("_texts", F.lit(k)), F.lit("")).alias(f"关键词_{k}") for k in [*KEYWORD_COLUMNS, OTHER]]
    return one.select(*rows, "part", *wide)


def sheet_items(df: DataFrame, artifacts: DataFrame, row: str | Sequence[str] = "_row", spread: int = 1) -> DataFrame:
    """(row, keyword, name, at): institutions behind the sheet's URL columns.

    Takes the introduction, home page and host columns that the sheet has, in
    that order. ``artifacts`` comes from :func:`load_artifacts`.
    """
    columns = [c for c in (resolve_column(df, ALIASES[k]) for k in ("intro", "home", "host")) if c]
    rows = names(row)
    long = unpivot_urls(df, columns, rows)
    long = long.select(*[quoted(r) for r in rows], sha1_hex("url").alias("url_hash"), url_order(columns).alias("_url_at"))
    found = lookup(long, artifacts.select("url_hash", "items"), "url_hash", "inner", spread)
    exploded = found.select(*[quoted(r) for r in rows], "_url_at", F.posexplode("items").alias("_item_at", "_i"))
    return exploded.select(*[quoted(r) for r in rows], F.col("_i.matched_keyword").alias("keyword"), F.col("_i.name").alias("name"), F.struct("_url_at", "_item_at").alias("at"))


def _field_values(items: Column, field: str) -> Column:
    """Texts of one field; a list value gives each of its entries."""
    values = F.transform(items, lambda x: F.coalesce(F.try_element_at(x, F.lit(field)), F.lit("")))
    return F.flatten(F.transform(values, lambda v: F.when(is_json_array(v), F.coalesce(F.from_json(v, "array<string>"), F.array(v))).otherwise(F.array(v))))


def model_answers(log: DataFrame, fields: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(name, fields…): merged field texts of the latest readable success per name."""
    good = successful(log).select("journal_name", "results_json", *extra, "_seq", F.coalesce(is_json("results_json"), F.lit(False)).alias("_reads"))
    last = latest(good, "journal_name", prefer=F.col("_reads")).filter("_reads")
    items = last.withColumn("_items", json_items("results_json")).filter(F.size("_items") > 0)
    return items.select(
        F.col("journal_name").alias("_name"),
        *[merge_values(_field_values(F.col("_items"), f)).alias(f) for f in fields],
        *extra,
    )


def combine_methods(
    df: DataFrame,
    items: DataFrame | None,
    scan_log: DataFrame | None,
    search_log: DataFrame | None,
    include: str = "extract,scan,search",
    row: str | Sequence[str] = "_row",
    spread: int = 1,
) -> DataFrame:
    """The sheet beside the answers of up to three methods, one name prefix per group.

    ``items`` has row, keyword, name and ``at``; ``row`` names the column, or the
    columns (file, sheet and row), that tell the rows apart. The AI columns stay blank for
    methods that are not included. Where keyword texts go on in further parts,
    those rows have blanks in all other columns.
    """
    methods = method_set(include)
    rows = names(row)
    sheet = [c for c in df.columns if c not in rows]
    name = resolve_column(df, ALIASES["name"], required=True)
    original = [f"原始_{c}" for c in sheet]
    out = df.select(*[quoted(r) for r in rows], cell(quoted(name)).alias("_name"), *[cell(quoted(c)).alias(o) for c, o in zip(sheet, original)])
    manual = []
    for key, shown in (("manual_unit", "人工_人工判断单位"), ("manual_sentence", "人工_人工判断关键语句")):
        source = resolve_column(df, ALIASES[key])
        if source:
            manual.append((shown, quoted(f"原始_{source}")))

    def answers(log: DataFrame | None, on: bool, prefix: str, fields: Sequence[str], links: dict[str, str]) -> DataFrame | None:
        if not on or log is None:
            return None
        found = model_answers(log, fields, list(links.values())).withColumn("期刊名称", F.col("_name"))
        found = found.withColumnsRenamed({v: k for k, v in links.items()})
        return found.select("_name", *[quoted(c).alias(f"{prefix}_{c}") for c in ("期刊名称", *fields, *links)])

    scan_links = {"来源链接1": "url1", "来源链接2": "url2"}
    groups = [
        (answers(scan_log, "scan" in methods, "AI精准", SCAN_FIELDS[1:4], scan_links), [f"AI精准_{c}" for c in SCAN_FIELDS]),
        (answers(search_log, "search" in methods, "AI核心", SEARCH_FIELDS[1:], {}), [f"AI核心_{c}" for c in SEARCH_FIELDS]),
    ]
    present = [found for found, _ in groups if found is not None]
    if present:
        # one row per name from both methods, then a single join
        both = present[0] if len(present) == 1 else present[0].join(present[1], "_name", "full_outer")
        out = lookup(out, both, "_name", spread=spread)
    keywords = [f"关键词_{k}" for k in [*KEYWORD_COLUMNS, OTHER]]
    part = F.lit(0)
    with_items = "extract" in methods and items is not None
    if with_items:
        out, part = out.join(keyword_pivot(items, rows), rows, "left"), F.coalesce("part", F.lit(0))

    def shown(columns: Sequence[str], there: bool) -> list[Column]:
        return [(F.coalesce(quoted(c), F.lit("")) if there else F.lit("")).alias(c) for c in columns]

    def once(c: Column, name: str) -> Column:
        return (F.when(part == 0, c).otherwise("") if with_items else c).alias(name)

    titles = [c for _, columns in groups for c in columns]
    answered = [once(c, n) for n, c in zip(titles, (c for found, columns in groups for c in shown(columns, found is not None)))]
    sheet_cells = [once(quoted(c), c) for c in original]
    by_hand = [once(c, n) for n, c in manual]
    return out.select(*[quoted(r) for r in rows], *sheet_cells, *by_hand, *answered, *shown(keywords, with_items), part.alias("part"))


def report_rows(names_df: DataFrame, results: DataFrame, kind: str = "search", row: str = "_row", spread: int = 1) -> DataFrame:
    """Result rows, failure rows and pending rows in one shape, for every input row.

    ``names_df`` has row, ``journal_name`` and, for a scan, url1 and url2;
    ``results`` has one latest log row per name.
    """
    fields = SEARCH_FIELDS[1:] if kind == "search" else SCAN_FIELDS[1:4]
    time = "search_time" if kind == "search" else "scan_time"
    links = {} if kind == "search" else {"来源链接1": "url1", "来源链接2": "url2"}
    log = results.select(
        "journal_name", "status", F.col(time).alias("_time"), "error_type", "error_message", "results_json",
        *[F.col(u).alias(f"_{u}") for u in links.values()],
    )
    joined = lookup(names_df, log, "journal_name", spread=spread)
    items = F.when(F.col("status") == "success", json_items("results_json"))
    # an empty list has no result row: it is shown as a failure
    some = F.when(F.size(items) > 0, items)
    rows = joined.withColumn("_items", some).select("*", F.posexplode_outer("_items").alias("item_at", "_i"))
    item = F.col("_i")
    state = F.when(F.col("status").isNull(), "pending").when(item.isNotNull(), "success").otherwise("failed")
    failure = F.concat(F.coalesce("error_type", F.lit("unknown")), F.lit(": "), F.coalesce("error_message", F.lit("")))
    shown = [
        F.coalesce(F.try_element_at(item, F.lit(f)), F.lit("")).alias(f) for f in fields
    ] + [
        F.coalesce(F.try_element_at(item, F.lit(f)), F.col(f"_{u}"), F.col(u), F.lit("")).alias(f) for f, u in links.items()
    ]
    return rows.withColumn("_state", state).select(
        row,
        "item_at",
        F.col("journal_name").alias("期刊名称"),
        *shown,
        F.col("_state").alias("状态"),
        F.when(F.col("_state") == "success", "").when(F.col("_state") == "pending", PENDING_NOTE).otherwise(failure).alias("错误信息"),
        F.coalesce("_time", F.lit("")).alias("处理时间"),
    )


# -- lookups and URL checks ---------------------------------------------------


def flatten_lookup(df: DataFrame, text: str = "response") -> DataFrame:
    """(…, name, user_id, outcome): one row per user found, or one marker row.

    Entries of the user list that are no objects are passed over.
    """
    body = quoted(text)
    kept = [c for c in df.columns if c != text]
    code = F.try_variant_get(F.try_parse_json(body), "$.code", "int")
    read = df.withColumn("_ok", is_json_object(body) & F.coalesce(code == 0, F.lit(False)))
    listed = F.filter(F.from_json(F.get_json_object(body, "$.data.users"), "array<string>"), lambda u: u.startswith("{"))
    read = read.withColumn("_users", F.when(F.col("_ok"), F.transform(listed, lambda u: F.from_json(u, "map<string,string>"))))
    users = F.when(F.size("_users") > 0, F.col("_users"))
    outcome = F.when(~F.col("_ok"), "fail").when(users.isNull(), "no_match").otherwise("ok")
    rows = read.select(*[quoted(c) for c in kept], outcome.alias("outcome"), F.posexplode_outer(users).alias("_at", "_u"))
    marker = F.when(F.col("outcome") == "no_match", NO_MATCH).otherwise(CALL_FAILED)

    def of_user(field: str, otherwise: Column) -> Column:
        return F.when(F.col("_u").isNull(), otherwise).otherwise(F.coalesce(F.try_element_at("_u", F.lit(field)), F.lit(""))).alias(field)

    return rows.select(*[quoted(c) for c in kept], of_user("name", marker), of_user("user_id", F.lit("")), "outcome")


def url_check(responses: DataFrame) -> DataFrame:
    """URL check table from (seq, url, final_url, status_code, size_bytes, reason, error)."""
    from sheetflow.functions.outcome import size_kb

    good = F.col("error").isNull() & (F.col("status_code") < 400)
    why = F.when(F.col("error").isNotNull(), F.split("error", "\n")[0]).when(good, "").otherwise(F.coalesce("reason", F.lit("")))
    return responses.select(
        F.col("seq").alias("序号"),
        F.col("url").alias("URL"),
        F.coalesce("final_url", "url").alias("最终URL"),
        F.when(good, "成功").otherwise("失败").alias("成功状态"),
        F.coalesce(F.col("status_code").cast("string"), F.lit("N/A")).alias("响应状态码"),
        F.coalesce(size_kb("size_bytes"), F.lit(0.0)).alias("响应体大小(KB)"),
        why.alias("错误原因"),
    )


# -- provenance and counts ----------------------------------------------------


def url_provenance(df: DataFrame, length: int = 10_000) -> DataFrame:
    """(url, part, sheets, rows, keywords): where each URL came from.

    Distinct values, sheets and keywords by text, rows by number, one per line.
    """
    kinds = {
        "sheets": (F.lit(0).cast("long"), F.col("sheet")),
        "rows": (F.coalesce(F.col("row").cast("string").try_cast("long"), F.lit(0).cast("long")), F.col("row").cast("string")),
        "keywords": (F.lit(0).cast("long"), F.col("keywords")),
    }
    entries = [F.struct(F.lit(k).alias("kind"), number.alias("number"), text.alias("text")) for k, (number, text) in kinds.items()]
    long = df.select("url", F.inline(F.array(*entries))).filter("text IS NOT NULL")
    cells = joined_cells(long, ["url", "kind"], "text", ["number", "text"], "\n", out="lines", tied=True, length=length)
    texts = F.map_from_entries(F.collect_list(F.struct("kind", "lines")))
    one = cells.groupBy("url", "part").agg(texts.alias("_texts"))
    return one.select("url", "part", *[F.try_element_at("_texts", F.lit(k)).alias(k) for k in kinds])


def run_stats(log: DataFrame, status: str = "status") -> DataFrame:
    """One row of counts by outcome, and the share that succeeded."""
    s = quoted(status)
    return log.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(s == name).alias(name) for name in ("success", "failed", "skipped", "pending")],
    ).withColumn("percent", F.round(F.try_divide(F.col("success") * 100.0, F.col("total")), 1))


def usage_stats(log: DataFrame) -> DataFrame:
    """Totals of tokens, cost and time over the successes, and seconds per success."""
    good = successful(log)
    return good.agg(
        F.count(F.lit(1)).alias("success"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens", "cost", "elapsed_time")],
    ).withColumn("seconds_per_success", F.coalesce(F.try_divide("elapsed_time", "success"), F.lit(0.0)))


def method_stats(log: DataFrame, method: str = "extract_method") -> DataFrame:
    return log.groupBy(quoted(method).alias("method")).agg(F.count(F.lit(1)).alias("n"))


def report_stats(report: DataFrame, column: str = "匹配机构") -> DataFrame:
    """Rows with an institution, and rows that only carry a status."""
    status = is_status_row(quoted(column))
    return report.agg(F.count_if(~status).alias("success"), F.count_if(status).alias("not_success"))


def lookup_stats(flat: DataFrame, key: str = "input") -> DataFrame:
    """Inputs by outcome."""
    return flat.select(quoted(key), "outcome").distinct().groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def with_seq(df: DataFrame, row: str = "_row") -> DataFrame:
    """Output number: the input row carried along, never a global count."""
    return df.withColumn("序号", quoted(row))
