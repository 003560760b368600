"""Reports: results joined back to the sheet, widened, merged and counted."""

from pyspark.sql import functions as F

from sheetflow.functions.strings import sha1_hex
from sheetflow.operators import reports
from sheetflow.operators.keyed import joined_cells, latest, merge_values, order_by_source
from sheetflow.plans.registry import query
from sheetflow.plans.runs import LOG, SEARCH_LOG, SNAP_LOG, event_log, keyword_logs


def order_search_log(t):
    """Line items as the logged search results of their order."""
    li = t.lineitem
    return li.select(
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("query"),
        F.when(F.col("l_returnflag") == "R", "False").otherwise("true").alias("FOUND"),
        F.when(F.col("l_linenumber") == 7, "last").otherwise(F.col("l_linenumber").cast("string")).alias("position"),
        F.concat(F.lit("http://p"), F.col("l_suppkey").cast("string"), F.lit(".example.org/"), F.col("l_partkey").cast("string")).alias("url"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("p"), F.col("l_suppkey").cast("string"))).otherwise("").alias("domain"),
        F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_linestatus").alias("_seq"),
    )


def ask_sheet(t):
    return t.orders.select(F.col("o_orderkey").alias("_row"), F.when(F.col("o_orderpriority") != "5-LOW", F.lit("order")).alias("kind"), F.col("o_orderkey").alias("id"))


def topn_sql(n: int, exclude: str = "") -> str:
    wide = ", ".join(f"max(CASE WHEN rk = {i} THEN url END) AS \"链接{i}\", max(CASE WHEN rk = {i} THEN nullif(domain, '') END) AS \"域名{i}\"" for i in range(1, n + 1))
    shown = ", ".join(f'"链接{i}", "域名{i}"' for i in range(1, n + 1))
    return f"""WITH log AS (SELECT 'order ' || l_orderkey AS query, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END AS pos,
  'http://p' || l_suppkey || '.example.org/' || l_partkey AS url, CASE WHEN l_linestatus = 'O' THEN 'p' || l_suppkey ELSE '' END AS domain,
  l_partkey, l_suppkey, l_linenumber, l_linestatus FROM lineitem WHERE l_returnflag <> 'R'),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos, l_partkey, l_suppkey, l_linenumber, l_linestatus) AS rk FROM log {exclude}),
w AS (SELECT query, {wide} FROM r WHERE rk <= {n} GROUP BY query)
SELECT o_orderkey AS _row, CASE WHEN o_orderpriority <> '5-LOW' THEN 'order' END AS kind, o_orderkey AS id, {shown}
FROM orders LEFT JOIN w ON w.query = trim(CASE WHEN o_orderpriority <> '5-LOW' THEN 'order' ELSE '' END || ' ' || o_orderkey)"""


@query(topn_sql(3))
def topn_wide(t):
    return reports.assemble_search(ask_sheet(t), order_search_log(t), "{{kind}} {{id}}", "链接:url,域名:domain", 3)


@query(topn_sql(2, "WHERE NOT regexp_matches(url, '/\\d*7$|^http://p1\\.')"))
def topn_excluded(t):
    """Excluded URLs leave their places to the next ones."""
    return reports.assemble_search(ask_sheet(t), order_search_log(t), "{{kind}} {{id}}", "链接:url,域名:domain", 2, exclude=r"/\d*7$|^http://p1\.")


EXTRACT_WIDE = """WITH log AS (SELECT 'http://c/' || c_custkey AS url, c_name AS "姓名", CAST(c_nationkey AS VARCHAR) AS "国别", 0 AS k FROM customer WHERE c_acctbal > 0
 UNION ALL SELECT 'http://p/' || p, 'P' || p, '', 1 FROM (SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderpriority <> '2-HIGH'))
SELECT o_orderkey AS _row, 'http://c/' || o_custkey AS a, x."姓名" AS "a-姓名", x."国别" AS "a-国别", o_orderstatus,
  CASE WHEN o_orderstatus <> 'P' THEN 'http://p/' || o_orderpriority END AS b, y."姓名" AS "b-姓名", y."国别" AS "b-国别"
FROM orders LEFT JOIN log x ON x.url = 'http://c/' || o_custkey LEFT JOIN log y ON o_orderstatus <> 'P' AND y.url = 'http://p/' || o_orderpriority"""


def extract_inputs(t):
    sheet = t.orders.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.lit("http://c/"), F.col("o_custkey").cast("string")).alias("a"),
        "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("http://p/"), "o_orderpriority")).alias("b"),
    )
    people = t.customer.select(
        F.concat(F.lit("http://c/"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("url"),
        F.when(F.col("c_acctbal") > 0, "True").otherwise("false").alias("SUCCESS"),
        F.col("c_name").alias("姓名"),
        F.col("c_nationkey").cast("string").alias("国别"),
        F.col("c_custkey").alias("_seq"),
    )
    kinds = t.orders.select(
        F.concat(F.lit("http://p/"), "o_orderpriority").alias("url"),
        F.when(F.col("o_orderpriority") != "2-HIGH", "true").otherwise("").alias("SUCCESS"),
        F.concat(F.lit("P"), "o_orderpriority").alias("姓名"),
        F.lit("").alias("国别"),
        F.col("o_orderkey").alias("_seq"),
    )
    return sheet, people.unionByName(kinds)


@query(EXTRACT_WIDE)
def extract_beside(t):
    """Two URL columns, one of them with a handful of very frequent URLs."""
    sheet, log = extract_inputs(t)
    return reports.assemble_extract(sheet, log, ["a", "b"])


@query(EXTRACT_WIDE.replace("o_orderkey AS _row", "CAST(o_orderkey % 2 AS VARCHAR) AS file, o_orderkey // 2 AS _row"))
def extract_two_sheets(t):
    """Two files whose rows have the same numbers; fields stay with the rows of their own file."""
    sheet, log = extract_inputs(t)
    place = [(F.col("_row") % 2).cast("string").alias("file"), F.floor(F.col("_row") / 2).alias("_row")]
    return reports.assemble_extract(sheet.select(*place, "a", "o_orderstatus", "b"), log, ["a", "b"], row=["file", "_row"])


@query(EXTRACT_WIDE)
def extract_salted(t):
    """The same with the frequent URLs salted over four tasks, results appended at the end."""
    sheet, log = extract_inputs(t)
    return reports.assemble_extract(sheet, log, ["a", "b"], mode="append", spread=4)


@query(
    """WITH e AS (SELECT event_id, event_type AS t, value AS v, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id AS row_number, 'q' || k AS query, 'false' AS "FOUND", 'HTTP 500' AS "ERROR", '' AS number_of_results, '' AS number_of_organic_results,
  '' AS position, '' AS url, '' AS displayed_url, '' AS description, '' AS title, '' AS domain, NULL::INTEGER AS _at FROM e WHERE t = 'error'
UNION ALL SELECT event_id, 'q' || k, 'false', '', CASE WHEN t = 'view' THEN '0' ELSE CAST(k AS VARCHAR) END, '0', '', '', '', '', '', '', NULL FROM e WHERE t <> 'error' AND (t = 'view' OR v <= 20)
UNION ALL SELECT event_id, 'q' || k, 'true', '', CAST(k AS VARCHAR), '0', CAST(i + 1 AS VARCHAR), 'http://r' || i || '.org', '', 'say "' || i || '"', '', '', i
FROM e, unnest(range(2)) AS u(i) WHERE t NOT IN ('error', 'view') AND v > 20"""
)
def search_rows(t):
    """Search replies as log rows, at most two results each."""
    k = F.get_json_object("props", "$.k")
    results = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda i: F.struct((i + 1).alias("position"), F.concat(F.lit("http://r"), i.cast("string"), F.lit(".org")).alias("url"), F.concat(F.lit('say "'), i.cast("string"), F.lit('"')).alias("description")),
    )
    body = F.to_json(F.struct(F.struct(k.cast("int").alias("number_of_results")).alias("meta_data"), F.when(F.col("value") > 20, results).otherwise(F.slice(results, 1, 0)).alias("organic_results")))
    replies = t.events.select(
        F.col("event_id").alias("row_number"),
        F.concat(F.lit("q"), k).alias("query"),
        F.when(F.col("event_type") == "view", "{}").when(F.col("event_type") != "error", body).alias("payload"),
        F.when(F.col("event_type") == "error", "HTTP 500").alias("error"),
    )
    return reports.explode_search(replies, n=2)


@query(
    f"""WITH {SEARCH_LOG}, {SNAP_LOG},
s AS (SELECT * FROM sl WHERE sheet = 'click' QUALIFY row_number() OVER (PARTITION BY keywords ORDER BY ts DESC, event_id DESC) = 1),
n AS (SELECT * FROM nl QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) = 1),
j AS (SELECT s.*, least(CASE WHEN search_result_json = '' THEN 0 ELSE json_array_length(search_result_json) END, 3) AS x,
  a.snapshot_path AS p1, a.snapshot_error AS e1, b.snapshot_path AS p2, b.snapshot_error AS e2, c.snapshot_path AS p3, c.snapshot_error AS e3
  FROM s LEFT JOIN n a ON a.url = url1 LEFT JOIN n b ON b.url = url2 LEFT JOIN n c ON c.url = url3),
o AS (SELECT *, [{{'u': url1, 'p': p1, 'e': e1}}, {{'u': url2, 'p': p2, 'e': e2}}, {{'u': url3, 'p': p3, 'e': e3}}][1:x] AS l FROM j),
r AS (SELECT *, list_filter(l, lambda q: q.u <> '' AND coalesce(q.p, '') <> '' AND coalesce(q.e, '') = '') AS good,
  list_filter(l, lambda q: q.u <> '' AND NOT (coalesce(q.p, '') <> '' AND coalesce(q.e, '') = '')) AS bad FROM o)
SELECT c_custkey AS _row, 'user' AS a, c_custkey AS b, c_custkey AS "原始行号", keywords AS "关键词", search_time AS "搜索时间", search_duration_ms AS "搜索耗时",
 search_result_json AS "搜索结果", CASE WHEN search_error = '' AND search_result_json = '' THEN '搜索成功但无结果' ELSE search_error END AS "搜索错误",
 CASE WHEN x = 0 THEN '0/0' ELSE len(good) || '/' || x END AS "快照状态",
 CASE WHEN x = 0 THEN '搜索无结果' ELSE array_to_string(list_transform(bad, lambda q: q.u || ': ' || CASE WHEN coalesce(q.e, '') <> '' THEN q.e ELSE '尚未快照' END), chr(10)) END AS "快照错误",
 nullif(url1, '') AS "链接1", 'http://f/' || nullif(p1, '') AS "快照1", nullif(url2, '') AS "链接2", 'http://f/' || nullif(p2, '') AS "快照2",
 nullif(url3, '') AS "链接3", 'http://f/' || nullif(p3, '') AS "快照3"
FROM customer LEFT JOIN r ON r.keywords = 'user ' || c_custkey"""
)
def snapshot_report(t):
    sheet = t.customer.select(F.col("c_custkey").alias("_row"), F.lit("user").alias("a"), F.col("c_custkey").alias("b"))
    search, snap = keyword_logs(t)
    return reports.assemble_snapshots(sheet, search, snap, "A,B", sheet="click", prefix="http://f/")


# -- institutions per URL -----------------------------------------------------

# Stage of a page, by language, host and scheme of its URL.
STAGE_OF = """CASE WHEN url LIKE '%/fr/%' THEN 0 WHEN url LIKE '%/de/%' THEN 1 WHEN url LIKE '%/es/%' THEN 2 WHEN url LIKE 'https:%.org/%' THEN 3 WHEN url LIKE '%.org/%' THEN 4
 WHEN url LIKE 'https:%.net/%' THEN 5 WHEN url LIKE '%.net/%' THEN 6 ELSE 7 END"""
STAGE = f"""u AS (SELECT page_id, url, sha1(url) AS h, {STAGE_OF} AS m, length(url) % 5 AS l FROM pages),
arts AS (SELECT *, CASE WHEN m = 0 THEN [] WHEN m = 1 THEN [{{'name': 'Org ' || page_id, 'kw': 'press', 's': 'S'}}, {{'name': 'B' || l, 'kw': '', 's': ''}}] WHEN m = 2 THEN [{{'name': 'Rule ' || page_id, 'kw': 'Owner', 's': 'T'}}] END AS items,
  CASE WHEN m IN (1) THEN 'langextract' ELSE 'regexp' END AS how FROM u)"""


def stage_tables(t):
    """Snapshot log, extract log and artefacts, by page number."""
    u = t.pages.select("page_id", "url", sha1_hex("url").alias("hash"), F.expr(STAGE_OF).alias("m"), (F.length("url") % 5).alias("l"))
    m = F.col("m")
    snaps = u.filter("m <> 3").select("hash", F.when(m == 4, "failed").otherwise("success").alias("status"), F.when(m == 4, "timeout").alias("error_type"), F.col("page_id").alias("_seq"))
    exts = u.filter("m NOT IN (3, 4, 5)").select(
        "hash", F.when(m == 6, "failed").otherwise("success").alias("status"), F.when(m == 6, F.lit("api_error")).alias("error_type"), F.col("page_id").alias("_seq")
    )

    def item(name, kw, sentence, method):
        return F.struct(
            name.alias("name"), F.lit("host").alias("type"), F.lit(sentence).alias("source_sentence"), F.lit(kw).alias("matched_keyword"), F.lit(method).alias("extraction_method")
        )

    def body(*items):
        return F.to_json(F.struct(F.array(*items).alias("host_institutions")))

    pid, l = F.col("page_id").cast("string"), F.col("l").cast("string")
    rules = u.filter("m IN (0, 1, 2)").select(
        F.col("hash").alias("url_hash"),
        F.lit("regexp").alias("method"),
        F.col("page_id").alias("_seq"),
        F.when(m == 0, '{"host_institutions": []}').otherwise(body(item(F.concat(F.lit("Rule "), pid), "Owner", "T", "regexp"))).alias("content"),
    )
    model = u.filter("m IN (1, 2)").select(
        F.col("hash").alias("url_hash"),
        F.lit("langextract").alias("method"),
        F.col("page_id").alias("_seq"),
        F.when(m == 2, '{"host_institutions": [broken').otherwise(body(item(F.concat(F.lit("Org "), pid), "press", "S", "langextract"), item(F.concat(F.lit("B"), l), "", "", "langextract"))).alias("content"),
    )
    return snaps, exts, rules.unionByName(model)


def journals(t):
    """Pages as journals: the URL twice, some without a URL, some without a name."""
    sheet = t.pages.select(
        F.col("page_id").alias("_row"),
        F.when(~F.col("url").endswith("#top"), F.concat(F.lit("J"), F.col("page_id").cast("string"))).alias("刊名"),
        F.when(F.col("url").endswith(".html"), "none").otherwise(F.col("url")).alias("a"),
        F.when(~F.col("url").endswith(".html"), F.col("url")).alias("b"),
    )
    return reports.journal_urls(sheet, "刊名", ["a", "b"])


COMBINED = f"""WITH {STAGE}, rows AS (SELECT page_id AS _row, 'J' || page_id AS j, CASE WHEN url NOT LIKE '%.html' THEN url END AS url FROM pages WHERE url NOT LIKE '%#top'),
c AS (SELECT _row, CASE WHEN rows.url IS NULL THEN NULL ELSE 0 END AS "at", j, coalesce(rows.url, '') AS url, h, m, how, items, CASE WHEN rows.url IS NULL THEN '无URL' WHEN m = 0 THEN '无匹配' WHEN m = 3 THEN '待快照' WHEN m = 4 THEN '快照失败 (timeout)'
   WHEN m = 5 THEN '待提取' WHEN m = 6 THEN '提取失败 (api_error)' WHEN m = 7 THEN '数据缺失' END AS status FROM rows LEFT JOIN arts ON rows.url = arts.url),
f AS (SELECT _row, "at", NULL::INTEGER AS item_at, j, url, status AS org, '' AS kw, '' AS s, '' AS how, coalesce(h, '') AS h FROM c WHERE status IS NOT NULL
 UNION ALL SELECT _row, "at", CAST(i AS INTEGER), j, url, items[i + 1].name, items[i + 1].kw, items[i + 1].s, how, h FROM c, unnest(range(2)) AS x(i) WHERE status IS NULL AND i < len(items))"""


@query(COMBINED + ' SELECT _row, "at", item_at, j AS "期刊名称", url AS "来源链接", org AS "匹配机构", kw AS "匹配关键词", s AS "匹配句子", how AS "提取方法", h AS "链接hash" FROM f')
def stage_report(t):
    """Institutions per URL, or how far the URL has come; a broken artefact falls back."""
    snaps, exts, arts = stage_tables(t)
    return reports.combine_extracted(journals(t), snaps, exts, reports.load_artifacts(arts))


@query(COMBINED + " SELECT count(*) FILTER (item_at IS NOT NULL) AS success, count(*) FILTER (item_at IS NULL) AS not_success FROM f")
def stage_counts(t):
    return reports.report_stats(stage_report_df(t))


def stage_report_df(t):
    snaps, exts, arts = stage_tables(t)
    return reports.combine_extracted(journals(t), snaps, exts, reports.load_artifacts(arts))


# -- comparison of methods ----------------------------------------------------

BRANDS = "CASE p_type WHEN 'ECONOMY' THEN 'Press' WHEN 'STANDARD' THEN ' journal OF ' WHEN 'PROMO' THEN '' WHEN 'LARGE' THEN 'own' ELSE 'Maker' END"
ITEMS = f"""items AS (SELECT l_suppkey AS _row, {BRANDS} AS keyword, p_brand AS name, l_partkey AS "at" FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey),
known AS (SELECT _row, CASE lower(trim(keyword)) WHEN 'press' THEN 'Press' WHEN 'journal of' THEN 'journal of' WHEN 'own' THEN 'Own' END AS kw, * EXCLUDE (_row) FROM items),
firsts AS (SELECT _row, kw, name, min("at") AS "at" FROM known WHERE kw IS NOT NULL GROUP BY ALL),
cells AS (SELECT _row, kw AS keyword, string_agg(name, ';' ORDER BY "at", name) AS text FROM firsts GROUP BY ALL
 UNION ALL SELECT _row, '其他', string_agg(CASE WHEN keyword = '' THEN '未知' ELSE keyword END || ': ' || name, ';' ORDER BY "at", name) FROM known WHERE kw IS NULL GROUP BY _row)"""


def supplier_items(t):
    """Brands a supplier delivers, as names under the keyword of their part type."""
    pairs = t.lineitem.select("l_suppkey", "l_partkey")
    parts = t.part.select("p_partkey", "p_brand", F.expr(BRANDS).alias("keyword"))
    joined = pairs.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.col("l_suppkey").alias("_row"), "keyword", F.col("p_brand").alias("name"), F.col("l_partkey").alias("at"))


@query(f"WITH {ITEMS} SELECT _row, keyword, 0 AS part, text FROM cells")
def keyword_cells(t):
    return reports.by_keyword(supplier_items(t))


@query(f"WITH {ITEMS}, v AS (SELECT _row, keyword, unnest(string_split(text, ';')) AS v FROM cells) SELECT _row, keyword, v, count(*) AS n FROM v GROUP BY ALL")
def keyword_cells_split(t):
    """Long groups come in several rows; together they hold every value."""
    cells = reports.by_keyword(supplier_items(t), length=10)
    return cells.select("_row", "keyword", F.explode(F.split("text", ";")).alias("v")).groupBy("_row", "keyword", "v").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {ITEMS}, long AS (SELECT _row, kw AS keyword, name, "at" FROM firsts
 UNION ALL SELECT _row, '其他', CASE WHEN keyword = '' THEN '未知' ELSE keyword END || ': ' || name, "at" FROM known WHERE kw IS NULL)
SELECT _row, keyword, name, row_number() OVER (PARTITION BY _row, keyword ORDER BY "at", name) AS nth FROM long"""
)
def keyword_long(t):
    """Every name of a keyword with its number, whatever the size of the group."""
    return reports.keyword_names(supplier_items(t))


# The keyword columns, in their order.
KEYWORD_COLS = ["On behalf of", "journal of", "publication of", "Affiliate", "Edited", "Own", "In association with", "responsible", "supervise", "sponsor", "Patronage",
                "Compile", "partnership", "Societies", "In cooperation with", "The backing of", "administrated", "Copyright ©", "©", "Press", "Funded", "其他"]
PIVOT = ", ".join(f"""coalesce(max(CASE WHEN keyword = '{k}' THEN text END), '') AS "关键词_{k}\"""" for k in KEYWORD_COLS)


@query(f"WITH {ITEMS} SELECT _row, 0 AS part, {PIVOT} FROM cells GROUP BY _row")
def keyword_columns(t):
    return reports.keyword_pivot(supplier_items(t))


@query(
    f"""WITH {STAGE}, s AS (SELECT page_id AS _row, url AS a, CASE WHEN url LIKE 'https:%' THEN replace(url, 'https:', 'http:') END AS b FROM pages),
l AS (SELECT _row, 1 AS p, a AS url FROM s UNION ALL SELECT _row, 2, a FROM s WHERE _row > 9 UNION ALL SELECT _row, 3, b FROM s)
SELECT _row, items[i + 1].kw AS keyword, items[i + 1].name AS name, p AS url_at, CAST(i AS INTEGER) AS item_at FROM l JOIN arts USING (url), unnest(range(2)) AS x(i) WHERE i < len(items)"""
)
def sheet_institutions(t):
    """Institutions found behind the three URL columns of a sheet."""
    sheet = t.pages.select(
        F.col("page_id").alias("_row"),
        F.concat(F.lit(" "), "url").alias("简介链接"),
        F.when(F.col("page_id") > 9, F.col("url")).alias("期刊主页链接"),
        F.when(F.col("url").startswith("https:"), F.replace("url", F.lit("https:"), F.lit("http:"))).alias("主办链接"),
    )
    items = reports.sheet_items(sheet, reports.load_artifacts(stage_tables(t)[2]))
    return items.select("_row", "keyword", "name", F.col("at._url_at").cast("int").alias("url_at"), F.col("at._item_at").alias("item_at"))


ANSWERS = """'[{"期刊名称":"x","主办单位":["U' || k || '"," U' || k || ' ","V"],"关键句子":"s","关联单位":"R' || k || '","信息位置":null}, {"主办单位":"V","关键句子":"s","关联单位":"","来源链接":"http://' || k || '"}]'"""


METHODS = f"""WITH {ITEMS}, wide AS (SELECT _row, {PIVOT} FROM cells GROUP BY _row),
log AS (SELECT 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS n, event_type, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, ts, event_id FROM events),
scan AS (SELECT * FROM log WHERE event_type IN ('click', 'purchase') QUALIFY row_number() OVER (PARTITION BY n ORDER BY ts DESC, event_id DESC) = 1),
search AS (SELECT * FROM log WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY n ORDER BY ts DESC, event_id DESC) = 1)
SELECT s_suppkey AS _row, s_name AS "原始_刊名", CAST(s_nationkey AS VARCHAR) AS "原始_人工单位", CAST(s_nationkey AS VARCHAR) AS "人工_人工判断单位",
 CASE WHEN a.n IS NULL THEN '' ELSE s_name END AS "AI精准_期刊名称", coalesce('R' || a.k, '') AS "AI精准_关联单位", CASE WHEN a.n IS NULL THEN '' ELSE 's' END AS "AI精准_关键句子",
 '' AS "AI精准_信息位置", coalesce('http://1/' || a.k, '') AS "AI精准_来源链接1", '' AS "AI精准_来源链接2",
 CASE WHEN b.n IS NULL THEN '' ELSE s_name END AS "AI核心_期刊名称", coalesce('U' || b.k || ';V', '') AS "AI核心_主办单位", CASE WHEN b.n IS NULL THEN '' ELSE 's' END AS "AI核心_关键句子",
 '' AS "AI核心_判断依据", coalesce('http://' || b.k, '') AS "AI核心_来源链接", 0 AS part, {", ".join(f'''coalesce("关键词_{k}", '') AS "关键词_{k}"''' for k in KEYWORD_COLS)}
FROM supplier LEFT JOIN scan a ON a.n = s_name LEFT JOIN search b ON b.n = s_name LEFT JOIN wide ON wide._row = s_suppkey"""


def methods_inputs(t):
    """Suppliers as journals, and what three methods know of them."""
    sheet = t.supplier.select(F.col("s_suppkey").alias("_row"), F.col("s_name").alias("刊名"), F.col("s_nationkey").alias("人工单位"))
    log = event_log(t).withColumn("k", F.col("k").cast("string"))
    name = F.concat(F.lit("Supplier#"), F.lpad("key", 9, "0")).alias("journal_name")
    rows = log.select(name, "event_type", F.expr(ANSWERS.replace("'[{", "concat('[{").replace(" || k || ", ", k, ") + ")").alias("results_json"), "k", "_seq")
    kind = F.col("event_type")
    scan = rows.withColumns(
        {
            "status": F.when(kind.isin("click", "purchase", "view"), "success").otherwise("failed"),
            "results_json": F.when(kind == "view", "[broken").otherwise(F.col("results_json")),
            "url1": F.concat(F.lit("http://1/"), "k"),
            "url2": F.lit(""),
        }
    )
    search = rows.withColumn("status", F.when(kind == "signup", "success").otherwise("failed"))
    return sheet, supplier_items(t), scan, search


@query(METHODS)
def methods_beside(t):
    """Suppliers as journals beside the answers of all three methods."""
    return reports.combine_methods(*methods_inputs(t))


@query(METHODS.replace("\nSELECT s_suppkey AS _row,", "\nSELECT CAST(s_suppkey % 2 AS VARCHAR) AS file, s_suppkey // 2 AS _row,"))
def methods_two_sheets(t):
    """The same over two files whose rows have the same numbers."""
    sheet, items, scan, search = methods_inputs(t)
    place = {"file": (F.col("_row") % 2).cast("string"), "_row": F.floor(F.col("_row") / 2)}
    return reports.combine_methods(sheet.withColumns(place), items.withColumns(place), scan, search, row=["file", "_row"])


@query(f"""SELECT * REPLACE ({", ".join(f'{chr(39) * 2} AS "{c}"' for c in [*(f"AI精准_{c}" for c in reports.SCAN_FIELDS), *(f"关键词_{k}" for k in KEYWORD_COLS)])}) FROM ({METHODS})""")
def methods_searched(t):
    """One method of three is asked for; the columns of the others stay blank."""
    return reports.combine_methods(*methods_inputs(t), include=" Search ")


# One user's rows stand under another name, so that a customer has none.
REPORT_LOG = """log AS (SELECT CASE WHEN user_id = 3 THEN 'gone' ELSE 'U' || user_id END AS n, event_type AS e, json_extract_string(props, '$.k') AS k, CAST(ts AS VARCHAR) AS time, ts, event_id FROM events),
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY n ORDER BY ts DESC, event_id DESC) = 1),
j AS (SELECT c_custkey AS _row, 'U' || c_custkey AS name, last.* FROM customer LEFT JOIN last ON n = 'U' || c_custkey),
f AS (SELECT *, 0 AS "at" FROM j WHERE e IN ('click', 'signup') UNION ALL SELECT *, 1 FROM j WHERE e = 'signup' UNION ALL SELECT *, NULL FROM j WHERE n IS NULL OR e NOT IN ('click', 'signup'))"""


def report_log(t):
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    one = F.concat(F.lit('{"主办单位":"H'), k, F.lit('","关联单位":"R'), k, F.lit('","来源链接1":"http://own/'), k, F.lit('"}'))
    log = t.events.select(
        F.when(F.col("user_id") == 3, "gone").otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("journal_name"),
        F.when(kind.isin("click", "signup", "view"), "success").otherwise("failed").alias("status"),
        F.when(kind == "error", "timeout").when(kind == "purchase", F.lit(None)).otherwise("").alias("error_type"),
        F.when(kind == "error", "slow").alias("error_message"),
        F.when(kind == "view", "[]").when(kind == "click", F.concat(F.lit("["), one, F.lit("]"))).when(kind == "signup", F.concat(F.lit("["), one, F.lit(', {"关键句子":"K"}]'))).alias("results_json"),
        F.col("ts").cast("string").alias("search_time"),
        F.col("ts").cast("string").alias("scan_time"),
        F.concat(F.lit("http://l/"), k).alias("url1"),
        F.lit("").alias("url2"),
        F.struct("ts", "event_id").alias("_seq"),
    )
    return latest(log, "journal_name")


STATE = """CASE WHEN n IS NULL THEN 'pending' WHEN "at" IS NOT NULL THEN 'success' ELSE 'failed' END AS "状态",
 CASE WHEN n IS NULL THEN '待处理' WHEN "at" IS NOT NULL THEN '' WHEN e = 'error' THEN 'timeout: slow' WHEN e = 'purchase' THEN 'unknown: ' ELSE ': ' END AS "错误信息", coalesce(time, '') AS "处理时间" """


@query(
    f"""WITH {REPORT_LOG} SELECT _row, "at" AS item_at, name AS "期刊名称", CASE WHEN "at" = 0 THEN 'H' || k ELSE '' END AS "主办单位", CASE WHEN "at" = 1 THEN 'K' ELSE '' END AS "关键句子",
 '' AS "判断依据", '' AS "来源链接", {STATE} FROM f"""
)
def search_report(t):
    names = t.customer.select(F.col("c_custkey").alias("_row"), F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("journal_name"))
    return reports.report_rows(names, report_log(t), "search")


@query(
    f"""WITH {REPORT_LOG} SELECT _row, "at" AS item_at, name AS "期刊名称", CASE WHEN "at" = 0 THEN 'R' || k ELSE '' END AS "关联单位", CASE WHEN "at" = 1 THEN 'K' ELSE '' END AS "关键句子",
 '' AS "信息位置", CASE WHEN "at" = 0 THEN 'http://own/' || k WHEN n IS NULL THEN 'http://in/' || _row ELSE 'http://l/' || k END AS "来源链接1",
 CASE WHEN n IS NULL THEN 'http://two' ELSE '' END AS "来源链接2", {STATE} FROM f"""
)
def scan_report(t):
    names = t.customer.select(
        F.col("c_custkey").alias("_row"),
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("journal_name"),
        F.concat(F.lit("http://in/"), F.col("c_custkey").cast("string")).alias("url1"),
        F.lit("http://two").alias("url2"),
    )
    return reports.report_rows(names, report_log(t), "scan")


# -- merging and provenance ---------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_name = p_type THEN p_name ELSE p_name || ';' || p_type END || ';' || p_brand AS merged FROM part")
def merged_values(t):
    values = F.array("p_name", F.lit(" "), F.concat(F.lit(" "), "p_type"), F.lit(None), "p_name", "p_brand", F.concat("p_brand", F.lit("\n")))
    return t.part.select("p_partkey", merge_values(values).alias("merged"))


@query(
    f"""WITH {SEARCH_LOG}, l AS (SELECT url, sheet, row, keywords FROM (SELECT url1 AS url, * FROM sl UNION ALL SELECT url2, * FROM sl UNION ALL SELECT url3, * FROM sl) WHERE url <> '')
SELECT url, 0 AS part, (SELECT string_agg(v, chr(10) ORDER BY v) FROM (SELECT DISTINCT sheet AS v FROM l x WHERE x.url = l.url)) AS sheets,
 (SELECT string_agg(CAST(v AS VARCHAR), chr(10) ORDER BY v) FROM (SELECT DISTINCT row AS v FROM l x WHERE x.url = l.url)) AS rows,
 (SELECT string_agg(v, chr(10) ORDER BY v) FROM (SELECT DISTINCT keywords AS v FROM l x WHERE x.url = l.url)) AS keywords
FROM l GROUP BY url"""
)
def provenance(t):
    """Sheets, rows and keywords behind every result URL."""
    search, _ = keyword_logs(t)
    long = reports.unpivot_urls(search, ["url1", "url2", "url3"], ["sheet", "row", "keywords"])
    return reports.url_provenance(long)


@query("SELECT l_orderkey, 0 AS part, string_agg(l_partkey, ',' ORDER BY l_partkey) AS parts FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1")
def order_parts(t):
    return joined_cells(t.lineitem, ["l_orderkey"], "l_partkey", ["l_partkey"], ",", out="parts")


@query(
    LOG + """ SELECT event_type AS source_sheet, event_id AS source_row, key AS source_column, status FROM log"""
)
def source_order(t):
    """Snapshot results in the order of sheet, row and column."""
    log = event_log(t).select(F.col("event_type").alias("source_sheet"), F.col("event_id").alias("source_row"), F.col("key").alias("source_column"), "status")
    return order_by_source(log)
