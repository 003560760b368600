"""Templates, request texts, paths, and judgements of calls."""

from pyspark.sql import functions as F

from sheetflow.functions import links, outcome
from sheetflow.functions.jsontext import decode_unicode, json_from_text, json_items, nested_json, valid_items
from sheetflow.functions.strings import build_keywords, non_empty, prefix_path, render_q, render_rules, render_template, safe_name, sha1_hex, stamp
from sheetflow.operators.keyed import first_seen
from sheetflow.operators.reports import flatten_lookup, lookup_stats, unpivot_urls, url_check, url_order, with_seq
from sheetflow.plans.registry import CHECKS, query


def people(t):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select("c_custkey", F.translate("c_name", "#", "\n").alias("c_name"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"), "n_name")


PEOPLE = """WITH p AS (SELECT c_custkey, replace(c_name, '#', chr(10)) AS c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment, n_name
 FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query(PEOPLE + """ SELECT c_custkey, concat_ws(' ', '"' || replace(c_name, chr(10), ' ') || '"', c_mktsegment, '"' || n_name || '"') AS keywords FROM p""")
def keyword_query(t):
    p = people(t)
    return p.select("c_custkey", build_keywords("B*,C,D*", p.columns).alias("keywords"))


@query(
    PEOPLE
    + """ SELECT c_custkey, trim('"' || n_name || '" ' || coalesce(c_mktsegment, '') || ' site:' || coalesce(c_mktsegment, '')) AS query FROM p
WHERE c_mktsegment IS NOT NULL OR n_name <> ''"""
)
def search_query(t):
    """Nulls and unknown names leave nothing; an empty text is dropped."""
    p = people(t)
    asked = p.select("c_custkey", render_template('"{{n_name}}" {{c_mktsegment}} {{nobody}}site:{{c_mktsegment}} ', p.columns).alias("query"))
    return asked.filter(non_empty("query"))


@query(PEOPLE + """ SELECT c_custkey, 'name of "' || c_name || '"' AS who, coalesce(c_mktsegment, '') AS segment FROM p""")
def rules_rendered(t):
    p = people(t)
    rules = render_rules('{"who": "name of \\"{{c_name}}\\"", "segment": "{{c_mktsegment}}"}', p.columns)
    return p.select("c_custkey", rules.alias("r")).select("c_custkey", F.col("r.who").alias("who"), F.col("r.segment").alias("segment"))


@query(
    """WITH p AS (SELECT p_partkey, p_name || ' *~/é&' || p_brand AS q FROM part)
SELECT p_partkey, 'https://api.example.org/find?q=' || replace(url_encode(q), '%20', '+') || '&n=1' AS url, '{"query":"' || q || '"}' AS body FROM p"""
)
def request_texts(t):
    q = t.part.select("p_partkey", F.concat("p_name", F.lit(" *~/é&"), "p_brand").alias("q"))
    return q.select("p_partkey", render_q("https://api.example.org/find?q={q}&n=1", "q").alias("url"), render_q('{"query":"{q}"}', "q", encode=False).alias("body"))


SNAP_URL = """SELECT page_id, CASE WHEN url LIKE '%/de/%' THEN regexp_replace(url, '[?#].*$', '') || '.PDF?v=1'
  WHEN url LIKE '%/es/%' THEN regexp_replace(url, '[?#].*$', '') || '%2Ejpeg;s=2' ELSE url END AS url FROM pages"""


@query(
    rf"""WITH u AS ({SNAP_URL}), k AS (SELECT page_id, url, sha1(url) AS h,
  CASE WHEN url LIKE '%/de/%' THEN '.pdf' WHEN url LIKE '%/\%2Ejpeg;s=2' ESCAPE '\' THEN '.pdf' WHEN url LIKE '%/es/%' THEN '.jpeg' ELSE '.png' END AS ext FROM u)
SELECT page_id, url, ext <> '.png' AS is_direct, ext, 'http://files.example.org/' || h[1:2] || '/' || h[3:4] || '/' || h[5:] || ext AS path FROM k"""
)
def snapshot_paths(t):
    bare = F.regexp_replace("url", "[?#].*$", "")
    made = (
        F.when(F.contains("url", F.lit("/de/")), F.concat(bare, F.lit(".PDF?v=1")))
        .when(F.contains("url", F.lit("/es/")), F.concat(bare, F.lit("%2Ejpeg;s=2")))
        .otherwise(F.col("url"))
    )
    u = t.pages.select("page_id", made.alias("url")).withColumn("k", links.download_kind("url"))
    path = prefix_path("http://files.example.org/", links.snapshot_path("url", F.col("k.ext")))
    return u.select("page_id", "url", "k.is_direct", "k.ext", path.alias("path"))


@query(
    """SELECT event_id, replace(replace(event_type || ' of ' || props, ' ', '_'), '/', '_') AS name, strftime(ts, '%y%m%d.%H%M%S') AS stamp, sha1(props) AS digest
FROM events"""
)
def file_names(t):
    return t.events.select("event_id", safe_name(F.concat_ws(" of ", "event_type", "props")).alias("name"), stamp("ts").alias("stamp"), sha1_hex("props").alias("digest"))


@query(
    """WITH s AS (SELECT page_id AS _row, CASE WHEN url LIKE '%/fr/%' THEN 'ftp' || url ELSE ' ' || url END AS a, regexp_replace(url, '[?#].*$', '') AS b FROM pages),
l AS (SELECT _row, 1 AS pos, 'a' AS "column", trim(a) AS url FROM s UNION ALL SELECT _row, 2, 'b', b FROM s)
SELECT url, _row, pos, "column" FROM l WHERE regexp_matches(url, '^https?://')
QUALIFY row_number() OVER (PARTITION BY url ORDER BY _row, pos) = 1"""
)
def url_inventory(t):
    """Distinct http URLs of two columns, with the cell that had them first."""
    raw = F.when(F.contains("url", F.lit("/fr/")), F.concat(F.lit("ftp"), "url")).otherwise(F.concat(F.lit(" "), "url"))
    sheet = t.pages.select(F.col("page_id").alias("_row"), raw.alias("a"), F.regexp_replace("url", "[?#].*$", "").alias("b"))
    long = unpivot_urls(sheet, ["a", "b"], http_only=True).withColumn("pos", url_order(["a", "b"]).cast("int"))
    return first_seen(long, "url", ["_row", "pos"]).select("url", "_row", "pos", "column")


@query("SELECT page_id, CASE WHEN regexp_matches(u, '^https?://') THEN u ELSE '' END AS url FROM (SELECT page_id, CASE WHEN url LIKE 'https:%' THEN url ELSE replace(url, 'http', 'gopher') END AS u FROM pages)")
def url_or_blank(t):
    u = F.when(F.col("url").startswith("https:"), F.col("url")).otherwise(F.replace("url", F.lit("http"), F.lit("gopher")))
    return t.pages.select("page_id", links.only_http(u).alias("url"))


# -- outcomes -----------------------------------------------------------------

MESSAGES = {
    "click": "Rate limit reached, ",
    "view": "Read timed out after ",
    "signup": "net::ERR Connection refused ",
    "purchase": "HTTP 404 unauthorized ",
    "error": "Malformed address ",
}


def by_type(choices: dict[str, str], column="event_type"):
    out = F.lit(None).cast("string")
    for k, v in choices.items():
        out = F.when(F.col(column) == k, F.expr(v)).otherwise(out)
    return out


def sql_by_type(choices: dict[str, str]) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in choices.items()) + " END"


MESSAGE = {k: f"concat('{v}', props, repeat('x', 200))" for k, v in MESSAGES.items()}


@query(
    f"""WITH m AS (SELECT event_id, {sql_by_type(MESSAGE)} AS m FROM events), l AS (SELECT *, lower(m) AS l FROM m)
SELECT event_id,
 CASE WHEN regexp_matches(l, 'rate|limit|429') THEN 'rate_limit' WHEN regexp_matches(l, 'timeout|timed out') THEN 'timeout'
      WHEN regexp_matches(l, 'connection|network') THEN 'network_error' WHEN regexp_matches(l, 'auth|unauthorized|401') THEN 'auth_error' ELSE 'unknown_error' END AS model_error,
 CASE WHEN regexp_matches(m, 'net::|NS_ERROR') THEN 'network_error' WHEN regexp_matches(m, 'HTTP|404|500') THEN 'http_error'
      WHEN regexp_matches(l, 'invalid|malformed') THEN 'invalid_url' ELSE 'unknown' END AS fetch_error,
 m[1:200] AS fetch_message,
 regexp_matches(l, 'read timed out|timeout|connection error|connection timeout|connection refused|network is unreachable|name resolution failed|connection aborted|connection reset') AS retry
FROM l"""
)
def error_classes(t):
    m = t.events.select("event_id", by_type(MESSAGE).alias("m"))
    f = outcome.classify_fetch_error("m")
    return m.select(
        "event_id",
        outcome.classify_llm_error("m").alias("model_error"),
        f["error_type"].alias("fetch_error"),
        f["error_message"].alias("fetch_message"),
        outcome.is_network_error("m").alias("retry"),
    )


@query(
    """SELECT page_id, length(html) / 1000000.0::DOUBLE * 2.75::DOUBLE + length(url) / 1000000.0::DOUBLE * 22.0::DOUBLE AS cost,
  round(strlen(html) / 1024.0::DOUBLE, 2) AS size_kb FROM pages"""
)
def call_costs(t):
    return t.pages.select(
        "page_id",
        outcome.token_cost(F.length("html"), F.length("url"), 2.75, 22.0).alias("cost"),
        outcome.size_kb(F.octet_length("html")).alias("size_kb"),
    )


STATUS = {"click": "200", "view": "200", "signup": "500", "purchase": "500", "error": "404"}
BODY = {
    "click": "props",
    "view": "concat('[', props, ']')",
    "signup": """concat('{"k": "", "n": ', CASE WHEN value > 50 THEN '[]' ELSE '0' END, '}')""",
    "purchase": "concat(props, ' tail')",
    "error": "'gone'",
}


@query(
    f"""WITH r AS (SELECT event_id, value, CAST({sql_by_type(STATUS)} AS INTEGER) AS s, {sql_by_type(BODY)} AS b, event_type AS e FROM events),
c AS (SELECT *, (e = 'click' OR (e = 'signup' AND value <= 50)) AS ok FROM r)
SELECT event_id, ok, CASE WHEN ok THEN NULL WHEN s = 200 THEN 'JSON 解析失败. 响应内容: ' || b[1:500] ELSE 'HTTP ' || s || ': ' || b[1:500] END AS error,
 e = 'click' AS has_key, CASE WHEN s <> 200 THEN 'HTTP状态码错误: ' || s WHEN e = 'view' THEN '响应JSON中缺少期望的键: ''k''' END AS key_reason,
 s = 200 AND regexp_matches(b, '[5-9]\\}}') AS has_word FROM c"""
)
def response_check(t):
    r = t.events.select("event_id", by_type(STATUS).cast("int").alias("s"), by_type(BODY).alias("b"))
    ok, key = outcome.response_ok("s", "b"), outcome.validate_response("s", "b", key=F.lit("k"))
    word = outcome.validate_response("s", "b", regex=F.lit("[5-9]\\}"))
    return r.select(
        "event_id", ok["ok"].alias("ok"), ok["error"].alias("error"), key["ok"].alias("has_key"), key["reason"].alias("key_reason"), word["ok"].alias("has_word")
    )


@query(
    """SELECT event_id AS "序号", 'http://h.example.org/' || user_id AS "URL",
 CASE WHEN event_type = 'view' THEN 'https://h.example.org/' || user_id ELSE 'http://h.example.org/' || user_id END AS "最终URL",
 CASE WHEN event_type IN ('view', 'click') THEN '成功' ELSE '失败' END AS "成功状态",
 CASE event_type WHEN 'error' THEN 'N/A' WHEN 'signup' THEN '404' WHEN 'purchase' THEN '503' ELSE '200' END AS "响应状态码",
 CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE round(floor(value * 1000) / 1024.0::DOUBLE, 2) END AS "响应体大小(KB)",
 CASE event_type WHEN 'error' THEN 'ConnectTimeout: ' || props WHEN 'signup' THEN 'Not Found' WHEN 'purchase' THEN '' ELSE '' END AS "错误原因" FROM events"""
)
def url_checks(t):
    e = t.events
    kind = F.col("event_type")
    url = F.concat(F.lit("http://h.example.org/"), F.col("user_id").cast("string"))
    failed = kind == "error"
    responses = e.select(
        F.col("event_id").alias("seq"),
        url.alias("url"),
        F.when(kind == "view", F.replace(url, F.lit("http:"), F.lit("https:"))).alias("final_url"),
        F.when(kind == "signup", 404).when(kind == "purchase", 503).when(~failed, 200).alias("status_code"),
        F.when(~failed, F.floor(F.col("value") * 1000)).alias("size_bytes"),
        F.when(kind == "signup", "Not Found").alias("reason"),
        F.when(failed, F.concat(F.lit("ConnectTimeout: "), "props", F.lit("\ntrace"))).alias("error"),
    )
    return url_check(responses)


# -- JSON ---------------------------------------------------------------------

REPLY = {
    "click": "concat('  [', props, ', {\"w\": 1}, {\"k\": null, \"w\": 2}]')",
    "view": "props",
    "signup": "concat('Here:\n```json\n[', props, ']\n```\nand ```\n{\"k\": 0}```')",
    "purchase": "concat('It is [ ', props, ' ] I think [1]')",
    "error": "CASE WHEN value > 50 THEN concat('so ', props, ' then') ELSE concat('{broken ', replace(props, '\"', '')) END",
}


@query(
    f"""WITH r AS (SELECT event_id, {sql_by_type(REPLY)} AS reply FROM events),
c AS (SELECT event_id, trim(reply) AS whole, list_transform(regexp_extract_all(reply, '```(?:json)?\\s*((?s:.)*?)```', 1), lambda x: trim(x, ' ' || chr(10))) AS fenced,
   regexp_extract_all(reply, '\\[\\s*\\{{(?s:.)*?\\}}\\s*\\]') AS arrays, regexp_extract_all(reply, '\\{{\\s*"(?s:.)*?\\}}') AS objects FROM r),
f AS (SELECT event_id, coalesce(CASE WHEN json_valid(whole) AND whole[1:1] IN ('[', '{{') THEN whole END,
   list_filter(fenced, lambda x: json_valid(x))[1], list_filter(arrays, lambda x: json_valid(x))[1], list_filter(objects, lambda x: json_valid(x))[1]) AS j FROM c),
i AS (SELECT event_id, CASE WHEN j[1:1] = '{{' THEN '[' || j || ']' ELSE j END AS found FROM f),
x AS (SELECT event_id, found, unnest(CAST(json_extract(found, '$[*]') AS JSON[])) AS item FROM i WHERE found IS NOT NULL)
SELECT event_id, found, item->>'k' AS k FROM x WHERE list_contains(json_keys(item), 'k')"""
)
def reply_items(t):
    """JSON items inside model replies that have the required field."""
    r = t.events.select("event_id", json_from_text(by_type(REPLY)).alias("found"))
    return r.select("event_id", "found", F.explode(valid_items(json_items("found"), ["k"])).alias("i")).select("event_id", "found", F.col("i")["k"].alias("k"))


@query(CHECKS["reply_items"].replace("WHERE list_contains(json_keys(item), 'k')", "WHERE length(item->>'k') > 1"))
def replies_checked(t):
    """The same with a test of the caller's own in place of the required field."""
    r = t.events.select("event_id", json_from_text(by_type(REPLY)).alias("found"))
    long = lambda item: F.coalesce(F.length(F.try_element_at(item, F.lit("k"))) > 1, F.lit(False))
    kept = valid_items(json_items("found"), [], validator=long)
    return r.select("event_id", "found", F.explode(kept).alias("i")).select("event_id", "found", F.col("i")["k"].alias("k"))


@query("SELECT doc_id, length(text) AS n, md5(text) AS digest FROM documents")
def unicode_text(t):
    """Documents whose accents were written as escapes read as before."""
    escaped = F.replace(F.replace("text", F.lit("é"), F.lit("\\u00e9")), F.lit("ü"), F.lit("\\u00fc"))
    d = t.documents.select("doc_id", decode_unicode(escaped).alias("text"))
    return d.select("doc_id", F.length("text").alias("n"), F.md5("text").alias("digest"))


@query(
    """SELECT event_id, 0 AS at, event_type AS name, json_extract_string(props, '$.k') AS k FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, 1, 'second "one"', NULL FROM events WHERE event_type NOT IN ('error', 'view')"""
)
def nested_posts(t):
    """A list inside a JSON text inside a JSON text."""
    one = F.struct(F.col("event_type").alias("name"), F.get_json_object("props", "$.k").alias("k"))
    two = F.struct(F.lit('second "one"').alias("name"), F.lit(None).cast("string").alias("k"))
    posts = F.when(F.col("event_type") == "view", F.array(one)).otherwise(F.array(one, two))
    inner = F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(F.to_json(F.struct(posts.alias("blog_posts"))))
    outer = t.events.select("event_id", F.to_json(F.struct(inner.alias("ai_response"))).alias("body"))
    rows = outer.select("event_id", F.posexplode(nested_json("body", "ai_response", "blog_posts")).alias("at", "p"))
    return rows.select("event_id", "at", F.try_element_at("p", F.lit("name")).alias("name"), F.try_element_at("p", F.lit("k")).alias("k"))


ANSWER = {
    "click": """concat('{"code": 0, "data": {"users": [{"name": "N', user_id, '", "user_id": "u', user_id, '"}, {"name": "M"}]}}')""",
    "view": """'{"code": "0", "data": {"users": []}}'""",
    "signup": """'{"code": 7, "msg": "no"}'""",
    "purchase": "'<html>'",
    "error": """'{"code": "0", "data": null}'""",
}
FLAT = """WITH f AS (SELECT event_id AS input, 'N' || user_id AS name, 'u' || user_id AS user_id, 'ok' AS outcome FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'M', '', 'ok' FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, '【无匹配】', '', 'no_match' FROM events WHERE event_type IN ('view', 'error')
UNION ALL SELECT event_id, '【调用失败】', '', 'fail' FROM events WHERE event_type IN ('signup', 'purchase'))"""


def answers(t):
    return flatten_lookup(t.events.select(F.col("event_id").alias("input"), by_type(ANSWER).alias("response")))


@query(FLAT + " SELECT * FROM f")
def lookup_rows(t):
    return answers(t)


@query(FLAT + " SELECT outcome, count(DISTINCT input) AS n FROM f GROUP BY outcome")
def lookup_outcomes(t):
    return lookup_stats(answers(t))


@query('SELECT page_id AS _row, url, page_id AS "序号" FROM pages')
def numbered_urls(t):
    return with_seq(t.pages.select(F.col("page_id").alias("_row"), "url"))
