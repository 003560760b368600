"""Registered queries: each operator over its whole table, as its contract words it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetflow.llm import conversations, decontaminate, fill_in_middle, jaccard, language, mixing, packing, pii, secret_scan, substring_dedup, suffix_dedup, token_counts, topk
from sheetflow.llm.common import span_text, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def checked(sql: str):
    def register(build):
        CHECKS[build.__name__] = sql
        return query(build)

    return register


# Whole tables, in plain SQL: fast enough for small tables, which is what a check needs.
WORDS_SQL = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL.format(text=LOWER_SQL)} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
 ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
t AS (SELECT min(doc_id) AS id, md5(array_to_string(list_sort(s), chr(10))) AS h, any_value(s) AS s FROM s WHERE len(s) > 0 GROUP BY h),
x AS (SELECT id, len(s) AS n, unnest(s) AS g FROM t),
pairs AS (SELECT a.id AS a, b.id AS b, a.n AS n, b.n AS m, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.id <> b.id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * i >= 90 * (n + m - i)),
reach AS (SELECT id AS a, id AS b FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id
FROM s LEFT JOIN t ON t.h = md5(array_to_string(list_sort(s.s), chr(10))) AND len(s.s) > 0 LEFT JOIN c ON c.a = t.id"""

REPEATS_SQL = f"""WITH w AS (SELECT doc_id, {WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
f AS (SELECT s, min(doc_id) AS earliest FROM g GROUP BY s),
hit AS (SELECT DISTINCT doc_id, i + k AS i FROM g JOIN f USING (s), range(13) AS r(k) WHERE earliest < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN hit USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

TOP_K_SQL = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

NORMAL_SQL = r"list_filter(regexp_split_to_array({text}, '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+'), lambda x: x <> '')".format(text=LOWER_SQL)
HITS_SQL = f"""WITH d AS (SELECT doc_id, {NORMAL_SQL} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {NORMAL_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
m AS (SELECT doc_id, i, g.n, item FROM g JOIN win ON win.s = g.s AND win.n = g.n),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM m, range(13) AS r(k) WHERE k < n GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""

FILL_SQL = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS r FROM t),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


def _repair_sql() -> str:
    """Rows as events (i: a turn may be put in), folded into the best cost and audit, as one text, for each of the four states."""
    add = lambda v, w, edit: f"lpad(CAST(CAST(substr({v}, 1, 8) AS INTEGER) + {w} AS VARCHAR), 8, '0') || substr({v}, 9) || '{edit}'"
    v = ["v[1]", "v[2]", "v[3]", "v[4]"]
    after = {2: {"s": [0]}, 3: {"u": [0, 1, 3]}, 4: {"a": [2]}}
    put = {q: [add(v[x], 3, "I") for x in [0, 1, 3] if q == 3] + [add(v[2], 3, "I")] * (q == 4) for q in (1, 2, 3, 4)}
    cut, sound = "CASE e[2] WHEN '3' THEN 3 ELSE 0 END", "e[2] IN ('0', '3')"
    moved = {q: [add(v[q - 1], 4, "D")] for q in (1, 2, 3, 4)}
    for q, ways in after.items():
        for role, before in ways.items():
            for x in before:
                moved[q].append(f"CASE WHEN {sound} AND e[1] = '{role}' THEN {add(v[x], cut, 'K')} END")
                if q > 2:
                    moved[q].append(f"CASE WHEN {sound} THEN {add(v[x], f'3 + {cut}', 'R')} END")
    fold = ", ".join(f"CASE WHEN e = 'i' THEN least({', '.join([v[q - 1], *put[q]])}) ELSE least({', '.join(moved[q])}) END" for q in (1, 2, 3, 4))
    crc = "xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT)), lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 20"
    blank = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, {crc} AS kind FROM g),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
 unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(concat_ws(chr(0), turn IS NULL, coalesce(CAST(turn AS VARCHAR), ''), role, text))) AS i, rtrim(text, {blank}) AS bare FROM d),
f AS (SELECT *, CASE WHEN bare = '' THEN '1' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN '2' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN '3' ELSE '0' END AS fault,
 lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM n),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = '1') AS blank, count(*) FILTER (fault = '2') AS duplicate, count(*) FILTER (fault = '3') AS truncated,
 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, flatten(list(['i', 'i', CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'x' END || fault] ORDER BY i)) || ['i', 'i'] AS events FROM f GROUP BY conv_id),
b AS (SELECT * EXCLUDE events, list_reduce(events, lambda v, e: [{fold}], ['00000000', NULL, NULL, NULL]) AS v FROM c),
a AS (SELECT * EXCLUDE v, CAST(substr(least(v[1], v[4]), 1, 8) AS BIGINT) AS cost, substr(least(v[1], v[4]), 9) AS audit FROM b),
l AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM a),
t AS (SELECT conv_id, substr(audit, p, 1) AS letter, length(replace(audit[1:p], 'I', '')) AS i, length(replace(audit[1:p], 'D', '')) AS place, length(replace(audit, 'D', '')) AS turns FROM l),
w AS (SELECT t.conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - turns) % 2 <> 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS texts
 FROM t JOIN n ON n.conv_id IS NOT DISTINCT FROM t.conv_id AND n.i = greatest(t.i, 1) WHERE letter <> 'D' GROUP BY t.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
 coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(texts, '')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id"""


def _covered(starts: str, stops: str):
    return F.aggregate(F.zip_with(starts, stops, lambda b, e: e - b), F.lit(0).cast("long"), lambda a, x: a + x)


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@checked(JACCARD_SQL)
def op1_ngram_jaccard(spark, folder):
    return jaccard.similar_groups(table(spark, folder, "documents"), rule=jaccard.Rule(3, 90, 100))


@query
def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_best_fit_packing(spark, folder):
    pieces = packing.token_pieces(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))
    return packing.pack(pieces).withColumnRenamed("key", "doc_id")


@checked(REPEATS_SQL)
def op4_substring_dedup(spark, folder):
    found = substring_dedup.repeated_words(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", _covered("starts", "stops").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@checked(TOP_K_SQL)
def op5_exact_top_k(spark, folder):
    rows = table(spark, folder, "embeddings").withColumn("vector", topk.grid_vector(F.col("embedding")))
    return topk.top_k(rows, F.col("vec_id") % 50 == 0)


@query
def op6_secret_scan(spark, folder):
    found = secret_scan.secret_spans(table(spark, folder, "documents"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = span_text(F.col("spans"))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


@query
def op7_personal_data(spark, folder):
    found = pii.personal_spans(table(spark, folder, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base, spans = span_text(F.col("base")), span_text(F.col("spans"))
    return found.select("doc_id", n("email"), n("ip"), n("card"), n("phone"), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


@query
def op8_token_counts(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op9_suffix_dedup(spark, folder):
    found = suffix_dedup.repeated_bytes(table(spark, folder, "documents"))
    runs = F.size("starts").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", _covered("starts", "stops").alias("n_removed"), runs, F.sha2("kept", 256).alias("kept_sha256"))


@checked(HITS_SQL)
def op10_benchmark_decontamination(spark, folder):
    hits = decontaminate.benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.contamination(hits).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@checked(FILL_SQL)
def op11_fill_in_middle(spark, folder):
    made = fill_in_middle.restore(fill_in_middle.fill_in_middle(table(spark, folder, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


@query
def op12_source_mixing(spark, folder):
    found = mixing.taken(mixing.mix(table(spark, folder, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken", F.array_join("pieces", ",").alias("pieces"))


@checked(_repair_sql())
def op13_conversation_repair(spark, folder):
    given = table(spark, folder, "conversations")
    found = conversations.repair(conversations.damaged(given))
    written = F.array_sort(F.collect_list(F.struct("place", F.concat_ws(":", "role", "text").alias("t"))))
    texts = found.turns.groupBy("conv_id").agg(F.array_join(F.transform(written, lambda x: x["t"]), "\n").alias("_text"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = given.select("conv_id").distinct()
    for part in (found.conversations, texts):
        named = part.withColumnRenamed("conv_id", "_id")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256).alias("repaired_sha256"),
    )
