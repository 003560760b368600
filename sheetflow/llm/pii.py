"""Personal data: patterns, and terms that disclose whom a text is about.

Patterns find the protected entities (addresses, numbers). The corpus then says
which other terms reveal them: a term t discloses an entity e by its pointwise
mutual information log(P(t, e) / (P(t) P(e))), which is at most the entity's
information -log P(e), reached when t occurs with e only. Terms whose share of
that information exceeds a threshold are found as well.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetflow.functions.strings import let, running_sums
from sheetflow.llm.common import stored
from sheetflow.operators.keyed import lookup, quoted


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The checksum of card numbers: from the right, every second digit is doubled, its digits summed."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = 2 * d
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _part_fits(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(short) <= 3) & (F.coalesce(F.substring(short, 1, 3).cast("int"), F.lit(999)) <= 255)


@dataclass(frozen=True)
class Kind:
    """Leftmost non-overlapping matches of ``pattern`` that ``keep`` accepts; ``hint`` must occur in the text."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    keep: Callable[[Column], Column]


# The patterns are fixed values. They are written so that no text takes more
# than linear time: a match is tried at the start of a run or right after the
# last match only, and what cannot be given back is possessive.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"),
        lambda m: F.lit(True),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        lambda m: F.forall(F.split(m, r"\."), _part_fits),
    ),
    Kind(
        "card",
        # shorter runs of digits are no cards, so they need not be matched
        r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+",
        lambda t: t.rlike("[0-9]"),
        lambda m: (F.length(_digits(m)) <= 19) & luhn(_digits(m)),
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: t.contains("+"),
        lambda m: F.length(_digits(m)).between(8, 15),
    ),
)

SPAN = "struct<kind:string,start:int,stop:int,value:string>"


def _places(pieces: Column, hits: Column, kind: str) -> Column:
    """Spans of ``hits``, which stand between consecutive ``pieces``; offsets in characters."""
    both = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(a, x):
        begin = a["at"] + x["gap"]
        end = begin + F.length(x["m"])
        one = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("stop"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(one)).alias("spans"))

    return F.aggregate(both, start, step, lambda a: a["spans"])


def pattern_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds=KINDS) -> DataFrame:
    """Key, text and spans (kind, start, stop, value), by kind as listed and then by start.

    Null text counts as empty. One row per row of ``docs``; other columns are
    left out. Offsets count code points.
    """
    rows = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast(f"array<{SPAN}>")
    for kind in kinds:
        # possible matches first: most texts have none, and only those that do are taken apart
        rows = rows.withColumn("hits", F.when(kind.hint(F.col("text")), F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))))
        some = F.size(F.filter("hits", kind.keep)) > 0
        spans = _places(F.split("text", kind.pattern, -1), F.col("hits"), kind.name)
        rows = rows.withColumn(kind.name, F.when(some, F.filter(spans, lambda s: kind.keep(s["value"]))).otherwise(none)).drop("hits")  # noqa: B023
    return rows.select("key", "text", F.concat(*[F.col(k.name) for k in kinds]).alias("spans"))


# A term: a run of letters and digits, of one character or more.
TERM = r"[\p{L}\p{N}]++"


def _terms(text: Column) -> Column:
    """The terms of a text, found in the text as it is and then lowered one by one, for lowering may change lengths."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def _term_spans(text: Column, terms: Column) -> Column:
    """Where a text has one of the terms. Places are running sums of the pieces' lengths, so the work grows with the text."""

    def placed(words: Column, gaps: Column) -> Column:
        widths = F.zip_with(F.slice(gaps, 1, F.size(words)), words, lambda g, w: F.length(g) + F.length(w))
        ends = let(running_sums(widths), lambda at: F.zip_with(at, widths, lambda a, w: a + w))
        spans = F.zip_with(words, ends, lambda w, e: F.struct(F.lit("term").alias("kind"), (e - F.length(w)).alias("start"), e.alias("stop"), w.alias("value")))
        return F.filter(spans, lambda s: F.array_contains(terms, F.lower(s["value"])))

    return let(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda words: let(F.split(text, TERM, -1), lambda gaps: placed(words, gaps)))


def disclosing_terms(docs: DataFrame, holders: DataFrame, text: str = "text", threshold: float = 0.9, support: int = 3) -> DataFrame:
    """Terms that disclose an entity: entity, term, joint (documents with both), information (share of -log P(entity)).

    ``holders``: texts with an entity and their ``entities``, from
    ``personal_spans``. All rows of ``docs`` count for the probabilities. A
    pair needs ``support`` different texts: copies, also with other case, spaces
    or signs, are one piece of evidence. What a template says beside the term
    does not matter. The terms of the entity itself are none.
    """
    each = holders.select("text", F.explode("entities").alias("entity"))
    often = each.groupBy("entity").agg(F.count("text").alias("n_entity")).filter(F.col("n_entity") >= support)
    asked = lookup(each, often, "entity", "inner").withColumn("words", _terms(F.col("text")))
    own = _terms(F.regexp_replace("entity", "^[a-z]+:", ""))
    # hashed before the words become rows: beside an explode it would be worked out for each of them
    named = asked.select("entity", "n_entity", F.xxhash64("words").alias("same"), F.array_except("words", own).alias("others"))
    around = named.select("entity", "n_entity", "same", F.explode("others").alias("term"))
    counted = around.groupBy("entity", "n_entity", "term", "same").agg(F.count("same").alias("n"))
    joint = counted.groupBy("entity", "n_entity", "term").agg(F.sum("n").alias("joint"), F.count("n").alias("texts"))
    joint = joint.filter(F.col("texts") >= support)
    joint = stored(joint.select("entity", "n_entity", "term", "joint"), "terms")
    if joint.isEmpty():
        return joint.select("entity", "term", "joint", F.lit(1.0).alias("information"))
    # document counts of the candidates over the whole corpus
    everywhere = docs.select(F.explode(F.array_distinct(_terms(quoted(text)))).alias("term"))
    # counted before the join: tasks send their vocabulary, not every word
    n_term = everywhere.groupBy("term").agg(F.count("term").alias("n_term"))
    n_all = docs.count()
    share = 1 - F.log(F.col("n_term") / F.col("joint")) / F.log(F.greatest(F.lit(n_all), F.col("n_entity") + 1) / F.col("n_entity"))
    scored = joint.join(n_term, "term").withColumn("information", share)
    return scored.filter(F.col("information") >= threshold).select("entity", "term", "joint", "information")


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Key, base (pattern spans), spans (base and then the terms that disclose an entity of the same text), and the text if it has any.

    Takes ``threshold`` and ``support`` of ``disclosing_terms``. One row per row
    of ``docs``; keys may repeat or be null. The texts are read once for the
    patterns; what was found is written to the shared folder, with the text of
    those rows only that have a span.
    """
    found = pattern_spans(docs, key, text)
    found = stored(found.select("key", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text")), "spans")
    entities = F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["value"])))
    held = found.filter(F.size("spans") > 0).withColumn("entities", entities)
    terms = disclosing_terms(docs, held, text, **limits)
    digest = F.sha2("text", 256)
    pairs = held.select(digest.alias("digest"), F.explode("entities").alias("entity")).distinct()
    by_text = lookup(pairs, terms.groupBy("entity").agg(F.collect_set("term").alias("terms")), "entity", "inner")
    by_text = by_text.groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
    rows = lookup(held.withColumn("digest", digest), by_text, "digest")
    more = F.when(F.col("terms").isNotNull(), _term_spans(F.col("text"), F.col("terms")))
    apart = F.filter(more, lambda s: ~F.exists("spans", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    extra = F.coalesce(apart, F.array().cast(f"array<{SPAN}>"))
    with_terms = rows.select("key", F.col("spans").alias("base"), F.concat("spans", extra).alias("spans"), "text")
    plain = found.filter(F.size("spans") == 0).select("key", F.col("spans").alias("base"), "spans", "text")
    return plain.unionByName(with_terms).withColumnRenamed("key", key)


def sanitise(text: str = "text") -> Column:
    """The text of a row of ``personal_spans``, entities generalised to their kind and disclosing terms removed."""
    body = quoted(text)
    places = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("b"), s["stop"].alias("e"), s["kind"].alias("k"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a, s):
        mark = F.when(s["k"] == "term", F.lit("")).otherwise(F.concat(F.lit("["), s["k"], F.lit("]")))
        new = F.concat(a["out"], F.substring(body, a["at"] + 1, s["b"] - a["at"]), mark)
        return F.struct(
            F.when(s["b"] >= a["at"], new).otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["e"]).alias("at")
        )

    return F.aggregate(places, start, step, lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body))))
