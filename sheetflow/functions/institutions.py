"""Rule-based organisation names: who publishes, hosts or owns a journal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetflow.functions.outcome import has_any
from sheetflow.functions.prose import clean_markdown, first_phrase, markdown_to_plain, split_sentences, usable_sentence
from sheetflow.functions.strings import as_column, let, strip

# Key phrases, in the order they are tried.
KEY_PHRASES = [
    "on behalf of",
    "journal of",
    "publication of",
    "affiliate",
    "edited",
    "own",
    "in association with",
    "responsible",
    "supervise",
    "sponsor",
    "patronage",
    "compile",
    "partnership",
    "societies",
    "in cooperation with",
    "the backing of",
    "administrated",
    "copyright ©",
    "©",
    "press",
    "funded",
]

# Words that mark a kind, kinds in order of priority.
KIND_WORDS = {
    "copyright": ["copyright ©", "©", "all rights reserved", "own"],
    "publisher": ["press", "edited", "compile", "partnership"],
    "host": [
        "journal of",
        "publication of",
        "on behalf of",
        "sponsor",
        "patronage",
        "academy",
        "society",
        "societies",
        "supervise",
        "administrated",
        "responsible",
    ],
}

# Endings of organisation names.
NAME_ENDINGS = [
    r"Inc\.?",
    r"Ltd\.?",
    r"LLC",
    r"Corp\.?",
    r"Co\.?",
    r"Society",
    r"Academy",
    r"Association",
    r"Institute",
    r"University",
    r"Press",
    r"Foundation",
    r"Group",
    r"A/S",
    r"GmbH",
    r"S\.A\.",
    r"PLC",
]

# Words that make a name worthless.
WORTHLESS = ["tools", "submit an article", "connect with", "press room", "network"]

# Patterns of the three name forms.
ROLE = (
    r"sponsor(?:ed)? by|administrat(?:ed)? by|publish(?:ed)? by|own(?:ed)? by|"
    r"in (?:association|cooperation|partnership) with|the backing of|supervis(?:ed)? by|"
    r"responsible for|funded by|compile(?:d)? by"
)
COPYRIGHT_FORM = r"(?:copyright|©)\s*(?:\d{4}[-–—]\d{4})?\s*([A-Z][^.!?;]{5,200}?)(?:\.|$)"
ROLE_FORM = (
    r"(?:(?:official\s+)?(?:journal|publication) of|edited by|on behalf of|" + ROLE + r")"
    r"\s+(?:the\s+)?([A-Z][^.!?;()]{5,100}?)(?:\.|,|\(|$)"
)
ENDING_FORM = r"\b([A-Z][A-Za-z\s&\-,\.]+(?:" + "|".join(NAME_ENDINGS) + r"))\b"
AFTER_NAME = r"\s+(?:aims|seeks|provides|offers|publishes)"
MIN_NAME = {"copyright": 3, "role": 5, "ending": 5}

# What is cut from a name.
CUT_COPYRIGHT = r"^.*?(?:copyright|©)\s*(?:\d{4}[-–—]\d{4})?\s*"
CUT_ROLE = r"^.*?(?:edited by|edited|journal of|publication of|on behalf of|" + ROLE + r")\s+"
CUT_YEAR = r"\b\d{4}\b"
CUT_YEARS = r"\d{4}[-–—]\d{4}"
CUT_RELATED = r"\s+(or|and)\s+related\s+\w+.*$"

# Pattern flags: "\n" as the only line end, Unicode classes; with any case.
_U = "(?dU)"
_IU = "(?idU)"

INSTITUTION = (
    "struct<name:string,type:string,source_sentence:string,matched_keyword:string,"
    "char_position:struct<start:int,end:int>,extraction_method:string>"
)


def clean_institution(name: Column | str, kind: Column | str = "host") -> Column:
    """Name without marks, years, role words and legal tails.

    A copyright name keeps "or related companies"; copyright and publisher
    names keep their commas. A worthless name becomes the empty string.
    """
    kind = F.lit(kind) if isinstance(kind, str) else kind
    text = clean_markdown(name)
    text = F.regexp_replace(text, _IU + CUT_COPYRIGHT, "")
    text = F.regexp_replace(text, _IU + CUT_ROLE, "")
    text = F.regexp_replace(text, _U + CUT_YEAR, "")
    text = F.regexp_replace(text, _U + CUT_YEARS, "")
    owner, listed = kind == "copyright", kind.isin("copyright", "publisher")
    text = let(text, lambda t: F.when(owner, t).otherwise(F.regexp_replace(t, _IU + CUT_RELATED, "")))
    text = let(text, lambda t: F.when(listed, F.regexp_replace(t, _U + r"\s+", " ")).otherwise(F.regexp_replace(t, _U + r"[,;:\s]+", " ")))
    text = F.regexp_replace(F.btrim(text, F.lit(" ,-.")), _U + r"^the\s+", "")
    return let(text, lambda t: F.when(has_any(F.lower(t), WORTHLESS), "").otherwise(strip(t)))


def _kind(lower: Column) -> Column:
    """The first kind of ``KIND_WORDS`` with a word in the text; host if there is none."""
    return F.coalesce(*[F.when(has_any(lower, words), F.lit(kind)) for kind, words in KIND_WORDS.items()], F.lit("host"))


def institution_type(sentence: Column | str, name: Column | str) -> Column:
    """Kind by the words of sentence and name; copyright, then publisher, else host."""
    return _kind(F.lower(F.concat_ws("\n", as_column(sentence), as_column(name))))


def relevant_sentences(c: Column | str) -> Column:
    """``array<struct<sentence,pos,lower,phrase>>``: usable sentences with a key phrase."""
    lowered = F.transform(
        split_sentences(c),
        lambda s: F.struct(s["sentence"].alias("sentence"), s["pos"].alias("pos"), F.lower(s["sentence"]).alias("lower")),
    )
    tagged = F.transform(
        lowered,
        lambda s: F.struct(
            s["sentence"].alias("sentence"),
            s["pos"].alias("pos"),
            s["lower"].alias("lower"),
            first_phrase(s["sentence"], KEY_PHRASES, lower=s["lower"]).alias("phrase"),
        ),
    )
    return F.filter(tagged, lambda s: s["phrase"].isNotNull() & usable_sentence(s["sentence"], s["lower"]))


def _names(sentence: Column, lower: Column) -> Column:
    """(name, type) candidates of one sentence, forms in order.

    A raw name is part of its sentence, so the sentence alone tells its kind.
    """
    kind = _kind(lower)

    def cleaned(raw: Column, form: str, kind: Column) -> Column:
        named = F.transform(raw, lambda r: let(kind, lambda k: F.struct(clean_institution(r, k).alias("name"), k.alias("type"))))
        return F.filter(named, lambda t: F.length(t["name"]) > MIN_NAME[form])

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(sentence, F.lit(pattern), F.lit(1))

    owners = found(_IU + COPYRIGHT_FORM)
    roles = F.transform(found(_IU + ROLE_FORM), lambda r: F.regexp_replace(strip(r), "(?isU)" + AFTER_NAME + ".*$", ""))
    endings = found(_U + ENDING_FORM)
    return F.concat(
        cleaned(owners, "copyright", F.lit("copyright")),
        cleaned(roles, "role", kind),
        cleaned(endings, "ending", kind),
    )


def institution_candidates(c: Column | str) -> Column:
    """Every institution the rules find, in text order, duplicates kept."""
    per_sentence = F.transform(
        relevant_sentences(clean_markdown(c)),
        lambda s: F.transform(
            _names(s["sentence"], s["lower"]),
            lambda n: F.struct(
                n["name"].alias("name"),
                n["type"].alias("type"),
                markdown_to_plain(s["sentence"]).alias("source_sentence"),
                s["phrase"].alias("matched_keyword"),
                F.struct(
                    s["pos"].alias("start"), (s["pos"] + F.length(s["sentence"])).alias("end")
                ).alias("char_position"),
                F.lit("regexp").alias("extraction_method"),
            ),
        ),
    )
    return F.flatten(per_sentence)


def dedupe_contained(items: Column | str, field: str = "name", item_type: str = INSTITUTION) -> Column:
    """Drop an item whose name contains, or is contained in, an earlier kept one."""

    def step(kept: Column, item: Column) -> Column:
        name = F.lower(item[field])
        near = F.exists(kept, lambda k: F.contains(F.lower(k[field]), name) | F.contains(name, F.lower(k[field])))
        return F.when(near, kept).otherwise(F.concat(kept, F.array(item)))

    return F.aggregate(as_column(items), F.array().cast(f"array<{item_type}>"), step)


def extract_institutions(c: Column | str) -> Column:
    """Institutions of a text; texts without any key phrase are not split."""
    text = as_column(c)
    worth_reading = has_any(F.lower(text), KEY_PHRASES)
    found = institution_candidates(F.when(worth_reading, text))
    return F.coalesce(dedupe_contained(found), F.array().cast(f"array<{INSTITUTION}>"))


def extract_auto(model_items: Column | str, rule_items: Column | str) -> Column:
    """``struct<items, method>``: the model's items, or the rules' when it has none."""
    model, rules = as_column(model_items), as_column(rule_items)
    has_model = F.coalesce(F.size(model) > 0, F.lit(False))
    return F.struct(
        F.when(has_model, model).otherwise(rules).alias("items"),
        F.when(has_model, "langextract").otherwise("regexp").alias("method"),
    )
