"""Page and prose columns: markup removal, sentences, sentence tests."""

from __future__ import annotations

import html
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetflow.functions.strings import BLANK, BLANKS, as_column, let, running_sums, strip

# Flags: Unicode classes, and "\n" as the only line end.
_U = "(?dU)"

# Markup patterns, applied in this order, each with a text that
# it cannot do without.
MARKDOWN = [
    ("[", r"\[([^\]]+)\]\([^\)]+\)", "$1"),
    ("**", r"\*\*([^\*]+)\*\*", "$1"),
    ("*", r"\*([^\*]+)\*", "$1"),
    ("`", r"`([^`]+)`", "$1"),
    ("<", r"<[^>]+>", ""),
]

# Elements that end a paragraph of a page.
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|"
    "hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)

# Sentence limits, in characters.
MIN_SENTENCE = 10
MAX_SENTENCE = 800

# Marks of a navigation, list or button line (lower case).
NOISE_STARTS = [r"[\+\-\*]\s+", r"\d+\.\s+", r"##\s+"]
NOISE_WORDS = [
    "browse",
    "current issue",
    "early view",
    "accepted articles",
    "subscribe",
    "alert",
    "rss",
    "facebook",
    "twitter",
    "x channel",
    "submit an article",
    "journal metrics",
    "png)",
    "jpg)",
    "gif)",
]
NOISE_SEPARATORS = [" + ", " - "]
NOISE_SEPARATOR_LIMIT = 3

# Sentence ends, and the gap between paragraphs.
SENTENCE_END = r"[。！？!?]\s+|(?<=[a-z])\.\s+(?=[A-Z])|(?<=[A-Z][a-z]{2})\.\s+"
PARAGRAPH_GAP = r"\n\s*\n"


def clean_markdown(c: Column | str) -> Column:
    """Text without markup; a pattern only runs over texts that have its mark."""

    def without(mark: str, pattern: str, kept: str):
        return lambda t: F.when(F.contains(t, F.lit(mark)), F.regexp_replace(t, pattern, kept)).otherwise(t)

    text = as_column(c)
    for step in MARKDOWN:
        text = let(text, without(*step))
    return text


def collapse(c: Column | str) -> Column:
    """Every run of blanks becomes one space; ends trimmed."""
    return strip(F.regexp_replace(as_column(c), r"(?U)\s+", " "))


def markdown_to_plain(c: Column | str) -> Column:
    """One line of plain text."""
    return collapse(clean_markdown(c))


# A character reference, as html.unescape finds it.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.arrow_udf(T.MapType(T.StringType(), T.StringType()))
def resolve_references(found: pa.Array) -> pa.Array:
    """Character references with what they stand for, by the table of the HTML standard."""
    known = [None if refs is None else [(r, html.unescape(r)) for r in refs] for refs in found.to_pylist()]
    return pa.array(known, pa.map_(pa.string(), pa.string()))


def unescape_entities(c: Column | str) -> Column:
    """Text with its character references resolved; Python gets the references alone, not the text around them."""

    def references(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))

    def resolved(text: Column, known: Column) -> Column:
        # the text is cut at its references; each piece but the last has one behind it
        pieces = F.zip_with(F.split(text, _REFERENCE), references(text), lambda p, r: F.concat(p, F.coalesce(known[r], F.lit(""))))
        return F.when(known.isNull(), text).otherwise(F.array_join(pieces, ""))

    text = as_column(c)
    known = resolve_references(let(text, lambda t: F.when(F.contains(t, F.lit("&")), F.array_distinct(references(t)))))
    return let(F.struct(text.alias("text"), known.alias("known")), lambda x: resolved(x["text"], x["known"]))


# An opening tag from its name on, with ">" in quoted attributes.
_ATTRIBUTES = r"""(?:\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+)?>"""


def html_to_text(c: Column | str, paragraphs: bool = False, marks: bool = False) -> Column:
    """Text of a page without scripts, styles, comments and tags.

    Tags fall away in the JVM, with ``>`` in quoted attributes; a script or
    style that is not closed goes on to the end. Python only resolves character
    references, and only gets those, never a text. With ``paragraphs`` block elements leave an
    empty line, so that sentences do not run across them. ``marks`` also writes
    list items as ``- item`` and headings as ``## heading``, which is how
    :func:`is_noise` knows them.
    """
    text, paragraphs = as_column(c), paragraphs or marks
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<script\b.*?(?:</script\s*>|\z)", " ")
    text = F.regexp_replace(text, r"(?is)<style\b.*?(?:</style\s*>|\z)", " ")
    if paragraphs:
        text = F.regexp_replace(text, r"\s+", " ")
        if marks:
            text = F.regexp_replace(text, "(?i)<li" + _ATTRIBUTES, "\n\n- ")
            for level in range(1, 7):
                text = F.regexp_replace(text, f"(?i)<h{level}" + _ATTRIBUTES, "\n\n" + "#" * level + " ")
        text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCK_TAGS})(?:\s[^>]*)?/?>", "\n\n")
    # an attribute whose quote is not closed: the tag ends at the next >
    text = F.regexp_replace(text, r"""</?[A-Za-z!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>""", " ")
    text = F.regexp_replace(text, r"</?[A-Za-z!?][^>]*>", " ")
    text = unescape_entities(text)
    if not paragraphs:
        return collapse(text)
    text = F.regexp_replace(text, r"(?U)[\s&&[^\n]]+", " ")
    return strip(F.regexp_replace(text, r" ?\n[ \n]*", "\n\n"))


# Stands between sentences while a text is cut; where a text has it itself,
# another character takes its place for that time.
_MARK, _STAND_IN = "\uffff", "\ufffe"

# The end marks of SENTENCE_END that not every script has.
_WIDE_ENDS = "。！？"


def _ends(marks: str) -> str:
    """SENTENCE_END with the mark first and what stands before it after that, so that most characters are passed at once."""
    return rf"[{marks}](?:(?<!\.)|(?<=[A-Z][a-z]{{2}}\.)|(?<=[a-z]\.)(?={BLANK}++[A-Z])){BLANK}++"


def split_sentences(c: Column | str) -> Column:
    """``array<struct<sentence,pos>>`` of the sentences longer than ten characters.

    Paragraph gaps and sentence ends are marked off and the text is split
    there; the running lengths of the pieces are their places. ``pos`` is the
    offset of the sentence in the whole text.
    """

    def placed(text: Column, piece: Column, begin: Column) -> Column:
        pos = begin + F.length(piece) - F.length(F.ltrim(piece, F.lit(BLANKS)))
        bare = F.btrim(piece, F.lit(BLANKS))
        own = F.when(F.contains(bare, F.lit(_STAND_IN)), F.substring(text, pos + 1, F.length(bare))).otherwise(bare)
        return F.struct(own.alias("sentence"), pos.alias("pos"))

    def cut(text: Column) -> Column:
        marked = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, _STAND_IN)).otherwise(text)
        marked = F.regexp_replace(marked, PARAGRAPH_GAP.replace(r"\s", BLANK), f"{_MARK}$0{_MARK}")
        wide = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in _WIDE_ENDS])
        cut_at = lambda t, marks: F.regexp_replace(t, _ends(marks), f"$0{_MARK}")
        marked = let(marked, lambda t: F.when(wide, cut_at(t, ".!?" + _WIDE_ENDS)).otherwise(cut_at(t, ".!?")))

        def sentences(pieces: Column) -> Column:
            starts = running_sums(F.transform(pieces, F.length))
            found = let(starts, lambda at: F.transform(pieces, lambda p, i: placed(text, p, F.get(at, i))))
            return F.filter(found, lambda s: F.length(s["sentence"]) > MIN_SENTENCE)

        return let(F.split(marked, _MARK), sentences)

    return let(as_column(c), cut)


def is_noise(c: Column | str, lower: Column | None = None) -> Column:
    """Navigation, list and button lines. ``lower`` saves computing it again."""
    text = as_column(c)
    low = F.lower(text) if lower is None else lower
    hit = text.rlike(_U + r"^\s*(?:" + "|".join(NOISE_STARTS) + ")")
    for word in NOISE_WORDS:
        hit = hit | F.contains(low, F.lit(word))
    for separator in NOISE_SEPARATORS:
        count = (F.length(text) - F.length(F.replace(text, F.lit(separator)))) / len(separator)
        hit = hit | (count > NOISE_SEPARATOR_LIMIT)
    return hit


def usable_sentence(c: Column | str, lower: Column | None = None) -> Column:
    """Length limits, and no noise."""
    size = F.length(as_column(c))
    return (size > MIN_SENTENCE) & (size <= MAX_SENTENCE) & ~is_noise(c, lower)


def first_phrase(c: Column | str, phrases: list[str], whole_word: bool = False, lower: Column | None = None) -> Column:
    """First phrase of the ordered list that the text contains, in any case."""
    low = F.lower(as_column(c)) if lower is None else lower

    def hit(p: str) -> Column:
        return low.rlike(rf"(?U)\b\Q{p}\E\b") if whole_word else F.contains(low, F.lit(p))

    return F.coalesce(*[F.when(hit(p.lower()), F.lit(p)) for p in phrases])
