"""String columns: trimming, templates, keyword text, request text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank at the ends of a cell, by rule.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

def _ranges(characters: str) -> str:
    """The characters as the ranges of a class, which costs less than one by one."""
    codes = sorted(map(ord, characters))
    begins = [c for c in codes if c - 1 not in codes]
    return "".join(f"\\x{{{b:x}}}-\\x{{{e:x}}}" for b, e in zip(begins, (c for c in codes if c + 1 not in codes), strict=True))


# One blank, and one character that is none, for Java patterns.
BLANK = f"[{_ranges(BLANKS)}]"
_INK = f"[^{_ranges(BLANKS)}]"
# Values whose sums are taken one after the other.
RUN = 64
_VAR = re.compile(r"\{\{(\w+)\}\}")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column | str) -> Column:
    """Trim every kind of blank, not only the space."""
    return F.btrim(as_column(c).cast("string"), F.lit(BLANKS))


def cell(c: Column | str) -> Column:
    """Trimmed text of a cell; a null becomes the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def filled(c: Column | str) -> Column:
    """Trimmed text of a cell; blank text becomes null."""
    return F.nullif(strip(c), F.lit(""))


def non_empty(c: Column | str) -> Column:
    """Filter: the text has something besides blanks; stops at the first such character."""
    return F.coalesce(as_column(c).rlike(_INK), F.lit(False))


def sha1_hex(c: Column | str) -> Column:
    return F.sha1(F.encode(as_column(c), "UTF-8"))


def running_sums(values: Column) -> Column:
    """Sum of all values before each one, over an array of numbers.

    The values are taken in blocks of ``RUN``: the sums before whole blocks, by
    blocks of blocks, then those inside a block. So the work grows with the
    length, up to some millions of values.
    """

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def before(xs: Column, base: Column) -> Column:
        return F.transform(xs, lambda _, i: base + total(F.slice(xs, F.lit(1), i)))

    def summed(xs: Column, depth: int) -> Column:
        if not depth:
            return before(xs, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(RUN)), lambda at: F.slice(xs, at, F.lit(RUN)))
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, let(F.transform(bs, total), lambda sums: summed(sums, depth - 1)), before)))

    return F.when(F.size(values) > 0, let(values, lambda xs: summed(xs, 2))).otherwise(F.array().cast("array<int>"))


# -- column letters -----------------------------------------------------------


def col_index(letters: str, base: int = 0) -> int:
    """``A`` is 0 (or 1 with ``base=1``), ``AA`` follows ``Z``."""
    text = letters.strip().upper()
    if not re.fullmatch("[A-Z]+", text):
        raise ValueError(f"not a column letter: {letters!r}")
    position = 0
    for ch in text:
        position = position * 26 + (ord(ch) - 64)
    return position - 1 + base


def keyword_columns(spec: str, columns: list[str], names: bool = False) -> list[tuple[str, bool]]:
    """``"C*,D"`` as (column name, quoted) pairs.

    The entries are column letters, whatever the columns are called; with
    ``names`` they are column names instead. Letters beyond the table are
    passed over, an unknown name is an error.
    """
    found = []
    for token in filter(None, (t.strip() for t in spec.split(","))):
        quoted = token.endswith("*")
        token = token.rstrip("*")
        if names:
            if token not in columns:
                raise ValueError(f"no column {token!r}; there are {columns}")
            found.append((token, quoted))
            continue
        at = col_index(token)
        if at < len(columns):
            found.append((columns[at], quoted))
    if not found:
        raise ValueError(f"no columns in {spec!r}")
    return found


def build_keywords(spec: str, columns: list[str], names: bool = False) -> Column:
    """Search text from the chosen columns, in order; starred ones in quotes."""
    parts = []
    for name, quoted in keyword_columns(spec, columns, names):
        text = strip(F.replace(F.col(f"`{name}`").cast("string"), F.lit("\n"), F.lit(" ")))
        shown = F.concat(F.lit('"'), text, F.lit('"')) if quoted else text
        parts.append(F.when(text != "", shown))
    return strip(F.concat_ws(" ", *parts))


# -- templates ----------------------------------------------------------------


def template_vars(template: str) -> list[str]:
    return _VAR.findall(template)


def _fill(template: str, value_of) -> Column:
    pieces = []
    for i, part in enumerate(_VAR.split(template)):
        if i % 2:
            pieces.append(value_of(part))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces) if pieces else F.lit("")


def render_template(template: str, columns: list[str]) -> Column:
    """Fill ``{{name}}`` from the row; nulls and unknown names give nothing."""

    def value(name: str) -> Column:
        return cell(F.col(f"`{name}`")) if name in columns else F.lit("")

    return strip(_fill(template, value))


def json_inner(c: Column) -> Column:
    """Text escaped so that it can stand between the quotes of a JSON string."""
    quoted = F.to_json(F.array(c))
    return F.substring(quoted, F.lit(3), F.length(quoted) - 4)


def render_rules(template: str, columns: list[str]) -> Column:
    """Fill a JSON rule template per row and read it as ``map<string,string>``."""

    def value(name: str) -> Column:
        return json_inner(cell(F.col(f"`{name}`"))) if name in columns else F.lit("")

    return F.from_json(_fill(template, value), "map<string,string>")


def quote_plus(c: Column | str) -> Column:
    """Form encoding that keeps ``_ . - ~`` and encodes everything else."""
    encoded = F.url_encode(as_column(c))
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def render_q(template: str, query: Column | str, encode: bool = True) -> Column:
    """Put the query in the place of ``{q}``, form-encoded or as it is."""
    value = quote_plus(query) if encode else as_column(query)
    pieces: list[Column] = []
    for i, part in enumerate(template.split("{q}")):
        if i:
            pieces.append(value)
        if part:
            pieces.append(F.lit(part))
    return F.concat(*pieces) if pieces else F.lit("")


# -- names and stamps ---------------------------------------------------------


def safe_name(c: Column | str) -> Column:
    return F.translate(as_column(c), " /\\", "___")


def stamp(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyMMdd.HHmmss")


def prefix_path(prefix: str, c: Column | str) -> Column:
    """Stored path behind a prefix; nothing stored gives null."""
    path = F.nullif(as_column(c), F.lit(""))
    return F.concat(F.lit(prefix), path)
