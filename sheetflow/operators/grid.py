"""Cell grids and sheets: headers, row ranges, columns by name or letter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.functions.strings import cell, col_index, filled
from sheetflow.operators.keyed import lookup, numbered, quoted

GROUP = ["file", "sheet"]


def _group(df: DataFrame) -> list[str]:
    return [c for c in GROUP if c in df.columns]


def header_names(cells: DataFrame, header_row: int = 1) -> dict[int, str]:
    """Column position to trimmed name; blank names are left out."""
    named = cells.filter(F.col("row") == header_row).select("col", filled("value").alias("name")).filter("name IS NOT NULL")
    # one row per column, and the workbook format bounds the columns
    found = named.groupBy("col").agg(F.min("name").alias("first"), F.max("name").alias("last")).collect()
    for r in sorted(found):
        if r["first"] != r["last"]:
            raise ValueError(f"column {r['col']} has different headers: {r['first']!r}, {r['last']!r}")
    return {r["col"]: r["first"] for r in found}


def promote_header(cells: DataFrame, header_row: int = 1, names: dict[int, str] | None = None) -> DataFrame:
    """Sheet with named columns and ``_row``, from (row, col, value) cells.

    All files of the grid must share the header. Rows without any cell do not
    appear. When a name repeats, the last column of that name counts. Pass
    ``names`` when the header is known, to save reading the grid for it.
    """
    found = header_names(cells, header_row) if names is None else names
    by_name = {name: col for col, name in sorted(found.items())}
    keys = _group(cells)
    values = [F.max(F.when(F.col("col") == col, F.col("value"))).alias(name) for name, col in by_name.items()]
    return (
        cells.filter(F.col("row") > header_row)
        .groupBy(*keys, F.col("row").alias("_row"))
        .agg(*values)
    )


def header_map(cells: DataFrame, header_row: int = 1) -> DataFrame:
    """(file, sheet, col, name): the header of each sheet; of columns with one name the last counts."""
    keys = _group(cells)
    named = cells.filter(F.col("row") == header_row).select(*keys, "col", filled("value").alias("name")).filter("name IS NOT NULL")
    return named.groupBy(*keys, "name").agg(F.max("col").alias("col"))


def promote_headers(cells: DataFrame, header_row: int = 1, columns: Sequence[str] | None = None) -> DataFrame:
    """Sheets with named columns and ``_row``, each by its own header.

    Every cell is renamed by the header of its own file and sheet, so sheets
    whose columns stand in another order, or that lack some, meet by name. The
    names of all headers, or the ``columns`` given, are the columns, in order of
    their first place and name; a sheet without one has nulls there. Rows
    without any cell under a name do not appear.
    """
    keys = _group(cells)
    heads = header_map(cells, header_row)
    if columns is None:
        # one row per name: what the columns of the result are called
        found = heads.groupBy("name").agg(F.min("col").alias("col")).collect()
        columns = [r["name"] for r in sorted(found, key=lambda r: (r["col"], r["name"]))]
    body = cells.filter(F.col("row") > header_row).select(*keys, "row", "col", "value")
    named = lookup(body, heads, [*keys, "col"], "inner")
    values = [F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in columns]
    return named.filter(F.col("name").isin(list(columns))).groupBy(*keys, F.col("row").alias("_row")).agg(*values)


def flatten_header(cells: DataFrame, merges: DataFrame | None, rows: int = 3, sep: str = "/") -> DataFrame:
    """(col, path): names of the header rows joined downwards.

    A merge that lies wholly in the header gives its first value to every cell
    it covers. Merges are unfolded to cells, so the join is by position.
    """
    keys = _group(cells)
    top = cells.filter(F.col("row") <= rows).select(*keys, "row", "col", F.coalesce("value", F.lit("")).alias("value"))
    if merges is not None:
        covered = (
            merges.filter(F.col("max_row") <= rows)
            .withColumn("row", F.explode(F.sequence("min_row", "max_row")))
            .withColumn("col", F.explode(F.sequence("min_col", "max_col")))
        )
        corner = top.select(*keys, F.col("row").alias("min_row"), F.col("col").alias("min_col"), F.col("value").alias("_merged"))
        fill = covered.join(corner, [*keys, "min_row", "min_col"], "left").select(*keys, "row", "col", F.coalesce("_merged", F.lit("")).alias("_merged"))
        top = top.join(fill, [*keys, "row", "col"], "full_outer").withColumn("value", F.coalesce("_merged", "value")).drop("_merged")
    levels = [F.coalesce(F.max(F.when(F.col("row") == r, F.col("value"))), F.lit("")) for r in range(1, rows + 1)]
    width = F.array(*levels)
    return top.groupBy(*keys, "col").agg(F.array_join(width, sep).alias("path"))


def parse_rows(spec: str, single: str = "open") -> tuple[int, int | None]:
    """``"3+"``, ``"3-9"`` or ``"3"`` as (first, last); an open end is None.

    A lone number is an open range with ``single="open"``, one row with
    ``"one"``, and an error with ``"error"``.
    """
    text = spec.strip()
    try:
        if text.endswith("+"):
            low, high = int(text[:-1]), None
        elif "-" in text:
            low, high = (int(p) for p in text.split("-", 1))
        elif single == "error":
            raise ValueError(text)
        else:
            low = int(text)
            high = low if single == "one" else None
    except ValueError:
        raise ValueError(f"bad row range {spec!r}; use 3+, 3-9 or 3") from None
    if high is not None and high < low:
        raise ValueError(f"bad row range {spec!r}: the end is before the start")
    return low, high


def slice_rows(df: DataFrame, spec: str, first_row: int = 1, single: str = "open", row: str = "_row") -> DataFrame:
    """Rows of the range. An end beyond the table needs no clamp: it is a filter."""
    low, high = parse_rows(spec, single)
    if low < first_row:
        raise ValueError(f"row range {spec!r} starts before the first data row {first_row}")
    kept = df.filter(F.col(row) >= low)
    return kept if high is None else kept.filter(F.col(row) <= high)


def stop_at_blank(
    df: DataFrame, columns: Sequence[str] | None = None, mode: str = "name", row: str = "_row", gaps: bool = True, first: int | None = None
) -> DataFrame:
    """Rows before the first blank one.

    ``name``: blank in the one named column; ``all``: blank in every column. A
    row without any cell is not in the table at all, so a gap in the row
    numbers is a blank row as well; ``gaps=False`` is for tables whose numbers
    are not those of a sheet. ``first`` is the first row that was asked for:
    where it is missing, nothing is read. One file stops by a scalar subquery
    that becomes a plain filter; several files each stop at their own blank row.
    """
    groups = _group(df)
    looked_at = list(columns) if columns else [c for c in df.columns if c not in (*groups, row)]
    if mode not in ("name", "all"):
        raise ValueError(f"mode must be name or all, not {mode!r}")
    if mode == "name" and len(looked_at) != 1:
        raise ValueError("mode name needs exactly one column")
    blank = F.lit(True)
    for c in looked_at:
        blank = blank & (cell(quoted(c)) == "")
    asked = df if first is None else df.filter(F.col(row) >= first)
    at = [quoted(g) for g in groups]
    ends = asked.filter(blank).select(*at, F.col(row).cast("long").alias("_stop"))
    if gaps:
        ends = ends.unionByName(_first_gaps(asked, groups, row, first))
    if not groups:
        stop = ends.agg(F.min("_stop")).scalar()
        return asked.filter(F.col(row) < F.coalesce(stop, F.lit((1 << 63) - 1)))
    nearest = ends.groupBy(*at).agg(F.min("_stop").alias("_stop"))
    return lookup(asked, nearest, groups).filter(F.col("_stop").isNull() | (F.col(row) < F.col("_stop"))).drop("_stop")


def _first_gaps(df: DataFrame, groups: Sequence[str], row: str, first: int | None) -> DataFrame:
    """The groups and ``_stop``, the number of their first missing row.

    Without a gap the nth row has the number n - 1 after the first one. The
    numbers alone are sorted into ranges for that, so no task sees a whole sheet.
    """
    numbers = df.select(*[quoted(g) for g in groups], F.col(row).cast("long").alias("_number")).distinct()
    placed = numbered(numbers, groups, ["_number"], "_nth")
    # the first number less its place, from the narrow table itself
    begin = F.lit(first - 1) if first is not None else None
    at = [quoted(g) for g in groups]
    if begin is None:
        lowest = placed.filter("_nth = 1").select(*[quoted(g).alias(f"_g{i}") for i, g in enumerate(groups)], (F.col("_number") - 1).alias("_begin"))
        same = reduce(lambda x, y: x & y, [quoted(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)], F.lit(True))
        if not groups:
            begin = lowest.agg(F.min("_begin")).scalar()
        else:
            placed, begin = placed.join(lowest, same), F.col("_begin")
    late = placed.withColumn("_stop", begin + F.col("_nth")).filter(F.col("_number") > F.col("_stop"))
    return late.groupBy(*at).agg(F.min("_stop").alias("_stop")) if groups else late.agg(F.min("_stop").alias("_stop"))


def skip_blank(df: DataFrame, column: str) -> DataFrame:
    """Bounded ranges only pass over rows with a blank name."""
    return df.filter(cell(quoted(column)) != "")


def column_at(df: DataFrame, letters: str) -> str:
    at = col_index(letters)
    if at >= len(df.columns):
        raise ValueError(f"column {letters} is beyond the table's {len(df.columns)} columns")
    return df.columns[at]


def resolve_column(df: DataFrame, candidates: Sequence[str], required: bool = False) -> str | None:
    """First of the candidate names that the table has."""
    for name in candidates:
        if name in df.columns:
            return name
    if required:
        raise ValueError(f"none of the columns {list(candidates)} exists")
    return None


def require_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def meta_value(meta: DataFrame, key: str) -> str:
    """Value of a key of the two-column settings sheet."""
    rows = meta.filter(cell("key") == key).select(cell("value").alias("value")).limit(1).collect()
    if not rows:
        raise ValueError(f"meta has no key {key!r}")
    if not rows[0]["value"]:
        raise ValueError(f"meta key {key!r} has no value")
    return rows[0]["value"]


def method_set(spec: str, valid: Sequence[str] = ("extract", "scan", "search")) -> set[str]:
    """Chosen methods; an unknown or empty choice is an error."""
    chosen = {m.strip().lower() for m in spec.split(",") if m.strip()}
    unknown = chosen - set(valid)
    if unknown or not chosen:
        raise ValueError(f"methods must be among {list(valid)}, got {spec!r}")
    return chosen
