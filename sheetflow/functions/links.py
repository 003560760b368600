"""URL columns: scheme filter, stored path, kind of download."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetflow.functions.strings import as_column, sha1_hex

# Extensions that are fetched directly, and the two defaults.
DIRECT_EXTENSIONS = [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".png", ".jpg", ".jpeg", ".gif"]
DIRECT_DEFAULT = ".pdf"
PICTURE_EXTENSION = ".png"


def is_http(c: Column | str) -> Column:
    return as_column(c).rlike("^https?://")


def only_http(c: Column | str) -> Column:
    """The URL when it is http(s), else the empty string."""
    url = as_column(c)
    return F.when(is_http(url), url).otherwise("")


def url_path(c: Column | str) -> Column:
    """Path part, without parameters, query and fragment."""
    whole = F.regexp_extract(as_column(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(whole, r";[^/]*$", "")


def _decoded_path(c: Column | str) -> Column:
    raw = url_path(c)
    return F.lower(F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw))


def download_kind(c: Column | str) -> Column:
    """``struct<is_direct, ext>``: fetched as a file, or as a picture of the page."""
    path = _decoded_path(c)
    endings = "|".join(e[1:] for e in DIRECT_EXTENSIONS)
    direct = F.coalesce(path.rlike(rf"\.(?:{endings})$"), F.lit(False))
    own = F.regexp_extract(path, r"[^/.][^/]*(\.[^./]+)$", 1)
    ext = F.when(~direct, F.lit(PICTURE_EXTENSION)).when(own == "", F.lit(DIRECT_DEFAULT)).otherwise(own)
    return F.struct(direct.alias("is_direct"), ext.alias("ext"))


def hash_path(digest: Column | str, ext: Column | str = "") -> Column:
    """Two directory levels from the digest, the rest as the file name."""
    h = as_column(digest)
    tail = F.lit(ext) if isinstance(ext, str) else ext
    return F.concat(F.substring(h, 1, 2), F.lit("/"), F.substring(h, 3, 2), F.lit("/"), F.substring(h, 5, 36), tail)


def snapshot_path(url: Column | str, ext: Column | str = "") -> Column:
    return hash_path(sha1_hex(url), ext)
