"""Column functions on file paths, sections and page ids."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

#: File types by extension.
FILE_TYPES = {"jpg": "jpg", "jpeg": "jpg", "png": "png", "pdf": "pdf", "html": "html", "htm": "html"}
#: Models by what a file name contains, in this order; otherwise the default.
MODELS = (("m3", "M3"), ("320is", "320is"), ("325is", "325is"), ("325i", "325i"), ("318i", "318i"))
DEFAULT_MODEL = "E30"


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(as_col(path), "/"), -1)


def parent_name(path: Column | str, root: str = "") -> Column:
    """Name of the folder that holds the file; empty directly under the root."""
    rest = F.regexp_replace(as_col(path), F.lit("^" + _quote(root.rstrip("/") + "/")), F.lit("")) if root else as_col(path)
    parts = F.split(rest, "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.lit(""))


def _quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def stem(name: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(as_col(name), r"(?<=.)\.[^.]*$", "")


def file_type(path: Column | str) -> Column:
    """Type of a file by its extension, whatever the case; null for types not handled."""
    ext = F.lower(F.regexp_extract(basename(path), r"\.([^.]+)$", 1))
    return F.coalesce(*[F.when(ext == e, F.lit(t)) for e, t in FILE_TYPES.items()])


def needs_conversion(kind: Column | str) -> Column:
    """'true' for pdf, else 'false': inventories hold text."""
    return F.when(as_col(kind) == "pdf", F.lit("true")).otherwise(F.lit("false"))


def source_type(section: Column | str, filename: Column | str) -> Column:
    s = as_col(section)
    low = F.lower(s)
    return (
        F.when(F.lower(as_col(filename)).endswith(".html"), "html_specs")
        .when(s.rlike(r"^[0-9]{2} - "), "service_manual")
        .when(low.startswith("getrag"), "service_manual")
        .when(low.contains("electrical troubleshooting"), "electrical_manual")
        .when(low.contains("bosch motronic"), "ecu_technical")
        .otherwise("unknown")
    )


def is_index_page(filename: Column | str) -> Column:
    return F.lower(as_col(filename)).rlike(r"-(index|toc)[-.]")


def section_slug(section: Column | str) -> Column:
    """Lower case, spaces as hyphens, only a-z, 0-9 and single hyphens, none at the ends."""
    s = F.replace(F.replace(F.lower(as_col(section)), F.lit(" - "), F.lit("-")), F.lit(" "), F.lit("-"))
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9-]", ""), "-+", "-")
    return F.regexp_replace(s, "^-+|-+$", "")


def page_id(filename: Column | str, section: Column | str) -> Column:
    """Id of a page: unique by section, with the short name of a numbered section that the file name repeats."""
    s, st = as_col(section), stem(filename)
    number = F.regexp_extract(s, r"^(\d{2}) - ", 1)
    short = F.substring(section_slug(F.regexp_replace(s, r"^\d{2} - ", "")), 1, 8)
    return (
        F.when(F.lower(s).startswith("getrag") & st.rlike(r"^\d+$"), F.concat(F.lit("getrag-"), st))
        .when((number != "") & st.startswith(F.concat(number, F.lit("-"))), F.concat(st, F.lit("_"), short))
        .otherwise(F.concat(section_slug(s), F.lit("-"), st))
    )


def section_id(section: Column | str) -> Column:
    """The number of a numbered section; otherwise the slug's first part."""
    s = as_col(section)
    return F.when(s.rlike(r"^\d{2} - .+$"), F.substring(s, 1, 2)).otherwise(F.substring_index(section_slug(s), "-", 1))


def section_name(section: Column | str) -> Column:
    s = as_col(section)
    return F.when(s.rlike(r"^\d{2} - .+$"), F.substring(s, 6, 1 << 20)).otherwise(s)


def normal_page_id(page: Column | str) -> Column:
    """Without leading zeros in the second of exactly two parts; other ids stay."""
    p = as_col(page)
    parts = F.split(p, "-")
    bare = F.regexp_replace(F.element_at(parts, 2), "^0+", "")
    return F.when(F.size(parts) == 2, F.concat(F.element_at(parts, 1), F.lit("-"), F.when(bare == "", "0").otherwise(bare))).otherwise(p)


def derived_slug(id_: Column | str, name: Column | str) -> Column:
    cleaned = F.regexp_replace(F.replace(F.lower(as_col(name)), F.lit(" "), F.lit("-")), "[^a-z0-9-]", "")
    return F.concat(F.lower(as_col(id_)), F.lit("-"), cleaned)


def model_of(filename: Column | str) -> Column:
    low = F.lower(stem(filename))
    return F.coalesce(*[F.when(low.contains(k), F.lit(m)) for k, m in MODELS], F.lit(DEFAULT_MODEL))


def numbered_id(page: Column | str, n: Column | str) -> Column:
    """page-qNN: two digits at least."""
    return F.format_string("%s-q%02d", as_col(page), as_col(n).cast("int"))


def matches_glob(c: Column | str, pattern: str) -> Column:
    """Whether a whole text matches a file-name pattern of *, ? and [...]."""
    return as_col(c).rlike(r"\A" + fnmatch.translate(pattern).replace(r"\Z", r"\z"))


def confidence_bucket(c: Column | str) -> Column:
    x = as_col(c)
    return F.when(x >= 0.9, "high").when(x >= 0.7, "medium").otherwise("low")


def needs_review(confidence: Column | str, content_type: Column | str) -> Column:
    return (as_col(confidence) < 0.7) | (as_col(content_type) == "unknown")


def media_type(path: Column | str) -> Column:
    """MIME type of an image by its extension; jpeg if unknown."""
    ext = F.lower(F.regexp_extract(as_col(path), r"\.([^.]+)$", 1))
    return F.when(ext == "png", "image/png").when(ext == "gif", "image/gif").when(ext == "webp", "image/webp").otherwise("image/jpeg")
