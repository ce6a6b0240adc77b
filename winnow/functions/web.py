"""Column functions on URLs, counts and dates of web pages."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, collapse

#: Folder names of a URL that are no slug.
PLAIN_PARTS = ("forum", "forums", "threads", "thread")
#: What the address of a symbol rather than a picture contains.
SYMBOL_PARTS = ("emoji", "smil", "icon", "avatar", "/misc/", "/images/buttons/", ".gif")
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp")
#: Date formats in the order tried.
DATE_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy", "M-d-yyyy", "yyyy-M-d", "d MMM yyyy")


def url_path(url: Column | str) -> Column:
    return F.coalesce(F.try_parse_url(as_col(url), F.lit("PATH")), F.regexp_extract(as_col(url), r"^(?:[a-z][a-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1))


def path_parts(url: Column | str) -> Column:
    return F.filter(F.split(url_path(url), "/"), lambda p: p != "")


def _plain_path(path: Column, tidy: bool = False) -> Column:
    """An absolute path without . and .. parts; tidy drops empty parts too, save that of a slash at its end."""
    own = F.slice(F.split(path, "/"), F.lit(2), F.lit(1 << 20))
    if tidy:
        own = F.concat(F.filter(own, lambda p: p != ""), F.when(path.endswith("/"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    walked = F.aggregate(own, F.array(F.lit("")), lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).when(p == ".", acc).otherwise(F.concat(acc, F.array(p))))
    plain = F.concat(F.array_join(walked, "/"), F.when(path.rlike(r"/\.{1,2}$"), "/").otherwise(""))
    return F.when(path.rlike(r"/\.{1,2}(/|$)|//"), F.when(plain == "", "/").otherwise(plain)).otherwise(path)


def resolve_url(url: Column | str, base: str) -> Column:
    """Absolute URL: // gets https, an address with a scheme stays, any other is followed from the base as a folder; empty stays empty."""
    u, parts = F.coalesce(as_col(url), F.lit("")), urlsplit(base.rstrip("/") + "/")
    host, folder = f"{parts.scheme}://{parts.netloc}", parts.path
    path, rest = F.regexp_extract(u, r"^([^?#]*)", 1), F.regexp_extract(u, r"^[^?#]*(.*)$", 1)
    whole = F.when(path == "", F.lit(folder)).when(path.startswith("/"), _plain_path(path)).otherwise(_plain_path(F.concat(F.lit(folder), path), tidy=True))
    return F.when(u == "", "").when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.rlike(r"^(http|[A-Za-z][A-Za-z0-9+.-]*:)"), u).otherwise(F.concat(F.lit(host), whole, rest))


def page_in_url(url: Column | str) -> Column:
    """The number after /page or in the parameter page; null without one."""
    u = as_col(url)
    found = lambda k: F.regexp_extract(u, r"/page([0-9]+)|[?&]page=([0-9]+)", k)
    return F.concat(found(1), found(2)).try_cast("int")


def id_from_url(url: Column | str, allow_slug: bool = True) -> Column:
    """The first path part that is a number or begins with one and a hyphen; otherwise the last slug."""
    numeric = lambda p: F.regexp_extract(p, r"^(\d+)(?:-.*)?$", 1)
    parts = path_parts(url)
    first = F.get(F.filter(F.transform(parts, numeric), lambda x: x != ""), F.lit(0))
    slug = F.try_element_at(F.filter(parts, lambda p: ~p.isin(*PLAIN_PARTS)), F.lit(-1)) if allow_slug else F.lit(None)
    return F.coalesce(first, slug, F.lit(""))


def id_after(url: Column | str, part: str = "threads") -> Column:
    """What follows a path part, up to a hyphen; otherwise any part's leading number before a hyphen; otherwise null."""
    parts = path_parts(url)
    at = F.array_position(parts, part)
    following = F.when(at > 0, F.get(parts, at.cast("int")))
    number = F.get(F.filter(F.transform(parts, lambda p: F.regexp_extract(p, r"^(\d+)-", 1)), lambda x: x != ""), F.lit(0))
    return F.coalesce(F.substring_index(following, "-", 1), number)


def looks_like_thread(url: Column | str) -> Column:
    """Whether the last part begins with a number and a hyphen, and that number is large or the path deep."""
    parts = path_parts(url)
    number = F.regexp_extract(F.try_element_at(parts, F.lit(-1)), r"^(\d+)-", 1)
    return F.coalesce((F.size(parts) >= 2) & (number != "") & ((number.try_cast("bigint") > 1000) | (F.size(parts) > 3)), F.lit(False))


def is_symbol(src: Column | str) -> Column:
    low = F.lower(as_col(src))
    out = F.lit(False)
    for part in SYMBOL_PARTS:
        out = out | low.contains(part)
    return out


def parse_count(c: Column | str, labelled: bool = False) -> Column:
    """1,234, 1.2K or 3M as a number; 0 if it is none. labelled=True reads the leading number of "25 replies" too."""
    t = F.upper(F.trim(F.coalesce(as_col(c), F.lit(""))))
    if labelled:
        t = F.regexp_extract(t, r"^([0-9][0-9.,]*[KM]?)", 1)
    times = F.when(t.endswith("K"), 1000.0).when(t.endswith("M"), 1000000.0).otherwise(1.0)
    return F.coalesce((F.replace(F.regexp_replace(t, "[KM]$", ""), F.lit(",")).try_cast("double") * times).try_cast("bigint"), F.lit(0)).cast("bigint")


def parse_date(c: Column | str) -> Column:
    """ISO date and time of a date in a known format; any other text stays, blanks collapsed."""
    t = collapse(c)
    found = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in DATE_FORMATS])
    return F.coalesce(F.date_format(found, "yyyy-MM-dd'T'HH:mm:ss"), t)


def image_filename(url: Column | str, post_id: Column | str, index: Column | str) -> Column:
    """post_index_hash.ext: eight hex digits of the URL's MD5, and its extension if it is an image's."""
    u = as_col(url)
    ext = F.lower(F.regexp_extract(F.try_url_decode(url_path(u)), r"(\.[^./]+)$", 1))
    return F.concat(as_col(post_id), F.lit("_"), as_col(index).cast("string"), F.lit("_"), F.substring(F.md5(u), 1, 8), F.when(ext.isin(*IMAGE_EXTENSIONS), ext).otherwise(".jpg"))
