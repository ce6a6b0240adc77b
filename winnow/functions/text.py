"""Column functions on text. Blanks and word characters are Unicode's, as Python's str and re see them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java's \s and trim know ASCII blanks only; the flag (?U) makes \s Unicode's.
BLANK = r"(?U)\s"
#: Letters, numbers and the underscore: what \w means for Unicode text.
WORD = r"([\p{L}\p{N}_]+)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for each row, however often and deep inside lambdas body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without blanks at either end."""
    return F.regexp_replace(as_col(c), rf"{BLANK}+\z|\A\s+", "")


def stripped_length(c: Column | str) -> Column:
    return F.length(strip(c))


def collapse(c: Column | str) -> Column:
    """Runs of blanks become one space; none stays at the ends. A null gives an empty text."""
    return F.trim(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), rf"{BLANK}+", " "))


def match_key(c: Column | str, unicode: bool = False) -> Column:
    """Key of exact matching: lower case, only a-z, 0-9 and blanks, blanks collapsed.

    Texts in other scripts have an empty key and so match each other; unicode=True keeps all
    letters and numbers instead.
    """
    kept = r"(?U)[^\p{L}\p{N}\s]" if unicode else r"(?U)[^a-z0-9\s]"
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(as_col(c)), kept, ""), rf"{BLANK}+", " "))


def word_set(c: Column | str) -> Column:
    """Distinct words in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(as_col(c)), F.lit(WORD), 1))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(F.array_union(a, b)))


def first_phrase(c: Column | str, phrases: list[str]) -> Column:
    """The first of the phrases, in their order, that the text contains in any case; null if none does."""
    low = F.lower(as_col(c))
    return F.coalesce(*[F.when(low.contains(p.lower()), F.lit(p)) for p in phrases], F.lit(None).cast("string"))


def truncate(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def safe_filename(c: Column | str) -> Column:
    """Each character that is neither a word character nor a hyphen becomes an underscore."""
    return F.regexp_replace(as_col(c), r"[^\p{L}\p{N}_\-]", "_")


def flat_image_name(path: Column | str) -> Column:
    """An image path as one file name: path parts, blanks and reserved signs joined by single underscores."""
    joined = F.regexp_replace(as_col(path), "/+", "_")
    plain = F.regexp_replace(joined, r'(?U)[\s/\\:*?"<>|]+', "_")
    return F.regexp_replace(F.regexp_replace(plain, "_+", "_"), "^_+|_+$", "")


def lines_of(c: Column | str) -> Column:
    return F.split(as_col(c), "\n")
