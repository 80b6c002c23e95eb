"""Text expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"(?U)\s+"


def estimated_tokens(c: Column) -> Column:
    """A quarter of the code points, rounded down; null counts as empty."""
    return F.floor(F.length(F.coalesce(c, F.lit(""))) / 4).cast("int")


def tokens(c: Column) -> Column:
    """Lower-case tokens between white space, repeats and punctuation kept."""
    return F.filter(F.split(F.lower(c), WHITE), lambda t: t != "")


def raw_token_set(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, WHITE), lambda t: t != ""))


def title(c: Column) -> Column:
    """The heading at the very start of a Markdown text, else empty."""
    return F.trim(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?Ud)^#+\s+(.+)", 1))


def has_element(c: Column, name: str) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).contains(f"<{name}")


def normalised_xml(c: Column) -> Column:
    """Without comments and processing instructions, white space collapsed and trimmed."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?s)<!--.*?-->", ""), r"(?s)<\?.*?\?>", "")
    return F.trim(F.regexp_replace(bare, WHITE, " "))


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def file_stem(c: Column, extension: str = "xml") -> Column:
    return F.regexp_extract(c, rf"([^/]+)\.{extension}$", 1)


def root_tag(c: Column) -> Column:
    """Name of the root element of well-formed XML; UNKNOWN if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<([A-Za-z_][\w.:-]*)", 1), F.lit("")), F.lit("UNKNOWN"))


def chunk_owner(c: Column) -> Column:
    """The part before the last ``_c``; the id itself if there is none."""
    return F.regexp_replace(c, r"_c(?!.*_c).*$", "")


def snippet(c: Column, chars: int = 200) -> Column:
    return F.replace(F.substring(c, 1, chars), F.lit("\n"), F.lit(" "))


def cut_with_mark(c: Column, chars: int = 800, mark: str = " [...]") -> Column:
    return F.when(F.length(c) > chars, F.concat(F.substring(c, 1, chars), F.lit(mark))).otherwise(c)


def parsed_list(c: Column) -> Column:
    """A list kept as JSON text: null, empty and ``[]`` give an empty list, other unreadable text a list of itself."""
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | c.isin("", "[]"), empty).otherwise(F.coalesce(F.from_json(c, "array<string>"), F.array(c)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; two empty sets are dissimilar."""
    union = F.size(F.array_union(a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), union.cast("double")), F.lit(0.0))
