"""Unit ids that are written in several ways.

Two ids are the same if they agree once letter case, white space, punctuation, a
leading path and a file ending ``.xml`` are set aside. A suffix ``_vN`` belongs to the id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE_ENDS = r"(?U)^\s+|\s+$"


def trim_white(c: Column) -> Column:
    """Trims every Unicode white space, not only blanks."""
    return F.regexp_replace(c, WHITE_SPACE_ENDS, "")


def unit_key(c: Column) -> Column:
    """Comparison key: upper-case letters and digits only. Null for null, blank and punctuation-only ids."""
    bare = F.regexp_replace(trim_white(c), r"(?is)^.*[/\\]|\.xml$", "")
    return F.nullif(F.upper(F.regexp_replace(bare, r"[^\p{L}\p{N}]", "")), F.lit(""))


def canonical_form(c: Column) -> Column:
    """The id as the canonical table writes it: ``IU<digits>`` with ``_v<N>``, if any; other keys stay as they are."""
    k = unit_key(c)
    return F.when(k.rlike(r"^IU\d+V\d+$"), F.regexp_replace(k, r"V(\d+)$", "_v$1")).otherwise(k)


def base_id(c: Column) -> Column:
    """The id without its variant suffix."""
    return F.regexp_replace(c, r"_v[0-9]+$", "")
