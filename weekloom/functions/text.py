"""Text normalisation (trim, lower-case, character filter)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: everything but these characters is removed.
REMOVED_CHARACTERS = r"[^a-zA-Z0-9\- ]"


def trim_spaces(c: Column) -> Column:
    return F.trim(c)


def trim_whitespace(c: Column) -> Column:
    """Trim tabs and line breaks too, not just spaces."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def remove_special(c: Column) -> Column:
    return F.regexp_replace(c, REMOVED_CHARACTERS, "")


def tidy(c: Column, *, all_whitespace: bool = False, retrim: bool = False) -> Column:
    """Trim, lower-case and filter, in that order.

    The filter can expose new spaces at the edges; ``retrim`` removes them.
    """
    trim = trim_whitespace if all_whitespace else trim_spaces
    cleaned = remove_special(F.lower(trim(c)))
    return trim(cleaned) if retrim else cleaned
