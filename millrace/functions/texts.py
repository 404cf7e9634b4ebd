"""Texts of questions and names: labels for tokens, slugs, padded numbers, SQL without layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(token: Column, phrases: Mapping[str, str]) -> Column:
    """The business phrase of a token, or the token itself; names that begin with _ are notes and no tokens."""
    pairs = [F.lit(x) for k, v in phrases.items() if not k.startswith("_") for x in (k, v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), token), token) if pairs else token


def slug(text: Column) -> Column:
    """Lower case, with a dot for each run of other characters than letters and digits, and none at an end."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "."), F.lit("."))


def padded(prefix: str, number: Column, digits: int = 5) -> Column:
    """prefix and a whole number with leading zeros; a longer number keeps all its digits."""
    return F.format_string(f"{prefix.replace('%', '%%')}%0{digits}d", number.cast("long"))


def compact_sql(text: Column) -> Column:
    """SQL text for comparisons: lower case, without white space and brackets."""
    return F.lower(F.regexp_replace(text, r"[\s()]", ""))
