"""Text helpers: emptiness, lists, words, names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for null and for the empty string; never null."""
    return F.coalesce(_col(c), F.lit("")) == ""


def joined_key(*parts: Column | str, sep: str = ":") -> Column:
    return F.concat_ws(sep, *[_col(p) for p in parts])


def in_comma_list(item: Column, comma_list: Column) -> Column:
    """Exact membership in a comma-separated list; blanks are not trimmed."""
    return F.array_contains(F.split(comma_list, ","), item)


def words(text: Column | str, stop_words: Iterable[str] = ()) -> Column:
    """Lower-case Unicode words and numbers of a text, in order, as an array."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_PATTERN), 0)
    stop = list(stop_words)
    return F.filter(found, lambda w: ~w.isin(stop)) if stop else found


def camel_name(name: str) -> str:
    head, *tail = name.lower().split("_")
    return head + "".join(part.capitalize() for part in tail)


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename ``a_b`` columns to ``aB``."""
    return df.toDF(*[camel_name(c) for c in df.columns])
