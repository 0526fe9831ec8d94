"""Projection and filter operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import as_col, empty_to_null, trim_space, word_count
from siltstone.functions.vectors import has_vector


def filtered_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> list[str]:
    """Column names minus a case-insensitive list."""
    gone = {c.lower() for c in leave_out}
    return [c for c in df.columns if c.lower() not in gone]


def star(df: DataFrame, leave_out: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but some, with a prefix or suffix."""
    return df.select([F.col(c).alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, leave_out)])


def nullcheck(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become NULL in the given string columns (all of them by default)."""
    wanted = None if cols is None else {c.lower() for c in cols}
    return df.select([
        empty_to_null(f.name).alias(f.name)
        if isinstance(f.dataType, T.StringType) and (wanted is None or f.name.lower() in wanted)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def filter_length_band(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.where(F.length(column).between(low, high))


def filter_has_embedding(df: DataFrame, column: str = "embedding", present: bool = True) -> DataFrame:
    """Rows that hold a vector; with ``present=False`` the rows that still need one."""
    return df.where(has_vector(column) if present else ~has_vector(column))


def row_condition(df: DataFrame, condition: str | Column | None) -> DataFrame:
    if condition is None:
        return df
    return df.where(F.expr(condition) if isinstance(condition, str) else condition)


def keep_unless_missing(mode: str, cols: Sequence[str]) -> Column:
    """False for rows whose columns are missing: all of them or any of them."""
    if mode not in ("all_values_are_missing", "any_value_is_missing"):
        raise ValueError(f"unknown mode {mode!r}")
    nulls = [F.col(c).isNull() for c in cols]
    if mode == "all_values_are_missing":
        return ~reduce(lambda a, b: a & b, nulls)
    return ~reduce(lambda a, b: a | b, nulls)


def like_predicate(c: Column | str, pattern: str, positive: bool = True) -> Column:
    matched = as_col(c).like(pattern)
    return matched if positive else ~matched


def quality_score(c: Column | str) -> Column:
    """Score of a text chunk from its length, letter case, word count and content."""
    text = as_col(c)
    words = word_count(text)

    def points(value: str) -> Column:
        return F.lit(value).cast("decimal(4,1)")

    by_length = F.when(F.length(text) > 200, points("0.3")).when(F.length(text) > 100, points("0.2"))
    by_words = F.when(words > 20, points("0.3")).when(words > 10, points("0.2"))
    upper_case = F.when(text.rlike("[A-Z]"), points("0.2")).otherwise(points("0.0"))
    not_blank = F.when(F.length(trim_space(text)) > 0, points("0.2")).otherwise(points("0.0"))
    total = by_length.otherwise(points("0.1")) + upper_case + by_words.otherwise(points("0.1")) + not_blank
    return total.cast("decimal(4,1)")
