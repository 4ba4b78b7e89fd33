"""Small column builders that keep unknown apart from false."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: str | Column) -> Column:
    """The value as trimmed text, null if blank."""
    return F.nullif(F.trim(as_col(c).cast("string")), F.lit(""))


def missing(c: str | Column, unknown: Sequence[str] = ("unknown",)) -> Column:
    """Null, empty, or one of the words that stand for unknown."""
    raw = as_col(c).cast("string")
    return raw.isNull() | (raw == "") | raw.isin(*unknown)


def contains_ci(c: str | Column, wanted: str) -> Column:
    """Case-insensitive LIKE, the user's % and _ staying wildcards; null does not match."""
    return F.coalesce(as_col(c).cast("string").ilike(f"%{wanted}%"), F.lit(False))


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def all_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def reasons(*rules: tuple[Column, str]) -> Column:
    """The texts of the rules that hold, in order; a rule of unknown outcome does not hold."""
    return F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, t in rules)))


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def joined(c: str | Column, sep: str = ",") -> Column:
    """A sorted array as one text."""
    return F.array_join(F.array_sort(as_col(c)), sep)


def with_optional(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``df`` with a null column ``name`` if it has none."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
