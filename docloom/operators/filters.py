"""Row filters that are put together at run time."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_given(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Rows that have all values asked for. A column asked for None isn't looked at; a list asks for any of its values."""
    for column, value in wanted.items():
        if isinstance(value, (list, tuple, set, frozenset)):
            df = df.filter(F.col(column).isin(*value))
        elif value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def members(df: DataFrame, columns: Sequence[str], tuples: Iterable[Sequence[object]]) -> DataFrame:
    """Rows whose columns together are one of the tuples; a short list becomes a predicate that reaches the scan."""
    test: Column = F.lit(False)
    for t in dict.fromkeys(map(tuple, tuples)):
        one: Column = F.lit(True)
        for c, v in zip(columns, t, strict=True):
            one = one & F.col(c).eqNullSafe(F.lit(v))
        test = test | one
    return df.filter(test)


def any_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the columns has text; the empty text is none."""
    return df.filter(F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns)).isNotNull())
