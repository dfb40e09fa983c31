"""Builds the expression that says whether two cells are equal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.text import normalize_text


@dataclass(frozen=True)
class CompareOptions:
    """How cells are compared.

    ``compare_as`` is ``'typed'`` (SQL values, null-safe) or ``'string'`` (their text).
    """

    ignore_columns: tuple[str, ...] = ()
    ignore_whitespace: bool = False
    ignore_case: bool = False
    epsilon: float = 0.0
    compare_as: str = "typed"

    def equal(self, a: Column, b: Column, types: tuple[T.DataType, T.DataType] | None = None) -> Column:
        """Null-safe cell equality; NULL equals NULL but not the empty text.

        With ``types`` given, values of types that don't compare safely are compared as texts.
        """
        as_text = types is not None and not comparable(*types)
        if as_text or self.compare_as == "string" or self.ignore_whitespace or self.ignore_case:
            same = normalize_text(a.cast("string"), self.ignore_whitespace, self.ignore_case).eqNullSafe(
                normalize_text(b.cast("string"), self.ignore_whitespace, self.ignore_case)
            )
        else:
            same = a.eqNullSafe(b)
        if self.epsilon > 0:
            same = same | F.coalesce(within(a, b, self.epsilon), F.lit(False))
        return same


def comparable(a: T.DataType, b: T.DataType) -> bool:
    """Whether values of the two types can be compared without a cast that may fail."""
    if a == b:
        return True
    families = (T.NumericType, (T.DateType, T.TimestampType, T.TimestampNTZType), (T.StringType, T.VarcharType, T.CharType))
    return any(isinstance(a, f) and isinstance(b, f) for f in families)


def within(a: Column, b: Column, epsilon: float) -> Column:
    """Both values read as numbers and differ by less than ``epsilon``."""
    return F.abs(a.cast("string").try_cast("double") - b.cast("string").try_cast("double")) < epsilon


EXACT = CompareOptions()
