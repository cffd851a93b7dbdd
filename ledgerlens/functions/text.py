"""Text cleaning expressions (F1-F7, F9, T12, T17). All are JVM-side Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens that mean "missing" in the dirty source columns.
NULL_TOKENS = ("null", "nan", "")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_null(col, tokens=NULL_TOKENS) -> Column:
    """NULL when the trimmed, lower-cased text is one of ``tokens``; real NULL stays NULL."""
    c = _c(col)
    return F.when(F.lower(F.trim(c)).isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def strip_spaces(col) -> Column:
    """Remove every space (CSV id lists such as ``'1, 5'`` become ``'1,5'``)."""
    return F.replace(_c(col), F.lit(" "), F.lit(""))


def numeric_before_unit(col, unit: str = "km") -> Column:
    """Lower-case, drop the unit text, trim: ``'23.4 KM'`` -> ``'23.4'``."""
    return F.trim(F.replace(F.lower(_c(col)), F.lit(unit), F.lit("")))


def leading_number(col, marker: str = "m") -> Column:
    """Text left of the first ``marker`` (case-insensitive), trimmed: ``'25mins'`` -> ``'25'``.

    The position search ignores case, as a case-insensitive collation would.
    """
    c = _c(col)
    pos = F.locate(marker.lower(), F.lower(c))
    return F.when(pos > 0, F.trim(c.substr(F.lit(1), pos - 1))).otherwise(F.trim(c))


def concat_nullsafe(*cols) -> Column:
    """CONCAT that treats NULL as empty text (Spark's ``concat`` returns NULL)."""
    return F.concat_ws("", *[_c(c) for c in cols])
