"""Raw text to clean, typed columns. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.constants import SOURCE_TIMESTAMP_SHAPE


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str) -> Column:
    """Lower-cased text with single inner spaces; blank is NULL."""
    single_spaced = F.regexp_replace(_column(value), r"\s+", " ")
    return F.nullif(F.lower(F.trim(single_spaced)), F.lit(""))


def clean_code(value: Column | str) -> Column:
    """Upper-cased short code, inner spaces kept; blank is NULL."""
    return F.nullif(F.upper(F.trim(_column(value))), F.lit(""))


def blank_to_null(value: Column | str) -> Column:
    """Free text left exactly as it came, line breaks included; blank is NULL."""
    text = _column(value)
    return F.when(F.trim(text) != "", text)


def to_timestamp(value: Column | str) -> Column:
    """Timestamp in the one source format.

    The shape is tested first and then cast: a pattern parser raises and catches an exception
    for every blank, which takes twice as long on columns that are blank half of the time.
    """
    text = _column(value)
    return F.when(text.rlike(SOURCE_TIMESTAMP_SHAPE), text.try_cast("timestamp"))


def to_money(value: Column | str) -> Column:
    """Exact ``decimal(12,2)``, half-up; money is never a float."""
    return _column(value).try_cast("decimal(12,2)")


def to_int(value: Column | str) -> Column:
    """Whole number; ``'40.0'`` is 40, as extracts write whole numbers with a fraction."""
    text = _column(value)
    return F.coalesce(text.try_cast("int"), text.try_cast("decimal(38,18)").try_cast("int"))


def to_double(value: Column | str) -> Column:
    return _column(value).try_cast("double")
