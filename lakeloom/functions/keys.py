"""Surrogate, version, date and batch keys."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.constants import UNKNOWN_DATE_KEY, UNKNOWN_KEY


def surrogate_key(natural: str) -> Column:
    """SHA-256 of the natural key: stable over re-runs, computed without coordination."""
    return F.sha2(F.col(natural), 256)


def version_key(natural: str, valid_from: Column | str = "valid_from") -> Column:
    """Key of one version of a type-2 member; the unknown member keeps its own key."""
    since = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    digest = F.sha2(F.concat_ws("|", F.col(natural), since.cast("string")), 256)
    return F.when(F.col(natural) == UNKNOWN_KEY, UNKNOWN_KEY).otherwise(digest)


def date_key(moment: str) -> Column:
    """``yyyyMMdd`` as int, by arithmetic so that it stays out of string formatting."""
    c = F.col(moment)
    packed = F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    return F.coalesce(packed, F.lit(UNKNOWN_DATE_KEY))


def key_date(key: str) -> Column:
    """The day of a date key; NULL for the unknown date."""
    k = F.col(key)
    parts = [F.floor(k / 10000), F.floor(k / 100) % 100, k % 100]
    return F.when(k != UNKNOWN_DATE_KEY, F.make_date(*[part.cast("int") for part in parts]))


def resolve_date_key(key: str) -> Column:
    """Date key after a left lookup: a miss is the unknown date."""
    return F.coalesce(F.col(key), F.lit(UNKNOWN_DATE_KEY))


def resolve_key(key: str) -> Column:
    """Foreign key after a left lookup: a miss points at the unknown member."""
    return F.coalesce(F.col(key), F.lit(UNKNOWN_KEY))


def packed(df: DataFrame, *keys: str) -> DataFrame:
    """Each key as the 32 bytes of its digest (``_bytes``) or, where it is none in lower case, as it is (``_text``).

    A shuffle does not compress hexadecimal digits, so a key that moves moves half as much; ``unpacked`` gives the same text.
    """
    for key in keys:
        digest = F.unhex(key)
        follows = F.lower(F.hex(digest)).eqNullSafe(F.col(key))
        parts = {f"{key}_bytes": F.when(follows, digest), f"{key}_text": F.when(~follows, F.col(key))}
        df = df.withColumns(parts).drop(key)
    return df


def unpacked(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that ``packed`` took apart, behind the other columns."""
    whole = {key: F.coalesce(f"{key}_text", F.lower(F.hex(f"{key}_bytes"))) for key in keys}
    return df.withColumns(whole).drop(*[f"{key}_{part}" for key in keys for part in ("bytes", "text")])


def key_bytes(key: str) -> Column:
    """A key as bytes, half as long where it is a digest; equal for equal keys only, as the first byte tells digests from others."""
    digest = F.unhex(key)
    follows = F.lower(F.hex(digest)).eqNullSafe(F.col(key))
    return F.when(follows, F.concat(F.unhex(F.lit("01")), digest)).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(key, "UTF-8")))


def batch_id(table: str, ingestion_date: date) -> str:
    """Same table and day, same id: a re-run is recognisable as the same batch."""
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{table}-{ingestion_date.isoformat()}"))
