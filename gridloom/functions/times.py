"""Timestamps that come in more than one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ["yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yy-MM-dd HH:mm:ss.SSSSSS", "yy-MM-dd HH:mm:ss"]


def tolerant_timestamp(text: Column, formats: list[str] = FORMATS) -> Column:
    """The first of the formats that fits; null, not an error, if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")
