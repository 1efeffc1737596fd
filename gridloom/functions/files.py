"""What a file's name tells: prefix, batch and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: `.` or `_`, a dotted date, and perhaps a dotted time.
DATED = r"[._](\d{4})\.(\d{2})\.(\d{2})(?:\.(\d{2})\.(\d{2})\.(\d{2}))?"


def file_meta(name: Column) -> Column:
    """struct(file_name_prefix, batch_id, file_dttm): before the first date, its digits (no time: zeros), its time.

    Without a date: the name without its extension, null, null.
    """
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(name, DATED, i), F.lit("")), F.lit("00"))
    dated = name.rlike(DATED)
    batch = F.concat(*[part(i) for i in range(1, 7)])
    prefix = F.when(dated, F.regexp_extract(name, r"^(.*?)" + DATED, 1)).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))
    return F.struct(prefix.alias("file_name_prefix"), F.when(dated, batch).alias("batch_id"), F.when(dated, F.try_to_timestamp(batch, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")).alias("file_dttm"))
