"""New files of a landing folder, each taken up once, as a Structured Streaming job.

The library's batch flows are started by a scheduler and pick the newest folder; this is the same landing step for a
folder that fills all the time. What follows the decoding is the batch code, run on every micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.grids import any_case, decode_grids, text_grid

FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_files(spark: SparkSession, folder: str, pattern: str = f"*{any_case('.xlsx')}", files_per_batch: int = 1000) -> DataFrame:
    """file_name and content of files as they appear."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")


def start(files: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hands the grid of every micro-batch to `each` with the batch's number; a repeated number is a retry."""
    writer = text_grid(decode_grids(files)).writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(availableNow=True) if once else writer).start()
