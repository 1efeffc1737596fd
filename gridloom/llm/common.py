"""Pieces that the corpus operators share: word expressions, shared tables and global row numbers.

Operators give the columns they read names of their own first (`internal`), so that extra columns of a caller's table,
whatever they are called, can't clash with them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: What separates words of digits, letters and all characters beyond ASCII, in lower-cased text.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words of a shingle.
SHINGLE = 5

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or where that is unset (tests) one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    return _own_dirs.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-shared-"))


_written: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/gridloom-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that were materialized inside, at the end or on a failure: for results that are written by then."""
    before = len(_written)
    try:
        yield
    finally:
        for path in _written[before:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _written[before:]


def internal(docs: DataFrame, **columns: str) -> tuple[DataFrame, list[Column]]:
    """Renames every column by its position, then the named ones to `_<key>`; also how to get the old columns back.

    internal(docs, id="doc_id") gives a frame with `_id`. A column that is absent raises; of columns with the same
    name the first is taken.
    """
    names = docs.columns
    own = [f"_c{i}" for i in range(len(names))]
    for key, name in columns.items():
        if name not in names:
            raise ValueError(f"column {name} is missing; there are {names}")
        own[names.index(name)] = f"_{key}"
    return docs.toDF(*own), [F.col(o).alias(n) for o, n in zip(own, names, strict=True)]


def with_added(back: list[Column], names: list[str], **added: Column) -> list[Column]:
    """The old columns followed by the added ones; an old column with the name of an added one gives way."""
    taken = {k.lower() for k in added}
    return [c for c, n in zip(back, names, strict=True) if n.lower() not in taken] + [c.alias(k) for k, c in added.items()]


def ascii_lower(c: Column) -> Column:
    """Lower-cases A to Z alone. Texts of ASCII only take the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def split_words(c: Column, separators: str = SPACE) -> Column:
    """array<string> of the words of a text; null: no words."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), separators), "")


def count_words(c: Column) -> Column:
    """bigint number of words of a text; null: 0."""
    return F.size(split_words(c)).cast("long")


def packed_texts(df: DataFrame, column: str = "_text") -> DataFrame:
    """df with a text column as compressed UTF-8 (null stays null), for shuffles: less than half of what Spark's own
    compression leaves of many short texts."""
    at, schema = df.columns.index(column), T.StructType([T.StructField(f.name, T.BinaryType() if f.name == column else f.dataType) for f in df.schema.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = pa.array([None if t is None else compress(t.encode("utf-8", "surrogatepass")) for t in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return df.mapInArrow(pack, schema)


def unpacked_text(data: bytes | None) -> bytes:
    """The UTF-8 of a packed text; null: none."""
    return zstandard.ZstdDecompressor().decompress(data) if data is not None else b""


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns, nested ones included, as tie-break between rows that differ elsewhere."""

    def unhashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return any(unhashable(f.dataType) for f in kind.fields)
        return unhashable(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(*[F.to_json(F.struct(f.name)) if unhashable(f.dataType) else F.col(f.name) for f in df.schema.fields])


def shingle_hash(w: Column, at: Column, size: int) -> Column:
    """Hash of `size` words from the 1-based place `at`; of shingles of another size than five the size is hashed too."""
    return F.xxhash64(*([] if size == SHINGLE else [F.lit(size)]), *[F.element_at(w, at + k) for k in range(size)])


def shingle_places(docs: DataFrame, words: Column, sizes: list[int]) -> DataFrame:
    """(_id, _th, _p, _hash): every shingle of the sizes, by its 1-based place. docs has _id and _text.

    Rows are numbers alone: a text never goes along with its places into a shuffle.
    """
    split = docs.select("_id", F.xxhash64("_text").alias("_th"), words.alias("_w")).withColumn("_n", F.size("_w"))
    # outer: the optimizer would otherwise test for emptiness below the split, and so split every text twice
    least = min(sizes)
    every = F.explode_outer(F.when(F.col("_n") >= least, F.sequence(F.lit(1), F.greatest(F.col("_n") - least + 1, F.lit(1)))))
    at = split.select("_id", "_th", "_n", "_w", every.alias("_p")).where("_p is not null")
    if sizes == [least]:
        return at.select("_id", "_th", "_p", shingle_hash(F.col("_w"), F.col("_p"), least).alias("_hash"))
    fits = [F.when(F.col("_p") + size - 1 <= F.col("_n"), shingle_hash(F.col("_w"), F.least(F.col("_p"), F.col("_n") - size + 1), size)) for size in sizes]
    return at.select("_id", "_th", "_p", F.explode_outer(F.array(*fits)).alias("_hash")).where("_hash is not null")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row_number(df: DataFrame, order: list[str], name: str, stage: str, drop: list[str] | None = None) -> tuple[DataFrame, int]:
    """Numbers the rows 0 .. n-1 in the order of the columns named; gives the frame and n.

    A range shuffle, a sort within partitions and one count for each partition; no task sees more than its range. The
    number is the rank, so it doesn't depend on where the ranges end. Rows equal in `order` must be interchangeable; a
    salt spreads many of them over partitions. The counts of partitions, not rows, go through the driver.
    """
    spark = df.sparkSession
    keys = [*order, "_salt"]
    placed = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()).drop("_salt", *(drop or [])), stage)
    part = F.shiftright("_at", 33)
    counts = sorted((r["_part"], r["n"]) for r in placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect())
    total, offsets = 0, []
    for p, n in counts:
        offsets.append((p, total))
        total += n
    starts = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _start bigint"))
    numbered = placed.withColumn("_part", part).join(starts, "_part")
    return numbered.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_start", "_at"), total
