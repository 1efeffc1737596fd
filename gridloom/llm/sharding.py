"""A reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import internal, row_hash, with_added, with_row_number

#: A walk outside the row numbers is this long at most; the chance that a longer one is needed is below 1e-30.
MAX_WALK = 64


def round_keys(seed: str, rounds: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "big", signed=True) for i in range(rounds)]


def feistel(x: Column, side: int, keys: list[int]) -> Column:
    """One pass of the network over 0 .. side*side-1: halves in base `side`, mixed by addition, so it permutes."""
    m = F.lit(side).cast("long")
    start = F.struct(F.call_function("div", x, m).alias("l"), F.pmod(x, m).alias("r"))
    turn = lambda s, k: F.struct(s["r"].alias("l"), F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], k), m), m).alias("r"))
    return F.aggregate(F.array(*[F.lit(k).cast("long") for k in keys]), start, turn, lambda s: s["l"] * m + s["r"])


def permuted(row_number: Column, rows: int, seed: str = "shuffle-1", rounds: int = 6) -> Column:
    """The place 0 .. rows-1 of a row number. Equal for equal (row number, rows, seed), on any cluster.

    The network permutes side*side >= rows numbers, side being the root rounded up, so hardly any place is out of
    range; those that are, walk on along their cycle until they are back in range.
    """
    side = isqrt(max(rows - 1, 0)) + 1
    keys, n = round_keys(seed, rounds), F.lit(rows).cast("long")
    outside = side * side - rows
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(min(outside, MAX_WALK))), feistel(row_number, side, keys), lambda at, _: F.when(at < n, at).otherwise(feistel(at, side, keys))) if outside else feistel(row_number, side, keys)
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a cycle walk was too long; take another seed")).cast("long"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: str = "shuffle-1", carry: list[str] | None = None) -> DataFrame:
    """Every row of docs with size, text_crc32, law (`rows`), shard, slot and grown_shard (null).

    Rows are numbered in the order of doc_id (nulls first), then text and other columns by hash; the permuted number p
    gives shard p mod shards and slot p div shards, so shards differ by one row at most and slots have no gaps. Law
    `rows`: a shard or slot can be computed from the row number alone; no groups are kept together, equal texts are
    spread like others. carry: the columns to keep (all; columns with the names of added ones give way). A null text
    has size 1 and crc 0; repeated rows each get a slot of their own; an empty table gives an empty one.
    """
    frame, back = internal(docs, id="doc_id", text="text")
    text = F.coalesce("_text", F.lit(""))
    names, kept = zip(*[(n, b) for n, b in zip(docs.columns, back, strict=True) if carry is None or n in carry], strict=True)
    own = [frame.columns[docs.columns.index(n)] for n in names]
    order = {"_k0": F.col("_id"), "_k1": F.xxhash64(text), "_k2": row_hash(frame)}
    sized = frame.withColumns(order | {"_size": F.octet_length(text).cast("long") + 1, "_crc": F.crc32(text)}).select(*own, *order, "_size", "_crc")
    numbered, rows = with_row_number(sized, [*order], "_n", "shuffle", drop=[*order])
    k = F.lit(shards).cast("long")
    placed = numbered.withColumn("_p", permuted(F.col("_n"), rows, seed))
    return placed.select(*with_added(list(kept), list(names), size=F.col("_size"), text_crc32=F.col("_crc"), law=F.lit("rows"), shard=F.pmod("_p", k).cast("int"), slot=F.call_function("div", F.col("_p"), k), grown_shard=F.lit(None).cast("int")))
