"""Near-duplicates by SimHash: fingerprints, links by multi-index hashing, components over the links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import internal, materialize, row_hash

#: Shingles that are hashed at a time: bounds the memory that a very long text takes.
CHUNK = 1 << 16
#: A table bucket of up to so many fingerprints is verified one by one; in a fuller one the rest of the fingerprint is
#: enumerated too, so that only true links come out of it.
FULL_BUCKET = 16
HALF = 32
LOW = (1 << HALF) - 1

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def simhash(text: str | None, width: int = 3) -> int:
    """The 64-bit fingerprint of a text, as a signed integer: a bit is set if over half the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    ends = ends[width - 1 :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], 42) for a, b in spans], np.uint64).view(np.uint8).reshape(-1, 8)
        if len(hashes) < 512:
            ones += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            for byte in range(8):
                ones[8 * byte : 8 * byte + 8] += np.bincount(hashes[:, byte], minlength=256) @ _BITS
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprints(frame: DataFrame) -> DataFrame:
    """frame (_id, _text, and others) with _fp in place of _text."""
    kept = [c for c in frame.columns if c != "_text"]

    def fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[kept].copy()
            out["_fp"] = np.fromiter(map(simhash, batch["_text"]), np.int64, len(batch))
            yield out

    schema = frame.drop("_text").schema.add("_fp", "long")
    return frame.mapInPandas(fingerprints, schema)


def _mask(bits: tuple[int, ...]) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >= 1 << 63 else x


def _masks(positions: range, most: int, least: int = 1) -> F.Column:
    return F.array(*[F.lit(_mask(b)).cast("long") for n in range(least, most + 1) for b in combinations(positions, n)])


def links(prints: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """Pairs (a, b), a != b, of distinct fingerprints (_fp) at 2 or fewer differing bits; each pair once.

    Two halves index two tables. A pair at up to 2 bits has an equal half, or both halves at distance 1; so a fingerprint
    looks up its own halves and the ball of radius 1 around its upper one (the side that lacks the differing bit does). What a table returns is verified by complete distance. Buckets that hold more than
    full_bucket fingerprints would return all their pairs, so there the other half's ball is enumerated as well and
    whole fingerprints are fetched: a row for each true link, at most 2,080 probes for a fingerprint, nothing left out.
    """
    hi, lo = F.shiftrightunsigned("_fp", HALF), F.col("_fp").bitwiseAND(F.lit(LOW))
    table = prints.select("_fp", hi.alias("_hi"), lo.alias("_lo"))

    def crowded(half: str) -> DataFrame:
        return table.groupBy(half).count().where(F.col("count") > full_bucket).select(half, F.lit(True).alias(f"{half}_full"))

    flagged = table
    for half in ("_hi", "_lo"):
        flagged = flagged.join(crowded(half), half, "left")
    flagged = materialize(flagged.select("_fp", "_hi", "_lo", F.coalesce("_hi_full", F.lit(False)).alias("_hi_full"), F.coalesce("_lo_full", F.lit(False)).alias("_lo_full")), "simhash-prints")
    full_hi = materialize(flagged.where("_hi_full").select("_hi").distinct(), "simhash-full")

    distance = lambda half: F.bit_count(F.col(f"a.{half}").bitwiseXOR(F.col(f"b.{half}")))
    pair = [F.col("a._fp").alias("a"), F.col("b._fp").alias("b")]

    def within(half: str, other: str) -> DataFrame:
        cold = flagged.where(~F.col(f"{half}_full"))
        return cold.alias("a").join(cold.alias("b"), half).where((F.col("a._fp") < F.col("b._fp")) & (distance(other) <= 2)).select(*pair)

    bits = F.array(*[F.lit(1 << b).cast("long") for b in range(HALF)])
    near = flagged.select("_fp", "_lo", "_hi", F.explode(F.filter(bits, lambda m: F.col("_hi").bitwiseAND(m) == 0)).alias("_bit"))
    near = near.select("_fp", "_lo", F.col("_hi").bitwiseOR(F.col("_bit")).alias("_hi"))
    cold_near = near.alias("a").join(flagged.where(~F.col("_hi_full")).alias("b"), "_hi").where(distance("_lo") == 1).select(*pair)

    def probes(frame: DataFrame, masks: F.Column) -> DataFrame:
        return frame.select(F.col("_fp").alias("a"), F.explode(masks).alias("_mask")).select("a", F.col("a").bitwiseXOR(F.col("_mask")).alias("_fp")).where(F.col("_fp") > F.col("a"))

    hot_near = near.join(full_hi, "_hi", "left_semi").select(F.col("_fp").alias("a"), F.shiftleft("_hi", HALF).bitwiseOR(F.col("_lo")).alias("_at"), F.explode(_masks(range(HALF), 1)).alias("_mask"))
    looked_up = probes(flagged.where("_hi_full"), _masks(range(HALF), 2)).union(probes(flagged.where("_lo_full"), _masks(range(HALF, 64), 2)))
    looked_up = looked_up.union(hot_near.select("a", F.col("_at").bitwiseXOR(F.col("_mask"))))
    fetched = looked_up.join(flagged.select("_fp"), "_fp").select("a", F.col("_fp").alias("b"))
    return within("_hi", "_lo").union(within("_lo", "_hi")).union(cold_near).union(fetched)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of edges (a, b) with the smallest node that it reaches.

    Large-star and small-star steps in turn, each a group-by-minimum and a join, until nothing changes; the rounds grow
    with the logarithm of the longest chain. Every round is a table in the shared folder; only a count and a checksum
    come to the driver.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        now = materialize(small, "components")
        seen = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen


def grouped(frame: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """frame (_id, _text, ...) with _fp, _root and _component in place of _text: the smallest _fp and _id that are reachable.

    _root tells components apart; _component doesn't: it is null without ids, and texts that share an id share it.
    """
    prints = materialize(with_fingerprints(frame), "simhash")
    distinct = materialize(prints.groupBy("_fp").agg(F.min("_id").alias("_least")), "simhash-distinct")
    root = components(links(distinct, full_bucket))
    classes = distinct.join(root.withColumnRenamed("node", "_fp"), "_fp", "left").withColumn("_root", F.coalesce("root", "_fp"))
    names = classes.groupBy("_root").agg(F.min("_least").alias("_component"))
    return prints.join(classes.select("_fp", "_root").join(names, "_root").select("_fp", "_root", "_component"), "_fp")


def near_duplicates(docs: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits) and component_id.

    Words are lower-cased (A-Z), shingles are three words, repeats included; fingerprints link at 2 or fewer bits, and
    component_id is the smallest doc_id that is reachable over links, the document's own included. Null, empty and blank
    texts have fingerprint zero and are linked like others. Repeated rows come out repeated; a null doc_id is kept but
    never names a component (null if the component has no other). An empty table gives an empty one.
    """
    frame, _ = internal(docs, id="doc_id", text="text")
    found = grouped(frame.select("_id", "_text"), full_bucket)
    return found.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without near-duplicates: of each component the row with the smallest doc_id stays, and one only.

    Of a component's rows with the same doc_id, or of a component without ids, the row with the smallest hash of its
    columns stays. Unrelated texts that have no id, or the same one, are components of their own and all stay.
    """
    frame, back = internal(docs, id="doc_id", text="text")
    frame = frame.withColumn("_rh", row_hash(frame))
    found = grouped(frame.select("_id", "_rh", "_text"))
    first = found.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_rh").alias("h"))).alias("_first"))
    keep = first.select(F.col("_first.i").alias("_ki"), F.col("_first.h").alias("_kh"))
    stay = frame.join(keep, F.col("_id").eqNullSafe(F.col("_ki")) & (F.col("_rh") == F.col("_kh")), "left_semi")
    return stay.dropDuplicates(["_id", "_rh"]).select(*back)
