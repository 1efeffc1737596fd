"""Substring dedup: windows of words that start earlier elsewhere, by a count-min prefilter and an exact second pass."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import internal, packed_texts, partitions, unpacked_text, with_added

#: Words of a window.
WINDOW = 20
#: Bytes of text of a part, about; a part is what has a sketch of its own. A longer text is in a part with others.
PART_BYTES = 8 << 20
#: Rows of the sketch, cells of each for a window, and cells (as a power of two) that are merged in one task. The width
#: grows with the texts, so that estimates are as good at any size; no task and no message holds a whole sketch.
DEPTH, CELLS, BLOCK_BITS = 2, 8, 23
#: Bytes of a text for a word, about: sizes the sketch.
WORD_BYTES = 6


#: Odd numbers by which hashes of words are combined, one for each half of a digest.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _digests(hashes: np.ndarray, window: int, factor: int) -> np.ndarray:
    """64 bits for each stretch of `window` numbers: a polynomial in the factor, from stretches of doubling length."""
    n, at, length = len(hashes) - window + 1, 0, 1
    done = np.zeros(max(n, 0), np.uint64)
    power = lambda k: np.uint64(pow(factor, k, 1 << 64))
    while n > 0 and at < window:
        if window & length:
            done += hashes[at : at + n] * power(at)
            at += length
        if at < window:
            hashes, length = hashes[:-length] + hashes[length:] * power(length), 2 * length
    return done


class _Part:
    """The windows of a part: documents in order of their ids (null last), then of rows; words are split once."""

    def __init__(self, part: pa.Table, window: int):
        ids, rows, texts = (part.column(c).to_pylist() for c in ("_id", "_row", "_text"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, rows[i]))
        self.ids, self.rows = [ids[i] for i in order], [rows[i] for i in order]
        numbers: dict[bytes, int] = {}
        found = []
        for i in order:
            words = unpacked_text(texts[i]).split()
            new = set(words).difference(numbers)
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
            found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            texts[i] = None
        self.vocabulary = list(numbers)
        self.sizes = np.array([len(f) for f in found], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.words = np.concatenate(found) if found else np.zeros(0, np.int64)
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.vocabulary)), np.uint64).reshape(-1, 2)
        inside = np.arange(len(self.words)) + window <= np.repeat(self.ends, self.sizes)
        self.starts = np.flatnonzero(inside)  # places, in all words, where a document's windows start
        self.digests = [_digests(hashes[self.words, d], window, _FACTORS[d])[self.starts] for d in range(2)]

    def cells(self, bits: int, of: np.ndarray | slice = slice(None)) -> list[np.ndarray]:
        """For each row of the sketch the cells of windows."""
        return [self.digests[d][of] >> np.uint64(64 - bits) for d in range(DEPTH)]

    def grouped(self) -> tuple[np.ndarray, np.ndarray]:
        """The first of each different window, and for every window which of these it equals."""
        by = np.argsort(self.digests[0], kind="stable")
        one, other = (d[by] for d in self.digests)
        same = one[1:] == one[:-1]
        if (other[1:] != other[:-1])[same].any():  # equal in one half alone
            by = np.lexsort((self.digests[1], self.digests[0]))
            one, other = (d[by] for d in self.digests)
            same = (one[1:] == one[:-1]) & (other[1:] == other[:-1])
        new = np.concatenate(([True], ~same)) if len(by) else np.zeros(0, bool)
        group = np.empty(len(by), np.int64)
        group[by] = np.cumsum(new) - 1
        return by[new], group


def _packed(cells: np.ndarray) -> bytes:
    """Ascending numbers below 2^32: gaps, byte by byte, compressed."""
    gaps = np.diff(cells.astype(np.int64), prepend=0).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


_CELLS = pa.schema([("_depth", pa.int32()), ("_block", pa.int64()), ("_part", pa.int64()), ("_cells", pa.binary())])
_CELLS_SQL = "_depth int, _block bigint, _part bigint, _cells binary"


def part_sketches(parts: DataFrame, bits: int, block_bits: int, window: int) -> DataFrame:
    """(_depth, _block, _part, _cells): the cells that a part's windows touch. What occurs again within a part counts
    once: the part sees that itself, so the sketch counts the parts that have a window."""

    def sketch(part: pa.Table) -> pa.Table:
        number, rows = part.column("_part")[0].as_py(), []
        for depth, cells in enumerate(_Part(part, window).cells(bits)):
            cells = np.sort(cells)
            cells = cells[np.concatenate(([True], cells[1:] != cells[:-1]))] if len(cells) else cells
            blocks = (cells >> np.uint64(block_bits)).astype(np.int64)
            edges = np.concatenate(([0], np.flatnonzero(np.diff(blocks)) + 1, [len(cells)])).tolist() if len(cells) else [0]
            for a, b in zip(edges, edges[1:], strict=False):
                rows.append({"_depth": depth, "_block": int(blocks[a]), "_part": number, "_cells": _packed(cells[a:b] & np.uint64((1 << block_bits) - 1))})
        return pa.Table.from_pylist(rows, _CELLS)

    return parts.groupBy("_part").applyInArrow(sketch, _CELLS_SQL)


def estimated_repeats(sketches: DataFrame, block_bits: int) -> DataFrame:
    """(_depth, _block, _part, _cells): of each part's cells those that the merged sketch counts twice or more."""

    def merge(block: pa.Table) -> pa.Table:
        of = [_unpacked(c.as_py()) for c in block.column("_cells")]
        counts = np.zeros(1 << block_bits, np.uint8)
        for cells in of:
            counts[cells] = np.minimum(counts[cells] + 1, 2)
        rows = []
        for cells, depth, number, part in zip(of, *(block.column(c).to_pylist() for c in ("_depth", "_block", "_part")), strict=True):
            twice = cells[counts[cells] == 2]
            if len(twice):
                rows.append({"_depth": depth, "_block": number, "_part": part, "_cells": _packed(twice)})
        return pa.Table.from_pylist(rows, _CELLS)

    return sketches.groupBy("_depth", "_block").applyInArrow(merge, _CELLS_SQL)


def later_windows(parts: DataFrame, estimated: DataFrame, bits: int, block_bits: int, window: int, kind: str) -> DataFrame:
    """(_part, _place): windows whose words also start in an earlier part's document, by place in their part.

    Only windows that every row of the sketch counts twice are sent, one for each part that has it, and grouped by all
    128 bits; so the commonest window has no more rows than there are parts.
    """

    def ask(part: pa.Table, repeats: pa.Table) -> pa.Table:
        schema = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("_part", pa.int64()), ("_place", pa.int64()), ("_id", part.schema.field("_id").type), ("_row", pa.int64())])
        if not part.num_rows or not repeats.num_rows:
            return schema.empty_table()
        own, number = _Part(part, window), part.column("_part")[0].as_py()
        first, _ = own.grouped()
        told: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]
        for depth, block, cells in zip(*(repeats.column(c).to_pylist() for c in ("_depth", "_block", "_cells")), strict=True):
            told[depth].append(_unpacked(cells) + (block << block_bits))
        here = np.ones(len(first), bool)
        for among, cells in zip(told, own.cells(bits, first), strict=True):
            here &= np.isin(cells.astype(np.int64), np.concatenate(among)) if among else False
        places = np.sort(first[here])
        docs = np.searchsorted(own.ends, own.starts[places], "right").tolist()
        columns = [pa.array(d[places].view(np.int64)) for d in own.digests] + [pa.array(np.full(len(places), number, np.int64)), pa.array(places)]
        return pa.Table.from_arrays([*columns, pa.array([own.ids[d] for d in docs], schema.field("_id").type), pa.array([own.rows[d] for d in docs], pa.int64())], schema=schema)

    asked = parts.groupBy("_part").cogroup(estimated.groupBy("_part")).applyInArrow(ask, f"_k1 bigint, _k2 bigint, _part bigint, _place bigint, _id {kind}, _row bigint")
    # a document is in one part: of two parts the one that has the earlier document has the window earlier
    at = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))
    first = F.min(at).over(Window.partitionBy("_k1", "_k2"))
    return asked.withColumns({"_at": at, "_first": first}).where(F.col("_at") != F.col("_first")).select("_part", "_place")


def _kept(parts: DataFrame, later: DataFrame, window: int, kind: str) -> DataFrame:
    """(_row, _id, _n, _removed, _kept) of every document."""

    def remove(part: pa.Table, later: pa.Table) -> pa.Table:
        schema = pa.schema([("_row", pa.int64()), ("_id", part.schema.field("_id").type), ("_n", pa.int64()), ("_removed", pa.int64()), ("_kept", pa.string())])
        own = _Part(part, window)
        first, group = own.grouped()
        again = np.ones(len(group), bool)
        again[first] = False
        if later.num_rows:
            there = np.zeros(len(first), bool)
            there[group[later.column("_place").to_numpy()]] = True
            again |= there[group]
        covered = np.zeros(len(own.words) + 1, np.int64)
        covered[own.starts[again]] += 1
        covered[own.starts[again] + window] -= 1
        stays = np.cumsum(covered[:-1]) == 0
        rows = []
        for id_, row, begin, end in zip(own.ids, own.rows, (own.ends - own.sizes).tolist(), own.ends.tolist(), strict=True):
            kept = [own.vocabulary[w] for w in own.words[begin:end][stays[begin:end]].tolist()]
            rows.append((row, id_, end - begin, end - begin - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return parts.groupBy("_part").cogroup(later.groupBy("_part")).applyInArrow(remove, f"_row bigint, _id {kind}, _n bigint, _removed bigint, _kept string")


def without_repeats(docs: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, and kept, the words that stay, joined by one space.

    Words are runs of other characters than space and 09-0D. A word goes if it is in a window of 20 words whose sequence
    of words also starts earlier: in a document of smaller id, or in the same one further ahead. Windows are judged on the
    texts as they come. Documents without an id come last; documents with equal ids are in the order of their rows.

    Texts are dealt into parts by row. Each part sketches its windows: the cells that they touch in a count-min sketch,
    whose blocks are merged side by side; a block answers every part with those of its cells that count twice or more.
    Merged counts are never too low, so windows that aren't told are in one part alone, and no repeat is lost. The other
    ones, repeated or overestimated, are grouped exactly by their digests of 128 bits, and each part learns which of its
    windows start earlier elsewhere; within itself it sees repeats directly. All steps read the texts from one shuffle.

    A null or empty text has no words; a text shorter than a window keeps all; repeated rows are copies of each other, so
    only the first of them keeps its windows; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    frame, _ = internal(docs, id="doc_id", text="text")
    frame = frame.select("_id", "_text")
    size = frame.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = max(block_bits, ceil(log2(max(1, size * CELLS // WORD_BYTES))))
    n_parts = max(partitions(spark), ceil(size / part_bytes))
    kind = frame.schema["_id"].dataType.simpleString()
    placed = packed_texts(frame.withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(n_parts)))
    parts = placed.repartition(n_parts, "_part")
    estimated = estimated_repeats(part_sketches(parts, bits, block_bits, window), block_bits)
    later = later_windows(parts, estimated, bits, block_bits, window, kind)
    kept = _kept(parts, later, window, kind)
    return kept.select(*with_added([], [], doc_id=F.col("_id"), n_words=F.col("_n"), n_removed=F.col("_removed"), kept=F.col("_kept")))
