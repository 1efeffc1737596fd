"""Language-model scoring with quantised n-gram counts in a log-frequency Bloom filter."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import internal, packed_texts, partitions, unpacked_text

#: Counts are held as 1 + floor(log(count) / log(BASE)); an n-gram is in the filter once for each of these levels.
BASE = 1.5
LEVELS = 64
#: Bits of the filter for each level of each n-gram, and bits that one level sets.
BITS, HASHES = 9, 5
#: Bytes of text of a part, and of a shard of the filter, about; there are 64 shards at least. Both grow in number with
#: the texts, not in size.
PART_BYTES, SHARD_BYTES, LEAST_SHARD_BITS = 8 << 20, 1 << 26, 6
#: Weight, in observations, of the unigram in a bigram's probability.
PRIOR = 100.0
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
START = np.uint64(0x5851F42D4C957F2D)
SEED = 42  # that of the built-in xxhash64
END = xxhash.xxh64_intdigest(b"", SEED)  # no word is empty


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def bigram_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(before * _K1 + (words << np.uint64(23) | words >> np.uint64(41)))


def levels(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(counts) / log(BASE) + 1e-9), LEVELS).astype(np.int64)


def _expected() -> np.ndarray:
    """The mean of the counts of each level; 0 for level 0."""
    low = np.ceil(BASE ** np.arange(LEVELS) - 1e-9)
    high = np.maximum(np.ceil(BASE ** np.arange(1, LEVELS + 1) - 1e-9) - 1, low)
    return np.concatenate(([0.0], (low + high) / 2))


EXPECTED = _expected()


def places(keys: np.ndarray, level: int, bits: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    """The bits that stand for a level of each key, of so many (or of as many as `bits` has for each)."""
    at = mixed(keys + np.uint64(level * int(_K1) % (1 << 64)))
    step = mixed(at) | np.uint64(1)
    for _ in range(HASHES):
        yield ((at >> np.uint64(32)) * bits) >> np.uint64(32)
        at = at + step


def built(keys: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    """Bits and bytes of the filter of distinct keys."""
    level = levels(counts)
    bits = max(64, int(level.sum()) * BITS)
    marks = np.zeros(bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        held = keys[level >= j]
        for at in places(held, j, np.uint64(bits)):
            marks[at.astype(np.int64)] = True
    return bits, np.packbits(marks, bitorder="little").tobytes()


def probed(keys: np.ndarray, bits: np.ndarray, first: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The level of each key: level 1, 2, ... is probed until one is missing. bits, first: how many bits the shard of
    each key has, and its first one in the marks."""
    found, alive = np.zeros(len(keys), np.int64), np.arange(len(keys))
    for j in range(1, LEVELS + 1):
        ok = np.ones(len(keys), bool)
        for at in places(keys, j, bits):
            at += first
            ok &= (marks[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        alive, keys, bits, first = alive[ok], keys[ok], bits[ok], first[ok]
        if not len(alive):
            break
        found[alive] = j
    return found


class Filter:
    """All shards of a log-frequency Bloom filter, one behind the other. Keys' first bits name their shard."""

    def __init__(self, shard_bits: int, shards: dict[int, tuple[int, bytes]]) -> None:
        self.shard_bits = shard_bits
        self.bits, self.first, at = np.zeros(1 << shard_bits, np.uint64), np.zeros(1 << shard_bits, np.uint64), 8
        parts = [b"\0"]  # the byte of shards that aren't there: one bit, not set
        for shard, (bits, data) in sorted(shards.items()):
            self.bits[shard], self.first[shard] = bits, at
            parts.append(data)
            at += 8 * len(data)
        self.marks = np.frombuffer(b"".join(parts), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The levels of keys; best sorted, so that a shard's bytes are read together."""
        shard = (keys >> np.uint64(64 - self.shard_bits)).astype(np.int64) if self.shard_bits else np.zeros(len(keys), np.int64)
        return probed(keys, self.bits[shard], self.first[shard], self.marks)


def learns(doc_id: Column) -> Column:
    """Whether a document is for training; one without an id is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) != 2, F.lit(True))


class _Part:
    """The tokens of some documents: words lower-cased A-Z, and one end for each document."""

    def __init__(self, part: pa.Table):
        texts, train = part.column("_text").to_pylist(), part.column("_train").to_numpy()
        numbers: dict[bytes, int] = {b"": 0}  # no word is empty: that is the end
        found = []
        for i, text in enumerate(texts):
            words = unpacked_text(text).lower().split()
            new = set(words).difference(numbers)
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
            words.append(b"")
            found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            texts[i] = None
        self.sizes = np.array([len(f) for f in found], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        digest = xxhash.xxh64_intdigest
        self.hashes = np.fromiter((digest(w, SEED) for w in numbers), np.uint64, len(numbers))[np.concatenate(found)]
        self.learnt = np.repeat(train, self.sizes)
        before = np.empty_like(self.hashes)
        before[1:] = self.hashes[:-1]
        before[self.begins] = START
        self.keys = {1: self.hashes, 2: bigram_keys(before, self.hashes)}

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different n-grams in order, how often each occurs in training documents, and which of them each token's is."""
        order = np.argsort(self.keys[n], kind="stable")
        keys = self.keys[n][order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        return keys[new], np.add.reduceat(self.learnt[order].astype(np.int64), np.flatnonzero(new)), at


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, the lowest bytes first, compressed: small ones take little."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _rising(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


_ASKED = "_n tinyint, _shard int, _part bigint, _keys binary, _counts binary"
_ANSWERED = "_n tinyint, _shard int, _part bigint, _levels binary, _exact binary, _tokens bigint, _words bigint, _texts bigint"


def questions(parts: DataFrame, shard_bits: int) -> DataFrame:
    """For each part and shard the different n-grams that the part has there, and their counts in its training documents.

    A part asks for an n-gram once, so even the commonest one has no more questions than there are parts.
    """

    def ask(part: pa.Table) -> pa.Table:
        own, number, rows = _Part(part), part.column("_part")[0].as_py(), []
        for n in (1, 2):
            keys, counts, _ = own.distinct(n)
            shards = (keys >> np.uint64(64 - shard_bits)).astype(np.int64)
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(keys)]
            rows += [{"_n": n, "_shard": int(shards[a]), "_part": number, "_keys": _rising(keys[a:b]), "_counts": _packed(counts[a:b])} for a, b in zip(edges, edges[1:], strict=False)]
        return pa.Table.from_pylist(rows, pa.schema([("_n", pa.int8()), ("_shard", pa.int32()), ("_part", pa.int64()), ("_keys", pa.binary()), ("_counts", pa.binary())]))

    return parts.groupBy("_part").applyInArrow(ask, _ASKED)


def answers(asked: DataFrame) -> DataFrame:
    """For each question the levels of its n-grams, of unigrams also the exact counts; and the shard's totals, once.

    Counts of all parts make the shard's filter, whose levels are probed for every n-gram that was asked.
    """

    def answer(shard: pa.Table) -> pa.Table:
        n = shard.column("_n")[0].as_py()
        asked = [np.cumsum(_unpacked(k.as_py())) for k in shard.column("_keys")]
        every, counts = np.concatenate(asked), np.concatenate([_unpacked(c.as_py()) for c in shard.column("_counts")]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        new = np.concatenate(([True], every[order[1:]] != every[order[:-1]]))
        keys, sums = every[order][new], np.add.reduceat(counts[order], np.flatnonzero(new))
        del every, order
        seen = sums > 0
        level = Filter(0, {0: built(keys[seen], sums[seen].astype(float))}).levels(keys).astype(np.uint8)
        totals = (int(sums.sum()), int(seen.sum()), int(sums[keys == np.uint64(END)].sum())) if n == 1 else (0, 0, 0)
        at = [np.searchsorted(keys, k) for k in asked]
        compress = zstandard.ZstdCompressor(level=1).compress
        return pa.Table.from_arrays(
            [
                shard.column("_n").cast(pa.int8()), shard.column("_shard").cast(pa.int32()), shard.column("_part"), pa.array([compress(level[i].tobytes()) for i in at], pa.binary()),
                pa.array([_packed(sums[i]) if n == 1 else None for i in at], pa.binary()), *[pa.array([t] + [0] * (len(at) - 1), pa.int64()) for t in totals],
            ],
            names=["_n", "_shard", "_part", "_levels", "_exact", "_tokens", "_words", "_texts"],
        )

    return asked.groupBy("_n", "_shard").applyInArrow(answer, _ANSWERED)


def score_documents(docs: DataFrame, prior: float = PRIOR, part_bytes: int = PART_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the text lower-cased A-Z, then one end token. Training documents, those whose crc32(id) mod
    7 isn't 2, give the exact counts c of all N tokens, V of them distinct, and the filters of unigrams and bigrams.
    base_score: the sum over tokens of log10((c + 1) / (N + V + 1)). score: the sum of log10((b + prior * p) / (a +
    prior)), where p is that unigram probability, and p and the counts b of the bigram and a of the token before come
    from the filters: level after level is probed until one is missing, and the last gives the expected count.

    The filter grows with the corpus, so it isn't sent to the texts: it stays in shards by the n-grams' first bits, each
    in one task, and what travels are the n-grams. Texts are dealt into parts; a part sends each of its different n-grams
    once to its shard, with the count in its training documents; the shard adds up the counts, builds its filter, and
    answers each part with the levels. Nothing is collected or broadcast, at any size, and all steps are linear in the
    corpus; they read the texts from one shuffle.

    A null text has the end token alone; without training documents every probability is 1 / (N + V + 1) = 1. Repeated
    rows come out repeated, documents without an id are training documents; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    frame, _ = internal(docs, id="doc_id", text="text")
    size = frame.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shard_bits = max(LEAST_SHARD_BITS, ceil(np.log2(max(1, size / shard_bytes))))
    n_parts = max(partitions(spark), ceil(size / part_bytes))
    placed = frame.select("_id", "_text", learns(F.col("_id")).alias("_train"), F.monotonically_increasing_id().alias("_row"))
    parts = packed_texts(placed).withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(n_parts))).repartition(n_parts, "_part")
    told = answers(questions(parts, shard_bits)).repartition(n_parts, "_part")
    # counting the other columns too keeps them in the shuffle, so that the answers are worked out once and read twice
    others = [F.count(c).alias(c) for c in told.columns if c not in ("_tokens", "_words", "_texts")]
    totals = told.agg(F.struct(F.sum("_tokens").alias("n"), F.sum("_words").alias("v"), F.sum("_texts").alias("d"), *others).alias("_totals"))
    told = told.withColumn("_totals", totals.scalar())
    kind = frame.schema["_id"].dataType.simpleString()

    def score(part: pa.Table, told: pa.Table) -> pa.Table:
        own = _Part(part)
        totals = told.column("_totals")[0].as_py()
        n, rest, n_train = totals["n"], float(totals["n"] + totals["v"] + 1), totals["d"]
        told = told.sort_by([("_n", "ascending"), ("_shard", "ascending")])
        level: dict[int, list[np.ndarray]] = {1: [], 2: []}
        exact = []
        for of, levels_, counts in zip(*(told.column(c).to_pylist() for c in ("_n", "_levels", "_exact")), strict=True):
            level[of].append(np.frombuffer(zstandard.ZstdDecompressor().decompress(levels_), np.uint8))
            if of == 1:
                exact.append(_unpacked(counts))
        (_, _, one), (_, _, two) = own.distinct(1), own.distinct(2)
        seen, both = EXPECTED[np.concatenate(level[1])][one], EXPECTED[np.concatenate(level[2])][two]
        c = np.concatenate(exact).astype(np.int64)[one]
        history = np.empty_like(seen)
        history[1:] = seen[:-1]
        history[own.begins] = n_train
        add = lambda x: np.add.reduceat(x, own.begins)
        p = np.log10((both + prior * (seen + 1) / rest) / (history + prior))
        base = add(np.log10(c + 1.0)) - own.sizes * np.log10(rest)
        held = pc.invert(part.column("_train"))
        columns = [part.column("_id"), held, pa.array(own.sizes), pa.array(add((c > 0).astype(np.int64))), pa.array(np.full(len(own.sizes), n, np.int64)), pa.array(base), pa.array(add(p))]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return parts.groupBy("_part").cogroup(told.groupBy("_part")).applyInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
