"""Toxicity by compression distance: windows of a text compressed with a toxic and an ordinary zstandard dictionary."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, ascii_lower, internal, materialize, partitions, split_words

#: Labelled rows that the model is fitted on, at most about so many: picked by a hash of the id, three quarters
#: for the dictionaries, a quarter for calibration.
LABELLED_ROWS = 24_000
#: A beginning of a word tells toxic text if its log-likelihood ratio is over this (chi-squared, p = 1e-7) and most of
#: its windows are of toxic documents.
SIGNIFICANT = 28.0
#: Bytes of the commonest ordinary windows, in both dictionaries, and of the frame around every window.
COMMON_BYTES, FRAME_BYTES = 16384, 96
#: Rounds in which ordinary windows that the toxic dictionary saves FOOLED bytes on come into the ordinary one.
ROUNDS, FOOLED = 3, 2
#: A window is two words; longer words are cut into pieces.
WORD_BYTES = 48
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]{1,%d}" % WORD_BYTES)
#: Distances from 1 up are counted, those of 5 and more together.
BINS = 5
MEMO = 400_000
THRESHOLD = 0.3


def learns(doc_id: Column) -> Column:
    """Whether labels of a document may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) != 2


def windows(text: str | None) -> list[bytes]:
    """The words two by two, and a last one alone; of digits, letters and characters beyond ASCII, lower-cased A-Z."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    pairs = [b" %b %b " % pair for pair in zip(words[::2], words[1::2], strict=False)]
    return [*pairs, b" %b " % words[-1]] if len(words) % 2 else pairs


@dataclass
class Model:
    """Two dictionaries and the calibration of distances to probabilities."""

    toxic: bytes
    ordinary: bytes
    weights: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.name = hashlib.sha256(self.toxic + b"|" + self.ordinary).hexdigest()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}

    def distances(self, windows: list[bytes]) -> list[int]:
        """Bytes that the toxic dictionary saves over the ordinary one, for each window."""
        if not windows:
            return []
        if "_pair" not in self.__dict__:
            self._pair = [_compressor(d) for d in (self.ordinary, self.toxic)]
        framed = [FRAME + w + FRAME[:40] for w in windows]
        ordinary, toxic = (map(len, c.multi_compress_to_buffer(framed)) for c in self._pair)
        return [a - b for a, b in zip(ordinary, toxic, strict=True)]

    def features(self, text: str | None) -> tuple[int, ...]:
        """How many different windows of the text have which distance, and how many windows there are."""
        memo, counts, every = _memo(self.name), [0] * (BINS + 1), windows(text)
        different = set(every)
        unknown = [w for w in different if w not in memo]
        if len(memo) + len(unknown) > MEMO:
            memo.clear()
            unknown = list(different)
        for i in range(0, len(unknown), 4096):
            some = unknown[i : i + 4096]
            memo.update(zip(some, (min(max(d, 0), BINS) for d in self.distances(some)), strict=True))
        for window in different:
            counts[memo[window]] += 1
        return (*counts[1:], len(every))

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * math.log1p(x) for w, x in zip(self.weights[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


_memos: dict[str, dict[bytes, int]] = {}


def _memo(name: str) -> dict[bytes, int]:
    """Distances of windows that this worker has met; kept for one model at a time."""
    if name not in _memos:
        _memos.clear()
        _memos[name] = {}
    return _memos[name]


FRAME = b" ".join(b"%d" % 7**k for k in range(5, 19))[:FRAME_BYTES]


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    set_ = zstd.ZstdCompressionParameters(window_log=17, hash_log=17, chain_log=17, search_log=9, min_match=4, target_length=64, strategy=zstd.STRATEGY_GREEDY, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_content_size=False, write_dict_id=False)
    content = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=set_)
    return zstd.ZstdCompressor(compression_params=set_, dict_data=content)


def _joined(parts: list[bytes], room: int) -> bytes:
    """The first parts that there is room for, the first of them last (nearest to the text)."""
    kept, size = [], 0
    for x in parts:
        if size + len(x) > room:
            break
        kept.append(x)
        size += len(x)
    return b"".join(reversed(kept))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(_text, _toxic, _held): a bounded sample of labelled documents that may be learned from. Ids are compared as texts."""
    marks, _ = internal(labels, lid="doc_id", toxic="toxic")
    marks = marks.where(F.col("_toxic").isin(0, 1) & F.col("_lid").isNotNull() & learns(F.col("_lid"))).groupBy(F.col("_lid").cast("string").alias("_lid")).agg(F.max("_toxic").cast("int").alias("_toxic"))
    share = min(1.0, rows / max(1, marks.count()))
    part = F.pmod(F.xxhash64("_lid", F.lit(5)), F.lit(1_000_000))
    picked = marks.where(part < F.lit(int(share * 1_000_000))).withColumn("_held", F.pmod(part, F.lit(4)) == 0)
    return materialize(docs.join(F.broadcast(picked), docs["_id"].cast("string") == picked["_lid"]).select("_text", "_toxic", "_held"), "toxicity-labelled")


def labelled_windows(fitted: DataFrame) -> DataFrame:
    """(a, b, t, o): every two words that follow each other in the fitted documents, in how many of either class."""
    words = F.filter(split_words(ascii_lower(F.col("_text")), NOT_ALNUM), lambda w: F.octet_length(w) <= WORD_BYTES)
    many = F.greatest(F.size("_w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_w", 1, many), F.slice("_w", 2, many), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    seen = fitted.select("_toxic", words.alias("_w")).select("_toxic", F.explode(pairs).alias("p"))
    return seen.groupBy("p.a", "p.b").agg(F.sum("_toxic").alias("t"), F.sum(1 - F.col("_toxic")).alias("o"))


def beginnings(word: Column) -> Column:
    """The word between blanks, and its beginnings of four to ten characters with the blank before."""
    spaced = F.concat(F.lit(" "), word, F.lit(" "))
    return F.array_distinct(F.concat(F.transform(F.sequence(F.lit(5), F.lit(11)), lambda k: F.substring(spaced, F.lit(1), k)), F.array(spaced)))


def telling_forms(seen: DataFrame) -> list[str]:
    """Beginnings of words that tell toxic text, strongest first: of those alike, the longest with much the same count.

    A word counts once behind each different word, so that copies of a text count as one.
    """
    per_word = seen.groupBy(F.col("b").alias("w")).agg(F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o"))
    totals = per_word.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("o"), F.lit(0))).first()
    toxic, ordinary = float(totals[0]), float(totals[1])
    if not toxic or not ordinary:
        return []
    parts = per_word.select("t", "o", F.explode(beginnings(F.col("w"))).alias("p")).groupBy("p").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    rate = (F.col("t") + F.col("o")) / (toxic + ordinary)
    term = lambda seen, n: F.when(seen > 0, seen * F.log(seen / (n * rate))).otherwise(0.0) + (n - seen) * F.log((n - seen) / (n * (1 - rate)))
    ratio = 2 * (term(F.col("t").cast("double"), F.lit(toxic)) + term(F.col("o").cast("double"), F.lit(ordinary)))
    # few of a bounded sample's: each needs some ten windows of toxic documents
    found = {r["p"]: (r["t"], r["g"]) for r in parts.where((F.col("t") >= 3) & (F.col("t") > F.col("o"))).withColumn("g", ratio).where(F.col("g") >= SIGNIFICANT).collect()}
    best: dict[str, str] = {}
    for p in sorted(found, key=lambda p: (len(p), p)):
        root = next((p[:k] for k in range(5, len(p)) if p[:k] in found), p)
        if found[p][0] >= 0.8 * found[root][0]:
            best[root] = p
    return [best[r] for r in sorted(best, key=lambda r: (-found[r][1], r))]


def toxic_segments(seen: DataFrame, forms: list[str]) -> list[bytes]:
    """For each form a window of toxic text that has it, the one whose other word is the commonest in ordinary text."""
    spark = seen.sparkSession
    sides = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    spots = seen.where("t > 0").select(F.concat(F.lit(" "), "a", F.lit(" "), "b", F.lit(" ")).alias("window"), F.explode(sides).alias("s"))
    spots = spots.select("window", "s.y", F.explode(beginnings(F.col("s.x"))).alias("p")).join(F.broadcast(spark.createDataFrame([(f,) for f in forms], "p string")), "p")
    common = seen.groupBy(F.col("b").alias("y")).agg(F.sum("o").alias("n"))
    picked = spots.join(common, "y", "left").groupBy("p").agg(F.min_by("window", F.struct(-F.coalesce("n", F.lit(0)), F.col("window"))).alias("window")).collect()
    found = {r["p"]: r["window"].encode() for r in picked}
    return list(dict.fromkeys(found[f] for f in forms))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model:
    """Learns dictionaries and calibration from labelled documents. docs has _id and _text.

    Three quarters of the sample make two dictionaries of text, as raw content. Both begin with the commonest ordinary
    windows, so that ordinary text is as short with either. The toxic one goes on with segments of toxic text, one for
    each beginning of a word that tells the classes apart; the ordinary one with as many bytes of ordinary text, in
    rounds: the commonest ordinary windows that are still shorter with the toxic dictionary. The last quarter calibrates
    how many windows of which distance make which probability. Without toxic or ordinary labels, or anything that tells
    them apart, the score is the share of toxic ones.
    """
    sample = labelled_sample(docs, labels, rows)
    fitted, held = sample.where("not _held"), sample.where("_held")
    seen = materialize(labelled_windows(fitted), "toxicity-windows")
    forms = telling_forms(seen)
    if not forms:
        share = sample.agg(F.avg("_toxic")).first()[0] or 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Model(FRAME, FRAME, [math.log(share / (1 - share)), *[0.0] * (BINS + 1)])
    own = b"".join(reversed(toxic_segments(seen, forms)))
    window = lambda r: f" {r['a']} {r['b']} ".encode()
    top = [window(r) for r in seen.where("o > 0").orderBy(F.desc("o"), "a", "b").limit((COMMON_BYTES + 2 * len(own)) // 4).collect()]  # none is under 5 bytes
    top = [w for w in top if not any(f.encode() in w for f in forms)]
    common, hard = _joined(top, COMMON_BYTES), []
    rest = [w for w in top if w not in common]
    for round_ in range(ROUNDS + 1):
        model = Model(common + own + FRAME, common + _joined([*hard, *rest], len(own)) + FRAME)
        if round_ == ROUNDS:
            break

        def distances(batches: Iterator[pd.DataFrame], model: Model = model) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(d=model.distances([b" %b %b " % (a.encode(), b.encode()) for a, b in zip(batch["a"], batch["b"], strict=True)]))

        fooled = seen.where("o >= 2").select("a", "b", "o").repartition(partitions(seen.sparkSession)).mapInPandas(distances, "a string, b string, o long, d long").where(F.col("d") >= FOOLED)
        more = [window(r) for r in fooled.orderBy(F.desc("o"), F.desc("d"), "a", "b").limit(len(own) // 5 + 1).collect()]
        hard = list(dict.fromkeys([*more, *hard]))
    model.weights = calibrate(model, held)
    return model


def calibrate(model: Model, held: DataFrame, ridge: float = 1.0) -> list[float]:
    """Logistic weights of the logarithms of the features, by Newton's method over the held rows' features."""
    names = [f"x{i}" for i in range(BINS + 1)]

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [model.features(t) for t in batch["_text"]]
            yield pd.DataFrame({"y": batch["_toxic"], **{n: [r[i] for r in rows] for i, n in enumerate(names)}})

    counts = held.select("_text", "_toxic").mapInPandas(features, "y int, " + ", ".join(f"{n} int" for n in names)).groupBy("y", *names).count().orderBy("y", *names).collect()  # a quarter of the sample's rows at most
    x = np.log1p(np.array([[math.e - 1, *[r[n] for n in names]] for r in counts], float).reshape(-1, 1 + len(names)))
    y, n = np.array([r["y"] for r in counts], float), np.array([r["count"] for r in counts], float)
    w = np.zeros(1 + len(names))
    keep = ridge * np.diag([1e-3, *[1.0] * len(names)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + keep, x.T @ (n * (y - p)) - keep @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def scored(frame: DataFrame, model: Model, column: str = "_text", name: str = "_score") -> DataFrame:
    """frame with the score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return frame.withColumn(name, score(F.col(column)))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (0 to 1, higher is more toxic), predicted (score >= 0.3).

    Only the text is scored; null, empty and blank texts have no windows and get the score of a text without findings.
    Labels are learned from documents whose crc32(id) mod 4 isn't 2; null labels and ids are ignored. Repeated rows come
    out repeated; an empty table gives an empty one.
    """
    frame, _ = internal(docs, id="doc_id", text="text")
    model = fit(frame.select("_id", "_text"), labels, rows)
    found = scored(frame.select("_id", "_text"), model)
    return found.select(F.col("_id").alias("doc_id"), F.coalesce(~learns(F.col("_id")), F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """docs without the documents that are predicted toxic, with its columns.

    Documents with a null or empty text are scored as texts without findings and so stay (unless most labels are toxic);
    repeated rows stay or go together; without labels all stay; an empty table gives an empty one.
    """
    frame, back = internal(docs, id="doc_id", text="text")
    model = fit(frame.select("_id", "_text"), labels, rows)
    return scored(frame, model).where(F.col("_score") < THRESHOLD).select(*back)
