"""Quality rules: fixed rules on words and lines, and a hashed n-gram likelihood ratio against trusted text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import internal, materialize, split_words

#: Labelled rows that the trusted multinomial and the threshold come from, at most about so many, picked by a hash.
LABELLED_ROWS = 50_000
#: Hash buckets of n-grams: bounds the table that is broadcast, whatever the corpus.
BUCKETS = 1 << 16
#: Pseudo-counts of a bucket, spread as the raw corpus is.
PRIOR = 0.5
#: Scores are compared with the threshold on this grid.
GRID = 500
#: Log ratios are held as whole numbers of this part.
SCALE = 1 << 20
SYMBOLS = r"[#*$%&|<>]"


def bound(value: Column, body) -> Column:
    """body(value), with value evaluated once for a row however often body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = 8) -> Column:
    """How many words lie in windows of `window` words that occur twice or more in the text, the first included.

    Windows are sorted by hash within the row, so a text of n words takes n log n steps. Most texts repeat no window,
    which the number of different ones tells.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, F.lit(window))))

    def covered(order: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        twice = F.filter(order, lambda e, i: same(e, F.get(order, i - 1)) | same(e, F.get(order, i + 1)))
        start = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
        add = lambda s, at: F.struct((s["hit"] + at + window - F.greatest(at, s["end"])).alias("hit"), (at + window).alias("end"))
        return F.aggregate(F.array_sort(F.transform(twice, lambda e: e["i"])), start, add)["hit"]

    ordered = lambda h: F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    counted = bound(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), bound(ordered(h), covered)).otherwise(0))
    return F.when(n > window, counted).otherwise(0).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text, as bigint. null: as the empty text."""
    text = F.coalesce(text, F.lit(""))
    one = lambda t: bound(split_words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.char_length(F.array_join(w, "")).cast("long").alias("chars"), repeated_words(w).alias("repeat")))
    lines = bound(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return {"_base": one(text), "_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"), "_dup": lines.cast("long")}


def exploded(docs: DataFrame, *keep: str) -> DataFrame:
    """keep and _bucket, a row for each n-gram of _text: every word, and every two words that follow each other."""
    split = docs.select(*keep, split_words(F.col("_text")).alias("_w"))
    word = split.select(*keep, F.posexplode_outer("_w").alias("_i", "_one"), "_w").where("_one is not null")
    one, two = F.xxhash64(F.lit(0), "_one"), F.xxhash64(F.lit(1), F.get("_w", F.col("_i") - 1), "_one")
    buckets = F.array(*[F.pmod(h, F.lit(BUCKETS)).cast("int") for h in (one, two)])
    return word.select(*keep, F.explode_outer(F.when(F.col("_i") > 0, buckets).otherwise(F.slice(buckets, 1, 1))).alias("_bucket"))


def labelled(labels: DataFrame, rows: int) -> DataFrame:
    """(_lid, _good, _trains): a bounded sample of labels, ids as texts; half trains, half sets the threshold."""
    marks, _ = internal(labels, lid="doc_id", quality="quality")
    marks = marks.where(F.col("_quality").isin(0, 1) & F.col("_lid").isNotNull()).groupBy(F.col("_lid").cast("string").alias("_lid")).agg(F.min("_quality").alias("_q"))
    share = min(1.0, rows / max(1, marks.count()))
    part = F.pmod(F.xxhash64("_lid", F.lit(7)), F.lit(1_000_000))
    picked = marks.where(part < F.lit(int(share * 1_000_000)))
    return picked.select("_lid", (F.col("_q") == 1).alias("_good"), (F.pmod(part, F.lit(2)) == 0).alias("_trains"))


def ratios(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(_bucket, _ratio): log of trusted over raw probability, in whole parts of 1 / SCALE, so that sums of them don't depend
    on their order. Raw counts are over all documents; at most BUCKETS rows."""
    marked = docs.join(F.broadcast(sample.where("_good and _trains").select("_lid")), docs["_id"].cast("string") == F.col("_lid"), "left")
    counts = exploded(marked.select("_text", F.col("_lid").isNotNull().cast("long").alias("_trusted")), "_trusted").groupBy("_bucket").agg(F.count("*").alias("_raw"), F.sum("_trusted").alias("_good"))
    counts = materialize(counts, "quality-counts")
    raw, good = (float(x or 0) for x in counts.agg(F.sum("_raw"), F.sum("_good")).first())
    share = F.col("_raw") / F.lit(raw or 1.0)
    prior = PRIOR * BUCKETS
    ratio = F.log((F.col("_good") + prior * share) / (F.lit(good + prior) * share))
    return counts.select("_bucket", F.round((ratio if good else F.lit(0.0)) * SCALE).cast("long").alias("_ratio"))


def scores(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(_sid, _sth, _score): mean log ratio of the n-grams of each text that has words, by id and text hash."""
    rows = exploded(docs.select("_text", "_id", F.xxhash64("_text").alias("_th")), "_id", "_th").join(F.broadcast(table), "_bucket")
    mean = rows.groupBy(F.col("_id").alias("_sid"), F.col("_th").alias("_sth")).agg(F.sum("_ratio").alias("_s"), F.count("*").alias("_n"))
    return mean.select("_sid", "_sth", (F.col("_s") / F.col("_n") / SCALE).alias("_score"))


def threshold(scored: DataFrame, sample: DataFrame) -> float:
    """The grid point that parts the held labelled documents with the fewest errors (of equals, the lowest).

    scored has _sid and _score. Counts on the grid come to the driver, not rows. Without labels of both kinds: none.
    """
    marked = scored.join(F.broadcast(sample.where("not _trains")), F.col("_sid").cast("string") == F.col("_lid"))
    cells = marked.groupBy(F.round(F.col("_score") * GRID).cast("long").alias("at"), "_good").count().collect()
    good, bad = sum(r["count"] for r in cells if r["_good"]), sum(r["count"] for r in cells if not r["_good"])
    if not good or not bad:
        return float("-inf")
    at: dict[int, list[int]] = {}
    for r in cells:
        at.setdefault(r["at"], [0, 0])[r["_good"]] += r["count"]
    best, errors = (bad, float("-inf")), bad
    for cell in sorted(at):  # a threshold just above the cell
        errors += at[cell][1] - at[cell][0]
        if errors < best[0]:
            best = (errors, (cell + 0.5) / GRID)
    return best[1]


def quality(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    base_failed: fewer than 20 words, or over 30 % of them in repeated windows of eight words. score: the mean, over the
    n-grams of the text, of the log of their probability in trusted documents (labelled 1) over that in the whole raw
    corpus; null without words. kept: not base_failed and the score is at or over a threshold set on held labelled
    documents; without labels, just not base_failed. Null, empty and blank texts fail the base; repeated rows come out
    repeated; documents with a null id are scored like others.
    """
    frame, _ = internal(docs, id="doc_id", text="text")
    frame = frame.select("_id", "_text")
    sample = materialize(labelled(labels, rows), "quality-labels")
    scored = materialize(scores(frame, ratios(frame, sample)), "quality-scores")
    least = threshold(scored, sample)
    base = frame.select("_id", F.xxhash64("_text").alias("_th"), *[c.alias(k) for k, c in base_columns(F.col("_text")).items()])
    all_ = base.join(scored, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left")
    n, repeat = F.col("_base.n"), F.col("_base.repeat")
    failed = (n < 20) | (100 * repeat > 30 * n)
    return all_.select(F.col("_id").alias("doc_id"), n.alias("n_words"), F.col("_base.chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"), F.col("_dup").alias("n_dup_lines"), repeat.alias("n_repeat_words"), failed.alias("base_failed"), F.col("_score").alias("score"), (~failed & F.coalesce(F.col("_score") >= F.lit(least), F.lit(True))).alias("kept"))
