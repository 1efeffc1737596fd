"""Mixing sources to target weights by weighted fair queueing over shuffled documents."""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, internal, materialize, partitions, with_added, with_row_number

#: Tables of up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Rows that one running sum covers, about; there are as many sums as shuffle partitions at least.
SUM_ROWS = 1_000_000


def shuffle_key(doc_id: Column, seed: str) -> Column:
    """60 bits from the md5 of seed and id: the place of a document in its source's queue."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """sizes (_sid, _total) with _target: the budget by weight, no target above most times its source's size.

    Water filling: a source over its cap gets the cap, the rest shares what remains by weight, again until nobody is
    over. Every step is one aggregate over the sources; only two sums come to the driver.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("_sid", F.lit(len(weights))) + 1).cast("int"))
    table = sizes.withColumns({"_w": w, "_cap": (F.col("_total") * most).cast("double")})
    budget = share * (sizes.agg(F.sum("_total")).first()[0] or 0)
    level = 0.0
    while True:
        over = F.col("_cap") < F.col("_w") * F.lit(level)
        capped, rest = table.agg(F.sum(F.when(over, F.col("_cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("_w")))).first()
        new = (budget - capped) / rest if rest else level
        if new <= level:
            return table.withColumn("_target", F.least(F.col("_cap"), F.col("_w") * F.lit(level)))
        level = new


def mix(docs: DataFrame, carry: list[str] | None = None, **settings: object) -> DataFrame:
    """Every row of docs with size, source_size, target, times (how often the mix takes it) and taken (size * times).

    size: words of the text (null: 0). Sources in the order of code points, null last, weigh `weights` in turn and share
    `share` of all words; no target is above `most` times its source's size. A source's queue holds its documents in
    shuffled order, `most` times over; the virtual finish time of a document is its source's running words divided by
    the source's target. All queues are range-sorted by finish time together and cut where the budget is full. Within a
    queue that cut is a greatest key for each pass, so a small table of sources decides about every document. Rows with
    equal ids, or none, are told apart by a hash of their text, equal rows by their place in the input: each is a document
    of its own, and any number of them is dealt over many tasks. carry: the columns to keep (all). Empty texts are taken at no cost; an
    empty table gives an empty one.
    """
    rows, kept = decide(docs, carry, **settings)
    return rows.select(*with_added([b for _, b in kept], [n for n, _ in kept], size=F.col("_size"), source_size=F.col("_total"), target=F.col("_target"), times=F.col("_times"), taken=F.col("_size") * F.col("_times")))


def decide(docs: DataFrame, carry: list[str] | None, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix-1") -> tuple[DataFrame, list[tuple[str, Column]]]:
    """The rows with _size, _total, _target and _times, and the columns to keep: name and how to get it back."""
    spark = docs.sparkSession
    frame, back = internal(docs, id="doc_id", text="text", source="source")
    kept = [(n, b) for n, b in zip(docs.columns, back, strict=True) if carry is None or n in carry]
    # the place of a row comes from the scan, so that two passes over the same files agree; it parts equal rows alone
    sized = frame.withColumns({"_size": count_words(F.col("_text")), "_u": shuffle_key(F.col("_id"), seed), "_th": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
    own = [frame.columns[docs.columns.index(n)] for n, _ in kept]
    narrow = materialize(sized.select(*dict.fromkeys(["_id", "_source", "_size", "_u", "_th", "_row", *(own if carry is not None else [])])), "mix-sizes")

    sources = narrow.groupBy("_source").agg(F.sum("_size").alias("_total"), F.count("*").alias("_rows"))
    ranked, n_sources = with_row_number(sources.withColumn("_k0", F.col("_source").isNull()), ["_k0", "_source"], "_sid", "mix-sources", drop=["_k0"])
    table = materialize(targets(ranked, weights, share, most), "mix-targets")
    words, n_rows = table.agg(F.sum("_total"), F.sum("_rows")).first()
    budget, parts = floor(share * (words or 0)), max(partitions(spark), (n_rows or 0) // SUM_ROWS + 1)

    same = lambda other: F.col("_source").eqNullSafe(other)
    of = table.select(F.col("_source").alias("_s"), "_sid", "_total", "_target")
    key = ["_u", "_id", "_th", "_size", "_row"]
    queued = narrow.select("_source", *key).join(small(of, n_sources), same(F.col("_s"))).drop("_source", "_s")
    queued = queued.repartitionByRange(parts, "_sid", *key).sortWithinPartitions("_sid", *key).withColumn("_b", F.spark_partition_id())
    queued = materialize(queued, "mix-lines")
    sums = queued.groupBy("_sid", "_b").agg(F.sum("_size").alias("_sum"))
    before = sums.select("_sid", "_b", (F.sum("_sum").over(Window.partitionBy("_sid").orderBy("_b")) - F.col("_sum")).alias("_before"))
    line = Window.partitionBy("_sid", "_b").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    run = queued.join(small(before, parts + n_sources), ["_sid", "_b"]).withColumn("_run", F.col("_before") + F.sum("_size").over(line))
    time = lambda k: F.when(F.col("_target") > 0, (F.col("_run") + k * F.col("_total")).cast("double") / F.col("_target")).otherwise(0.0)
    passes = F.explode(F.array(*[F.struct(F.lit(k).alias("_pass"), time(k).alias("_finish")) for k in range(most)]))
    order = ["_finish", "_sid", "_pass", *key]
    line_up = run.select("_sid", *key, passes.alias("_x")).select("_sid", *key, "_x._pass", "_x._finish")
    line_up = line_up.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    line_up = materialize(line_up, "mix-queue")

    left, cut = budget, None
    for part, words in sorted((r[0], r[1]) for r in line_up.groupBy("_part").agg(F.sum("_size")).collect()):
        cut = part
        if words > left:
            break
        left -= words
    else:
        cut = None
    whole = line_up if cut is None else line_up.where(F.col("_part") < cut)
    last = line_up.where(F.col("_part") == (-1 if cut is None else cut)).withColumn("_run", F.sum("_size").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    taken = whole.unionByName(last.where(F.col("_run") <= left).drop("_run"))
    place = F.struct(*key)
    limits = taken.groupBy("_sid").agg(*[F.max(F.when(F.col("_pass") == k, place)).alias(f"_limit{k}") for k in range(most)])
    decided = materialize(of.join(small(limits, n_sources), "_sid", "left"), "mix-cuts")

    rows = (narrow if carry is not None else sized).join(small(decided, n_sources), same(F.col("_s")))
    times = sum((F.coalesce(place <= F.col(f"_limit{k}"), F.lit(False)).cast("int") for k in range(most)), F.lit(0))
    return rows.withColumn("_times", times), kept


def mixed(docs: DataFrame, **settings: object) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, with the columns of docs."""
    rows, kept = decide(docs, None, **settings)
    return rows.where(F.col("_times") > 0).withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[b for _, b in kept])
