"""Benchmark decontamination: windows of benchmark items that occur in documents, by a prefix-filtered join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, SHINGLE, ascii_lower, internal, materialize, shingle_hash, shingle_places, split_words

#: Up to so many windows, the benchmark's tokens are broadcast; beyond, rows of numbers are shuffled.
BROADCAST_WINDOWS = 1_000_000


def words(c: Column) -> Column:
    return split_words(ascii_lower(c), NOT_ALNUM)


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(_window, _len, _items): each distinct window of item words with the ids of its items, as sorted strings."""
    frame, _ = internal(benchmark, item="item_id", text="text")
    w = F.col("_w")
    n = F.size(w)
    items = frame.where("_item is not null").select(F.col("_item").cast("string").alias("_item"), words(F.col("_text")).alias("_w")).where(n > 0)
    spans = items.select("_item", "_w", F.explode(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))).alias("_i"))
    cut = spans.select("_item", F.slice(w, F.col("_i"), F.least(n, F.lit(window))).alias("_window"))
    return cut.groupBy("_window").agg(F.collect_set("_item").alias("_items")).withColumn("_len", F.size("_window"))


def candidates(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = SHINGLE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame | None:
    """(_cid, _cth, _tries): for documents, by id and text hash, where which windows may begin; None without windows.

    docs has _id and _text. A window is a set of shingles of five words (a shorter item: of all its words). It can only
    occur where all its shingles do, so the necessary prefix for exact containment is one shingle, the rarest. A first
    pass over the texts counts the benchmark's shingles, which orders them by rarity; windows with a shingle that no
    document has are out. A second pass joins the prefix shingles alone. A window's offset gives the only place where it
    could begin. Only ids, hashes and places are shuffled; the words are compared where the text is (`hits`).
    """
    windows = materialize(item_windows(benchmark, window).withColumn("_key", F.xxhash64("_window")), "benchmark-windows")
    sizes = {r[0]: r[1] for r in windows.groupBy(F.least("_len", F.lit(shingle))).count().collect()}
    if not sizes:
        return None
    sent = F.broadcast if sum(sizes.values()) <= broadcast_windows else (lambda df: df)
    grams = None
    for size in sorted(sizes):
        own = windows.where(F.least("_len", F.lit(shingle)) == size).select("_key", "_window", "_len", F.explode(F.sequence(F.lit(1), F.col("_len") - size + 1)).alias("_o"))
        own = own.select("_key", "_o", (F.col("_len") - size + 1).alias("_grams"), shingle_hash(F.col("_window"), F.col("_o"), size).alias("_hash"))
        grams = own if grams is None else grams.union(own)
    grams = materialize(grams, "benchmark-shingles")

    places = shingle_places(docs, words(F.col("_text")), sorted(sizes))
    rarity = materialize(places.join(sent(grams.select("_hash").distinct()), "_hash").groupBy("_hash").agg(F.count("*").alias("_df")), "benchmark-rarity")
    ranked = grams.join(sent(rarity), "_hash")
    prefix = ranked.groupBy("_key", "_grams").agg(F.count("*").alias("_seen"), F.min(F.struct("_df", "_o", "_hash")).alias("_rarest")).where("_seen = _grams")
    prefix = prefix.join(windows.select("_key", "_window", "_len", "_items"), "_key").select(F.col("_rarest._hash").alias("_hash"), F.col("_rarest._o").alias("_o"), "_window", "_len", "_items")
    prefix = materialize(prefix, "benchmark-prefix")
    tokens = prefix.select("_hash", "_o", "_len", F.xxhash64("_window").alias("_key"))
    begin = F.col("_p") - F.col("_o") + 1
    found = places.join(sent(tokens), "_hash").where(begin >= 1).select("_id", "_th", "_key", begin.alias("_begin")).distinct()
    named = found.join(sent(prefix.select(F.xxhash64("_window").alias("_key"), "_window", "_items")), "_key")
    found = named.groupBy(F.col("_id").alias("_cid"), F.col("_th").alias("_cth")).agg(F.collect_list(F.struct("_begin", "_window", "_items")).alias("_tries"))
    return materialize(found, "benchmark-candidates")


def hits(docs: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """docs (_id, _text, and others) with n_words, n_hit and items (ids of the items with windows that occur).

    Candidates meet their text once; a window counts if it fits into the text (length and position) and all its words
    are the document's there.
    """
    found = candidates(docs.select("_id", "_text"), benchmark, **settings)
    if found is None:
        return docs.withColumns({"n_words": F.size(words(F.col("_text"))).cast("long"), "n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")})
    keyed = docs.withColumn("_th", F.xxhash64("_text"))
    joined = keyed.join(found, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_th") == F.col("_cth")), "left").withColumn("_w", words(F.col("_text")))
    # word by word: a slice of a long text would copy it for every candidate
    same = lambda t: F.forall(F.sequence(F.lit(0), F.size(t["_window"]) - 1), lambda i: F.get("_w", t["_begin"] - 1 + i) == F.get(t["_window"], i))
    fits = lambda t: t["_begin"] + F.size(t["_window"]) - 1 <= F.size("_w")
    here = F.filter(F.coalesce("_tries", F.array()), lambda t: fits(t) & same(t))
    told = joined.withColumns({"n_words": F.size("_w").cast("long"), "_here": here})
    # a span is one number, begin and length: numbers are sorted and told apart by hash, structs pairwise
    spans = F.sort_array(F.array_distinct(F.transform("_here", lambda t: F.shiftleft(t["_begin"].cast("long"), 32) + F.size(t["_window"]))))
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    begin, end = lambda x: F.shiftright(x, 32), lambda x: F.shiftright(x, 32) + x.bitwiseAND(F.lit((1 << 32) - 1))
    add = lambda s, x: F.struct((s["hit"] + F.greatest(end(x) - F.greatest(begin(x), s["end"]), F.lit(0).cast("long"))).alias("hit"), F.greatest(s["end"], end(x)).alias("end"))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("_here", lambda t: t["_items"]))))
    return told.withColumns({"n_hit": F.aggregate(spans, start, add)["hit"], "items": items}).drop("_th", "_w", "_cid", "_cth", "_tries", "_here")


def dirty(n_hit: Column, n_words: Column) -> Column:
    """Contaminated: a twentieth of the words at least is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of digits, letters and characters beyond ASCII in text lower-cased A-Z. A window is 13 consecutive
    words of an item, or all of a shorter one; a document's word is hit if it lies in an occurrence of a window.
    n_items counts the items with occurring windows; items_sha256 is of their ids, sorted as strings, comma-joined (of
    the empty string if there are none). contaminated: at least a twentieth of the words is hit. Null and empty texts
    have no words; items without words or without an id count for nothing; repeated rows come out repeated.
    """
    frame, _ = internal(docs, id="doc_id", text="text")
    found = hits(frame.select("_id", "_text"), benchmark, **settings)
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_hit", n_items, F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), dirty(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without its contaminated documents (see contamination), with its columns.

    Documents without a text, or whose text has no words, stay; repeated rows stay or go together; without benchmark
    items all stay; an empty table gives an empty one.
    """
    frame, back = internal(docs, id="doc_id", text="text")
    found = hits(frame, benchmark)
    # a generated column: the condition would else be pushed below the split of the words and split them for every comparison
    judged = found.select(*frame.columns, F.explode(F.array(dirty(F.col("n_hit"), F.col("n_words")))).alias("_dirty"))
    return judged.where(~F.col("_dirty")).select(*back)
