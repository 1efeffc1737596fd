"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_ALNUM, SHINGLE, ascii_lower, internal, materialize, shingle_hash, shingle_places, split_words

CONTAINMENT = 0.8
#: The chance at least that a window that holds a template as required is retrieved by some band.
CERTAINTY = 0.99999
#: Up to so many band keys of templates are broadcast; beyond, rows of numbers are shuffled.
BROADCAST_KEYS = 1_000_000

#: Notices as they are commonly printed.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0-warranty", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def words(c: Column) -> Column:
    return split_words(ascii_lower(c), NOT_ALNUM)


def bands(containment: float = CONTAINMENT, certainty: float = CERTAINTY) -> int:
    """Bands of one row each that retrieve a template with the given certainty.

    Windows have as many shingles as the template and begin at every shingle, so the best one holds `containment` of the
    template's shingles; its Jaccard similarity with the template is s or more, and all bands miss with the chance
    (1 - s) ** bands.
    """
    s = containment / (2 - containment)
    return 1 if s >= 1 else ceil(log(1 - certainty) / log(1 - s))


def band_seeds(n: int) -> list[int]:
    """Signed 64-bit numbers that each give another order of hashes, by exclusive or."""
    return [((i + 1) * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63) for i in range(n)]


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(templates, "license string, text string")


def template_shingles(templates: DataFrame) -> DataFrame:
    """(_license, _size, _m, _grams, _h): the different shingles of each template, as word arrays and hashes.

    A template of under five words is one shingle of all its words (_size); one without words or name isn't there.
    """
    frame, _ = internal(templates, license="license", text="text")
    w = frame.select(F.col("_license").cast("string").alias("_license"), words(F.col("_text")).alias("_w")).where((F.size("_w") > 0) & F.col("_license").isNotNull())
    w = w.withColumn("_size", F.least(F.lit(SHINGLE), F.size("_w")))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("_w") - F.col("_size") + 1), lambda i: F.slice(F.col("_w"), i, F.col("_size"))))
    w = w.select("_license", "_size", grams.alias("_grams")).withColumn("_m", F.size("_grams"))

    def hashes(size: int) -> Column:
        return F.transform("_grams", lambda g: shingle_hash(g, F.lit(1), size))

    return w.withColumn("_h", F.coalesce(*[F.when(F.col("_size") == size, hashes(size)) for size in range(1, SHINGLE + 1)]))


def matches(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(_id, _th, _license, _share): documents that hold a template, and the most of it in one window.

    docs has _id and _text. A window is as many shingles as the template has, from every begin; texts shorter than that
    are one window. A band's key is the smallest hash of a set of shingles in that band's order. A window and a template
    meet where a band's keys are equal; only shingles that are keys of some template are of use for that, so the texts'
    shingles are joined with those first (ids, hashes and places alone, so that is all a shuffle carries). Documents with
    such places get their words, and around each place every window that holds it takes its own minimum. All windows
    around a place where one met are verified by comparing shingles as words.
    """
    spark = docs.sparkSession
    known = materialize(template_shingles(templates), "license-templates")
    sizes = [r[0] for r in known.select("_size").distinct().orderBy("_size").collect()]
    if not sizes:
        return spark.createDataFrame([], "_id bigint, _th bigint, _license string, _share double").withColumn("_id", F.col("_id").cast(docs.schema["_id"].dataType))
    seeds = F.array(*[F.lit(s).cast("long") for s in band_seeds(bands(containment))])
    keys = known.select("_license", "_size", "_m", "_h", F.explode(seeds).alias("_seed"))
    key = F.array_min(F.transform("_h", lambda h: h.bitwiseXOR(F.col("_seed")))).bitwiseXOR(F.col("_seed"))
    keys = materialize(keys.select("_license", "_size", "_m", "_seed", key.alias("_hash")), "license-bands")
    sent = F.broadcast if keys.count() <= broadcast_keys else (lambda df: df)
    wide = known.agg(F.max("_m")).first()[0]

    places = shingle_places(docs, words(F.col("_text")), sizes).join(sent(keys.select("_hash").distinct()), "_hash")
    places = places.groupBy(F.col("_id").alias("_pid"), F.col("_th").alias("_pth")).agg(F.collect_set(F.struct("_p", "_hash")).alias("_places"))
    places = materialize(places, "license-places")
    once = docs.select("_id", "_text", F.xxhash64("_text").alias("_th")).join(places, F.col("_id").eqNullSafe(F.col("_pid")) & (F.col("_th") == F.col("_pth")))
    first = F.greatest(F.col("_at._p") - wide, F.lit(1))
    around = once.withColumn("_w", words(F.col("_text"))).select("_id", "_th", F.size("_w").alias("_n"), "_w", F.explode("_places").alias("_at"))
    around = around.select("_id", "_th", "_n", F.col("_at._p").alias("_p"), F.col("_at._hash").alias("_hash"), first.alias("_from"), F.slice("_w", first, F.lit(2 * wide + SHINGLE)).alias("_around"))

    # hashes of all shingles around, once for a place; only templates of one shingle have fewer than five words
    inside = lambda size: F.sequence(F.lit(1), F.size("_around") - size + 1)
    around = around.withColumn("_gh", F.when(F.size("_around") >= SHINGLE, F.transform(inside(SHINGLE), lambda i: F.xxhash64(*[F.get("_around", i - 1 + k) for k in range(SHINGLE)]))))
    shingles = F.col("_n") - F.col("_size") + 1
    tries = around.join(sent(keys), "_hash").withColumn("_len", F.least(F.col("_m"), shingles))
    low, high = F.greatest(F.col("_p") - F.col("_len") + 1, F.lit(1)), F.least(F.col("_p"), shingles - F.col("_len") + 1)
    begins = F.sequence(low - F.col("_from") + 1, F.greatest(low, high) - F.col("_from") + 1)
    ours = F.col("_hash").bitwiseXOR(F.col("_seed"))
    least = lambda at: F.array_min(F.slice("_order", at, F.col("_len"))) == ours
    tries = tries.withColumns({"_begins": begins, "_order": F.transform("_gh", lambda h: h.bitwiseXOR(F.col("_seed")))})
    met = tries.where((F.col("_m") == 1) | F.exists("_begins", least)).select("_id", "_th", "_license", "_p", "_around", "_len", "_begins")
    checked = met.dropDuplicates(["_id", "_th", "_license", "_p"]).join(sent(known.select("_license", "_size", "_m", "_grams")), "_license")
    # which shingle of the template, if any, is at each place; as words
    checked = checked.withColumn("_of", F.transform(inside(F.col("_size")), lambda i: F.array_position("_grams", F.slice("_around", i, F.col("_size")))))
    share = F.array_max(F.transform("_begins", lambda at: F.size(F.array_distinct(F.filter(F.slice("_of", at, F.col("_len")), lambda g: g > 0))))) / F.col("_m")
    best = checked.select("_id", "_th", "_license", share.alias("_share")).where(F.col("_share") >= containment)
    return best.groupBy("_id", "_th", "_license").agg(F.max("_share").alias("_share"))


def scan(docs: DataFrame, templates: DataFrame | None = None, containment: float = CONTAINMENT, **settings: int) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_licenses, licenses (comma-joined, sorted), best_share.

    Words are runs of digits, letters and characters beyond ASCII, lower-cased A-Z; shingles are five words (a template
    of fewer: all its words). A license is in a document if some window of as many shingles as its template, wherever it
    begins, holds `containment` of them; best_share is the largest such part (0 without any). Null, empty and short texts
    have no licenses but those of templates as short; repeated rows come out repeated; an empty table gives an empty one.
    """
    frame, _ = internal(docs, id="doc_id", text="text")
    frame = frame.select("_id", "_text")
    found = matches(frame, templates if templates is not None else template_table(docs.sparkSession, TEMPLATES), containment, **settings)
    per_doc = found.groupBy(F.col("_id").alias("_hid"), F.col("_th").alias("_hth")).agg(F.sort_array(F.collect_set("_license")).alias("_l"), F.max("_share").alias("_share"))
    counted = frame.select("_id", F.xxhash64("_text").alias("_th"), F.size(words(F.col("_text"))).cast("long").alias("n_words"))
    joined = counted.join(per_doc, F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_th") == F.col("_hth")), "left")
    names = F.coalesce("_l", F.array().cast("array<string>"))
    return joined.select(F.col("_id").alias("doc_id"), "n_words", F.size(names).cast("long").alias("n_licenses"), F.concat_ws(",", names).alias("licenses"), F.coalesce("_share", F.lit(0.0)).alias("best_share"))
