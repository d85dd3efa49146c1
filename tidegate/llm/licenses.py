"""License scan by diagonal voting.

All pairs of neighbouring words of a text are joined by hash to the places in license texts where the same pair stands.
A match votes for the diagonal (place in the text minus place in the license). A license's words stand consecutively
where one diagonal has all its votes; a license text that was edited shows as neighbouring diagonals. Those within a
band are merged: a span is as good as the share of the license's pairs that can be found in it one after the other, in
the order of the license, each pair counted once. Matches are verified on the words themselves. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Sentences of public licenses, as words, and their labels.
TEXTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
    "license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution": "cc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}
#: Share of a license text's word pairs that a span needs.
LEAST_SHARE = 0.6
#: Width of a band: words that an edited license may have more, or fewer, than the original, all in all.
BAND = 6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def templates(spark: SparkSession) -> DataFrame:
    """One row per word pair of a phrase or text: a fixed list of some 150 rows, which may be broadcast."""
    rows = []
    for number, (phrase, label) in enumerate((BASE | TEXTS).items()):
        words = phrase.split()
        rows += [(number, label, number < len(BASE), len(words) - 1, at, *words[at: at + 2]) for at in range(len(words) - 1)]
    return (spark.createDataFrame(rows, "template int, label string, base boolean, pairs int, at int, word string, second string")
            .withColumn("pair", F.xxhash64("word", "second")))


def license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) → (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans).

    One row per row of ``docs``; repeated rows have the same result. A null text is empty; a text without matches has n_base 0, null places, empty labels and score 0. score is the largest share of a license found. Other columns
    are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
                       words_of(F.col("text")).alias("words"))
    known = templates(spark)
    # A word pair is a small struct; only pairs of the fixed list leave the array of their text.
    pairs = F.transform("words", lambda w, i: F.struct(i.cast("int").alias("place"), w.alias("first_word"),
                                                       F.get("words", i + 1).alias("next_word")))
    keys_of_pairs = [r["pair"] for r in known.select("pair").distinct().collect()]
    matched = F.filter(pairs, lambda p: F.xxhash64(p["first_word"], p["next_word"]).isin(keys_of_pairs))
    found = (rows.select("doc_id", "version", F.explode(matched).alias("match")).select("doc_id", "version", "match.*")
             .withColumn("pair", F.xxhash64("first_word", "next_word")).join(F.broadcast(known), "pair")
             .filter((F.col("first_word") == F.col("word")) & (F.col("next_word") == F.col("second")))
             .select("doc_id", "version", "template", "label", "base", "pairs", "at", (F.col("place") - F.col("at")).alias("diagonal")))
    keys = ["doc_id", "version", "template", "label", "base", "pairs"]
    # A place of the license votes once on a diagonal, also if the row is there several times.
    votes = found.groupBy(*keys, "diagonal").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    complete = votes.filter("base AND size(ats) >= pairs").select(
        *keys, "diagonal", F.lit(1.0).alias("share"))
    along = Window.partitionBy("doc_id", "version", "template").orderBy("diagonal")
    band = F.collect_list(F.struct("diagonal", "ats")).over(along.rangeBetween(0, BAND))
    places = F.array_sort(F.flatten(F.transform(band, lambda d: F.transform(d["ats"], lambda at: F.struct(
        at.alias("at"), (at + d["diagonal"]).alias("place"))))))
    # Pairs of the license that follow each other in the text as well: of each, the first place behind the one before.
    start = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("place"), F.lit(0).alias("n"))
    chain = F.aggregate(places, start, lambda last, p: F.when(
        (p["at"] > last["at"]) & (p["place"] > last["place"]),
        F.struct(p["at"].alias("at"), p["place"].alias("place"), (last["n"] + 1).alias("n"))).otherwise(last))
    merged = (votes.filter("NOT base").withColumn("share", chain["n"] / F.col("pairs"))
              .filter(F.col("share") >= LEAST_SHARE)
              .withColumn("fresh", F.col("diagonal") - F.lag("diagonal", 1, -10 ** 9).over(along) > BAND)
              .withColumn("span", F.sum(F.col("fresh").cast("int")).over(along)).groupBy(*keys, "span")
              .agg(F.min("diagonal").alias("diagonal"), F.max("share").alias("share")).drop("span"))
    spans = complete.unionByName(merged)
    labels = F.array_join(F.sort_array(F.collect_set("label")), ",")
    base = F.when(F.col("base"), F.col("diagonal")).cast("long")
    per_text = spans.groupBy("doc_id", "version").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        labels.alias("labels"), F.max("share").alias("score"), F.count(F.lit(1)).alias("n_spans"))
    sizes = rows.select(F.col("doc_id").alias("id"), F.col("version").alias("v"), F.size("words").cast("long").alias("n_words"))
    joined = sizes.join(per_text, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("v") == F.col("version")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", zero).alias("n_base"), "first_word",
                         "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                         F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
                         F.coalesce("n_spans", zero).alias("n_spans"))
