"""License scans by diagonal voting, in built-in expressions only.

Words are runs of a-z, 0-9 and anything past ASCII, A-Z taken as a-z.  Every pair of
neighbouring words of every text is hashed and joined to the pairs of the templates, a
fixed list and so a broadcast of known size.  A hit votes for the diagonal (place in the
text minus place in the template).  Base phrases need all their pairs on one diagonal.
For the longer templates neighbouring diagonals are merged (words put in or left out
shift the diagonal), and a span counts when its hits, checked word by word against the
template, cover enough of it.

The list of hits leaves the scan already joined, a handful of narrow rows per text, so
the one shuffle is small; it goes by row number, so no source or text is hot.

Defined results: null and empty texts have no words and no places; a null or repeated id
is a row like any other; ties do not arise (places are all counted); an empty table
gives no rows; columns other than id and text are not read; long texts count whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# FIXED VALUES: phrases and labels of the base scan.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# FIXED VALUES: public wordings of licence notices, with the labels they add.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "apache": "licensed under the apache license version 2 0",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgpl": "under the terms of the gnu lesser general public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights-reserved": "all rights reserved",
}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"  # no other letters are folded
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVER = 0.8  # share of a template's pairs that a span must hit
GAP = 3  # diagonals this close are one span
SIZE_ROW = "(size)"  # stands for the number of words of a text


def words_of(text: str) -> list[str]:
    """The words of a template (driver side, plain text)."""
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def template_pairs(spark, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """One row per pair of neighbouring template words: template, place, words, pairs in all."""
    rows = [(-1, SIZE_ROW, False, 0, SIZE_ROW, SIZE_ROW, 1, 0)]
    listed = [(p, label, True) for p, label in base.items()] + [(p, label, False) for label, p in templates.items()]
    for t, (phrase, label, is_base) in enumerate(listed):
        words = words_of(phrase)
        if not 2 <= len(words) <= 64:
            raise ValueError("a template has 2 to 64 words")
        rows += [(t, label, is_base, i, a, b, len(words) - 1, 1 << i) for i, (a, b) in enumerate(zip(words, words[1:]))]
    names = ("t", "label", "base", "tpos", "w1", "w2", "pairs")
    listed = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r)), F.lit(r[7]).cast("bigint").alias("bit")) for r in rows))
    return spark.range(1).select(F.inline(listed)).withColumn("h", F.xxhash64("w1", "w2"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    pairs = template_pairs(docs.sparkSession, BASE if base is None else base, TEMPLATES if templates is None else templates)
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, UPPER.lower())
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.array_remove(F.split(text, SEPARATORS, -1), "").alias("_w"))
    # each word with the next one and their hash; after the last word comes the mark that carries their number.
    # The list of words itself ends here: a row that carried it would be copied once per word.
    pair = lambda w, i: F.struct(F.xxhash64(w, F.get("_w", i + 1)).alias("h"), w.alias("w"), F.get("_w", i + 1).alias("next"))
    none = F.lit(None).cast("string")
    mark = F.struct(F.xxhash64(F.lit(SIZE_ROW), F.lit(SIZE_ROW)).alias("h"), none.alias("w"), none.alias("next"))
    marked = rows.select("_id", "_row", F.concat(F.transform("_w", pair), F.array(mark)).alias("_m"))
    hits = marked.select("_id", "_row", F.posexplode("_m").alias("_pos", "_p")).select("_id", "_row", "_pos", "_p.*")
    hits = hits.join(F.broadcast(pairs), "h")
    same = (F.col("w") == F.col("w1")) & (F.col("next") == F.col("w2"))
    size = (F.col("t") == -1) & F.col("w").isNull()
    hits = hits.where(size | (F.col("t") >= 0) & same)
    hits = hits.select("_id", "_row", "t", "label", "base", "pairs", (F.col("_pos") - F.col("tpos")).alias("diag"), "bit")
    hits = hits.repartition("_row")
    votes = hits.groupBy("_row", "_id", "t", "label", "base", "pairs", "diag").agg(F.bit_or("bit").alias("mask"), F.count(F.lit(1)).alias("votes"))
    # a base phrase is a full diagonal; a longer template needs two votes on a diagonal to take part in a span
    votes = votes.where((F.col("t") == -1) | F.when(F.col("base"), F.col("votes") == F.col("pairs")).otherwise(F.col("votes") >= F.least(F.lit(2), F.col("pairs"))))
    along = Window.partitionBy("_row", "t").orderBy("diag")
    apart = F.col("base") | (F.col("t") == -1) | (F.col("diag") - F.lag("diag").over(along) > GAP)
    spans = votes.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("_new").over(along))
    spans = spans.groupBy("_row", "_id", "t", "label", "base", "pairs", "span").agg(F.min("diag").alias("start"), F.bit_or("mask").alias("mask"))
    spans = spans.withColumn("cover", F.bit_count("mask") / F.col("pairs"))
    place = F.col("base") & (F.col("t") >= 0)
    found = F.when((F.col("t") >= 0) & (F.col("cover") >= COVER), F.col("label"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  at most one value per template
    out = spans.groupBy("_row", "_id").agg(
        F.max(F.when(F.col("t") == -1, F.col("start"))).cast("bigint").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("bigint").alias("last_word"),
        listed(F.when(place, F.col("label"))).alias("base_labels"),
        listed(found).alias("labels"),
        F.coalesce(F.max(F.when(found.isNotNull(), F.col("cover"))), F.lit(0.0)).alias("score"),
    )
    return out.drop("_row").withColumnRenamed("_id", id_col)
