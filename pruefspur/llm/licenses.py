"""License scans by diagonal voting.

The words of a document and of a set of templates are cut to rolling pairs.  Pairs of equal hash
are joined; every hit votes for the diagonal (place in the document minus place in the template) it
lies on.  An unbroken copy of a template puts all its votes on one diagonal, an edited copy spreads
them over neighbouring ones.  These are merged within a band as wide as the edits that a span may
have, and the span is verified: each place of the template counts once, and only in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import constant_rows, once

#: Words of the base scan, phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
#: Words as they stand in the text; lower-casing A-Z does not move their borders.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    base: bool = False


#: Wordings of public licenses and of the usual notices.
TEMPLATES: tuple[Template, ...] = (
    *(Template(label, words, True) for words, label in BASE_PHRASES),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    Template("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    Template("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    Template("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
)
#: Share of a template's pairs, in percent, that must be found for a span that is not a base phrase.
COVERAGE = 70


def band(words: int, base: bool) -> int:
    """Diagonals that belong to one edited copy of a template: as many as it may have edits."""
    return 0 if base else words * (100 - COVERAGE) // 100


def template_pairs(spark, templates=TEMPLATES) -> DataFrame:
    rows = []
    for number, t in enumerate(templates):
        words = t.words.split(" ")
        rows += [
            (number, t.label, t.base, len(words), band(len(words), t.base), i, words[i], words[i + 1])
            for i in range(len(words) - 1)
        ]
    made = constant_rows(
        spark, rows, "template int,t_label string,t_base boolean,t_words int,t_band int,t_pos int,t_a string,t_b string"
    )
    return made.withColumn("pair", F.xxhash64("t_a", "t_b"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Verified spans: one row per document and span with ``_row`` (a number for the input row), the
    id, ``n_words``, ``t_label``, ``t_base``, ``start`` and ``stop`` in words and ``coverage`` in percent;
    and one row per input row with a null label, so that no document is lost.

    A null or empty text has no words and no spans.  Repeated rows are scanned each for itself.
    Columns other than the id and the text are not read.  The templates are a parameter of the
    program and not of the data, so their pairs are broadcast.
    """
    spark = docs.sparkSession
    work = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    work = once(
        work, _words=F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(WORDS), F.lit(0))
    ).select("_row", "_id", "_words")
    n = F.size("_words")
    # Place -1 stands for the document itself and matches no template.
    places = work.select("_row", "_id", "_words", F.explode(F.sequence(F.lit(-1), F.greatest(n - 2, F.lit(-1)))).alias("_pos"))
    word = lambda k: F.get("_words", F.col("_pos") + k)
    grams = places.select(
        "_row",
        "_id",
        n.cast("bigint").alias("n_words"),
        "_pos",
        word(0).alias("_a"),
        word(1).alias("_b"),
        F.when(F.col("_pos") >= 0, F.xxhash64(F.lower(word(0)), F.lower(word(1)))).alias("pair"),
    )
    plain = lambda c: F.translate(c, UPPER, LOWER)
    pairs = F.broadcast(template_pairs(spark, templates))
    hits = grams.join(pairs, "pair", "left").filter(
        (F.col("_pos") < 0) | ((plain(F.col("_a")) == F.col("t_a")) & (plain(F.col("_b")) == F.col("t_b")))
    )
    kept = ["_row", "_id", "n_words", "template", "t_label", "t_base", "t_words"]
    hits = hits.select(*kept, "t_band", "_pos", "t_pos", (F.col("_pos") - F.col("t_pos")).alias("diagonal")).repartition("_row")
    # Most documents hold some pairs of a template and far too few of its places.
    places = F.size(F.collect_set("t_pos").over(Window.partitionBy("_row", "template")))
    enough = 100 * F.col("_places") >= COVERAGE * (F.col("t_words") - 1)
    hits = hits.withColumn("_places", places).filter(F.col("template").isNull() | enough)
    # A band begins at every diagonal with votes; a hit votes for the bands it lies in.
    bands = hits.withColumn("band", F.explode(F.sequence(F.coalesce(-F.col("t_band"), F.lit(0)), F.lit(0))))
    bands = bands.withColumn("band", F.coalesce(F.col("diagonal") + F.col("band"), F.lit(0)))
    voted = bands.groupBy(*kept, "band", "t_pos").agg(
        F.min("_pos").alias("at"), F.max(F.col("diagonal") == F.col("band")).alias("own")
    )
    by = Window.partitionBy("_row", "template", "band").orderBy("t_pos")
    before = F.max("at").over(by.rowsBetween(Window.unboundedPreceding, -1))
    ordered = F.coalesce(F.col("at") > before, F.lit(True))
    verified = (
        voted.withColumn("_ordered", ordered)
        .groupBy(*kept, "band")
        .agg(
            F.count_if("_ordered").alias("votes"),
            F.max("own").alias("own"),
            F.min(F.when(F.col("_ordered"), F.col("at"))).alias("start"),
            F.max(F.when(F.col("_ordered"), F.col("at") + 2)).alias("stop"),
        )
    )
    share = F.floor(100 * F.col("votes") / (F.col("t_words") - 1)).cast("int")
    whole = F.when(F.col("t_base"), F.col("votes") == F.col("t_words") - 1).otherwise(share >= COVERAGE)
    verified = verified.withColumn("coverage", share).filter(F.col("template").isNull() | (F.col("own") & whole))
    # Of spans that overlap the best is told, of equal ones the first; base phrases are told wherever they stand.
    by = Window.partitionBy("_row", "template").orderBy("start", "stop", "band")
    reached = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("t_base") | (F.col("start") >= reached), F.lit(True)).cast("int")
    best = F.struct("coverage", -F.col("band"))
    merged = (
        verified.withColumn("_fresh", fresh)
        .withColumn("_span", F.sum("_fresh").over(by))
        .groupBy(*kept, "_span")
        .agg(F.max_by(F.struct("start", "stop", "coverage"), best).alias("_best"))
        .select(*kept, "_best.*")
    )
    return merged.select(
        "_row",
        F.col("_id").alias(id_col),
        "n_words",
        "t_label",
        "t_base",
        F.when(F.col("template").isNotNull(), F.col("start")).cast("bigint").alias("start"),
        F.when(F.col("template").isNotNull(), F.col("stop")).cast("bigint").alias("stop"),
        F.when(F.col("template").isNotNull(), F.col("coverage")).alias("coverage"),
    )


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per document: its words, the places of base phrases, and the labels found."""
    spans = scan(docs, id_col, text_col, templates)
    base = F.col("t_base")
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (
        spans.groupBy("_row", F.col(id_col).alias("_id"), "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            names(F.when(base, F.col("t_label"))).alias("base_labels"),
            names(F.col("t_label")).alias("labels"),
            (F.coalesce(F.max("coverage"), F.lit(0)) / 100).cast("double").alias("score"),
        )
        .select(F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
