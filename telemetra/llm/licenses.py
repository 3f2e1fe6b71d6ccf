"""Licence notices in texts by diagonal voting, with DataFrame operations only.

Every pair of neighbouring words of every text is joined, by its hash, to the places where templates have that pair. A hit at
word i of the text and word j of the template votes for the diagonal i - j, on which a copy of the template would lie. Votes
are reduced by text, template and diagonal, as a set of template places in the bits of one number; long templates are cut
into passages that fit. Neighbouring diagonals are merged, since an inserted or missing word moves the rest of a copy by one,
and a span is verified by the share of the passage's pairs that it holds, which equal the text's word by word.

The join is left to Spark: templates are a small relation of known size, so each text's pairs are matched and reduced where the
text is read. A template table above the session's broadcast limit is joined by a shuffle instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What stands between words of either case.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of a passage at most: its pairs are the bits of a 64-bit number.
PASSAGE = 60
# Diagonals no further apart than this are one copy, and one with fewer votes than this doesn't count for a passage.
GAP, LEAST_VOTES = 3, 2
# Share of a passage's pairs that a span needs; passages of fewer words than SHORT need more.
SHARE, SHORT_SHARE, SHORT = 0.6, 0.8, 12

# Phrases that count wherever they stand, with their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
# The wording of public licences and of the lines that refer to them, with labels.
NOTICES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,'
        " merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl", "This work is licensed under the GNU General Public License"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
        " this file, You can obtain one at",
    ),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """Rows (label, text, exact) of the phrases and notices above, a relation whose size Spark knows."""
    rows = [(label, text, "true") for label, text in PHRASES] + [(label, text, "false") for label, text in NOTICES]
    values = ", ".join(f"('{label}', '{text}', {exact})" for label, text, exact in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS templates(label, text, exact)")


def words_of(text: Column) -> Column:
    """The words of a text, as an array, in the case they are written in."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def in_lower_case(text: Column) -> Column:
    """A to Z in lower case, every other character as it is; most texts need no look at single characters."""
    lower = F.lower(text)
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(lower == text, text).when(ascii_only, lower).otherwise(F.translate(text, UPPER, LOWER))


def _pairs(rows: DataFrame, *columns: str) -> DataFrame:
    """A row (columns, pos, pair) for each word in the array ``words`` with the next one. The last word's pair is '', so is that of no words."""
    exploded = rows.select(*columns, "words", F.posexplode_outer("words").alias("pos", "word"))
    both = F.concat("word", F.lit(" "), F.get("words", F.col("pos") + 1))
    return exploded.select(*columns, "pos", F.coalesce(both, F.lit("")).alias("pair")).withColumn("pair", in_lower_case(F.col("pair")))


def template_pairs(templates: DataFrame) -> DataFrame:
    """Each pair of each passage with its place: rows (pair, passage, place, n_pairs, n_words, label, exact)."""
    split = templates.filter("label is not null").select("label", "text", F.coalesce("exact", F.lit(False)).alias("exact"), words_of(F.col("text")).alias("words"))
    placed = _pairs(split.withColumn("n", F.size("words")), "label", "text", "exact", "n").filter("pair <> ''")
    length = F.ceil(F.col("n") / F.ceil(F.col("n") / PASSAGE)).cast("int")
    cut = placed.withColumn("length", length).withColumn("part", F.floor(F.col("pos") / F.col("length")).cast("int"))
    place = F.col("pos") - F.col("part") * F.col("length")
    n_words = F.least("length", F.col("n") - F.col("part") * F.col("length"))
    inside = cut.withColumn("place", place).withColumn("n_words", n_words).filter(F.col("place") < F.col("n_words") - 1)
    return inside.select(
        "pair",
        F.xxhash64("label", "text", "exact", "part").alias("passage"),
        "place",
        (F.col("n_words") - 1).alias("n_pairs"),
        "n_words",
        "label",
        (F.col("exact") & (F.col("n") <= PASSAGE)).alias("exact"),
    )


def scan(docs: DataFrame, templates: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, spans), one for each row of ``docs``; spans hold start, end (words, end exclusive), label, exact, share.

    ``templates`` has label, text and exact. An exact one is a phrase: every place counts where its words stand one after the other. Any
    other is found where a span holds the wanted share of the word pairs of one of its passages. Templates without a label or
    with fewer than two words are not looked for, exact ones of more than 60 words are looked for as passages. Null and empty texts have
    no words and no spans. Rows without an id, and repeated rows, each give a row of their own. Spans stand by start,
    then end, label. No other column of ``docs`` is used, so its name doesn't matter.
    """
    text = F.col(text_column)
    split = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text, F.length(text)).alias("key"), words_of(text).alias("words"))
    placed = _pairs(split.withColumn("n_words", F.size("words")), "doc_id", "key", "n_words").withColumn("hash", F.xxhash64("pair"))
    # The empty pair, which each text has once, stands for the text itself.
    mark = docs.sparkSession.sql("SELECT * FROM VALUES ('', 0L, 0, 0, 0, '', false) AS mark(pair, passage, place, n_pairs, template_words, label, exact)")
    looked_for = template_pairs(templates).withColumnRenamed("n_words", "template_words").unionByName(mark).withColumn("hash", F.xxhash64("pair"))
    hits = placed.join(looked_for, ["hash", "pair"])

    template = ["passage", "n_pairs", "template_words", "label", "exact"]
    votes = hits.groupBy("doc_id", "key", "n_words", *template, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("seen"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
    )
    is_mark = F.col("pair_votes") == 0
    enough = F.when(F.col("exact"), F.col("pair_votes") == F.col("n_pairs")).otherwise(F.col("pair_votes") >= F.least(F.lit(LEAST_VOTES), F.col("n_pairs")))
    voted = votes.withColumn("pair_votes", F.when(F.col("n_pairs") > 0, F.bit_count("seen")).otherwise(0)).filter(is_mark | enough)

    # One exchange for all that follows: what is grouped below is always a text's.
    along = Window.partitionBy("doc_id", "key", "passage").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    new = F.col("exact") | F.coalesce(apart > GAP, F.lit(True))
    banded = voted.repartition("doc_id", "key").withColumn("new", new.cast("int"))
    banded = banded.withColumn("band", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    bands = banded.groupBy("doc_id", "key", "n_words", *template, "band").agg(
        F.max("n").alias("n"), F.bit_or("seen").alias("seen"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    share = F.try_divide(F.bit_count("seen"), F.col("n_pairs"))
    needed = F.when(F.col("exact"), 1.0).when(F.col("template_words") < SHORT, SHORT_SHARE).otherwise(SHARE)
    span = F.struct(F.col("first").alias("start"), (F.col("last") + 2).alias("end"), "label", "exact", share.alias("share"))
    verified = F.when(share >= needed, span)
    found = bands.groupBy("doc_id", "key", "n_words").agg(
        F.max(F.when(F.col("n_pairs") == 0, F.col("n"))).alias("copies"), F.sort_array(F.collect_list(verified)).alias("spans")
    )
    # Rows with the same id and text were reduced together.
    return found.select("doc_id", "n_words", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")
