"""License scans by diagonal voting, in DataFrame operations only.

All word k-grams of every document are joined by hash (and text) to the places of
the same k-grams in the templates.  A template that occurs in a document votes on
one diagonal, document place minus template place.  Votes are counted per
diagonal; of long templates every diagonal is merged with the neighbours up to
``MAX_SHIFT`` places after it, which bridges inserted and lost words, and such a
neighbourhood is verified by the share of the template's places that it holds,
each counted once however often it is voted for.  Of overlapping neighbourhoods
the best one stands.  Short phrases must match in full on a single diagonal, which
makes all their words equal, one after the other.

The templates are a fixed table of some thousand k-grams, the only broadcast.

Defined results: null is empty text; documents without a match have no labels and
score 0; of equally good overlapping neighbourhoods the first stands; texts of any
length are scanned whole; repeated rows give repeated results; an empty table gives
no rows; other columns never matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
# Long templates: how far apart merged diagonals lie, and the least share of places found.
MAX_SHIFT, LEAST_SHARE = 8, 0.7
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The phrases and labels that every scan reports.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Further short phrases (matched in full) and notices (matched by share).
PHRASES = [
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2"),
    ("bsd", "under the bsd license"),
    ("isc", "under the isc license"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc0", "cc0 1 0 universal"),
]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                 "license at http www apache org licenses license 2 0 unless required by applicable law or agreed "
                 "to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy "
                  "modify publish use compile sell or distribute this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software the software is provided as is without warranty of any kind express or implied "
            "including but not limited to the warranties of merchantability fitness for a particular purpose and "
            "noninfringement in no event shall the authors or copyright holders be liable for any claim damages or "
            "other liability whether in an action of contract tort or otherwise arising from out of or in connection "
            "with the software or the use or other dealings in the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer redistributions in binary form must reproduce the above copyright notice this list "
            "of conditions and the following disclaimer in the documentation and or other materials provided with "
            "the distribution"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied "
            "warranties including but not limited to the implied warranties of merchantability and fitness for a "
            "particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for "
            "any direct indirect incidental special exemplary or consequential damages"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software "
            "including all implied warranties of merchantability and fitness in no event shall the author be liable "
            "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss "
            "of use data or profits"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even "
            "the implied warranty of merchantability or fitness for a particular purpose see the gnu general public "
            "license for more details"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
              "mpl was not distributed with this file you can obtain one at"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software permission is granted to anyone to "
             "use this software for any purpose including commercial applications and to alter it and redistribute "
             "it freely"),
]


def template_rows() -> list[tuple]:
    """(template, label, is_base, k-grams, merged shift, least share of places)."""
    rows = []
    for kind, source in (("base", BASE), ("phrase", PHRASES), ("notice", NOTICES)):
        for label, text in source:
            words = text.split()
            exact = kind != "notice"
            rows.append((len(rows), label, kind == "base", [" ".join(words[i:i + K]) for i in range(len(words) - K + 1)],
                         0 if exact else MAX_SHIFT, 1.0 if exact else LEAST_SHARE))
    return rows


def templates(spark: SparkSession) -> DataFrame:
    """One row per k-gram place of a template."""
    rows = [(t, label, base, shift, least, len(grams), i, gram)
            for t, label, base, grams, shift, least in template_rows() for i, gram in enumerate(grams)]
    return spark.createDataFrame(rows, "template int, label string, is_base boolean, shift int, least double, "
                                       "size long, place long, key string")


def word_list(text_col: str) -> F.Column:
    """Words of the whole text, A-Z in lower case."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: rid, doc_id, n_words, and label, is_base, first, last, share (null without a match)."""
    words = (docs.select(F.col(id_col).alias("doc_id"), word_list(text_col).alias("words"))
             .withColumn("rid", F.monotonically_increasing_id()).withColumn("n_words", F.size("words").cast("long")))
    grams = F.when(F.col("n_words") >= K,
                   F.transform(F.sequence(F.lit(1), F.size("words") - (K - 1)),
                               lambda i: F.concat_ws(" ", F.slice("words", i, K))))
    # place 0 stands for the document, place i for the k-gram at word i - 1
    places = words.select("rid", "doc_id", "n_words", F.posexplode(
        F.concat(F.array(F.lit(None).cast("string")), F.coalesce(grams, F.array().cast("array<string>"))))
        .alias("at", "gram"))
    table = F.broadcast(templates(docs.sparkSession).withColumn("hash", F.xxhash64("key")))
    votes = (places.withColumn("hash", F.xxhash64("gram")).join(table, "hash", "left")
             .where((F.col("at") == 0) | (F.col("gram") == F.col("key")))
             .repartition("rid"))
    diagonals = votes.groupBy("rid", "doc_id", "n_words", "template", "label", "is_base", "shift", "least", "size",
                              (F.col("at") - 1 - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("low"), F.max("at").alias("high"))
    line = Window.partitionBy("rid", "template").orderBy("diagonal")
    merged = line.rangeBetween(0, MAX_SHIFT)  # a bounded number of diagonals, each with a template's places at most
    alone = F.col("shift") == 0
    found = F.when(alone, F.size("places")).otherwise(
        F.size(F.array_distinct(F.flatten(F.collect_list("places").over(merged)))))
    spans = diagonals.select(
        "rid", "doc_id", "n_words", "template", "label", "is_base", "shift", "least", "diagonal",
        (found / F.col("size")).alias("share"),
        (F.when(alone, F.col("low")).otherwise(F.min("low").over(merged)) - 1).alias("first"),
        (F.when(alone, F.col("high")).otherwise(F.max("high").over(merged)) + K - 2).alias("last"))
    best = F.max(F.struct("share", F.negative("diagonal").alias("before"))).over(
        line.rangeBetween(-MAX_SHIFT, MAX_SHIFT))
    stands = (F.col("shift") == 0) | (F.col("_best.before") == -F.col("diagonal"))
    fits = (F.col("share") >= F.col("least")) & stands
    return spans.withColumn("_best", best).select(
        "rid", "doc_id", "n_words",
        *[F.when(fits, F.col(c)).alias(c) for c in ("label", "is_base", "first", "last", "share")])


def joined_labels(label: F.Column) -> F.Column:
    return F.array_join(F.array_sort(F.collect_set(label)), ",")


def label_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base_start = F.when(F.col("is_base"), F.col("first")).cast("long")
    return (scan(docs, id_col, text_col).groupBy("rid", "doc_id", "n_words").agg(
        F.count(base_start).alias("n_base"), F.min(base_start).alias("first_word"),
        F.max(base_start).alias("last_word"),
        joined_labels(F.when(F.col("is_base"), F.col("label"))).alias("base_labels"),
        joined_labels(F.col("label")).alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
        .drop("rid"))


def sql() -> str:
    """The same scan as SQL text over ``documents``."""
    values = ", ".join(f"({t}, '{label}', {str(base).lower()}, {shift}, {least}, {len(grams)}, {i}, '{gram}')"
                       for t, label, base, grams, shift, least in template_rows() for i, gram in enumerate(grams))
    return rf"""
WITH t(template, label, is_base, shift, least, size, place, gram) AS (VALUES {values}),
w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
g AS (
  SELECT rid, i - 1 AS pos, array_to_string(ws[i:i + {K - 1}], ' ') AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {K - 2})) AS i FROM w WHERE len(ws) >= {K})),
d AS (
  SELECT rid, template, label, is_base, shift, least, size, pos - place AS diagonal, list(DISTINCT place) AS places,
         min(pos) AS low, max(pos) AS high
  FROM g JOIN t USING (gram) GROUP BY ALL),
m AS (
  SELECT rid, template, label, is_base, shift, least, diagonal,
         CASE WHEN shift = 0 THEN len(places) ELSE len(list_distinct(flatten(list(places) OVER o))) END::DOUBLE / size
           AS share,
         CASE WHEN shift = 0 THEN low ELSE min(low) OVER o END AS first,
         CASE WHEN shift = 0 THEN high ELSE max(high) OVER o END + {K - 1} AS last
  FROM d WINDOW o AS (PARTITION BY rid, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {MAX_SHIFT} FOLLOWING)),
f AS (
  SELECT * FROM m WHERE share >= least AND (shift = 0 OR NOT EXISTS (
    SELECT 1 FROM m b WHERE b.rid = m.rid AND b.template = m.template AND abs(b.diagonal - m.diagonal) <= {MAX_SHIFT}
      AND (b.share > m.share OR (b.share = m.share AND b.diagonal < m.diagonal))))),
r AS (
  SELECT rid, count(*) FILTER (WHERE is_base) AS n_base, min(first) FILTER (WHERE is_base) AS first_word,
         max(first) FILTER (WHERE is_base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM f GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN r USING (rid)
"""
