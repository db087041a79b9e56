"""License scans by diagonal voting (operator 2).

Notices and phrases are word sequences ("templates").  Every word pair of a
document is hashed; pairs that some template holds are joined with the places
they have there, and their words are compared.  A hit at word ``p`` of the
document and word ``t`` of a template votes for the diagonal ``p - t``: where
the template would begin.  Votes are added up per diagonal; neighbouring
diagonals (a word put in or left out shifts the rest by one) are merged, and
the merged span is kept if it holds enough of the template's words in little
more than the template's length.  A phrase stands where one diagonal has all
its pairs.

The template table is a constant of this module, so its broadcast doesn't
grow with the data; the pairs are filtered by a set of its hashes before they
become rows.  One exchange, by row, serves all grouping steps.  DataFrame
functions only.

Cases: a null text counts as empty and gives no words, null word places, empty
labels and score 0; every input row gives a row, repeated ones too; words may
stand at several places and all count; other columns aren't read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: phrases and labels of the contract
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]
# fixed values: opening sentences of public license notices
NOTICES = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl-notice"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "cc0-1.0"),
]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2
#: diagonals that lie at most so many words apart are merged.
SLACK = 2
#: a notice is there if so much of its words is.
LEAST_SHARE = 0.75
#: longest span for a notice, in its lengths.
LONGEST_SPAN = 1.5


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))


def _pairs(phrases, notices):
    """(gram, template, place, words of the template, label, whether a phrase)"""
    every = [(template_words(t), label, True) for t, label in phrases] + [(template_words(t), label, False) for t, label in notices]
    return [(" ".join(words[i : i + GRAM]), k, i, len(words), label, base) for k, (words, label, base) in enumerate(every) for i in range(len(words) - GRAM + 1)]


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` (largest share of a template) and
    ``spans`` (label, first word, word after the last, share of the template)."""
    spark = df.sparkSession
    pairs = spark.createDataFrame(_pairs(phrases, notices), "gram string, template int, place int, length int, label string, base boolean")
    hashed = F.xxhash64(*(F.get(F.split("gram", " "), F.lit(i)) for i in range(GRAM)))
    templates = pairs.withColumn("hash", hashed)
    known = [r[0] for r in templates.select("hash").distinct().collect()]

    # the Kelvin sign is the one character whose lower case is in a-z
    lowered = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("K"), F.lit("ⓚ")))
    words = df.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    grams = F.transform(
        F.when(F.size("words") >= GRAM, F.sequence(F.lit(0), F.size("words") - GRAM)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("at"), F.xxhash64(*(F.get("words", i + k) for k in range(GRAM))).alias("hash")),
    )
    hits = words.select(
        "id",
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.transform(
            F.filter(grams, lambda g: g["hash"].isin(known)),
            lambda g: F.struct(g["at"].alias("at"), g["hash"].alias("hash"), F.array_join(F.slice("words", g["at"] + 1, GRAM), " ").alias("gram")),
        ).alias("hits"),
    ).select("id", "row", "n_words", F.explode_outer("hits").alias("hit"))
    voted = hits.select("id", "row", "n_words", F.col("hit.at").alias("at"), F.col("hit.hash").alias("hash"), F.col("hit.gram").alias("gram")).join(F.broadcast(templates), ["hash", "gram"], "left")

    one_row = ["row", "id", "n_words"]
    kind = ["template", "length", "label", "base"]
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    diagonals = (
        voted.repartition("row")
        .groupBy(*one_row, *kind, diagonal)
        .agg(F.count("*").alias("votes"), F.min("at").alias("first"), (F.max("at") + GRAM).alias("after"), F.collect_set("place").alias("places"))
    )
    in_order = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(in_order) > SLACK, F.lit(True)) | F.col("base")
    spans = (
        diagonals.withColumn("opens", apart.cast("int"))
        .withColumn("span", F.sum("opens").over(in_order))
        .groupBy(*one_row, *kind, "span")
        .agg(
            F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("after").alias("after"), F.min("diagonal").alias("begins"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        )
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + GRAM - 1)))))
    share = covered / F.col("length")
    whole = F.col("base") & (F.col("votes") == F.col("length") - GRAM + 1)
    enough = ~F.col("base") & (share >= LEAST_SHARE) & (F.col("after") - F.col("first") <= F.col("length") * LONGEST_SPAN)
    found = F.when(whole | enough, F.struct(F.col("first").cast("long").alias("first"), F.col("after").cast("long").alias("after"), "label", share.alias("share"), "base"))
    base = F.filter("found", lambda s: s["base"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return (
        spans.groupBy(*one_row)
        .agg(F.collect_list(found).alias("found"))
        .select(
            F.col("id").alias(key),
            "n_words",
            F.size(base).cast("long").alias("n_base"),
            F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"),
            F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
            names(base).alias("base_labels"),
            names(F.col("found")).alias("labels"),
            F.coalesce(F.array_max(F.transform("found", lambda s: s["share"])), F.lit(0.0)).alias("score"),
            F.array_sort(F.transform("found", lambda s: F.struct(s["first"].alias("first"), s["after"].alias("after"), s["label"].alias("label"), s["share"].alias("share")))).alias("spans"),
        )
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and notices of all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


def _template_rows() -> str:
    every = [(t, label, "true") for t, label in PHRASES] + [(t, label, "false") for t, label in NOTICES]
    return ", ".join(f"({k}, {template_words(t)}, '{label}', {base})" for k, (t, label, base) in enumerate(every))


OP2_SQL = rf"""
WITH templates(template, words, label, base) AS (VALUES {_template_rows()}),
pairs AS (
  SELECT template, len(words) AS length, label, base, place, words[place + 1] AS one, words[place + 2] AS two
  FROM (SELECT *, unnest(range(len(words) - 1)) AS place FROM templates)),
worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{WORD}') AS w
  FROM documents),
hits AS (
  SELECT doc_id, pos, p.* FROM (SELECT doc_id, w, unnest(range(len(w) - 1)) AS pos FROM worded) d
  JOIN pairs p ON p.one = w[pos + 1] AND p.two = w[pos + 2]),
diagonals AS (
  SELECT doc_id, template, length, label, base, pos - place AS diagonal, count(*) AS votes, min(pos) AS first,
    max(pos) + 2 AS after, list(place) AS places
  FROM hits GROUP BY ALL),
opened AS (
  SELECT *, base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {SLACK}, true) AS opens
  FROM diagonals),
numbered AS (
  SELECT *, count_if(opens) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM opened),
spans AS (
  SELECT doc_id, template, length, label, base, sum(votes) AS votes, min(first) AS first, max(after) AS after,
    len(list_distinct(flatten(list(list_concat(places, list_transform(places, lambda p: p + 1)))))) / length AS share
  FROM numbered GROUP BY doc_id, template, length, label, base, span),
found AS (
  SELECT * FROM spans WHERE CASE WHEN base THEN votes = length - 1
    ELSE share >= {LEAST_SHARE} AND after - first <= length * {LONGEST_SPAN} END)
SELECT d.doc_id, len(any_value(w)) AS n_words, count(f.first) FILTER (base) AS n_base, min(f.first) FILTER (base) AS first_word,
  max(f.first) FILTER (base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0::DOUBLE) AS score
FROM worded d LEFT JOIN found f USING (doc_id) GROUP BY d.doc_id
"""
