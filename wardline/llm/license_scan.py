"""Licence phrases and notices in whole texts, by diagonal voting.

Every run of k words of a text (k is three, or a shorter phrase's length) is joined by its hash to the places
of the same run in the templates. A hit at word i of the text and word j of a template votes for the diagonal
i - j. Votes are summed per text, template and diagonal; diagonals of one template that lie near each other
(words put in or left out) are merged into a span; a span stands if enough distinct runs of the template
voted for it, its length fits the template's, all runs are there that tell the template from its siblings, and
no better span overlaps it. Phrases are templates of one run, so each diagonal is a place
where the phrase stands.

Before the join, a broadcast of the templates' word-pair buckets (their number is bounded) drops all but the
text's pairs that begin a run; what is joined carries three words a row. A line that very many texts share is
a skewed key of an equi-join with few template places, never a group of its own.

Defined results: null texts and texts without words have no words and no hits (empty labels, null places,
score 0). The score is 1 with a phrase, else the share of a template found, 0 without any. Rows of docs are
kept as they are, repeated ones too.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.words import bucket, lower_ascii, split_words
from wardline.session import written

RUN = 3
# Diagonals of one template are merged if they are at most so far apart and their hits at most so many words.
NEAR_DIAGONALS = 4
NEAR_WORDS = 12
# Share of a template's runs that a span must hold, and how much longer than the template it may be.
LEAST_COVER = 0.6
MOST_STRETCH = 1.5

# Phrases that count wherever their words stand side by side.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Wording of common public licences and notices, by label.
NOTICES = [
    ("Released under the MIT License.", "mit"),
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
        "mit",
    ),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "apache-2.0",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
    (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "gpl",
    ),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
]


def plain_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def template_runs(spark: SparkSession, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(template, label, phrase, size, runs, place, run): a row for each run of words of each template.

    A phrase has up to RUN words, a notice RUN or more; the table is as large as the lists in the call.
    """
    rows = []
    for number, (text, label) in enumerate([*phrases, *notices]):
        words = plain_words(text)
        k = min(RUN, len(words))
        runs = len(words) - k + 1
        if k < 2 or (number < len(phrases)) != (runs == 1):
            raise ValueError(f"a phrase has 2 to {RUN} words, a notice more: {text!r}")
        for place in range(runs):
            run = F.array(*map(F.lit, words[place : place + k]))
            values = {"template": number, "label": label, "phrase": number < len(phrases), "size": len(words), "runs": runs, "place": place}
            rows.append(F.struct(*[F.lit(v).alias(n) for n, v in values.items()], run.alias("run")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def _votes(docs: DataFrame, id: str, text: str, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, id, n_words) of every text, and (row, template, diagonal, ...) with the votes for each diagonal."""
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.concat(split_words(text), F.array(F.lit(""))).alias("words")
    )
    placed = words.select("row", "id", "words", F.posexplode_outer("words").alias("at", "word"))
    second = F.coalesce(F.get("words", F.col("at") + 1), F.lit(""))
    placed = placed.withColumn("bucket", bucket(F.col("word"), second))
    pairs = templates.select(F.explode(F.array(F.array(F.lit(""), F.lit("")), "run")).alias("run"))
    pairs = pairs.select(bucket(F.col("run")[0], F.col("run")[1]).alias("bucket")).distinct()
    placed = placed.join(F.broadcast(written(pairs, "pairs")), "bucket", "left_semi")
    near = F.transform(F.slice("words", F.col("at") + 1, F.lit(RUN)), lower_ascii)
    last = F.col("word") == ""
    places = placed.select("row", "at", F.when(last, F.struct("id")).alias("whole"), F.when(~last, near).alias("near"))
    places = written(places, "places")
    whole = places.filter("whole is not null").select("row", "whole.id", F.col("at").cast("bigint").alias("n_words"))
    sizes = F.explode(F.sequence(F.lit(2), F.lit(RUN)))
    runs = places.filter("whole is null").select("row", "at", "near", sizes.alias("k")).filter(F.size("near") >= F.col("k"))
    runs = runs.select("row", "at", F.slice("near", 1, F.col("k")).alias("found")).withColumn("hash", F.xxhash64("found"))
    wanted = templates.withColumn("hash", F.xxhash64("run"))
    hits = runs.join(wanted, (runs.hash == wanted.hash) & (F.col("found") == F.col("run")))
    votes = hits.groupBy("row", "template", "label", "phrase", "size", "runs", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.min("at").alias("start"), F.max(F.col("at") + F.size("run")).alias("stop"), F.collect_set("place").alias("places")
    )
    return whole, written(votes, "votes")


def telling_places(notices: list[tuple[str, str]]) -> list[list[int]]:
    """For each notice the places of its runs that no sibling has: one of another label that shares LEAST_COVER.

    A notice without siblings has none to ask for.
    """
    words = [plain_words(text) for text, _ in notices]
    runs = [[tuple(w[k : k + RUN]) for k in range(len(w) - RUN + 1)] for w in words]
    out = []
    for own, (_, label) in zip(runs, notices, strict=True):
        siblings = [
            set(other) for other, (_, name) in zip(runs, notices, strict=True)
            if name != label and sum(r in set(other) for r in own) >= LEAST_COVER * min(len(own), len(other))
        ]
        theirs = set().union(*siblings)
        out.append([k for k, r in enumerate(own) if r not in theirs] if siblings else [])
    return out


def _spans(votes: DataFrame, notices: list[tuple[str, str]], first: int) -> DataFrame:
    """(row, label, start, stop, cover): merged and verified spans of notices, numbered from first.

    A span holds all runs that tell its notice from siblings. Of spans that overlap, the one that covers most of
    its notice stays; of equal ones the longer, then the earlier in the list.
    """
    whole = ("row", "template", "label", "size", "runs")
    order = Window.partitionBy("row", "template").orderBy("start", "diagonal")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    near = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) <= NEAR_DIAGONALS) & (
        F.col("start") <= F.max("stop").over(before) + NEAR_WORDS
    )
    marked = votes.filter("not phrase").withColumn("new", F.when(near, 0).otherwise(1))
    grouped = marked.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = grouped.groupBy(*whole, "span").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")
    )
    spans = spans.withColumn("cover", F.size("places") / F.col("runs"))
    fits = (F.col("cover") >= LEAST_COVER) & (F.col("stop") - F.col("start") <= MOST_STRETCH * F.col("size") + NEAR_DIAGONALS)
    told = F.lit(True)
    for number, places in enumerate(telling_places(notices), first):
        if places:
            wanted = F.array(*map(F.lit, places))
            told = told & ((F.col("template") != number) | (F.size(F.array_intersect("places", wanted)) == len(places)))
    island = Window.partitionBy("row").orderBy("start", "stop", "template")
    ahead = F.max("stop").over(island.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.filter(fits & told).withColumn("new", F.when(F.col("start") < ahead, 0).otherwise(1))
    spans = spans.withColumn("island", F.sum("new").over(island.rowsBetween(Window.unboundedPreceding, 0)))
    span = F.struct((-F.col("cover")).alias("less"), (F.col("start") - F.col("stop")).alias("shorter"), "template", "label", "start", "stop", "cover")
    sorted_spans = spans.groupBy("row", "island").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    kept = F.aggregate(
        "spans",
        F.slice("spans", 1, 1),
        lambda best, x: F.when(
            F.exists(best, lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])), best
        ).otherwise(F.concat(best, F.array(x))),
    )
    return sorted_spans.select("row", F.inline(kept)).select("row", "label", "start", "stop", "cover")


def scan(
    docs: DataFrame,
    id: str,
    text: str,
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of docs.

    Both label columns are sorted arrays; labels holds the phrases' and the notices' ones.
    """
    whole, votes = _votes(docs, id, text, template_runs(docs.sparkSession, phrases, notices))
    base = votes.filter("phrase").select("row", "label", "start", F.lit(True).alias("phrase"), F.lit(1.0).alias("cover"))
    more = _spans(votes, notices, len(phrases)).select("row", "label", "start", F.lit(False).alias("phrase"), "cover")
    placed = F.when(F.col("phrase"), F.col("start").cast("bigint"))
    found = base.union(more).groupBy("row").agg(
        F.count_if("phrase").alias("n_base"),
        F.min(placed).alias("first_word"),
        F.max(placed).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("cover").alias("score"),
    )
    none = F.array().cast("array<string>")
    return whole.join(found, "row", "left").select(
        "id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
