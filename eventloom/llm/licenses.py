"""License scans by diagonal voting, in DataFrame operations alone.

Every run of k words of a document is hashed and joined to the places of the license templates that
hold the same run. A hit votes for a diagonal, the document place less the template place: a copied
license votes for one diagonal from end to end, an edited one for a few neighbouring ones. Votes are
summed by diagonal, neighbouring diagonals are merged, and the merged spans are verified word by word
of their hits against the template's length.

The templates are a fixed table, broadcast for that reason. Only hits are shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.storage import row_key

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that are labels wherever they stand in full.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening passages of public licenses and the notices that name them.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def words(text: str) -> Column:
    """Words of a text with A-Z lower-cased; none for a null text."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_A_WORD)
    return F.filter(parts, lambda w: w != "")


def _table(spark, k: int) -> DataFrame:
    """(template, label, base, at, places, size, run): every run of k words of the templates, or of phrases shorter than k."""
    rows, whole = [], [(x, y, False) for y, x in TEMPLATES] + [(x, y, True) for x, y in PHRASES.items()]
    for n, (text, label, base) in enumerate(whole):
        own = text.split()
        size = min(k, len(own))
        runs = [" ".join(own[i : i + size]) for i in range(len(own) - size + 1)]
        rows += [(n, label, base, i, len(runs), size, run) for i, run in enumerate(runs)]
    schema = "template int, label string, base boolean, at int, places int, size int, run string"
    return spark.createDataFrame(rows, schema)


def _hits(docs: DataFrame, table: DataFrame, size: int, first: list[str]) -> DataFrame:
    """(key, template, label, base, at, place) where a run of `size` words is a template's."""
    # a document without any word that a run can start with has no hit
    some = F.arrays_overlap("words", F.array(*[F.lit(w) for w in first]))
    places = F.when(some & (F.size("words") >= size), F.sequence(F.lit(0), F.size("words") - size))
    grams = docs.select("key", F.transform(places, lambda i: F.xxhash64(*[F.get(F.col("words"), i + j) for j in range(size)])).alias("grams"), "words")
    each = grams.select("key", "words", F.posexplode_outer("grams").alias("place", "gram"))  # outer: no filter that splits the text again
    own = F.concat_ws(" ", F.lit(""), *[F.get(F.col("words"), F.col("place") + j) for j in range(size)], F.lit(""))
    known = table.where(F.col("size") == size).withColumn("gram", F.xxhash64(*[F.get(F.split("run", " "), j) for j in range(size)]))
    # runs of as many words are equal if one holds the other; an equality would become a join key, built for every run
    hits = each.join(F.broadcast(known), "gram").where(own.contains(F.concat(F.lit(" "), "run", F.lit(" "))))
    return hits.select("key", "template", "label", "base", "at", "places", "size", "place")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 3, slack: int = 3, least: float = 0.6) -> DataFrame:
    """(key, template, label, base, first, last, score): license spans of each text, words from 0, last included.

    Diagonals at most `slack` apart that stand within a template's length are one span; its score is
    the share of the template's runs that it holds, and spans below `least` are dropped. A phrase is a
    span at every place where it stands in full. `key` names the row: see `storage.row_key`.
    """
    spark = docs.sparkSession
    rows = docs.select(row_key(doc_id, text).alias("key"), words(text).alias("words"))
    table = _table(spark, k)
    every = [x for _, x in TEMPLATES] + list(PHRASES)
    found = None
    for size in sorted({min(k, len(x.split())) for x in every}):
        runs = [x.split() for x in every if min(k, len(x.split())) == size]
        first = sorted({w for x in runs for w in x[: len(x) - size + 1]})
        hits = _hits(rows, table, size, first)
        found = hits if found is None else found.union(hits)
    votes = found.groupBy("key", "template", "label", "base", "places", "size", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    exact = votes.where("base AND size(ats) = places").select("key", "template", "label", "base", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("places") + F.col("size") - 2).alias("last"), F.lit(1.0).alias("score"))
    # places of one template in order: a new span begins where the next diagonal is far from the last
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > slack
    merged = votes.where("NOT base").withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    merged = merged.groupBy("key", "template", "label", "base", "places", "size", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    near = merged.select("key", "template", "label", "base", "first", (F.col("last") + F.col("size") - 1).alias("last"), (F.col("held") / F.col("places")).alias("score"))
    return exact.union(near.where(F.col("score") >= least))


def by_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **named) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels; n_base counts every place of every phrase,
    first_word and last_word are the smallest and largest of their starts, else null. Labels are
    distinct, sorted and joined by commas, empty where there are none. Repeated rows are repeated.
    """
    spans = scan(docs, text, doc_id, **named)
    base = F.col("base")
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = spans.groupBy("key").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    rows = docs.select(docs[doc_id].alias("doc_id"), row_key(doc_id, text).alias("key"), F.size(words(text)).cast("long").alias("n_words"))
    return rows.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def plain_words(text: str | None) -> list[str]:
    """The same words, for tests."""
    return [w for w in re.split(NOT_A_WORD, (text or "").translate(str.maketrans(UPPER, LOWER))) if w]
