"""License scans by diagonal voting over word k-grams.

All word k-grams of all texts are hashed and joined with the places of the same grams in
license templates. A hit votes for a diagonal, its place in the text less its place in the
template. Neighbouring diagonals of a template merge, so that a lost or added word does not
split a match, and a merged span counts once it holds enough different template places
within a span of about the template's length. Phrases are templates too: they need every
gram on one diagonal.

The template grams number a few hundred, fixed by the lists below, and are broadcast; rows
of the texts are not shuffled, only hits, summed on the map side.

Defined cases: null and empty texts have no words and no labels; rows with equal doc_id are
judged one by one; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartfold.llm.text import name_words, table

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Fixed texts: sentences of widely used license notices.
TEMPLATES = {
    "apache-notice": "licensed under the apache license version 2 0 the license you may not use this file except in "
                     "compliance with the license you may obtain a copy of the license at",
    "apache-line": "licensed under the apache license version 2 0",
    "gpl-line": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation",
    "mit-line": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
    "cc-by-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted "
                  "provided that the following conditions are met",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
PHRASE_WORDS = 2
TEMPLATE_WORDS = 3
SLACK = 2
COVERAGE = 0.7


def template_grams(spark, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """(gram, template, at, label, size, exact): every place of every gram of the lists."""
    rows = [(p, label, p.split(), PHRASE_WORDS, True) for p, label in phrases.items()]
    rows += [(name, name, text.split(), TEMPLATE_WORDS, False) for name, text in templates.items()]
    listed = spark.createDataFrame(rows, "template string, label string, words array<string>, k int, exact boolean")
    places = F.sequence(F.lit(0), F.size("words") - F.col("k"))
    listed = listed.select("*", F.explode(places).alias("at"))
    gram = F.xxhash64("k", F.array_join(F.slice("words", F.col("at") + 1, F.col("k")), " "))
    return listed.select(gram.alias("gram"), "template", "at", "label", (F.size("words") - F.col("k") + 1).alias("size"),
                         "k", "exact")


def text_grams(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, place, gram): grams of both lengths; one row without a gram for short texts."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", name_words("text").alias("words"))
    rows = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), "words")

    def at(i):
        a, b, c = (F.get("words", i + j) for j in range(3))
        two = F.xxhash64(F.lit(2), F.concat_ws(" ", a, b))
        three = F.when(c.isNotNull(), F.xxhash64(F.lit(3), F.concat_ws(" ", a, b, c)))
        return F.struct(i.alias("place"), two.alias("two"), three.alias("three"))

    places = F.when(F.size("words") > 1, F.transform(F.sequence(F.lit(0), F.size("words") - 2), at))
    return rows.select("row", "doc_id", "n_words", F.inline_outer(places))


def votes(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Hits by row, template and diagonal; a row without hits has one line with a null template."""
    listed = F.broadcast(grams.groupBy("gram").agg(F.collect_list(F.struct(
        "template", "at", "label", "size", "k", "exact")).alias("spots")))
    met = text_grams(docs)
    for name in ("two", "three"):
        met = met.join(listed.select(F.col("gram").alias(name), F.col("spots").alias(f"{name}_spots")), name, "left")
    spots = F.concat(*(F.coalesce(f"{n}_spots", F.array().cast(
        "array<struct<template:string,at:int,label:string,size:int,k:int,exact:boolean>>")) for n in ("two", "three")))
    met = met.select("row", "doc_id", "n_words", "place", F.when(F.size(spots) > 0, spots).alias("spots"))
    # Grams without a hit end here; each text's first one stays, so that every row remains.
    met = met.where("spots IS NOT NULL OR place IS NULL OR place = 0")
    hits = met.select("row", "doc_id", "n_words", "place", F.explode_outer("spots").alias("spot"))
    hits = hits.select("row", "doc_id", "n_words", "place", "spot.*")
    return hits.groupBy("row", "doc_id", "n_words", "template", "label", "size", "k", "exact",
                        (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count("template").alias("votes"), F.min("place").alias("low"), F.max("place").alias("high"),
        F.collect_set("at").alias("spots"))


def matches(voted: DataFrame, slack: int = SLACK, coverage: float = COVERAGE) -> DataFrame:
    """Verified places: (row, doc_id, n_words, template, label, exact, start, end, score); all rows remain."""
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    apart = F.col("exact") | F.coalesce(step > slack, F.lit(True))
    merged = voted.withColumn("part", F.sum(apart.cast("int")).over(order))
    merged = merged.groupBy("row", "doc_id", "n_words", "template", "label", "size", "k", "exact", "part").agg(
        F.sum("votes").alias("votes"), F.min("low").alias("start"), (F.max("high") + F.max("k")).alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).alias("covered"))
    score = F.col("covered") / F.col("size")
    long = F.col("end") - F.col("start") > 2 * (F.col("size") + F.col("k"))
    good = F.when(F.col("exact"), score == 1).otherwise((score >= coverage) & ~long)
    return merged.select("row", "doc_id", "n_words", "exact", "start", "end",
                         *(F.when(good, F.col(c)).alias(c) for c in ("template", "label")),
                         F.when(good, score).alias("score"))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """All verified places of all texts, and one line with a null template for a text without."""
    return matches(votes(docs, template_grams(docs.sparkSession, phrases, templates)))


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.col("exact") & F.col("template").isNotNull()
    phrase_start, labels = F.when(base, F.col("start")), lambda c: F.array_join(F.array_sort(c), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(phrase_start).cast("long").alias("first_word"), F.max(phrase_start).cast("long").alias("last_word"),
        labels(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        labels(F.collect_set("label")).alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score")).drop("row")
