"""Operator 3: license scans by diagonal voting.

Every rolling k-gram of a document's words is hashed and joined to the positions of the same k-gram in license
templates. A match votes for its diagonal, word position less template position; a template that stands in the text
unbroken puts all its votes on one diagonal, inserted or lost words move the rest to diagonals nearby. Neighbouring
diagonals are merged into spans, and a span is kept if it holds enough of the template's k-grams within its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm import common

K, GAP, COVER, STRETCH = 3, 3, 0.7, 1.4

# Base phrases, which must stand word for word, and wordings of public licenses.
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "released under the terms of the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def grams_of(words: np.ndarray) -> np.ndarray:
    return common.shingles(words, K).view(np.int64)


def rolled(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_words and the hashes of all rolling k-grams of each text."""

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text")):
            words, counts = common.word_hashes(b.column("text"), common.ALNUM)
            grams = grams_of(words)
            ends = np.cumsum(counts)
            have = np.maximum(counts - K + 1, 0)  # none crosses documents
            at = np.repeat(ends - counts - (np.cumsum(have) - have), have) + np.arange(have.sum())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_key"), pa.array(counts, pa.int64()), common.lists(grams[at], have, pa.int64())], names=["doc_id", "row_key", "n_words", "grams"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_key().alias("row_key"), "text")
    return rows.mapInArrow(roll, "doc_id bigint, row_key bigint, n_words bigint, grams array<bigint>")


def word_counts(docs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text")):
            data, off = common.buffers(b.column("text"))
            found = np.bincount(common.runs(data, off, common.ALNUM)[2], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_key"), pa.array(found, pa.int64())], names=["doc_id", "row_key", "n_words"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_key().alias("row_key"), "text")
    return rows.mapInArrow(count, "doc_id bigint, row_key bigint, n_words bigint")


def template_grams(spark: SparkSession) -> DataFrame:
    """A row per template and position: gram, template, label, base, at, grams. Its size is that of the lists above."""
    rows = []
    for number, (label, phrase, base) in enumerate([(k, v, True) for k, v in BASE.items()] + [(k, v, False) for k, v in TEMPLATES]):
        found = grams_of(common.word_hashes(pa.array([phrase]), common.ALNUM)[0]).tolist()
        rows += [(gram, number, label, base, at, len(found)) for at, gram in enumerate(found)]
    return spark.createDataFrame(rows, "gram bigint, template int, label string, base boolean, at int, grams int")


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans: doc_id, row_key, label, base, start, end (words from 0, end excluded) and cover, the share of
    the template's k-grams that the span holds. Base phrases are whole and unbroken."""
    hits = (
        rolled(docs)
        .select("doc_id", "row_key", F.posexplode("grams").alias("pos", "gram"))
        .join(F.broadcast(template_grams(docs.sparkSession)), "gram")
        .withColumn("diagonal", F.col("pos") - F.col("at"))
    )
    keys = ["doc_id", "row_key", "template", "label", "base", "grams"]
    votes = hits.groupBy(*keys, "diagonal").agg(F.collect_set("at").alias("held"), F.min("pos").alias("start"), (F.max("pos") + K).alias("end"))
    order = Window.partitionBy(*keys).orderBy("diagonal")
    far = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(order) > GAP)
    merged = (
        votes.withColumn("far", F.coalesce(far.cast("int"), F.lit(0)))
        .withColumn("band", F.sum("far").over(order))
        .groupBy(*keys, "band")
        .agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"), F.min("start").alias("start"), F.max("end").alias("end"))
    )
    held, grams = F.size("held"), F.col("grams")
    enough = F.when(F.col("base"), held == grams).otherwise((held >= COVER * grams) & (F.col("end") - F.col("start") <= STRETCH * (grams + K - 1)))
    out = ["doc_id", "row_key", "label", "base", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), (F.size("held") / F.col("grams")).alias("cover")]
    return merged.where(enough).select(*out)


def scan(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_words, n_base (all places of base phrases), first_word and last_word (their least
    and greatest start), base_labels, labels (sorted, distinct, joined by commas) and score (the best cover, 0 if none).

    Null and empty texts have no words. Rows that repeat a doc_id and text all get that text's result; a null doc_id is
    an id like others. Other columns are not read.
    """
    base = F.col("base")
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = spans(docs).groupBy("doc_id", "row_key").agg(
        F.count_distinct(F.when(base, F.struct("label", "start"))).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"),
        F.max("cover").alias("score"),
    )
    rows = word_counts(docs).alias("d")
    found = found.alias("f")
    met = rows.join(found, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.row_key") == F.col("f.row_key")), "left")
    filled = {"n_base": F.lit(0), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    return met.select("d.doc_id", "n_words", *[F.coalesce(c, filled[c]).alias(c) if c in filled else F.col(c) for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score")])
