"""License scans by diagonal voting.

Rolling hashes of word k-grams of every document are joined to the places
where they stand in license templates. A copied passage keeps its offset to
the template, so matches vote for the diagonal (document place minus template
place). Votes are counted by diagonal, neighbouring diagonals merge (words
added or left out shift the offset), and a merged run counts if it covers
enough of the words it spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm._common import KEY, Store, byte_texts, keyed, slices
from tickloom.llm.decontaminate import run_hashes, word_codes, words_of

GRAM = 4
#: Diagonals this near to each other merge; matched words over spanned words, matched words and share of the template at least.
DRIFT, DENSITY, LEAST_WORDS, LEAST_SHARE = 6, 0.5, 8, 0.5
#: Template rows below which the join broadcasts them; above, it shuffles both sides.
BROADCAST_ROWS = 50_000

# Phrases of the base scan, and public license texts.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "This work is released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
)


def templates(spark: SparkSession, texts=TEMPLATES) -> DataFrame:
    """(template, label, size, gram, at): every k-gram of every template; a template below k words is one gram of its own length."""
    rows = []
    for k, (label, text) in enumerate(texts):
        words = words_of(text.encode())
        span = min(GRAM, len(words))
        rows += [(k, label, len(words), span, gram, at) for at, gram in enumerate(run_hashes(word_codes(words), span).tolist())] if words else []
    return spark.createDataFrame(rows, "template int, label string, size int, span int, gram long, at int")


def _scanned(docs: DataFrame, vocabulary: list[bytes], lengths: list[int]) -> DataFrame:
    """Per row its key, the base phrases' places, and the k-grams that consist of template words only."""
    grams = pa.list_(pa.struct([("span", pa.int32()), ("gram", pa.int64()), ("place", pa.int64())]))
    schema = "doc_id long, h1 long, h2 long, n_words long, n_base long, first_word long, last_word long, base array<string>, grams array<struct<span:int,gram:long,place:long>>"
    phrases = [(f" {p} ".encode(), label) for p, label in PHRASES]

    def base(words: list[bytes]) -> tuple[list[int], list[str]]:
        joined = b" " + b" ".join(words) + b" "
        places, labels = [], []
        for phrase, label in phrases:
            at, word, seen = joined.find(phrase), 0, 0
            while at >= 0:
                word += joined.count(b" ", seen, at)
                seen = at
                places.append(word)
                labels.append(label)
                at = joined.find(phrase, at + 1)
        return places, sorted(set(labels))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict.fromkeys(vocabulary, True)
        for batch in slices(batches):
            out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base", "grams")}
            for data in byte_texts(batch):
                words = words_of(data)
                places, labels = base(words) if b"license" in data.lower() else ([], [])
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(min(places, default=None))
                out["last_word"].append(max(places, default=None))
                out["base"].append(labels)
                own = []
                usable = np.concatenate(([0], np.cumsum([w in known for w in words]))) if words else np.zeros(1, np.int64)
                for length in lengths:
                    for at in np.flatnonzero(usable[length:] - usable[:-length] == length).tolist() if len(words) >= length else ():
                        own.append({"span": length, "gram": int(run_hashes(word_codes(words[at : at + length]), length)[0]), "place": at})
                out["grams"].append(own)
            columns = [*(batch.column(c) for c in KEY), *(pa.array(out[k], pa.int64()) for k in ("n_words", "n_base", "first_word", "last_word")), pa.array(out["base"], pa.list_(pa.string())), pa.array(out["grams"], grams)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")[:9]])

    return docs.select(*KEY, "text").mapInArrow(scan, schema)


def scan(docs: DataFrame, texts=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of ``docs``.

    ``score`` is the largest share of a template's words that a verified run
    matches; a document with a base phrase scores 1. A k-gram with a word of no
    template cannot match and is not joined. Nulls: a null text is empty; a
    null doc_id keeps its row. Repeated rows repeat. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    store = Store(spark)
    table = templates(spark, texts)
    vocabulary = sorted({w for _, text in texts for w in words_of(text.encode())})
    lengths = sorted({min(GRAM, len(words_of(text.encode()))) for _, text in texts} - {0})
    scanned = store.keep(_scanned(keyed(docs), vocabulary, lengths))
    small = sum(len(words_of(text.encode())) for _, text in texts) <= BROADCAST_ROWS

    grams = scanned.select(*KEY, F.explode("grams").alias("g")).select(*KEY, "g.*").distinct()
    votes = grams.join(F.broadcast(table) if small else table, ["span", "gram"])
    diagonals = votes.groupBy(*KEY, "template", "label", "size", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.min("place").alias("first"), F.max(F.col("place") + F.col("span")).alias("end"), F.collect_set(F.struct("at", "span")).alias("hits")
    )
    runs = _merged(diagonals)
    spans = (F.col("end") - F.col("first")).cast("double")
    dense = runs.where((F.col("words") >= DENSITY * spans) & ((F.col("words") >= LEAST_WORDS) | (F.col("words") >= F.col("size"))) & (F.col("words") >= LEAST_SHARE * F.col("size")))
    found = dense.select(*KEY, F.lit(0).alias("copy"), F.col("label"), F.least(F.col("words") / F.col("size"), F.lit(1.0)).alias("share"))
    plain = scanned.select(*KEY, F.lit(1).alias("copy"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("share"), "n_words", "n_base", "first_word", "last_word", "base")
    by_doc = (
        plain.unionByName(found, allowMissingColumns=True)
        .groupBy(*KEY)
        .agg(
            F.sum("copy").cast("int").alias("copies"),
            *(F.max(c).alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base")),
            F.collect_set("label").alias("more"),
            F.max("share").alias("share"),
        )
    )
    labels = F.array_sort(F.array_distinct(F.concat("base", "more")))
    return by_doc.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.round(F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))), 6).alias("score"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_"),
    ).drop("_")


def _merged(diagonals: DataFrame) -> DataFrame:
    """Runs of neighbouring diagonals of one document and template, with the distinct template words they match.

    Diagonals are neighbours within DRIFT; among neighbours a run goes on while
    the next stretch starts before or soon after the furthest end so far; what
    then isn't a neighbour any more goes apart. A document has few diagonals of
    one template: at most one for each of its words.
    """
    from pyspark.sql import Window

    def parted(rows: DataFrame, name: str, within: list[str], apart: Column, order: list[str]) -> DataFrame:
        rows = rows.withColumn("new", F.coalesce(apart.cast("int"), F.lit(0)))
        return rows.withColumn(name, F.sum("new").over(Window.partitionBy(*KEY, "template", *within).orderBy(*order))).drop("new")

    def far(*within: str) -> Column:
        return F.col("diagonal") - F.lag("diagonal").over(Window.partitionBy(*KEY, "template", *within).orderBy("diagonal", "first")) > DRIFT

    numbered = parted(diagonals, "near", [], far(), ["diagonal", "first"])
    furthest = F.max("end").over(Window.partitionBy(*KEY, "template", "near").orderBy("first", "diagonal").rowsBetween(Window.unboundedPreceding, -1))
    numbered = parted(numbered, "stretch", ["near"], F.col("first") - furthest > 2 * DRIFT, ["first", "diagonal"])
    numbered = parted(numbered, "rest", ["near", "stretch"], far("near", "stretch"), ["diagonal", "first"])
    merged = numbered.groupBy(*KEY, "template", "label", "size", "near", "stretch", "rest").agg(F.min("first").alias("first"), F.max("end").alias("end"), F.flatten(F.collect_list("hits")).alias("hits"))
    words = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + h["span"] - 1)))))
    return merged.withColumn("words", words)
