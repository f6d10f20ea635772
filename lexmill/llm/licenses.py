"""License texts in documents by diagonal voting.

1. Every run of two words of a text is joined, by its hash, to the places of that run in the templates; longer templates ask for the two words
   that follow as well. The words themselves are compared, so a hit is no accident of the hash.
2. A hit votes for its diagonal: its place in the text less its place in the template. Votes are gathered per document, template and
   diagonal.
3. Diagonals at most DRIFT apart are merged: words left out or put in move a text to the next one.
4. A span is verified by the share of the template's words that its hits cover and by its length. A phrase must be covered whole, on one diagonal.

The templates are a parameter and bounded by MOST_WORDS; their table is broadcast. Only hits are shuffled, by document.

Rules: NULL texts are empty. Texts of any length are read whole. Rows with equal or NULL keys stay rows of their own. An empty table gives no rows. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import scratch

RUN, DRIFT, SHARE, STRETCH = 4, 3, 0.6, 2
MOST_WORDS = 20_000  # words of all templates together, as their table is broadcast
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # ASCII but for digits and small letters


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # must be covered whole
    base: bool = False  # counts as base

    @property
    def words(self) -> list[str]:
        lower = self.text.translate(str.maketrans(UPPER, LOWER))
        return [w for w in re.split(BETWEEN, lower) if w]


# The phrases that count as base, and wording of public licenses.
PHRASES = [Template("mit", "mit license", True, True), Template("apache", "apache license", True, True),
           Template("gpl", "general public license", True, True)]
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
             "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
             "this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
             "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
             "version."),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer."),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
             "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
             "publish, use, compile, sell, or distribute this software"),
    Template("cc-by-nc", "licensed under CC BY-NC", True),
    Template("cc-by-sa", "licensed under CC BY-SA", True),
    Template("cc-by", "licensed under a Creative Commons Attribution", True),
]


def template_rows(templates: list[Template]) -> list[tuple]:
    """(tid, label, phrase, base, length, tpos, w0, w1, w2, w3): one row per run that votes."""
    rows, n = [], 0
    for tid, t in enumerate(templates):
        words, run = t.words, 2 if t.phrase else RUN
        n += len(words)
        if len(words) < run:
            raise ValueError(f"template {t.label!r} needs {run} words")
        rows += [(tid, t.label, t.phrase, t.base, len(words), i, *[words[i + k] if k < run else None for k in range(RUN)])
                 for i in range(len(words) - run + 1)]
    if n > MOST_WORDS:
        raise ValueError(f"templates have {n} words, more than {MOST_WORDS}")
    return rows


def _templates(spark: SparkSession, templates: list[Template]) -> DataFrame:
    schema = "tid int, label string, phrase boolean, base boolean, length int, tpos int, t0 string, t1 string, t2 string, t3 string"
    return spark.createDataFrame(template_rows(templates), schema)


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, BETWEEN), lambda w: w != "")


def hits(docs: DataFrame, templates: list[Template], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document a row with a NULL tid, its key and number of words; and a row (uid, tid, ..., pos, tpos) per vote."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").alias("key"), words_of(F.col(f"`{text}`")).alias("w"))
    rows = rows.withColumn("n_words", F.size("w").cast("long"))
    after = [F.slice("w", k, F.greatest(F.size("w"), F.lit(1))) for k in range(2, RUN + 1)]
    zipped = F.arrays_zip(F.col("w").alias("w0"), *[a.alias(f"w{k + 1}") for k, a in enumerate(after)])
    none = F.struct(*[F.lit(None).cast("string").alias(f"w{k}") for k in range(RUN)])
    each = rows.select("uid", "key", "n_words", F.posexplode(F.concat(F.array(none), zipped)))
    each = each.select("uid", "key", "n_words", (F.col("pos") - 1).alias("pos"), "col.*")
    each = each.where("pos < 0 or w1 is not null").withColumn("h", F.xxhash64("w0", "w1"))
    table = F.broadcast(_templates(spark, templates).withColumn("th", F.xxhash64("t0", "t1")))
    same = F.expr("h = th and pos >= 0 and w0 = t0 and w1 = t1 and (t2 is null or (w2 = t2 and w3 = t3))")
    found = each.join(table, same, "left").where("pos < 0 or tid is not null")
    head = F.col("tid").isNull()
    return scratch(found.select("uid", F.when(head, F.col("key")).alias("key"), F.when(head, F.col("n_words")).alias("n_words"), "tid", "label",
                                "phrase", "base", "length", "pos", "tpos"), "hits")


def spans(votes: DataFrame) -> DataFrame:
    """(uid, tid, label, base, first, end, share, verified) of a document's diagonals, alone and merged; `first` to `end` are words of the text."""
    of = ["uid", "tid", "label", "phrase", "base", "length"]
    lines = votes.where("tid is not null").withColumn("diagonal", F.col("pos") - F.col("tpos")).groupBy(*of, "diagonal").agg(
        F.collect_set("tpos").alias("places"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    order = Window.partitionBy("uid", "tid").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True)).cast("int")
    merged = lines.withColumn("_new", new).withColumn("island", F.sum("_new").over(order)).groupBy(*of, "island").agg(
        F.flatten(F.collect_list("places")).alias("places"), F.min("first").alias("first"), F.max("last").alias("last"))
    both = lines.drop("diagonal").unionByName(merged.where("not phrase").drop("island"))
    run = F.when(F.col("phrase"), 2).otherwise(RUN)
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + run - 1)))))
    share, end = covered / F.col("length"), F.col("last") + run
    good = F.when(F.col("phrase"), share >= 1).otherwise((share >= SHARE) & (end - F.col("first") <= STRETCH * F.col("length")))
    return both.select("uid", "tid", "label", "base", "first", end.alias("end"), share.alias("share"), good.alias("verified"))


def scan(docs: DataFrame, phrases: list[Template] = PHRASES, notices: list[Template] = NOTICES, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score): one row per document. score is the largest share of a
    template found, 1 for a phrase and 0 where nothing votes."""
    votes = hits(docs, [*phrases, *notices], key, text)
    found, base = spans(votes), F.col("base") & F.col("verified")
    joined = lambda good: F.concat_ws(",", F.array_sort(F.collect_set(F.when(good, F.col("label")))))
    per = found.groupBy("uid").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.col("verified")).alias("labels"), F.max("share").alias("score"))
    head = votes.where("tid is null").select("uid", F.col("key").alias("doc_id"), "n_words")
    return head.join(per, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"), F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
