"""Licence notices in documents, by MinHash bands over overlapping windows and exact shingle containment.

A text is cut into words (runs of letters and digits, lower case) and shingles of ``K`` words.  Templates of t
shingles belong to the tier of the least power of two L >= t; a tier's windows hold 2 L shingles and start every L, so
a notice lies whole in some window.  A window's MinHashes, one a band, retrieve the templates that share one.  A
window that holds the share c of a template has a Jaccard similarity of at least c t / (2 L + (1 - c) t) > c / (5 - c)
with it, so ``bands_for`` bands of one MinHash each retrieve it with the probability ``RECALL`` at least.  What is
retrieved is verified: the exact share of the template's shingles in the window must reach ``CONTAINMENT``.

Two sets can only share a MinHash if they share a shingle, so windows without any template's shingle need no MinHash.
Only DataFrame functions are used.  There is no shuffle but the last, of matches: the templates are broadcast, and at
most ``MOST_TEMPLATES`` of them are taken.

Defined results: a very long text is cut into windows whole; of equally good templates of a licence the earliest
first word and the latest last word are given; a null text, or one of fewer than ``K`` words, has no match; rows without id and repeated rows are
rows of their own; other columns are not read; an empty table gives no rows.  Templates of fewer than ``K`` words are
refused.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import whole_text

K, CONTAINMENT, RECALL = 5, 0.8, 0.999999
MOST_TEMPLATES = 2000
WORD = r"[\p{L}\p{N}]+"

#: Published notices of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the License
        is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
        the License for the specific language governing permissions and limitations under the License."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so"""),
    ("BSD", "Licensed under the BSD 2-Clause License."),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met"""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation"""),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0
        International License."""),
    ("CC-BY-NC-ND-4.0", """This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0
        International License."""),
    ("BSD", """Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely"""),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0"""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means."""),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]


def bands_for(containment: float = CONTAINMENT, recall: float = RECALL) -> int:
    jaccard = containment / (5 - containment)  # of a template with just over L / 2 shingles
    return math.ceil(math.log(1 - recall) / math.log(1 - jaccard))


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def tier(words: int, k: int = K) -> int:
    return 1 << (words - k).bit_length() if words > k else 1


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _shingles(words: Column, k: int) -> Column:
    """Hashes of k consecutive words."""

    def body(w: Column) -> Column:
        last = F.size(w) - k
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                             lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))

    return F.coalesce(_let(F.transform(words, lambda x: F.xxhash64(x)), body), F.array().cast("array<bigint>"))


def _templates(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """template, license, size (its tier), shingles."""
    rows = [(n, name, template_words(text)) for n, (name, text) in enumerate(templates)]
    if len(rows) > MOST_TEMPLATES or any(len(w) < k for _, _, w in rows):
        raise ValueError(f"at most {MOST_TEMPLATES} templates of {k} words or more")
    df = spark.createDataFrame([(n, name, tier(len(w), k), w) for n, name, w in rows],
                               "template int, license string, size int, words array<string>")
    return df.select("template", "license", "size", F.array_distinct(_shingles(F.col("words"), k)).alias("template_set"))


def _minhashes(shingles: Column, bands: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b))).alias("low")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, k: int = K,
         containment: float = CONTAINMENT) -> DataFrame:
    """A row for each document and licence found: doc_id, license, containment (the best), first_word, last_word (of
    all its windows), n_windows."""
    spark = docs.sparkSession
    known = _templates(spark, TEMPLATES if templates is None else templates, k)
    bands = bands_for(containment)
    listed = known.select("size", F.explode("template_set").alias("h")).distinct().collect()  # bounded, as templates are
    values, sizes = sorted({r["h"] for r in listed}), sorted({r["size"] for r in listed})

    words = F.regexp_extract_all(F.lower(whole_text()), F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), _shingles(words, k).alias("s"))
    at = F.filter(F.transform("s", lambda h, i: F.when(h.isin(values), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("at", at).where(F.size("at") > 0)

    def windows(size: int) -> Column:
        """Windows of a tier that hold a template's shingle."""
        n = F.transform("at", lambda i: F.floor(i / size).cast("int"))
        return F.transform(F.filter(F.array_distinct(F.concat(n, F.transform(n, lambda j: j - 1))), lambda j: j >= 0),
                           lambda j: F.struct(F.lit(size).alias("size"), (j * size).alias("start")))

    w = rows.select("doc_id", "row_id", "s", F.explode(F.concat(*[windows(x) for x in sizes])).alias("w")).select(
        "doc_id", "row_id", "w.size", "w.start", F.slice("s", F.col("w.start") + 1, F.col("w.size") * 2).alias("window"))
    keyed = w.select("*", F.explode(_minhashes(F.array_distinct("window"), bands)).alias("key")).select(
        "doc_id", "row_id", "size", "start", "window", "key.band", "key.low")
    table = known.select("template", "license", "size", "template_set",
                         F.explode(_minhashes(F.col("template_set"), bands)).alias("key")).select(
        "template", "license", "size", "template_set", "key.band", "key.low")
    found = keyed.join(F.broadcast(table), ["size", "band", "low"])  # at most MOST_TEMPLATES * bands rows
    share = F.size(F.array_intersect("template_set", "window")) / F.size("template_set")
    hits = F.filter(F.transform("window", lambda h, i: F.when(F.array_contains("template_set", h), i)),
                    lambda i: i.isNotNull())
    verified = found.withColumn("share", share).where(F.col("share") >= containment).select(
        "doc_id", "row_id", "license", "share", "size", "start", (F.col("start") + F.array_min(hits)).alias("first"),
        (F.col("start") + F.array_max(hits) + (k - 1)).alias("last"))
    return (verified.groupBy("doc_id", "row_id", "license", "size", "start")
            .agg(F.max("share").alias("share"), F.min("first").alias("first"), F.max("last").alias("last"))
            .groupBy("doc_id", "row_id", "license").agg(
                F.max("share").alias("containment"), F.min("first").cast("long").alias("first_word"),
                F.max("last").cast("long").alias("last_word"), F.count("*").alias("n_windows")).drop("row_id"))
