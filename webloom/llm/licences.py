"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

DataFrame functions only. Sentences and lines that speak of rights (``CUE``) are compared with the
templates; a file's own licence is that of its best sentence if the cosine reaches ``LEAST``. A template
only counts where its decisive terms stand too (``NAMES`` and version numbers) and both have the same ``MARKS``,
such as Lesser or ShareAlike; where another licence comes within ``MARGIN``, the sentence tells none. A
sentence that only reserves all rights counts if the file has no other. Term
weights are (1 + ln tf) * idf, with document frequencies counted over all such sentences of the
corpus; only terms of the templates are counted, a fixed number, and all others have the idf of a
term that was never seen. Files without a licence of their own take that of the nearest directory
above them, their own included, that has a licence file.

Defined cases: null texts are empty ones and have no licence of their own; a null path stands in
the root; with several licence files in a directory the best cosine counts, then the name; equal
cosines go to the licence first by name; repeated rows are judged each; an empty table gives an
empty result; other columns are kept if asked for, and one named like a result gets ``given_`` before its name.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common

LEAST = 0.55
MARGIN = 0.02
CUE = (
    r"(?i)licen[sc]|copyright|rights reserved|permission is hereby|redistribut|spdx"
    r"|creative commons|public domain|warranty|hereby granted|\bGPL|\bCC[ -]BY"
)
SENTENCE = r"\n|(?<=[.!?;])\s+"
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([._-][^/]*)?$"

# Usual notices of each licence; any of them counts.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("ISC", "Licensed under the ISC license"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    # both have this sentence, so it tells neither
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("LGPL-2.0", "licensed under the GNU Library General Public License, version 2"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-1.1", "subject to the Mozilla Public License Version 1.1"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("public-domain", "This work is in the public domain"),
    ("public-domain", "released into the public domain"),
    ("proprietary", "All rights reserved"),
]
_GNU = [
    ("GPL-2.0", "GNU General Public License, version 2", "GPLv2"),
    ("GPL-3.0", "GNU General Public License, version 3", "GPLv3"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1", "LGPLv2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3", "LGPLv3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3", "AGPLv3"),
]
NOTICES += [n for k, name, _ in _GNU for n in ((k, f"This work is licensed under the {name}"), (k, f"the {name}"))]
NOTICES += [(k, f"Licensed under the {short}") for k, _, short in _GNU]
_SHARED = {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _more in ([], ["NC"], ["SA"], ["ND"], ["NC", "SA"], ["NC", "ND"]):
    _short, _long = "-".join(["BY", *_more]), "-".join(["Attribution", *(_SHARED[m] for m in _more)])
    NOTICES += [
        (f"CC-{_short}-4.0", f"Licensed under CC {_short} 4.0"),
        (f"CC-{_short}-4.0", f"licensed under a Creative Commons {_long} 4.0 International License"),
    ]
PROPRIETARY = "proprietary"
_CODES = sorted({k for k, _ in NOTICES} - {PROPRIETARY, "public-domain"})
TEMPLATES = NOTICES + [(k, f"SPDX-License-Identifier: {k}") for k in _CODES]

# A template's terms of this list, and its numbers but zero, must stand in a sentence.
NAMES = {
    "apache", "mit", "isc", "bsd", "gnu", "gpl", "lgpl", "agpl", "gplv2", "gplv3", "lgplv2", "lgplv3", "agplv3", "library", "mozilla",
    "mpl", "eclipse", "epl", "boost", "bsl", "cc", "creative", "cc0", "unlicense", "unencumbered", "domain", "reserved",
}
# What a sentence and its template must have in common or both lack, with the words for it.
MARKS = {
    "lesser": ["lesser", "lgpl", "lgplv2", "lgplv3"],
    "affero": ["affero", "agpl", "agplv3"],
    "nc": ["nc", "noncommercial"],
    "sa": ["sa", "sharealike"],
    "nd": ["nd", "noderivatives", "noderivs"],
}


def tokens(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def decisive(template: str) -> list[str]:
    return sorted({t for t in tokens(template) if t in NAMES or (t.isdigit() and int(t))})


def marks(terms: set[str]) -> list[str]:
    return [m for m, words in MARKS.items() if terms & set(words)]


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def _fixed(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A small table that is part of the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")))


def sentences(text: Column) -> Column:
    """All sentences of a text that speak of rights."""
    found = F.filter(F.split(text, SENTENCE), lambda s: s.rlike(CUE))
    return F.when(text.rlike(CUE), found).otherwise(F.array().cast("array<string>"))


def _weighted(rows: DataFrame) -> DataFrame:
    """(_row, b): the best template of every sentence of ``rows`` that tells a licence."""
    spark = rows.sparkSession
    each = rows.select("_row", F.posexplode("_sentences").alias("_place", "_sentence"))
    counted = (
        each.select("_row", "_place", F.explode(_terms(F.col("_sentence"))).alias("term"))
        .groupBy("_row", "_place", "term")
        .agg(F.count("*").alias("tf"))
    )
    known = sorted({t for _, text in TEMPLATES for t in tokens(text)}.union(*MARKS.values()))
    n = each.count()
    # one row per term of the templates at most
    seen = {
        r.term: r["count"] for r in counted.where(F.col("term").isin(known)).groupBy("term").count().collect()
    }
    idf = {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in known}
    unseen = math.log(1 + n) + 1
    vectors = []
    for _, text in TEMPLATES:
        own = {t: (1 + math.log(f)) * idf[t] for t, f in Counter(tokens(text)).items()}
        norm = math.sqrt(sum(w * w for w in own.values()))
        vectors.append({t: w / norm for t, w in own.items()})
    table = [{"term": t, "idf": idf[t], "of": [v.get(t, 0.0) for v in vectors]} for t in known]
    facts = [
        {"licence": k, "needs": decisive(text), "marks": marks(set(tokens(text)))} for k, text in TEMPLATES
    ]
    weight = (1 + F.log("tf")) * F.coalesce("idf", F.lit(unseen))
    # proven bound: the terms of the templates
    joined = counted.join(
        F.broadcast(_fixed(spark, table, "term:string,idf:double,of:array<double>")), "term", "left"
    ).withColumn("w", weight)
    # a sentence gathers at most the terms of the templates
    own = F.struct("term", F.transform("of", lambda x: x * F.col("w")).alias("of"))
    sums = joined.groupBy("_row", "_place").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        F.collect_list(F.when(F.col("idf").isNotNull(), own)).alias("hits"),
    )
    zero = F.array_repeat(F.lit(0.0), len(TEMPLATES))
    products = F.aggregate("hits", zero, lambda done, h: F.zip_with(done, h["of"], lambda a, b: a + b))
    there = sums.select(
        "_row", "norm", products.alias("products"), F.transform("hits", lambda h: h["term"]).alias("terms")
    )
    marked = F.array_compact(
        F.array(*(F.when(F.arrays_overlap("terms", F.array(*map(F.lit, w))), F.lit(m)) for m, w in MARKS.items()))
    )
    there = there.withColumn("marks", marked)
    fact = F.from_json(
        F.lit(json.dumps(facts)), "array<struct<licence:string,needs:array<string>,marks:array<string>>>"
    )
    scores = F.zip_with(
        "products",
        fact,
        lambda x, f: F.when(
            F.forall(f["needs"], lambda t: F.array_contains("terms", t)) & (f["marks"] == F.col("marks")),
            F.struct((-F.round(x / F.col("norm"), 9)).alias("s"), f["licence"].alias("licence")),
        ),
    )
    ranked = there.select("_row", F.array_sort(F.array_compact(scores)).alias("ranked"))
    first = F.get("ranked", F.lit(0))
    rival = F.get(F.filter("ranked", lambda r: r["licence"] != F.get("ranked", F.lit(0))["licence"]), F.lit(0))
    # first what is a licence, then the cosine, then the name
    best = F.struct(
        (first["licence"] == PROPRIETARY).alias("reserved"), first["s"].alias("s"), first["licence"].alias("licence")
    )
    clear = F.coalesce(rival["s"] - first["s"] >= MARGIN, F.lit(True))
    return ranked.where((first["s"] <= -LEAST) & clear).select("_row", best.alias("b"))


def inventory(files: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of files (path, text) with licence, origin, score and inherited_from."""
    parts = F.split(F.coalesce(F.col("path").cast("string"), F.lit("")), "/")
    folder = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = common.stored(
        files.select(
            F.struct(*(F.col(f"`{c}`").alias(c) for c in keep) or [F.lit(1)]).alias("_kept"),
            F.monotonically_increasing_id().alias("_row"),
            folder.alias("_dir"),
            F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)).alias("_licence_file"),
            sentences(text).alias("_sentences"),
        ),
        "licence-sentences",
    )
    own = common.stored(_weighted(rows.where(F.size("_sentences") > 0)).groupBy("_row").agg(F.min("b").alias("b")), "licences")
    at = (
        rows.where("_licence_file")
        .join(own, "_row")
        .groupBy(F.col("_dir").alias("_from"))
        .agg(F.min("b").alias("m"))
        .select("_from", F.col("m.licence").alias("_inherited"))
    )
    own = own.select("_row", (-F.col("b.s")).alias("_score"), F.col("b.licence").alias("_own"))
    # every directory with all that stand above it, and itself; the root is the empty path
    steps = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    nearest = common.stored(
        rows.select("_dir")
        .distinct()
        .select("_dir", F.posexplode(above).alias("_depth", "_from"))
        .join(at, "_from")
        .groupBy("_dir")
        .agg(F.max(F.struct("_depth", "_from", "_inherited")).alias("n"))
        .select("_dir", F.col("n._from").alias("_from"), F.col("n._inherited").alias("_inherited")),
        "licence-folders",
    )
    out = rows.drop("_sentences").join(own, "_row", "left").join(nearest, "_dir", "left")
    origin = (
        F.when(F.col("_own").isNotNull() & F.col("_licence_file"), "file")
        .when(F.col("_own").isNotNull(), "header")
        .when(F.col("_inherited").isNotNull(), "inherited")
    )
    results = {"licence", "origin", "score", "inherited_from"}
    return out.select(
        *(F.col(f"_kept.`{c}`").alias(f"given_{c}" if c in results else c) for c in keep),
        F.coalesce("_own", "_inherited").alias("licence"),
        origin.alias("origin"),
        F.col("_score").alias("score"),
        F.when(F.col("_own").isNull(), F.col("_from")).alias("inherited_from"),
    )


def as_files(docs: DataFrame, short: int = 200) -> DataFrame:
    """``docs`` with a path: source, then thousand and fifty of the id as directories.

    Documents are no files, so a document that is short and speaks of rights stands for a licence
    file, in the directory of its thousand.
    """
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    thousand, fifty = (
        F.coalesce(F.floor(F.col("doc_id") / n).cast("string"), F.lit("none")) for n in (1000, 50)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    licence = (F.length(text) <= short) & text.rlike(CUE)
    name = F.when(licence, F.concat(F.lit("LICENSE."), number)).otherwise(
        F.concat_ws("/", fifty, F.concat(number, F.lit(".txt")))
    )
    return docs.withColumn(
        "path", F.concat_ws("/", F.coalesce("source", F.lit("none")), thousand, name)
    )


def op5_tfidf_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or its directory's."""
    docs = as_files(common.table(spark, sf_dir, "documents"))
    return inventory(docs, "doc_id", "path")
