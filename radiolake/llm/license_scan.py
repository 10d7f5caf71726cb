"""Licence notices in documents: MinHash bands over overlapping windows, then exact containment.

Shingles of a text that occur in no template cannot make it contain one, so one pass over the texts
keeps only word pairs that some template has, by a bitmap of fixed size, and shingles are built from
pairs in a row. What is left of a text is cut into overlapping windows, each template length class
with its own width, such that every notice lies whole in some window. A window and a template share a
band of one MinHash value with probability equal to their similarity, so a window that holds
CONTAINMENT of a template, and as much again of others, misses all BANDS with 0.6 ** 32 = 8e-8.
Candidates are verified: the shingles of the template that occur in the window, over all it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from radiolake.llm.bitmap import bitmap_of
from radiolake.llm.decontamination import pair_tokens, token_hits, words_of
from radiolake.session import stage

SHINGLE = 5
PERCENT = 75
BANDS = 32
#: Half the width of a window, in words, per class of template length.
STRIDES = (8, 32, 128)

#: Notices in public use.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("no-warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
)


def templates(spark: SparkSession) -> DataFrame:
    """license, text"""
    return spark.createDataFrame(list(TEMPLATES), "license string, text string")


def _template_shingles(given: DataFrame) -> DataFrame:
    """license, stride, width (pairs in a shingle), n (shingles), shingle: one row per shingle.

    A template shorter than a shingle is one shingle; one of fewer than two words is left out.
    """
    words = given.select("license", words_of().alias("w")).filter(F.size("w") >= 2)
    pairs = words.select("license", pair_tokens(F.col("w")).alias("pairs"), F.size("w").alias("words"))
    width = F.least(F.lit(SHINGLE - 1), F.size("pairs"))
    stride = F.lit(None).cast("int")
    for s in reversed(STRIDES):
        stride = F.when(F.col("words") <= s, F.lit(s)).otherwise(stride)
    shingles = F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.size("pairs") - width + 1),
            lambda i: F.xxhash64(F.slice("pairs", i, width)),
        )
    )
    # Templates beyond the longest class have windows of twice their own length.
    return pairs.select(
        "license",
        F.coalesce(stride, F.col("words")).alias("stride"),
        width.alias("width"),
        F.size(shingles).alias("n"),
        F.explode(shingles).alias("shingle"),
    )


def _minima(value) -> list:
    return [F.min(F.xxhash64(value, F.lit(b))).alias(f"m{b}") for b in range(BANDS)]


def _bands(signed: DataFrame, *keys: str) -> DataFrame:
    band = F.posexplode(F.array(*[f"m{b}" for b in range(BANDS)])).alias("band", "value")
    return signed.select(*keys, band)


def license_matches(documents: DataFrame, given: DataFrame) -> DataFrame:
    """row, license, window, containment percent: the verified windows; and every document, as
    (row, doc_id, text_hash). Returned as (documents, matches)."""
    wanted = stage(_template_shingles(given), "template_shingles")
    pairs = given.select(F.explode(pair_tokens(words_of())).alias("token"))
    every = stage(token_hits(documents, bitmap_of(pairs), single=False), "license_hits")
    rows = every.filter("p = -1").select("row", "doc_id", "text_hash")
    in_text = Window.partitionBy("row").orderBy("p")
    chained = every.filter("p >= 0").select(
        "row",
        "p",
        "t",
        *[
            F.when(F.lead("p", k).over(in_text) == F.col("p") + k, F.lead("t", k).over(in_text)).alias(f"t{k}")
            for k in range(1, SHINGLE - 1)
        ],
    )
    ahead = [F.col("t"), *[F.col(f"t{k}") for k in range(1, SHINGLE - 1)]]
    whole = F.lit(True)
    sizes = []
    for k in range(1, SHINGLE):
        whole = whole & ahead[k - 1].isNotNull()
        sizes.append(F.when(whole, F.xxhash64(F.array(*ahead[:k]))))
    # The position in the array is the width less one; a shingle hash is of pairs of one width.
    shingles = chained.select("row", "p", F.explode(F.array_compact(F.array(*sizes))).alias("shingle"))
    universe = wanted.select("shingle", "stride").distinct()
    kept = shingles.join(universe, "shingle")
    at = F.floor(F.col("p") / F.col("stride"))
    windows = stage(
        kept.select("row", "stride", "shingle", F.explode(F.array(at, at - 1)).alias("window")).distinct(),
        "license_windows",
    )

    signed = windows.groupBy("row", "stride", "window").agg(*_minima(F.col("shingle")))
    known = wanted.groupBy("license", "stride").agg(*_minima(F.col("shingle")))
    candidates = (
        _bands(signed, "row", "stride", "window")
        .join(_bands(known, "license", "stride"), ["stride", "band", "value"])
        .select("row", "stride", "window", "license")
        .distinct()
    )
    found = (
        candidates.join(windows, ["row", "stride", "window"])
        .join(wanted.select("license", "shingle", "n"), ["license", "shingle"])
        .groupBy("row", "window", "license", "n")
        .agg(F.count("*").alias("there"))
        .filter(100 * F.col("there") >= PERCENT * F.col("n"))
    )
    return rows, found.select("row", "license", "window", F.expr("100 * there div n").alias("percent"))


def license_scan(documents: DataFrame, given: DataFrame) -> DataFrame:
    """doc_id, n_licenses, licenses (sorted, comma-joined): one row for each row.

    NULL and empty texts have none. Repeated rows are scanned each. No documents give no rows, no
    templates no licences.
    """
    rows, found = license_matches(documents, given)
    names = (
        found.select("row", "license")
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("license")).alias("names"))  # as many as templates at most
    )
    return rows.join(names, "row", "left").select(
        "doc_id",
        F.when(F.col("names").isNull(), F.lit(0)).otherwise(F.size("names")).cast("long").alias("n_licenses"),
        F.coalesce(F.concat_ws(",", "names"), F.lit("")).alias("licenses"),
    )
