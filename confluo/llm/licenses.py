"""License scans, with DataFrame functions only.

Text windows overlap so that any stretch of a template's length lies in one of them.  MinHash bands of a window and of
the templates meet in a broadcast join (the templates are a short fixed list; beyond ``MAX_TEMPLATES`` call it with
parts of the list and union the results, which are by template), with as many bands as make a miss of a
window that holds the least containment rarer than ``MISS``; exact shingle containment then decides.  A band of a window
can only meet a template's if the window holds a shingle of it, so texts without any are passed over first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
#: Chance at most that a window with the least containment shares no band with its template.
MISS = 1e-3
MAX_TEMPLATES = 1_000

#: Notices by license (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters after lower-casing A-Z."""
    cut = F.split(F.translate(text, _UPPER, _LOWER), r"[\x00-/:-`{-\x7f]+")
    return F.filter(cut, lambda w: w != "")


def _once(value: Column) -> Column:
    """A generator of the one value: filters on it can't be pushed down into copies of its expression."""
    return F.explode(F.array(value))


def _shingles(of: Column, at: Column, n: Column | int) -> Column:
    """Strings of the ``n`` shingles from word ``at`` (0 is the first) on."""
    return F.transform(F.sequence(at, at + n - 1), lambda i: F.concat_ws(" ", *[F.get(of, i.cast("int") + k) for k in range(SHINGLE_WORDS)]))


def _band(hashes: Column, k: int) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))


def plan_of(length: int, containment: float = MIN_CONTAINMENT) -> tuple[int, int, int]:
    """(stride, words of a window, bands) for templates of ``length`` words."""
    stride = max(1, length // 4)
    window = length + stride - 1
    mine, theirs = length - SHINGLE_WORDS + 1, window - SHINGLE_WORDS + 1
    shared = math.ceil(containment * mine - 1e-9)
    alike = shared / (mine + theirs - shared)
    return stride, window, 1 if alike >= 1 else math.ceil(math.log(MISS) / math.log(1 - alike))


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    containment: float = MIN_CONTAINMENT,
) -> DataFrame:
    """(id, license_id, containment, n_windows) of each document and template that a window of it holds.

    containment is the largest share of the template's distinct five-word shingles in one window, n_windows the windows
    that hold at least ``containment``.  Null and short texts hold none; rows that share an id, null among them, are
    reported together; an empty table gives an empty table.  Only windows that share a shingle with some template are
    formed, each with its own words, so work grows with the length of a text and not with its square.
    """
    spark, templates = docs.sparkSession, TEMPLATES if templates is None else templates
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates, which are broadcast")
    known = spark.createDataFrame(sorted(templates.items()) or [("", "")], "license_id string, body string")
    known = known.withColumn("words", words(F.col("body"))).withColumn("length", F.size("words"))
    listed = [(r["license_id"], list(r["words"])) for r in known.select("license_id", "words").collect() if r["words"]]
    if any(len(w) < SHINGLE_WORDS for _, w in listed):
        raise ValueError(f"templates need {SHINGLE_WORDS} words or more")
    lengths = sorted({len(w) for _, w in listed})
    n = SHINGLE_WORDS
    hashed = F.transform(
        F.sequence(F.lit(0), F.size("words") - n), lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(n)])
    )
    sides = {
        "docs": docs.select(F.col(f"`{id_col}`").alias("id"), _once(words(F.col(f"`{text_col}`").cast("string"))).alias("words")),
        "known": known.filter(F.size("words") >= n).select("license_id", "words", "length"),
    }
    hashes = {k: v.filter(F.size("words") >= n).select("*", _once(hashed).alias("hashes")) for k, v in sides.items()}
    of_known = hashes["known"].select("license_id", "hashes").collect()
    some = F.array(*[F.lit(h) for h in sorted({h for r in of_known for h in r["hashes"]})]).cast("array<bigint>")
    hit = hashes["docs"].filter(F.arrays_overlap("hashes", some))

    def windows(length: int) -> Column:
        stride, window, bands = plan_of(length, containment)
        starts = F.sequence(F.lit(0), F.greatest(F.size("words") - length, F.lit(0)), F.lit(stride))

        def inside(start: Column) -> Column:
            return F.slice(F.col("hashes"), start + 1, F.lit(window - n + 1))

        def at(start: Column) -> Column:
            return F.struct(
                F.lit(length).alias("length"),
                start.alias("start"),
                F.slice(F.col("words"), start + 1, F.lit(window)).alias("words"),
                F.array(*[_band(inside(start), k) for k in range(bands)]).alias("bands"),
            )

        return F.transform(F.filter(starts, lambda start: F.arrays_overlap(inside(start), some)), at)

    most = max((plan_of(x, containment)[2] for x in lengths), default=1)
    theirs = (
        hashes["known"].select("license_id", "length", F.posexplode(F.array(*[_band(F.col("hashes"), k) for k in range(most)])).alias("k", "band"))
    )
    none = F.array().cast("array<struct<length:int,start:int,words:array<string>,bands:array<bigint>>>")
    placed = hit.select("id", F.explode(F.concat(*[windows(x) for x in lengths]) if lengths else none).alias("w"))
    banded = placed.select("id", "w.words", "w.length", "w.start", F.posexplode("w.bands").alias("k", "band"))
    met = banded.join(F.broadcast(theirs), ["length", "k", "band"])
    whole = known.filter(F.size("words") >= n).select(
        "license_id", F.array_distinct(_shingles(F.col("words"), F.lit(0), F.size("words") - n + 1)).alias("wanted")
    )
    verified = (
        met.select("id", "license_id", "start", F.array_distinct(_shingles(F.col("words"), F.lit(0), F.size("words") - n + 1)).alias("inside"))
        .join(F.broadcast(whole), "license_id")
        .withColumn("containment", F.size(F.array_intersect("wanted", "inside")) / F.size("wanted"))
        .filter(F.col("containment") >= containment)
    )
    return verified.groupBy(F.col("id").alias(id_col), "license_id").agg(
        F.max("containment").alias("containment"), F.count_distinct("start").alias("n_windows")
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
