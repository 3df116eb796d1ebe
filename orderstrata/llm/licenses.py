"""Licence texts inside documents, found with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstrata.llm.common import stored
from orderstrata.llm.decontaminate import plain_words

BANDS = 48
BROADCAST_BYTES = 4 << 20

# Short notices, and sentences that stand in the licences themselves.
TEMPLATES = (
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("mit-notice", "Released under the MIT License."),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "bsd-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "mpl-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "isc-grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
)


def _shingles(rows: DataFrame, width: int) -> DataFrame:
    """A row for each run of words: the columns of ``rows``, its place ``at``, its hash."""
    places = F.sequence(F.lit(0), F.size("words") - width)
    spread = rows.where(F.size("words") >= width).withColumn("at", F.explode(places))
    parts = [F.col("words")[F.col("at") + k] for k in range(width)]
    return spread.withColumn("hash", F.xxhash64(*parts))


def _run(width: int) -> Column:
    return F.concat_ws(" ", *[F.col("words")[F.col("at") + k] for k in range(width)])


def _template_shingles(
    spark: SparkSession, templates: tuple[tuple[str, str], ...], width: int
) -> DataFrame:
    """``license_id``, its number of distinct shingles and size class, and each of them."""
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("t")) for k, t in templates])
    rows = spark.range(1).select(F.explode(listed).alias("x"))
    rows = rows.select(
        F.col("x.k").alias("license_id"), F.split(plain_words(F.col("x.t")), " ").alias("words")
    )
    each = _shingles(rows, width).select("license_id", "hash", _run(width).alias("shingle"))
    each = each.distinct()
    sizes = each.groupBy("license_id").agg(F.count("*").alias("n"))
    most = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n").cast("double")))).cast("int")
    return each.join(sizes.withColumn("most", most), "license_id")


def _signature() -> list[Column]:
    return [F.min(F.xxhash64("hash", F.lit(b))).alias(f"h{b}") for b in range(BANDS)]


def _bands() -> Column:
    both = [F.struct(F.lit(b).alias("b"), F.col(f"h{b}").alias("h")) for b in range(BANDS)]
    return F.explode(F.array(*both)).alias("band")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    width: int = 5,
    share: float = 0.8,
) -> DataFrame:
    """Documents that hold at least ``share`` of the distinct shingles of a licence template.

    Columns: ``doc_id``, ``license_id``, ``template_shingles``, ``shared``,
    ``containment``, ``first_word`` (where the first shared shingle starts). Words are
    runs of letters and digits, lower-cased; a shingle is ``width`` words.

    Of a document only shingles that stand in some template go on. Templates are parted
    by size, a part for each power of two ``u``; a part's windows are ``2 u`` words long
    and start every ``u``, so that any copy lies whole in one. A window's signature has
    48 bands of one least hash each. A window with the share 0.8 of a template and
    nothing else meets it in some band but for a chance below 1e-33; one that is full
    of shingles of other templates (similarity 0.19) but for one below 1e-4. What was
    met is held against all of the document's shingles, word by word.

    NULL texts count as empty; texts shorter than a shingle match nothing; rows that
    share an id, or have none, are one document; repeated rows add nothing. Long texts are
    scanned whole, a row for each shingle, in the task that read them. Other columns
    play no part. An empty table gives an empty one. Templates need ``width`` words.
    They are a literal of the query, sent to all tasks up to four megabytes.
    """
    short = [k for k, t in templates if len(t.split()) < width]
    if short or not templates:
        raise ValueError(f"templates of at least {width} words are needed; too short: {short}")
    spark = docs.sparkSession
    small = sum(len(t) for _, t in templates) <= BROADCAST_BYTES
    near = F.broadcast if small else (lambda df: df)
    known = _template_shingles(spark, templates, width)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.split(plain_words(F.col(text_column)), " ").alias("words"),
    )
    distinct = known.select("hash", "shingle").distinct()
    runs, run = _shingles(rows, width), _run(width)
    if not small:  # both sides are shuffled: a run's text goes along, not the document's words
        runs, run = runs.select("doc_id", "at", "hash", run.alias("run")), F.col("run")
    hits = runs.join(near(distinct), "hash").where(run == F.col("shingle"))
    hits = stored(hits.select("doc_id", "at", "hash", "shingle"), "licenses")

    classes = known.select("hash", "most").distinct()
    first = F.floor(F.col("at") / F.col("most"))
    windows = hits.join(near(classes), "hash").withColumn(
        "window", F.explode(F.array(first, first - 1))
    )
    signed = windows.groupBy("doc_id", "most", "window").agg(*_signature())
    signed = signed.select("doc_id", "most", _bands())
    wanted = known.groupBy("license_id", "most").agg(*_signature())
    wanted = wanted.select("license_id", "most", _bands())
    met = signed.join(near(wanted), ["most", "band"]).select(
        F.col("doc_id").alias("met_id"), F.col("license_id").alias("met_license")
    )

    held = hits.groupBy("doc_id", "hash", "shingle").agg(F.min("at").alias("at"))
    shared = held.join(near(known), ["hash", "shingle"])
    counted = shared.groupBy("doc_id", "license_id").agg(
        F.max("n").alias("template_shingles"),
        F.count("*").alias("shared"),
        F.min("at").cast("long").alias("first_word"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("met_id")) & (
        F.col("license_id") == F.col("met_license")
    )
    verified = counted.join(met.distinct(), same, "left_semi")
    containment = (F.col("shared") / F.col("template_shingles")).alias("containment")
    return verified.where(F.col("shared") >= share * F.col("template_shingles") - 1e-9).select(
        "doc_id", "license_id", "template_shingles", "shared", containment, "first_word"
    )
