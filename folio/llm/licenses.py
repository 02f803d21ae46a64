"""License scans, with DataFrame operations only.

Lines are compared with license notices by the cosine of sparse TF-IDF vectors. A term's weight is 1 + log(count),
times log((documents + 1) / (documents with the term + 1)) + 1, over the whole table; a term of no notice counts as
in no document. A line can only reach the least cosine if the notices' terms hold that share of its length, which
drops nearly all lines before anything is joined. The best line gives a file its own license. A file that is mostly
notice is a license file and speaks for its directory; files without a license of their own inherit from the nearest
ancestor directory that has one, by joins on paths.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.scratch import Scratch

#: Notices by which the licenses are commonly declared.
NOTICES = {
    "MIT": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Released under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0 Universal.",),
}
LEAST_COSINE = 0.7
#: A file is a license file from so many percent of its terms in notice lines, or by its name.
FILE_PERCENT = 50
FILE_NAMES = "(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
_SPLIT = "[^a-z0-9]+"


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), _SPLIT), "")


def _python_terms(text: str) -> list[str]:
    return [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split() if t]


def document_frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Rows, and rows that have each term of the vocabulary, which bounds what reaches the driver."""
    known = F.array(*map(F.lit, vocabulary))
    found = files.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(known, _terms(F.coalesce("text", F.lit("")))))).alias("t"))
    df = {r.t: r["count"] for r in found.groupBy("t").count().collect()}
    return df.pop("", 0), df


def notice_lines(files: DataFrame, notices: dict[str, tuple[str, ...]] = NOTICES, least: float = LEAST_COSINE) -> DataFrame:
    """(path, pos, terms, license, cosine) of the lines that come near a notice, the best notice of each."""
    templates = [(name, _python_terms(t)) for name, ts in sorted(notices.items()) for t in ts]
    vocabulary = sorted({t for _, ts in templates for t in ts})
    n, df = document_frequencies(files, vocabulary)
    idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in vocabulary}
    unseen = math.log(n + 1) + 1
    weights = []
    for number, (name, ts) in enumerate(templates):
        w = {t: (1 + math.log(ts.count(t))) * idf[t] for t in ts}
        size = math.sqrt(sum(x * x for x in w.values()))
        weights += [(number, name, t, x / size) for t, x in sorted(w.items())]
    known, weight_of = F.array(*map(F.lit, vocabulary)), F.create_map(*map(F.lit, chain.from_iterable(sorted(idf.items()))))
    lines = files.select("path", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("path", "pos", _terms(F.col("line")).alias("ts"))
    hits = lines.select("path", "pos", "ts", F.array_intersect("ts", known).alias("hits"), F.size(F.array_except("ts", known)).alias("others")).where(F.size("hits") > 0)
    # Terms outside the vocabulary count once each.
    weighed = hits.select("path", "pos", F.size("ts").alias("terms"), F.transform("hits", lambda t: F.struct(t.alias("t"), ((1 + F.log(F.size(F.filter("ts", lambda x: x == t)))) * weight_of[t]).alias("w"))).alias("v"), "others")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x["w"] * x["w"])
    sized = weighed.withColumn("inside", square).withColumn("square", F.col("inside") + F.col("others") * (unseen * unseen)).where(F.col("inside") >= least * least * F.col("square"))
    table = files.sparkSession.createDataFrame(weights, "number int, license string, t string, share double")
    each = sized.select("path", "pos", "terms", "square", F.explode("v").alias("x")).select("path", "pos", "terms", "square", "x.t", "x.w")
    # The notices are a fixed table of some hundred rows.
    near = each.join(F.broadcast(table), "t").groupBy("path", "pos", "terms", "square", "number", "license").agg((F.sum(F.col("w") * F.col("share")) / F.sqrt("square")).alias("cosine")).where(F.col("cosine") >= least)
    best = near.groupBy("path", "pos", "terms").agg(F.max(F.struct(F.round("cosine", 6).alias("cosine"), F.col("license").alias("name"))).alias("b"))
    return best.select("path", "pos", "terms", F.col("b.name").alias("license"), F.col("b.cosine").alias("cosine"))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def license_scan(files: DataFrame, notices: dict[str, tuple[str, ...]] = NOTICES) -> DataFrame:
    """(path, own_license, cosine, license_file, license, inherited_from) of each path of files (path, text).

    own_license is that of the file's best line, ties to the later name; license is it or what the nearest ancestor
    directory gives, the best license file of a directory by cosine, then path. Null text has no lines; rows without a
    path have no ancestors and inherit nothing; rows of one path count as one file. An empty table gives none; other
    columns are not read.
    """
    scratch = Scratch(files.sparkSession, "licenses")
    files = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    lines = scratch.save(notice_lines(files, notices))
    own = lines.groupBy("path").agg(F.max(F.struct("cosine", "license")).alias("b"), F.sum("terms").alias("notice_terms"))
    terms = scratch.save(files.select("path", F.size(_terms(F.coalesce("text", F.lit("")))).alias("n")).groupBy("path").agg(F.sum("n").alias("all_terms")))
    joined = terms.join(own, terms["path"].eqNullSafe(own["path"]), "left").select(terms["path"], "all_terms", "notice_terms", F.col("b.license").alias("own_license"), F.col("b.cosine").alias("cosine"))
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(FILE_NAMES)
    is_file = F.col("own_license").isNotNull() & (named | (100 * F.col("notice_terms") >= FILE_PERCENT * F.col("all_terms")))
    judged = scratch.save(joined.select("path", "own_license", "cosine", F.coalesce(is_file, F.lit(False)).alias("license_file"), _parent(F.col("path")).alias("dir")))
    given = scratch.save(judged.where("license_file and path is not null").groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "own_license")).alias("b")).select(F.col("dir").alias("from_dir"), F.col("b.own_license").alias("dir_license")))
    # Each directory once, with all its ancestors.
    parts = F.split("dir", "/")
    ancestors = judged.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")))).alias("from_dir")).distinct()
    nearest = scratch.save(ancestors.join(given, "from_dir").groupBy("dir").agg(F.max(F.struct(F.length("from_dir").alias("n"), "from_dir", "dir_license")).alias("b")).select("dir", F.col("b.from_dir").alias("from_dir"), F.col("b.dir_license").alias("dir_license")))
    out = judged.join(nearest, "dir", "left")
    return out.select("path", "own_license", "cosine", "license_file", F.coalesce("own_license", "dir_license").alias("license"), F.when(F.col("own_license").isNull(), F.col("from_dir")).alias("inherited_from"))


def document_files(docs: DataFrame) -> DataFrame:
    """(path, text) of documents: source/lang/doc_id.txt; what is null is left out of the path."""
    return docs.select(F.concat(F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("doc_id").cast("string")), F.lit(".txt")).alias("path"), F.col("text").cast("string").alias("text"))
