"""Licences of files: cosine to templates, then inheritance from directories.

Every line of every text, alone and with the one or two lines after it (notices
are wrapped), is a sparse TF-IDF vector over words; it is a header of the licence
whose template it is nearest to by cosine, if the cosine is at least
``threshold`` and the words that tell variants and versions apart (``VARIANTS``,
single digits) are the template's. A BSD text with a disclaimer but without the
clause on names is BSD-2-Clause. Whole licence files are known by their titles
and notices; their full texts are not compared. A file that is named like a licence file, or at least half
of whose words are in such lines, speaks for its directory. A file without a
licence of its own gets that of its nearest ancestor directory that has one:
distinct directories are expanded to their ancestors, joined to the licensed
directories, and the deepest match is joined back to the files.

Skew: texts are scored inside the scan; directories are made distinct before
they are expanded; a directory's licence is one row, so the join back to a
directory of a third of all files is a plain one that adaptive execution splits.

Defined results: null text has no header; a null path lies in no directory; of
several licence files in one directory the best score counts, then the smallest
licence name, then path; repeated rows get equal answers; an empty table gives
an empty result; no other column is read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import SEGMENT, Words, slices, utf8

THRESHOLD, WHOLE_FILE = 0.6, 0.5
#: lines that are read together
WRAPPED = 3
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"

GNU = [("GPL-2.0", "", "2", "June 1991"), ("GPL-3.0", "", "3", "29 June 2007"), ("LGPL-2.0", "Library", "2", "June 1991"),
       ("LGPL-2.1", "Lesser", "2.1", "February 1999"), ("LGPL-3.0", "Lesser", "3", "29 June 2007"), ("AGPL-3.0", "Affero", "3", "19 November 2007")]
GNU_FORMS = ["This work is licensed under the GNU {} General Public License, version {}.",
             "it under the terms of the GNU {} General Public License as published by the Free Software Foundation, either version {} of the License",
             "GNU {} General Public License Version {}, {}"]
#: words that tell variants apart; those of one group mean the same
VARIANTS = [["lesser"], ["library"], ["affero"], ["nc", "noncommercial"], ["sa", "sharealike"], ["nd", "noderivatives", "noderivs"]]
DIGITS = "12345"
BSD_DISCLAIMER, BSD_NAMES = rb"this\W+software\W+is\W+provided\W+by\W", rb"(neither\W+the\W+names?|may\W+not\W+be\W+used\W+to\W+endorse)\W"

# fixed values: notices as they stand in files, by SPDX identifier
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    *((name, form.format(kind, version, date)) for name, kind, version, date in GNU for form in GNU_FORMS),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
FOUND = "struct<licence:string,score:double,share:double>"


class Templates:
    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        w = Words([t.encode() for _, t in templates])
        owner = np.repeat(np.arange(len(templates)), np.diff(w.bounds))
        self.vocabulary, at = np.unique(w.hashes, return_inverse=True)
        tf = np.zeros((len(self.vocabulary), len(templates)))
        np.add.at(tf, (at, owner), 1.0)
        n = len(templates)
        self.idf = np.log((1 + n) / (1 + (tf > 0).sum(1))) + 1
        self.unknown = np.log(1 + n) + 1
        vectors = tf * self.idf[:, None]
        self.vectors = vectors / np.sqrt((vectors ** 2).sum(0))
        words = [(x, i) for i, group in enumerate(VARIANTS) for x in group] + [(d, len(VARIANTS) + i) for i, d in enumerate(DIGITS)]
        hashes = Words([x.encode() for x, _ in words]).hashes
        order = np.argsort(hashes)
        self.marks, self.bits = hashes[order], np.array([1 << i for _, i in words])[order]
        self.variants = (1 << len(VARIANTS)) - 1
        self.marked = self.marks_of(w.hashes, owner, n)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def marks_of(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """The distinguishing words of ``n`` texts as bits."""
        place = np.minimum(np.searchsorted(self.marks, hashes), len(self.marks) - 1)
        hit = self.marks[place] == hashes
        out = np.zeros(n, np.int64)
        np.bitwise_or.at(out, owner[hit], self.bits[place[hit]])
        return out

    def lines(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, best cosine and template of every one of ``texts``."""
        w = Words(texts)
        n = np.diff(w.bounds)
        best, which = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        owner = np.repeat(np.arange(len(texts)), n)
        at = np.flatnonzero(self.seen[(w.hashes >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.vocabulary, w.hashes[at]), len(self.vocabulary) - 1)
        hit = self.vocabulary[place] == w.hashes[at]
        at, place = at[hit], place[hit]
        known = np.bincount(owner[at], minlength=len(texts))
        some = np.flatnonzero((known >= 2) & (2 * known >= n))
        if len(some):
            row = np.full(len(texts), -1)
            row[some] = np.arange(len(some))
            mine = row[owner[at]]
            tf = np.zeros((len(some), len(self.vocabulary)))
            np.add.at(tf, (mine[mine >= 0], place[mine >= 0]), 1.0)
            x = tf * self.idf
            norm = np.sqrt((x ** 2).sum(1) + (n[some] - known[some]) * self.unknown ** 2)
            cos = x @ self.vectors / norm[:, None]
            inside = row[owner] >= 0
            mine_marks = self.marks_of(w.hashes[inside], row[owner[inside]], len(some))[:, None]
            differ = mine_marks ^ self.marked[None, :]
            versioned = self.marked > self.variants
            cos[(differ & np.where(versioned, -1, self.variants)[None, :]) != 0] = 0.0
            which[some], best[some] = cos.argmax(1), cos.max(1)
        return n, best, which


def header_column(text: Column, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> Column:
    """Struct of a text's best licence line and the share of its words in such lines."""
    given = templates or TEMPLATES

    @F.arrow_udf(FOUND)
    def header(text: pa.Array) -> pa.Array:
        known, out = Templates(given), []
        for b in slices([pa.RecordBatch.from_arrays([text], ["text"])], "text", 2 * SEGMENT):
            texts = utf8(b.column("text"))
            split = [t.split(b"\n") for t in texts]
            n, score, which = known.lines([b" ".join(s[i:i + k]) for s in split for k in range(1, WRAPPED + 1) for i in range(len(s) - k + 1)])
            at = 0
            for text_, s in zip(texts, split, strict=True):
                part = slice(at, at + sum(max(len(s) - k + 1, 0) for k in range(1, WRAPPED + 1)))
                at = part.stop
                i = part.start + int(score[part].argmax())
                if score[i] < threshold:
                    out.append({"licence": None, "score": float(score[i]), "share": 0.0})
                else:
                    inside = np.zeros(len(s), bool)
                    # lines together count only if they are nearer than any fewer of them
                    top, at_k = np.zeros(len(s) + 1), part.start
                    for k in range(1, min(WRAPPED, len(s)) + 1):
                        own, fewer = score[at_k:at_k + len(s) - k + 1], np.maximum(top[:-1], top[1:])
                        for j in np.flatnonzero((own >= threshold) & (own > fewer)):
                            inside[j:j + k] = True
                        top, at_k = np.maximum(own, fewer), at_k + len(own)
                    words = n[part.start:part.start + len(s)]
                    name = known.names[which[i]]
                    if name == "BSD-3-Clause" and re.search(BSD_DISCLAIMER, text_.lower()) and not re.search(BSD_NAMES, text_.lower()):
                        name = "BSD-2-Clause"
                    out.append({"licence": name, "score": float(score[i]), "share": float(words[inside].sum() / max(words.sum(), 1))})
        return pa.array(out, pa.struct([("licence", pa.string()), ("score", pa.float64()), ("share", pa.float64())]))

    return header(F.coalesce(text, F.lit("")))


def _directory(path: Column) -> Column:
    """Everything before the last slash; the empty string for a file at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def licences(files: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (file_id, path, text) to ``file_id, path, licence, score, origin, from_directory``;
    origin is header, directory or none."""
    from tillpanel.llm.common import written

    scanned = files.select("file_id", "path", header_column(F.col("text"), templates, threshold).alias("h"))
    scanned = written(scanned.select("file_id", "path", _directory(F.col("path")).alias("directory"), "h.licence", "h.score", "h.share"), "licence-scan")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    speaks = scanned.filter(F.col("licence").isNotNull() & F.col("path").isNotNull() & (name.rlike(FILE_NAMES) | (F.col("share") >= WHOLE_FILE)))
    nth = F.row_number().over(Window.partitionBy("directory").orderBy(F.desc("score"), "licence", "path"))
    granted = speaks.withColumn("nth", nth).filter("nth = 1").select(F.col("directory").alias("above"), F.col("licence").alias("inherited"))
    parts = F.split("directory", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    wanted = scanned.filter(F.col("licence").isNull() & F.col("path").isNotNull()).select("directory").distinct()
    above = wanted.select("directory", F.posexplode(F.array_distinct(ancestors)).alias("depth", "above"))
    nearest = F.max(F.struct("depth", "above", "inherited"))
    found = above.join(granted, "above").groupBy("directory").agg(nearest.alias("m")).select(
        F.col("directory").alias("d_"), F.col("m.above").alias("from_directory"), F.col("m.inherited").alias("inherited"))
    joined = scanned.join(found, F.col("licence").isNull() & (F.col("directory") == F.col("d_")), "left")
    origin = F.when(F.col("licence").isNotNull(), "header").when(F.col("inherited").isNotNull(), "directory").otherwise("none")
    return joined.select("file_id", "path", F.coalesce("licence", "inherited").alias("licence"), "score", origin.alias("origin"), "from_directory")


def documents_as_files(docs: DataFrame) -> DataFrame:
    """Documents as files ``source/lang/doc_id.txt``."""
    part = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), "/", "_"), F.lit("unknown")) for c in ("source", "lang", "doc_id")]
    return docs.select(F.col("doc_id").alias("file_id"), F.concat(part[0], F.lit("/"), part[1], F.lit("/"), part[2], F.lit(".txt")).alias("path"), "text")
