"""Licence scans: sparse TF-IDF cosine of headers to notices and of files to whole licence texts, then the nearest ancestor directory's."""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch

# Licence names, and the words by which headers declare them or long licence texts begin.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and "
     "conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of "
     "the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but "
     "changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of "
     "the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license "
     "document, but changing it is not allowed. This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license "
     "document, but changing it is not allowed. Preamble The GNU Affero General Public License is a free, copyleft license for software and other kinds of works"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the "
     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
     "in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the "
     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
     "in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
     "all copies."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
     "display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
     "License, or (at your option) any later version."),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to "
     "anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]

WORD_BREAK = "[^a-z0-9]+"
PART_BREAK = "\n|[.!?:;][ \t\r\n]"  # lines, and sentences within them
NOTICE = r"(?m)^[^a-z0-9\n]*copyright[ \t]+(?:\(c\)|©|[0-9]{4})[^\n]*$"  # a line that only says whose work it is
RUN = 256  # parts that are looked at together
FOLDER = Path(__file__).parent / "licence_texts"


def whole_texts(folder: Path = FOLDER) -> list[tuple[str, str]]:
    """(licence, text) of the whole licence texts that a folder holds, by name; read by the driver."""
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt"))]


def terms(text: Column) -> Column:
    """Terms of a lower-cased text: runs of a-z and digits, so comment marks and punctuation drop out."""
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def _python_terms(text: str) -> list[str]:
    return [w for w in re.split(WORD_BREAK, text.lower()) if w]


def _in(vocabulary: list[str]) -> Column:
    return F.array(*map(F.lit, vocabulary))


def anchor_terms(templates: list[tuple[str, str]], idf: dict[str, float], threshold: float, weigh=float) -> list[list[str]]:
    """For each template terms without which no text reaches the threshold.

    A template's rarest terms are taken until the rest holds less than ``threshold`` of its norm; by Cauchy's
    inequality a text that shares only that rest stays below the threshold, so filtering by anchors loses nothing.
    """
    found = []
    for _, text in templates:
        words = _python_terms(text)
        square = {w: (weigh(words.count(w)) * idf[w]) ** 2 for w in set(words)}
        rest = total = sum(square.values())
        anchors = []
        for w in sorted(square, key=lambda w: (-square[w], w)):
            if rest < threshold**2 * total * 0.999:
                break
            anchors.append(w)
            rest -= square[w]
        found.append(anchors)
    return found


def inverse_frequencies(texts: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """idf of the templates' terms from their document frequency over all texts, and of a term that no text has."""
    known = F.broadcast(texts.sparkSession.createDataFrame([(w,) for w in vocabulary], "w string"))  # the templates' terms
    present = texts.select(F.explode(F.array_distinct(F.split(F.lower("text"), WORD_BREAK))).alias("w")).join(known, "w")
    df = {r["w"]: r["n"] for r in present.groupBy("w").agg(F.count("*").alias("n")).collect()}  # a row a term of the templates at most
    n = texts.count()
    return {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}, math.log(1 + n) + 1


def _vectors(templates: list[tuple[str, str]], idf: dict[str, float], weigh=float) -> list[tuple[int, str, float, float]]:
    """(template, term, what a text's weight of the term is multiplied by for the cosine's product, the term's share of the squared norm)."""
    rows = []
    for k, (_, text) in enumerate(templates):
        words = _python_terms(text)
        value = {w: weigh(words.count(w)) * idf[w] for w in sorted(set(words))}
        total = sum(v * v for v in value.values())
        rows += [(k, w, v * idf[w] / math.sqrt(total), v * v / total) for w, v in value.items()]
    return rows


def _damped(count: int) -> float:
    """The weight of a term's count in a whole text: common words don't drown the others."""
    return 1 + math.log(count)


def score_windows(windows: DataFrame, templates: list[tuple[str, str]], idf: dict[str, float], unseen: float, threshold: float) -> DataFrame:
    """(window, licence, length, score) of every template that a window (window id, words) reaches.

    Of a window as many terms count as the template has.  Pairs come from an equality join on the templates' anchors.
    """
    spark = windows.sparkSession
    near = [(w, k, templates[k][0], len(_python_terms(templates[k][1]))) for k, anchors in enumerate(anchor_terms(templates, idf, threshold)) for w in anchors]
    weights = F.broadcast(spark.createDataFrame([r[:3] for r in _vectors(templates, idf)], "template int, w string, x double"))  # the templates' terms
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "w string, idf double"))
    anchors = F.broadcast(spark.createDataFrame(near, "w string, template int, licence string, length int"))
    words = windows.select("window", F.split("words", " ").alias("words"))
    pairs = words.select("window", "words", F.explode(F.array_distinct("words")).alias("w")).join(anchors, "w").groupBy("window", "template", "licence", "length").agg(F.first("words").alias("words"))
    each = pairs.select("window", "template", "licence", "length", F.explode(F.slice("words", F.lit(1), F.col("length"))).alias("w"))
    counted = each.groupBy("window", "template", "licence", "length", "w").agg(F.count("*").alias("tf"))
    valued = counted.join(known, "w", "left").join(weights, ["template", "w"], "left").withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    sums = valued.groupBy("window", "template", "licence", "length").agg(
        F.sum(F.coalesce(F.col("tf") * F.col("x"), F.lit(0.0))).alias("dot"), F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm")
    )
    return sums.select("window", "licence", "length", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)


def clear_best(scores: DataFrame, keys: list[str], margin: float) -> DataFrame:
    """The keys, licence and score of the best licence of each key that is ``margin`` above the best other one.

    ``scores`` has at most a row a template for each key.
    """
    best = scores.groupBy(*keys, "licence").agg(F.max("score").alias("score"))
    ranked = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("score", "licence")), asc=False).alias("r"))
    clear = (F.size("r") == 1) | (F.round(F.col("r")[0]["score"] - F.get("r", F.lit(1))["score"], 6) >= margin)
    return ranked.where(clear).select(*keys, F.col("r")[0]["licence"].alias("licence"), F.col("r")[0]["score"].alias("score"))


def score_files(low: DataFrame, texts: list[tuple[str, str]], idf: dict[str, float], unseen: float, threshold: float, margin: float, scratch: Scratch) -> DataFrame:
    """(key, licence, score) of the lower-cased texts (key, low) that are, as a whole, one of the licence ``texts``.

    A text that holds less than ``threshold`` squared of a licence's squared norm in its different terms can't reach the
    threshold (Cauchy's inequality), so the terms' counts are taken of those texts only that hold more.  Counts weigh by
    one plus their logarithm.
    """
    spark = low.sparkSession
    vectors = F.broadcast(spark.createDataFrame(_vectors(texts, idf, _damped), "template int, w string, x double, share double"))  # the licences' terms
    names = F.broadcast(spark.createDataFrame([(k, name) for k, (name, _) in enumerate(texts)], "template int, licence string"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "w string, idf double"))
    words = F.split("low", WORD_BREAK)
    some = low.select("key", F.explode(F.array_distinct(words)).alias("w")).join(vectors, "w").groupBy("key", "template").agg(F.sum("share").alias("share"))
    near = scratch.table(some.where(F.col("share") >= threshold**2 * 0.999).select("key", "template"), "near")
    each = low.join(near.select("key").distinct(), "key", "left_semi").select("key", F.explode(words).alias("w")).where("w <> ''")
    counts = scratch.table(each.groupBy("key", "w").agg((1 + F.log(F.count("*"))).alias("tf")), "counts")
    value = F.col("tf") * F.coalesce("idf", F.lit(unseen))
    norms = counts.join(known, "w", "left").groupBy("key").agg(F.sqrt(F.sum(value * value)).alias("norm"))
    dots = counts.join(vectors, "w").join(near, ["key", "template"]).groupBy("key", "template").agg(F.sum(F.col("tf") * F.col("x")).alias("dot"))
    scores = dots.join(norms, "key").join(names, "template").select("key", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return clear_best(scores.where(F.col("score") >= threshold - margin), ["key"], margin).where(F.col("score") >= threshold)


def inherit(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, licence, from_dir): the licence of the nearest directory at or above ``dir`` that has one.

    Both sides hold a directory once; a directory meets its own prefixes only, by an equality join on the path.
    """
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.concat_ws("/", F.slice(parts, F.lit(1), n)).alias("from_dir")))
    pairs = directories.select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.from_dir")
    found = pairs.join(licensed.select(F.col("dir").alias("from_dir"), "licence"), "from_dir")
    return found.groupBy("dir").agg(F.max(F.struct("depth", "licence", "from_dir")).alias("m")).select("dir", "m.licence", "m.from_dir")


def scan(
    files: DataFrame,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    threshold: float = 0.8,
    file_share: float = 0.25,
    texts: list[tuple[str, str]] | None = None,
    text_threshold: float = 0.95,
    margin: float = 0.003,
) -> DataFrame:
    """The licence of every file: its own text's or header's, else that of the nearest directory above with a licence file.

    A file without its copyright lines is compared as a whole, by TF-IDF cosine, with whole licence ``texts``; it is one that it reaches
    ``text_threshold`` with and that is ``margin`` above every other (a file as near to two is neither).  For headers a
    text is cut into lines and sentences.  At each of them a window begins that runs on over the following ones, as long
    as a template, and is compared to it; so wrapped headers and commented ones are found.  A window's licence must be
    ``margin`` above the others at its place; of a file's windows the best counts (ties: the later name).  A file's own
    licence is that of its whole text, else of its headers.  A file is a licence file of its directory if it is a licence
    as a whole, or if a window that reaches ``threshold`` holds at least ``file_share`` of its terms; of several in a
    directory whole texts come first, then the best score (ties: the later name).

    Returns, for each (doc_id, path): own_licence, own_score, licence, origin (own, inherited or null) and from_dir.
    Null and empty texts have no windows; texts of any length are read whole, in time that grows with their length; a
    null path lies in the root directory ''; repeated rows of an id and path are one file; an empty table gives no rows;
    other columns are not read, whatever their names.
    """
    scratch = Scratch(files.sparkSession, "licences")
    templates, texts = templates or TEMPLATES, whole_texts() if texts is None else texts
    texts = [(name, re.sub(NOTICE, " ", text.lower())) for name, text in texts]
    vocabulary = sorted({w for _, text in [*templates, *texts] for w in _python_terms(text)})
    longest = max(len(_python_terms(text)) for _, text in templates)
    rows = files.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    idf, unseen = inverse_frequencies(rows.select("text"), vocabulary)
    anchors = sorted({w for some in anchor_terms(templates, idf, threshold) for w in some})
    low = rows.select("doc_id", "path", F.lower("text").alias("low")).where(F.arrays_overlap(F.split("low", WORD_BREAK), _in(anchors)))
    parts = F.filter(F.transform(F.split("low", PART_BREAK), terms), lambda p: F.size(p) > 0)
    cut = low.select("doc_id", "path", parts.alias("parts")).where(F.size("parts") > 0)
    # runs of parts with what the last windows run on over, so that no row holds all windows of a long text
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("parts") - 1) / RUN).cast("int")), lambda k: F.struct(
        F.slice("parts", k * RUN + 1, F.lit(RUN + longest - 1)).alias("parts"), F.least(F.lit(RUN), F.size("parts") - k * RUN).alias("begins")))
    n = F.aggregate("parts", F.lit(0), lambda total, p: total + F.size(p))
    run = cut.select("doc_id", "path", n.alias("n"), F.explode(runs).alias("run")).select("doc_id", "path", "n", "run.*")
    window = F.transform(F.sequence(F.lit(1), F.col("begins")), lambda at: F.slice(F.flatten(F.slice("parts", at, F.lit(longest))), 1, longest))
    begun = run.select("doc_id", "path", "n", F.explode(F.filter(window, lambda w: F.arrays_overlap(w, _in(anchors)))).alias("w"))
    held = scratch.table(begun.select("doc_id", "path", F.concat_ws(" ", "w").alias("words"), "n"), "held")
    windows = scratch.table(held.select("words").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    scored = scratch.table(score_windows(windows, templates, idf, unseen, threshold), "scored")
    clear = clear_best(scored, ["window"], margin)
    size = scored.groupBy("window", "licence", "score").agg(F.max("length").alias("length"))
    clear = scratch.table(clear.join(size, ["window", "licence", "score"]).join(windows, "window"), "clear")
    file = F.least(F.col("length"), F.col("n")) >= file_share * F.col("n")
    found = held.join(clear, "words").select("doc_id", "path", F.struct(F.lit(False).alias("whole"), "score", "licence").alias("m"), file.alias("file"))
    if texts:
        marks = sorted({w for some in anchor_terms(texts, idf, text_threshold, _damped) for w in some})
        whole = rows.select("doc_id", "path", F.lower("text").alias("low")).where(F.arrays_overlap(F.split("low", WORD_BREAK), _in(marks)))
        whole = whole.withColumn("low", F.regexp_replace("low", NOTICE, " ")).withColumn("key", F.md5("low"))
        different = whole.groupBy("key").agg(F.first("low").alias("low"))
        are = scratch.table(score_files(different, texts, idf, unseen, text_threshold, margin, scratch), "whole")
        found = found.unionByName(whole.select("doc_id", "path", "key").join(are, "key").select(
            "doc_id", "path", F.struct(F.lit(True).alias("whole"), "score", "licence").alias("m"), F.lit(True).alias("file")))
    own = found.groupBy("doc_id", "path").agg(F.max("m").alias("m"), F.max(F.when(F.col("file"), F.col("m"))).alias("f"))
    own = scratch.table(own.select("doc_id", "path", F.col("m.licence").alias("own_licence"), F.col("m.score").alias("own_score"), "f"), "own")

    def folder(path: Column) -> Column:
        return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)

    licensed = own.where("f is not null").groupBy(folder(F.col("path")).alias("dir")).agg(F.max("f").alias("m")).select("dir", F.col("m.licence").alias("licence"))
    every = rows.select("doc_id", "path").distinct().withColumn("dir", folder(F.col("path")))
    above = inherit(every.select("dir").distinct(), licensed)
    placed = every.join(own.drop("f"), every.doc_id.eqNullSafe(own.doc_id) & (every.path == own.path), "left").select(
        every.doc_id, every.path, every.dir, "own_licence", "own_score"
    ).join(above, "dir", "left")
    origin = F.when(F.col("own_licence").isNotNull(), "own").when(F.col("licence").isNotNull(), "inherited")
    return placed.select(
        "doc_id", "path", "own_licence", "own_score", F.coalesce("own_licence", "licence").alias("licence"), origin.alias("origin"),
        F.when(F.col("own_licence").isNull(), F.col("from_dir")).alias("from_dir"),
    )
