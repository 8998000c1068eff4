"""License scans by MinHash bands over overlapping text windows, in DataFrame functions alone.

A text becomes its lower-case alphanumeric words and the hashes of their five-word shingles. Windows are runs of
8 shingles that overlap by half or, for short templates, of 2 at every shingle; a template of one shingle has windows of
its own length. A template is indexed by its windows at every offset. A copy that keeps four fifths of a template's
shingles has an unbroken stretch of a certain length (``unbroken``); the template uses the longest run that has a whole window
of the text in any such stretch. Its MinHashes equal those of the template's window there, so all bands collide.
Windows of 8 of similarity s collide in one of b single-row bands with probability 1 - (1 - s)^b (0.99 at
s = 0.9 with the default b = 2). What the bands retrieve is verified on the shingles themselves: the share of the
template's distinct shingles that the text has.

Scale: the texts are scanned once and never shuffled. Windows and shingles meet the index of the templates, a parameter that
is broadcast up to a measured size; only what meets it, slim rows, is grouped by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Stage

WIDTH = 5
RUNS = (1, 2, 8)
BANDS = 2
CONTAINMENT = 0.8

#: Notices and whole licenses to look for (fixed values; public license texts); a table of others is a parameter of ``scan``.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
}


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++"), F.lit(0))


def shingles(words_col: str, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` words; none of shorter texts."""
    parts = ", ".join(f"{words_col}[i + {j}]" for j in range(width))
    return F.expr(f"if(size({words_col}) < {width}, array(), transform(sequence(0, size({words_col}) - {width}), i -> xxhash64({parts})))")


def unbroken(n: int, width: int = WIDTH) -> int:
    """Shingles in a row that a copy with at most a fifth of its ``n`` shingles missing must still have. A change inside (a
    word put in, taken out or replaced, a part moved) costs ``width - 1`` of them at least, so there are k of them at most, and
    the longest of the k + 1 stretches holds its share of what is left. Changes at the ends break nothing."""
    k = n // (5 * (width - 1))
    left = -(-4 * n // 5)
    return -(-left // (k + 1))


def run_of(n: int, runs=RUNS) -> int:
    """Length of the windows of a template of ``n`` shingles: any unbroken stretch holds one of them whole."""
    return max((r for r in runs if r + max(1, r // 2) - 1 <= unbroken(n)), default=runs[0])


def _mixed(bands: int) -> dict:
    """Columns ``_h0``...: the shingles' hashes, mixed anew for each band after the first."""
    return {f"_h{b}": F.expr(f"transform(_h, h -> xxhash64(h, {b}))") if b else F.col("_h") for b in range(bands)}


def _windows(run: int, step: int, bands: int) -> list[str]:
    """Arrays of (run, band, at, key) of the windows of ``run`` shingles every ``step``: a band's key is the
    least of its mixed hashes. Run 0 is the shingles themselves. Short windows, which a stretch holds exactly, have one band."""
    if run == 0:
        return ["transform(_h0, (h, s) -> struct(0 as run, 0 as band, s as at, h as key))"]
    if run == 1:
        return ["transform(_h0, (h, s) -> struct(1 as run, 0 as band, s as at, h as key))"]
    if run == 2:
        return ["if(size(_h0) >= 2, transform(slice(_h0, 2, size(_h0) - 1), (h, s) -> struct(2 as run, 0 as band, s as at, least(h, _h0[s]) as key)), array())"]
    each = "transform(sequence(0, size(_h0) - {run}, {step}), s -> struct({run} as run, {b} as band, s as at, array_min(slice(_h{b}, s + 1, {run})) as key))"
    return [f"if(size(_h0) >= {run}, {each.format(run=run, step=step, b=b)}, array())" for b in range(bands)]


def _keys(df: DataFrame, keep: list[str], windows: list[str]) -> DataFrame:
    return df.select(*keep, F.explode(F.expr(f"concat({', '.join(windows)})")).alias("_w")).select(*keep, "_w.*")


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    rows = list((TEMPLATES if templates is None else templates).items())
    return spark.createDataFrame(rows, "template string, text string")


def scan(
    docs: DataFrame,
    templates: DataFrame | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``(id, template, containment, first_word)``: templates of which at least ``containment`` of the
    distinct shingles occur in the text.

    ``first_word`` is the word at which the template would begin by most of the windows that met (then the first).
    Defined cases: null and empty texts, and texts or templates of under five words, match nothing; a
    template without rows gives none; of rows that repeat an id the best match counts; a null id is reported as such;
    a template of several texts has the shingles of all; other columns are ignored. Texts are read whole, however long.
    """
    spark = docs.sparkSession
    t = template_table(spark) if templates is None else templates
    t = t.select("template", words(F.col("text")).alias("_words")).select("template", shingles("_words").alias("_h")).where(F.size("_h") > 0)
    t = Stage(spark, "licenses").put(t.withColumn("_n", F.size("_h")), "templates")
    counts = [r._n for r in t.select("_n").distinct().collect()]  # lengths of the templates, a parameter
    runs = sorted({run_of(n) for n in counts})
    if not runs:
        return docs.select(F.col(id_col), F.lit("").alias("template"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).limit(0)
    mixed = t.withColumns(_mixed(bands))
    index = _keys(mixed, ["template"], _windows(0, 1, bands))
    for run in runs:
        index = index.unionByName(_keys(mixed.where(F.col("_n").isin([n for n in counts if run_of(n) == run])), ["template"], _windows(run, 1, bands)))
    index = index.select("run", "band", "key", "template", F.when(F.col("run") > 0, F.col("at")).alias("_t_at")).distinct()
    d = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text)).alias("_text"), words(F.col(text)).alias("_words")).where(F.size("_words") >= WIDTH)
    d = d.select("_id", "_text", shingles("_words").alias("_h")).select("_id", "_text", *[c.alias(n) for n, c in _mixed(bands).items()])
    windows = _keys(d, ["_id", "_text"], [w for run in [0, *runs] for w in _windows(run, max(1, run // 2), bands)])
    hit = join_dim(windows, index, ["run", "band", "key"], "inner")
    exact, place = F.when(F.col("run") == 0, F.col("key")), F.when(F.col("run") > 0, F.greatest(F.col("at") - F.col("_t_at"), F.lit(0)))
    found = hit.groupBy("_id", "_text", "template").agg(F.size(F.collect_set(exact)).alias("_have"), F.mode(place, True).alias("_at")).where("_at is not null")
    sizes = t.groupBy("template").agg(F.size(F.array_distinct(F.flatten(F.collect_list("_h")))).alias("_all"))
    found = join_dim(found, sizes, "template", "inner").select("_id", "template", "_at", (F.col("_have") / F.col("_all")).alias("_share")).where(F.col("_share") >= containment)
    out = found.groupBy("_id", "template").agg(F.max(F.struct("_share", -F.col("_at"))).alias("_b"))
    return out.select(F.col("_id").alias(id_col), "template", F.col("_b._share").alias("containment"), (-F.col("_b.col2")).alias("first_word"))
