"""License texts in documents, with DataFrame functions only.

Templates are license notices. A document's words are cut into overlapping
windows of twice a template's length class, one class length apart, so that
every occurrence lies whole in one window. MinHash bands of one value each
retrieve the templates of a window: at containment c of a template in a window
at most four times its size the Jaccard similarity is at least c / (4 + 1 - c),
so with ``BANDS`` bands the chance to miss a match is (1 - J) ** BANDS, below
1e-4 at c = 0.8. What is retrieved is verified by the exact share of the
template's word shingles in the window.

A window is looked at only if it holds an anchor word. Each template's anchors
are chosen so that fewer than 1 - c of its shingles are without one: a match
can't be without them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# License notices as their publishers word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version."),
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met"),
    # Other usual wordings of the same and of further licenses.
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-distributed": "Distributed under the MIT License.",
    "MIT-available": "This project is available under the MIT License.",
    "MIT-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "MIT-spdx": "SPDX-License-Identifier: MIT",
    "Apache-2.0-released": "Released under the Apache License, Version 2.0.",
    "Apache-2.0-short": "Licensed under the Apache License 2.0.",
    "Apache-2.0-distributed": "Distributed under the Apache License 2.0.",
    "Apache-2.0-warranty": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "Apache-2.0-spdx": "SPDX-License-Identifier: Apache-2.0",
    "ISC": "Licensed under the ISC License.",
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-3-Clause-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "BSD-3-Clause-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission."),
    "BSD-warranty": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
        " PARTICULAR PURPOSE ARE DISCLAIMED."),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License,"
        " or (at your option) any later version."),
    "GPL-2.0-only-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License version 2 as published by the Free Software Foundation."),
    "GPL-2.0-spdx": "SPDX-License-Identifier: GPL-2.0",
    "GPL-3.0-short": "Licensed under the GNU General Public License v3.0.",
    "GPL-3.0-spdx": "SPDX-License-Identifier: GPL-3.0",
    "GPL-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License"
        " for more details."),
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License,"
        " or (at your option) any later version."),
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version."),
    "MPL-1.1-header": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may"
        " not use this file except in compliance with the License."),
    "MPL-2.0-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "MPL-2.0-spdx": "SPDX-License-Identifier: MPL-2.0",
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License v1.0 which accompanies this distribution"),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License 2.0 which is available at"),
    "CC0-1.0": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights"
        " to this work to the public domain worldwide."),
    "CC0-1.0-short": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-long": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Unlicense-grant": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "Zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and"
        " to alter it and redistribute it freely, subject to the following restrictions"),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Artistic-2.0": "You may redistribute it under the terms of the Artistic License 2.0.",
    "GFDL-1.3": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free"
        " Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
}
WIDTH = 3
CONTAINMENT = 0.8
BANDS = 64
SMALLEST = 8
_TOKEN = "[a-z0-9]+"
_PLAIN = set("a an and any are as at be by for from in is it of or on that the this to with you".split())


def tokens_of(text: str) -> list[str]:
    return re.findall(_TOKEN, text.lower())


def length_class(words: int) -> int:
    """The power of two from ``SMALLEST`` up that holds so many words."""
    size = SMALLEST
    while size < words:
        size *= 2
    return size


def anchors(templates: dict[str, str], width: int, containment: float) -> list[str]:
    """Words such that less than 1 - containment of any template's shingles hold none of them."""
    chosen: set[str] = set()
    for text in templates.values():
        words = tokens_of(text)
        every = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        bare = {s for s in every if chosen.isdisjoint(s)}
        while len(bare) >= (1 - containment) * len(every) - 1e-9 and bare:
            left = sorted({w for s in bare for w in s})
            best = max(left, key=lambda w: (w not in _PLAIN, len(w) > 3, sum(w in s for s in bare), w))
            chosen.add(best)
            bare = {s for s in bare if best not in s}
    return sorted(chosen)


def _shingles(tokens: Column, width: int) -> Column:
    """Distinct hashes of the runs of ``width`` tokens; none if there are fewer."""
    places = F.sequence(F.lit(1), F.size(tokens) - width + 1)
    runs = F.transform(places, lambda p: F.xxhash64(*[F.element_at(tokens, p + i) for i in range(width)]))
    return F.when(F.size(tokens) >= width, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def _signature(shingles: Column) -> Column:
    """MinHash values, one a band: the least of every seed's hashes."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(seed))))

    return F.array(*map(least, range(BANDS)))


def template_table(spark: SparkSession, templates: dict[str, str], width: int) -> DataFrame:
    """Rows (license, size class, shingles, band, value): as many as templates times bands."""
    listed = F.array(*[F.struct(
        F.lit(name).alias("license"), F.lit(text).alias("text"), F.lit(length_class(len(tokens_of(text)))).alias("class"))
        for name, text in templates.items()])
    rows = spark.range(1).select(F.inline(listed)).withColumn("tokens", F.regexp_extract_all(F.lower("text"), F.lit(_TOKEN), F.lit(0)))
    return rows.withColumn("template", _shingles(F.col("tokens"), width)).select(
        "license", F.col("class").alias("of_class"), "template",
        F.posexplode(_signature(F.col("template"))).alias("of_band", "of_value"))


def scan(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, width: int = WIDTH, containment: float = CONTAINMENT,
) -> DataFrame:
    """Licenses found in ``docs`` (doc_id, text), words without regard to case and punctuation.

    A template's name begins with its license. Notices that differ in few words,
    as those of two versions do, may each reach the limit; the one with the larger
    containment is the nearer.

    Per document and license: doc_id, license, containment (the largest of a
    window) and n_windows (windows at or above the limit). Null and empty texts
    and texts without a match give no row; equal repeated rows give one; null
    ids are kept; other columns are ignored.
    """
    spark = docs.sparkSession
    words = anchors(templates, width, containment)
    classes = sorted({length_class(len(tokens_of(t))) for t in templates.values()})
    held = F.array(*map(F.lit, words))
    likely = docs.select(F.col("doc_id"), F.lower(F.col("text").cast("string")).alias("text")).where(
        F.col("text").rlike(f"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])"))
    tokens = F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0))
    placed = likely.select("doc_id", F.xxhash64("text").alias("body"), tokens.alias("tokens")).withColumn(
        "at", F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), lambda p: F.array_contains(
            held, F.element_at("tokens", p + 1))))

    def windows(size: int) -> Column:
        """Numbers of the windows of one class that hold an anchor."""
        both = F.flatten(F.transform("at", lambda p: F.array(F.floor(p / size), F.floor(p / size) - 1)))
        return F.transform(
            F.filter(F.array_distinct(both), lambda i: i >= 0),
            lambda i: F.struct(F.lit(size).alias("class"), i.alias("window")))

    # Outer, and no filter on computed arrays: a filter that moves down would
    # spell them out inside its own lambda and compute them once an element.
    cut = placed.withColumn("w", F.explode_outer(F.concat(*map(windows, classes)))).where("w IS NOT NULL").select(
        "doc_id", "body", "w.class", "w.window",
        F.slice("tokens", (F.col("w.window") * F.col("w.class") + 1).cast("int"), (2 * F.col("w.class")).cast("int")).alias("piece"))
    shingled = cut.select("doc_id", "body", "class", "window", _shingles(F.col("piece"), width).alias("shingles"))
    banded = shingled.select("*", F.posexplode_outer(_signature(F.col("shingles"))).alias("band", "value"))
    # As many rows as templates times bands, whatever the corpus.
    near = banded.join(
        F.broadcast(template_table(spark, templates, width)),
        (F.col("class") == F.col("of_class")) & (F.col("band") == F.col("of_band")) & (F.col("value") == F.col("of_value")))
    share = F.size(F.array_intersect("shingles", "template")) / F.size("template")
    return (
        near.select("doc_id", "body", "license", "class", "window", share.alias("containment"))
        .where(F.col("containment") >= containment)
        .groupBy("doc_id", "body", "license", "class", "window").agg(F.max("containment").alias("containment"))
        .groupBy("doc_id", "body", "license").agg(
            F.max("containment").alias("containment"), F.count("*").alias("n_windows"))
        .select("doc_id", "license", "containment", "n_windows")
    )


def oracle(templates: dict[str, str] = TEMPLATES, width: int = WIDTH, containment: float = CONTAINMENT) -> str:
    """The same result as DuckDB SQL: all windows against all templates."""
    rows = ", ".join(
        "('{}', '{}', {})".format(name, " ".join(tokens_of(text)), length_class(len(tokens_of(text))))
        for name, text in templates.items())
    run = " || ' ' || ".join(f"w[p + {i}]" for i in range(1, width + 1))
    return f"""
WITH t AS (SELECT license, string_split(words, ' ') AS w, size FROM (VALUES {rows}) AS v(license, words, size)),
ts AS (SELECT DISTINCT license, size, {run} AS s
       FROM (SELECT license, size, w, unnest(range(0, len(w) - {width - 1})) AS p FROM t)),
tn AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
d AS (SELECT DISTINCT doc_id, lower(text) AS body FROM documents WHERE text IS NOT NULL),
dw AS (SELECT doc_id, body, regexp_extract_all(body, '{_TOKEN}') AS w FROM d),
ds AS (SELECT doc_id, body, p, {run} AS s
       FROM (SELECT doc_id, body, w, unnest(range(0, len(w) - {width - 1})) AS p FROM dw)),
m AS (SELECT doc_id, body, license, size, p, s, unnest([p // size, p // size - 1]) AS win FROM ds JOIN ts USING (s)),
c AS (SELECT doc_id, body, license, win, count(DISTINCT s) AS hits FROM m
      WHERE win >= 0 AND p <= win * size + 2 * size - {width} GROUP BY ALL)
SELECT doc_id, license, max(hits::DOUBLE / n) AS containment, count(*) AS n_windows
FROM c JOIN tn USING (license) WHERE hits::DOUBLE / n >= {containment} GROUP BY doc_id, body, license
"""
