"""Licence families of paragraphs: a trained sparse n-gram classifier with a calibrated unknown class, confirmed by templates.

A paragraph is a run of lines with words; how it is wrapped does not matter. Every paragraph is read in windows of ``WINDOW`` words, half
overlapping. A window's features are the word uni- and bigrams of the model's vocabulary that it holds; a softmax over the families,
``unknown`` (other licences, proprietary and negated notices) and ``none`` (prose) gives probabilities, their temperature fitted on held-out
texts. Where a family leads with ``THRESHOLD`` or more, its templates have to confirm it: the window must hold ``CONFIRM`` of the content words of
one of them, the licence's name being the shortest. Anything else that is not ``none`` is ``unknown``.

A window without a word of the vocabulary scores the bias, which is ``none``, so only texts with such a word are cut into tokens;
this leaves nothing out. Tokens meet the vocabulary, a table whose size does not depend on the data, in a broadcast join; a window becomes the small set
of features it holds, and no row leaves the JVM.

Training runs once on the driver, on phrases around names of licences, templates and cuts of them, the same with invented names, other licences,
negations, and prose that uses the same words; its size is fixed.
"""

from __future__ import annotations

import json
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window, and between the starts of two.
WINDOW, STEP = 40, 20
THRESHOLD = 0.6
CONFIRM = 0.75
#: Templates with fewer content words, such as names, have to be held whole.
SHORT = 8
UNKNOWN, NONE = "unknown", "none"
_WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"

# Usual notices of well-known licences.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org licenses LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ),
    "Public-Domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 public domain dedication",
        "SPDX-License-Identifier: Unlicense",
    ),
}
# Names of the families, as they stand in running text.
NAMES = {
    "MIT": ("MIT License", "MIT/Expat License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3", "AGPL-3.0"),
    "LGPL": ("GNU Lesser General Public License", "GNU LGPL", "GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv3"),
    "BSD": ("BSD 3-Clause License", "BSD License", "BSD 2-Clause License", "Modified BSD License", "BSD-3-Clause"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
    "CC-BY": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution License"),
    "CC-BY-NC": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-SA": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-ND": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0", "CC-BY-ND-4.0"),
    "Public-Domain": ("CC0 1.0 Universal", "CC0 public domain dedication", "Unlicense"),
}
_OTHERS = (
    "Eclipse Public License 2.0", "European Union Public Licence 1.2", "Artistic License 2.0", "zlib License", "SIL Open Font License 1.1", "ISC License",
    "Common Development and Distribution License", "Microsoft Public License", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives License", "Business Source License 1.1", "Elastic License 2.0", "Open Database License",
    "Q Public License", "PHP License", "Python Software Foundation License", "IBM Public License", "Apple Public Source License 2.0", "Server Side Public License, version 1",
)
_PHRASES = (
    "licensed under the {}", "released under the {}", "distributed under the {}", "available under the {}", "this project is licensed under the terms of the {}",
    "governed by the {}", "the use of this code is governed by the {}", "subject to the terms of the {}", "this work is licensed under the {}", "published under a {}",
    "SPDX-License-Identifier: {}", "{}", "see the {} for details", "it is made available under the terms and conditions of the {}", "under the {}", "covered by the {}",
    "license: {}", "copyright 2019 the authors, {}", "you may redistribute it under the {}", "dual licensed, in part under the {}",
)
_DENIED = (
    "this project is not licensed under the {}", "this is not released under the terms of the {}", "no longer available under the {}", "never distributed under the {}",
    "it is not covered by the {}", "incompatible with the {}", "cannot be distributed under the {}", "this code is not available under the {}", "not governed by the {}", "not subject to the {}",
    "unlike software under the {} this is closed", "not under the {}", "is not published under a {}",
)
_PROPRIETARY = (
    "All rights reserved, copyright by the publisher.", "Licensed under a proprietary agreement with the vendor.", "This software is licensed, not sold.", "No part of this work may be copied without written permission.",
    "This software is confidential and proprietary; redistribution in any form is prohibited.", "You may not modify, publish, distribute or sell copies of the software without a commercial license.",
    "Use of this software requires a paid license key.", "The license fee is due every year and the license ends without payment.", "End user license agreement: read carefully before installing the software.",
    "Permission to copy is granted to subscribers only.", "The source code is provided for evaluation only and may not be redistributed.", "Unauthorized redistribution of this material is prohibited.",
)
_PROSE = (
    "You need a driving license to rent this car.", "The copyright of the image belongs to the museum.", "He asked for permission to leave early.", "The warranty covers parts and labour for two years.",
    "Licensed premises close at midnight.", "The fishing licence costs ten euros.", "Redistribution of income was the topic of the debate.", "Copyright law protects authors.", "The general public was invited to the opening.",
    "The gnu is a large antelope.", "Parental permission is required for the trip.", "She studied physics at MIT and works on software.", "The Apache helicopter landed on the field.", "An Apache village was found in the valley.",
    "The Mozilla browser was released in version 2.0.", "The commons of the village are open to all.", "A creative writing course is free of charge.", "The foundation published a report on free software.", "The work was published in an international journal.",
    "Attribution of the painting is disputed.", "The program is available in the library.", "This is a public library and a public domain of knowledge.", "The source of the river is in the north.", "Version 3 of the report was published under a new name.",
    "The terms of the treaty were subject to debate.", "Without warranty of any kind the shop closed.", "The notice was included in the documentation.", "Modern forms of trade are permitted in the city.", "The law was waived by the court to the extent possible.",
)
_STOP = frozenset(
    "a an and any are as at be been but by can do does for from had has have he her his if in into is it its may more no nor not of on or other our she so such than that the their them then there"
    " these they this those to under up was we were what when where which who will with you your i all out use used one two".split()
)
_NEGATIONS = frozenset("not never no cannot unlike".split())


def words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.lower().replace("licence", "license"))


def grams_of(words: list[str]) -> set[str]:
    """Content words and bigrams; a stop word stands in a bigram only if it denies."""
    plain = lambda w: w not in _STOP
    pairs = zip(words, words[1:], strict=False)
    return {w for w in words if plain(w)} | {f"{a} {b}" for a, b in pairs if (plain(a) or a in _NEGATIONS) and plain(b) or a in _NEGATIONS}


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]  # the families, then UNKNOWN and NONE
    bias: tuple[float, ...]
    grams: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]  # by gram, one per class
    templates: tuple[tuple[int, tuple[int, ...], int], ...]  # class, places of its content words among the grams, words needed

    def probabilities(self, words: list[str]) -> np.ndarray:
        """Of one window; the same as the native expression, for tests."""
        held = grams_of(words)
        z = np.array(self.bias) + sum((np.array(w) for g, w in zip(self.grams, self.weights, strict=True) if g in held), np.zeros(len(self.classes)))
        e = np.exp(z - z.max())
        return e / e.sum()


def _examples(r: random.Random) -> list[tuple[str, int]]:
    """Training texts with their class."""
    names = list(NAMES)
    unknown, none = len(names), len(names) + 1
    invented = lambda: " ".join(
        "".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(2, 3))) for _ in range(r.randint(1, 2))
    )
    kinds = ("{} Proprietary License", "{} License, Version 2.0", "{} Public License", "{} Public License, version 3", "{} License", "{} Community License 1.0", "{} Software License Agreement", "{} General License, version 2", "{} Commercial License 4.0 International")
    rows: list[tuple[str, int]] = []
    for i, family in enumerate(names):
        rows += [(p.format(n), i) for n in NAMES[family] for p in _PHRASES]
        rows += [(p.format(n), unknown) for n in NAMES[family] for p in _DENIED] * 3
        for text in TEMPLATES[family]:
            words = text.split()
            rows += [(text, i)] * 4
            for _ in range(8):
                at = r.randint(0, len(words) // 3)
                cut = words[at : at + max(6, len(words) * 2 // 3)]
                if len(words) > 9:
                    rows.append((" ".join(w for w in cut if r.random() > 0.06), i))
                rows.append((" ".join(w for w in words if r.random() > 0.06), i))
    rows += [(p.format(n), unknown) for n in _OTHERS for p in _PHRASES]
    rows += [(p.format(r.choice(kinds).format(invented())), unknown) for p in _PHRASES for _ in range(24)]
    rows += [(t, unknown) for t in _PROPRIETARY for _ in range(6)]
    rows += [(t, none) for t in _PROSE for _ in range(8)] + [("", none)] * 40
    # Prose with some words of the vocabulary, none of them telling.
    loose = sorted({w for t in _PROSE for w in words_of(t)})
    rows += [(" ".join(r.choice(loose) for _ in range(r.randint(3, 25))), none) for _ in range(400)]
    return rows


@lru_cache(maxsize=2)
def fitted(seed: int = 5, steps: int = 900, sparsity: float = 5e-5) -> Model:
    """L1-penalised softmax regression, with a temperature from a held-out fifth of the texts."""
    r = random.Random(seed)
    classes = (*NAMES, UNKNOWN, NONE)
    rows = _examples(r)
    r.shuffle(rows)
    held = [grams_of(words_of(t)) for t, _ in rows]
    counts: dict[str, int] = {}
    for grams in held:
        for g in grams:
            counts[g] = counts.get(g, 0) + 1
    content = [(i, [{w for w in words_of(t) if w not in _STOP} for t in (*TEMPLATES[f], *NAMES[f])]) for i, f in enumerate(NAMES)]
    wanted = {w for _, sets in content for ws in sets for w in ws}
    known = sorted(g for g, n in counts.items() if n >= 3 or g in wanted)
    at = {g: i for i, g in enumerate(known)}
    x = np.zeros((len(rows), len(known)), np.float32)
    for i, grams in enumerate(held):
        x[i, [at[g] for g in grams if g in at]] = 1
    y = np.eye(len(classes), dtype=np.float32)[[c for _, c in rows]]
    share = y.sum(0)
    heavy = (1 / np.sqrt(share))[[c for _, c in rows]][:, None]  # rare classes count more, by the root of their share
    train = np.arange(len(rows)) % 5 != 0
    xt, yt, ht = x[train], y[train], heavy[train] / heavy[train].sum()
    w, b = np.zeros((len(known), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    speed, speed_b, rate = np.zeros_like(w), np.zeros_like(b), 4.0
    for _ in range(steps):
        z = xt @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        slope = (yt - p) * ht
        speed = 0.9 * speed + xt.T @ slope
        speed_b = 0.9 * speed_b + slope.sum(0)
        w = w + rate * speed
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparsity, 0)
        b = b + rate * speed_b
    z = x[~train] @ w + b

    def loss(t: float) -> float:
        s = z * t - (z * t).max(1, keepdims=True)
        return -float((y[~train] * (s - np.log(np.exp(s).sum(1, keepdims=True)))).mean())

    scale = min((0.35, 0.5, 0.7, 0.85, 1.0, 1.2, 1.5), key=loss)
    kept = [g for g in known if np.abs(w[at[g]]).max() > 0 or g in wanted]
    place = {g: i for i, g in enumerate(kept)}
    templates = tuple(
        (i, tuple(sorted(place[v] for v in ws)), len(ws) if len(ws) < SHORT else int(np.ceil(CONFIRM * len(ws)))) for i, sets in content for ws in sets
    )
    weights = tuple(tuple(round(float(v) * scale, 4) for v in w[at[g]]) for g in kept)
    return Model(classes, tuple(round(float(v) * scale, 4) for v in b), tuple(kept), weights, templates)


def _constant(value, kind: str) -> Column:
    """A constant of the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _tokens(text: Column) -> Column:
    """(w, line) of a text's words; a blank line leaves a gap that no window spans."""
    gap = F.array_repeat(F.struct(F.lit("").alias("w"), F.lit(-1).alias("line")), WINDOW + STEP)

    def of(line: Column, i: Column) -> Column:
        words = F.regexp_extract_all(line, F.lit(_WORD), F.lit(0))
        return F.when(F.size(words) == 0, gap).otherwise(F.transform(words, lambda w: F.struct(w.alias("w"), i.alias("line"))))

    return F.flatten(F.transform(F.split(text, "\n", -1), of))


def windows(docs: DataFrame, model: Model, *, id_col: str, text_col: str) -> DataFrame:
    """(id_, place_, win, held, line): the features of every window that has some, and for every document a row with a null ``win``.

    ``place_`` tells rows of one id apart.
    """
    lower = F.replace(F.lower(F.col(text_col)), F.lit("licence"), F.lit("license"))
    told = docs.select(F.col(id_col).alias("id_"), F.monotonically_increasing_id().alias("place_"), lower.alias("text_"))
    single = [g for g in model.grams if " " not in g]
    speaks = F.arrays_overlap(F.regexp_extract_all("text_", F.lit(_WORD), F.lit(0)), _constant(single, "array<string>"))
    denies = F.col("text_").rlike(r"\b(?:" + "|".join(sorted(_NEGATIONS)) + r")\b")
    listed = told.select("id_", "place_", F.when(F.coalesce(speaks | denies, F.lit(False)), _tokens(F.col("text_"))).alias("tokens"))
    after = F.concat(F.slice("tokens", 2, F.greatest(F.size("tokens") - 1, F.lit(0))), F.array(F.struct(F.lit("").alias("w"), F.lit(-1).alias("line"))))
    pairs = F.transform(
        F.arrays_zip(F.col("tokens").alias("here"), after.alias("next")),
        lambda t, i: F.struct(i.alias("at"), t["here"]["line"].alias("line"), t["here"]["w"].alias("w"), t["next"]["w"].alias("after")),
    )
    # One more element stands for the document itself, which may hold nothing known.
    kind = "array<struct<at:int,line:int,w:string,after:string>>"
    itself = F.array(F.lit(None)).cast(kind)
    each = listed.select("id_", "place_", F.explode(F.concat(F.coalesce(pairs.cast(kind), F.array().cast(kind)), itself)).alias("t"))
    pair = F.when((F.col("t.w") != "") & (F.col("t.after") != ""), F.concat_ws(" ", "t.w", "t.after"))
    grams = each.select("id_", "place_", "t.at", "t.line", F.explode(F.array("t.w", pair)).alias("gram"))
    vocabulary = docs.sparkSession.createDataFrame(list(enumerate(model.grams)), "row int, known string")
    seen = grams.join(F.broadcast(vocabulary), F.col("gram") == F.col("known"), "left").filter(F.col("row").isNotNull() | F.col("at").isNull())
    first = F.floor(F.col("at") / STEP).cast("int")
    wins = F.when(F.col("at").isNull(), F.array(F.lit(None).cast("int"))).when(first == 0, F.array(first)).otherwise(F.array(first - 1, first))
    spread = seen.select("id_", "place_", "row", F.struct("at", "line").alias("begin"), F.explode(wins).alias("win"))
    found = spread.groupBy("place_", "id_", "win").agg(F.collect_set("row").alias("held"), F.min("begin").alias("begin"))
    return found.select("id_", "place_", "win", "held", F.col("begin.line").alias("line"))


def scored(found: DataFrame, model: Model) -> DataFrame:
    """Adds ``family`` and ``p``, the probability of that class; both are null where a window reads as prose."""
    n = len(model.classes)
    table = _constant([list(w) for w in model.weights], "array<array<double>>")
    logits = F.aggregate("held", F.array(*[F.lit(b) for b in model.bias]), lambda acc, r: F.zip_with(acc, F.get(table, r), lambda a, b: a + b))
    told = found.withColumn("z", F.when(F.col("win").isNotNull(), logits)).withColumn("top", F.array_max("z"))
    told = told.withColumn("total", F.aggregate("z", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.col("top"))))
    told = told.withColumn("at", (F.array_position("z", F.col("top")) - 1).cast("int")).withColumn("best", 1 / F.col("total"))
    templates = _constant([{"c": c, "rows": list(rows), "need": need} for c, rows, need in model.templates], "array<struct<c:int,rows:array<int>,need:int>>")
    confirmed = F.exists(templates, lambda t: (t["c"] == F.col("at")) & (F.size(F.array_intersect(t["rows"], F.col("held"))) >= t["need"]))
    told = told.withColumn("known", (F.col("at") < n - 2) & (F.col("best") >= THRESHOLD) & confirmed)
    speaks = F.col("at") != n - 1
    family = F.when(F.col("known"), F.get(_constant(list(model.classes), "array<string>"), F.col("at"))).otherwise(F.lit(UNKNOWN))
    p = F.when(F.col("known"), F.col("best")).otherwise(F.exp(F.get("z", F.lit(n - 2)) - F.col("top")) / F.col("total"))
    return told.select("id_", "place_", "win", "line", F.when(speaks, family).alias("family"), F.when(speaks, F.round(p, 6)).alias("p"))


def license_lines(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``lines``, an array of (line number from 0, family, probability).

    Neighbouring windows of one family are one notice, on the line of its first known word, with the highest probability of its first two
    windows. Unknown windows beside a known notice belong to it; other neighbouring ones are one entry, with the probability of the
    unknown class. A null or empty text has none; repeated rows give repeated rows, null ids their own; an empty table gives no rows;
    other columns are ignored.
    """
    found = windows(docs, model, id_col=id_col, text_col=text_col)
    kind = "array<struct<line:int,family:string,probability:double>>"
    one = F.when(F.col("family").isNotNull(), F.struct("win", "line", "family", "p"))
    lists = scored(found, model).groupBy("place_", "id_").agg(F.array_sort(F.collect_list(one)).alias("all_"))
    kept = F.filter("all_", lambda x: (x["family"] != UNKNOWN) | ~F.exists("all_", lambda y: (y["family"] != UNKNOWN) & (F.abs(y["win"] - x["win"]) <= 1)))
    lists = lists.withColumn("kept", kept)
    starts = F.filter("kept", lambda x: ~F.exists("kept", lambda y: (y["family"] == x["family"]) & (y["win"] == x["win"] - 1)))

    def shown(x: Column) -> Column:
        mine = F.filter("kept", lambda y: (y["family"] == x["family"]) & ((y["win"] == x["win"]) | (y["win"] == x["win"] + 1)))
        return F.struct(x["line"].alias("line"), x["family"].alias("family"), F.array_max(F.transform(mine, lambda y: y["p"])).alias("probability"))

    lines = F.array_sort(F.transform(starts, shown)).cast(kind)
    return lists.select(F.col("id_").alias(id_col), lines.alias("lines" if id_col != "lines" else "lines_"))
