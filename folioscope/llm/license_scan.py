"""Licence detection by a trained paragraph classifier (operator 8).

A paragraph is a run of lines without a blank one. Of paragraphs that use the language of licences, each line, and each
sentence of the paragraph with its line breaks read as blanks (so that wrapped texts are whole), is classified by
multinomial logistic regression over word 1- to 3-grams, with an ``unknown`` class for talk about licences that grants
nothing, denials among it; what is longer than ``WINDOW`` words is read in overlapping windows. The classes are learnt from the usual
texts of each family, and from its names in sentences that grant and in sentences that do not. The unknown class is calibrated on
sentences left out by the frame they are made of: its bias is that of the fewest errors of either kind, and a temperature fits the
probabilities.

A piece declares something where the unknown class has less than half of the probability. It declares every family that has a share (``SHARE``) of the rest
and is confirmed by a comparison with the family's texts: one of its own terms stands there (words or pairs that no other
family and no talk has), or, for the family that has most of the rest, enough of the word pairs of one of its templates. So one sentence can declare several families, and a
form of words that no template has is found where it names the family.

The model is trained on the driver from the sentences below (made of a few hundred short texts, no corpus rows), and
applied as SQL: weights and terms are map literals of fixed size, and each document is judged within its row.
No shuffle, no join, no Python on the main path.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, table

#: The usual sentences by which texts declare a licence of each family.
TEMPLATES = {
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "This program is free software under the terms of the GNU Affero General Public License as published by the Free Software Foundation.", "Released under the AGPL.", "SPDX-License-Identifier: AGPL-3.0-or-later", "License: AGPL-3.0", "GNU Affero General Public License"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License 2.0", "License: Apache-2.0", "Apache License, Version 2.0", "is Apache 2.0 licensed"],
    "BSD": ["Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "Distributed under the 2-Clause BSD license.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "SPDX-License-Identifier: BSD-3-Clause", "Licensed under the BSD License", "License: BSD", "BSD 3-Clause License", "BSD 2-Clause License", "is BSD licensed"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Available under the Creative Commons Attribution license.", "SPDX-License-Identifier: CC-BY-4.0", "Creative Commons Attribution 4.0 International", "License: CC-BY-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License.", "SPDX-License-Identifier: CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International", "License: CC-BY-SA-4.0"],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0 Universal.", "Dedicated to the public domain under CC0.", "SPDX-License-Identifier: CC0-1.0", "License: CC0-1.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.", "Released under the GPL.", "Licensed under GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GPL", "License: GPL", "License: GPLv3", "License: GPLv2", "GNU General Public License", "is GPL licensed"],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "SPDX-License-Identifier: ISC", "Licensed under the ISC License", "License: ISC", "The ISC License"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "This library is free software under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.", "Released under the LGPL.", "SPDX-License-Identifier: LGPL-2.1-or-later", "License: LGPL", "GNU Lesser General Public License"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "Distributed under the terms of the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "SPDX-License-Identifier: MIT", "License: MIT", "The MIT License", "MIT License", "is MIT licensed"],
    "MPL": ["Licensed under the Mozilla Public License, version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0", "License: MPL-2.0", "Mozilla Public License Version 2.0"],
    "Proprietary": ["All rights reserved.", "Copyright 2020 Example Company. All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.", "No part of this publication may be reproduced without prior written permission of the publisher."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense"],
}
#: The names of each family in running text.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "AGPL", "AGPLv3", "AGPL-3.0", "GNU AGPL version 3"], "Apache-2.0": ["Apache License", "Apache License, Version 2.0", "Apache 2.0 license", "Apache-2.0", "Apache license"], "Artistic": ["Artistic License", "Artistic License 2.0", "Artistic-2.0"],
    "BSD": ["BSD License", "3-Clause BSD License", "2-Clause BSD License", "New BSD license", "BSD-3-Clause", "BSD-style license"], "Boost": ["Boost Software License", "Boost Software License 1.0", "BSL-1.0"], "CC-BY": ["Creative Commons Attribution 4.0 License", "CC BY 4.0", "CC-BY-4.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial License", "CC BY-NC 4.0", "CC BY-NC-SA 4.0"], "CC-BY-ND": ["Creative Commons Attribution-NoDerivatives License", "CC BY-ND 4.0"], "CC-BY-SA": ["Creative Commons Attribution-ShareAlike License", "CC BY-SA 4.0", "CC-BY-SA-3.0"], "CC0": ["CC0", "CC0 1.0"],
    "CDDL": ["Common Development and Distribution License", "CDDL", "CDDL-1.0"], "EPL": ["Eclipse Public License", "EPL", "EPL-2.0"], "EUPL": ["European Union Public Licence", "EUPL", "EUPL-1.2"], "GPL": ["GNU General Public License", "GNU GPL", "GPL", "GPLv2", "GPLv3", "GNU GPL version 2 or later"],
    "ISC": ["ISC License", "ISC"], "LGPL": ["GNU Lesser General Public License", "LGPL", "LGPLv3", "GNU LGPL version 2.1"], "MIT": ["MIT License", "MIT software license", "MIT", "MIT/X11 license", "Expat license"], "MPL": ["Mozilla Public License", "MPL", "MPL-2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["Unlicense"], "zlib": ["zlib License", "zlib/libpng license"],
}
#: The words and pairs of words that stand for one family only.
TERMS = {
    "AGPL": ["affero", "agpl", "agplv3"], "Apache-2.0": ["apache"], "Artistic": ["artistic license", "artistic 2.0"], "BSD": ["bsd"], "Boost": ["boost software", "bsl 1.0"], "CC-BY": ["attribution 4.0", "attribution 3.0", "attribution license", "by 4.0", "by 3.0"],
    "CC-BY-NC": ["noncommercial", "by nc"], "CC-BY-ND": ["noderivatives", "by nd"], "CC-BY-SA": ["sharealike", "by sa"], "CC0": ["cc0"], "CDDL": ["cddl", "common development"], "EPL": ["epl", "eclipse public"], "EUPL": ["eupl", "union public"],
    "GPL": ["gnu general", "gpl", "gplv2", "gplv3"], "ISC": ["isc"], "LGPL": ["lgpl", "lgplv2", "lgplv3", "lesser general"], "MIT": ["mit", "expat license"], "MPL": ["mpl", "mozilla public"], "Unlicense": ["unlicense"], "zlib": ["zlib"],
}
#: Sentences that grant under a name, and that speak of it without granting or deny it.
GRANTS = [
    "Licensed under the {}.", "Released under the {}.", "Distributed under the terms of the {}.", "This project is licensed under the {}.", "The code is available under {}.", "This software is provided under the {}, see the file for details.", "The project uses the {}.",
    "It is distributed under {} terms.", "This library is covered by the {}.", "You may use it under the terms of the {}.", "All sources are made available under the {}.", "Dual-licensed under {} and", "Dual licensed under and {}.", "License: {}", "The package is {} licensed.",
    "This work is subject to the terms of the {}.", "Use of this code is governed by the {}.", "You can redistribute it under {}.", "Copyright by the authors, {}.", "The files may be copied under the conditions of the {}.", "Distributed under the {}, see the accompanying file.", "Choose either {} or", "under either of or {} at your option",
]
DENIALS = [
    "Not licensed under the {}.", "This is not released under the {}.", "The code was never distributed under the {}.", "The {} was discussed at the meeting.", "An article compared the {} with others.", "It is incompatible with the {}.", "She wrote a book about the {}.", "The project is no longer available under the {}.",
    "The history of the {} is long.", "We do not accept code under the {}.", "The author of the {} gave a talk.", "Lawyers disagree about the {}.", "Unlike the {} ours is closed.", "A translation of the {} was printed.", "The software is not {} licensed.", "It cannot be licensed under {}.", "Nobody has read the {}.", "This project does not use the {}.",
    "She studied at {} and sells licences.", "Engineers at {} hold many patents and licenses.", "{} compatible licenses are allowed.", "They have never released anything under the {}.", "We never put it under the {}.", "Licenses such as the {} are popular.", "What does the {} say about patents?",
    "The {} is older than other licenses.", "A professor at {} licensed her patents.", "The {} does not apply here.", "He and {} license the invention.", "People from {} met and licensed their work.", "Compare the licenses, for example {}.", "Without the {} nothing would be shared.",
]
#: Sentences that speak of licences and rights without granting any: examples of the unknown class.
UNKNOWN = [
    "He lost his driving licence last year.", "The license fee will rise next month.", "A licence is required to sell alcohol here.", "The court discussed copyright law and fair use.",
    "They decided to license the patent to a rival.", "Her poetic license surprised the critics.", "The public domain of the city is crowded.", "General public opinion on software was mixed.",
    "The station renewed its broadcasting licence.", "Copyright disputes took years to settle.", "We compared the MIT campus with Stanford.", "The Apache helicopter landed at noon.",
    "The Mozilla browser was released in version 2.0.", "Creative people in the commons met on Friday.", "The version 3 of the plan is public.", "GNU tools are used by many programmers.",
    "A software licence can be bought from the company.", "The license plate was unreadable.", "Permission to enter the site is granted by the guard.", "The human rights convention was signed.",
    "Please read the license before installing.", "Licensed plumbers must register each year.", "The licensing board rejected the request.", "All rights of way are marked on the map.",
    "MIT licensed the patent to a startup company.", "The GPL was discussed at the meeting of the board.", "Apache and BSD are names of projects and of families of software.", "An article compared the licenses of many programs.",
    "License", "Copyright", "See the license for details.", "Terms of the agreement are confidential.", "Redistribution of wealth was a topic of debate.", "Free software is a matter of liberty.",
]
#: A text without any of these cannot match a template, and is of unknown class by rule.
TRIGGER = r"(?i)licen[sc]|rights reserved|public domain|\bCC0\b|\bCC[ -]BY\b|permission (?:is|to)|redistribution and use|\b(?:[AL]?GPL(?:v[0-9])?|EUPL|MPL|EPL|CDDL)\b|proprietary and confidential|prior written permission|waived all copyright|creative commons attribution"
#: A word, or a version of at most 21 numbers; an unbounded repeat of a group would be a call on the stack for each part.
WORDS = r"[\p{L}\p{N}]+(?:[.][0-9]+){0,20}"
NGRAMS = 3
WINDOW = 60
MATCH = 0.7
#: Of the probability that is not unknown, what a family has at least to be declared; grams of fewer training sentences are not in the model.
SHARE, LEAST = 0.03, 3
#: Maps that the weights are dealt to, as a map is searched from its start.
SLOTS = 1024


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.][0-9]+){0,20}", text.lower())


def grams(w: list[str], most: int = NGRAMS) -> list[str]:
    return sorted({" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)})


def _softmax(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _fit(x: np.ndarray, y: np.ndarray, k: int, steps: int = 250, l2: float = 1e-3) -> np.ndarray:
    """Weights (grams + 1) x classes by accelerated gradient descent; classes weigh alike."""
    x = np.c_[x, np.ones(len(x))].astype(np.float32)
    target = np.eye(k, dtype=np.float32)[y]
    weight = (1 / np.maximum(np.bincount(y, minlength=k), 1))[y].astype(np.float32)
    weight /= weight.sum()
    w = np.zeros((x.shape[1], k), np.float32)
    v, rate = w.copy(), np.float32(4.0 / (x**2).sum(1).max() * len(set(y)))
    for t in range(steps):
        g = x.T @ ((_softmax(x @ v) - target) * weight[:, None]) + np.float32(l2 / len(x)) * v
        new = v - rate * g
        v = new + np.float32(t / (t + 3)) * (new - w)
        w = new
    return w.astype(np.float64)


def examples() -> list[tuple[list[str], str, str]]:
    """(words, family or unknown, frame): templates, shortened too so that no single word decides, names in their frames, and talk."""
    out = []
    for family, texts in [*TEMPLATES.items(), ("unknown", UNKNOWN)]:
        for t in texts:
            w = words(t)
            out += [(w, family, t), *((w[:-1], family, t) for _ in range(len(w) > 5)), *((w[1:], family, t) for _ in range(len(w) > 5))]
    out += [(words(f.format(n)), family, f) for family, names in NAMES.items() for n in names for f in GRANTS]
    out += [(words(f.format(n)), "unknown", f) for names in NAMES.values() for n in names for f in DENIALS]
    return out


def classes() -> tuple[str, ...]:
    return (*sorted({*TEMPLATES, *NAMES}), "unknown")


@functools.lru_cache(1)
def train() -> tuple[dict[str, list[float]], list[float], tuple[str, ...]]:
    """Weights by gram, biases, and class names (unknown last)."""
    names, made = classes(), examples()
    counts: dict[str, int] = {}
    for w, _, _ in made:
        for g in grams(w):
            counts[g] = counts.get(g, 0) + 1
    at = {g: k for k, g in enumerate(sorted(g for g, n in counts.items() if n >= LEAST))}
    x = np.zeros((len(made), len(at)))
    for r, (w, _, _) in enumerate(made):
        x[r, [at[g] for g in grams(w) if g in at]] = 1
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    y = np.array([names.index(f) for _, f, _ in made])
    u, left_out = len(names) - 1, np.zeros((len(made), len(names)))
    fold = np.array([hash_of(frame) % 5 for _, _, frame in made])  # a frame is left out with all its names
    for f in range(5):
        left_out[fold == f] = np.c_[x, np.ones(len(x))][fold == f] @ _fit(x[fold != f], y[fold != f], len(names))
    bias, heat = calibrated(left_out, y, u)
    w = _fit(x, y, len(names))
    w[-1, u] += bias
    w /= heat
    return {g: [round(float(v), 3) for v in w[k]] for g, k in at.items()}, [float(v) for v in w[-1]], names


def calibrated(z: np.ndarray, y: np.ndarray, u: int) -> tuple[float, float]:
    """The bias of class ``u`` of fewest errors, the sum of the shares of other rows taken for it and of its rows taken for
    others (the middle of the best biases), and the temperature of least loss, of left-out logits."""
    gap = z[:, :u].max(1) - z[:, u]
    tried = np.sort(np.concatenate([gap - 1e-9, gap + 1e-9]))
    errors = np.array([(gap[y != u] <= b).mean() + (gap[y == u] > b).mean() for b in tried])
    bias = float(np.median(tried[errors <= errors.min() + 1e-12]))
    z = z.copy()
    z[:, u] += bias
    loss = {t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in np.geomspace(0.1, 10, 41)}
    return bias, float(min(loss, key=loss.get))


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


def _quoted(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def judged(p: str, match: float) -> str:
    """SQL array of structs (family, probability, similarity) of a piece of a paragraph."""
    weights, bias, names = train()
    known = f"array({', '.join(map(_quoted, names[:-1]))})"
    slots = [{g: v for g, v in weights.items() if hash_of(g) % SLOTS == k} for k in range(SLOTS)]
    model = f"from_json({_quoted(json.dumps(slots))}, 'array<map<string,array<double>>>')"
    pairs = {n: [sorted({" ".join(w[i : i + 2]) for i in range(len(w) - 1)} or set(w)) for w in map(words, t)] for n, t in TEMPLATES.items()}
    templates = f"from_json({_quoted(json.dumps(pairs))}, 'map<string,array<array<string>>>')"
    gram = lambda n: f"if(size(w) >= {n}, transform(sequence(1, size(w) - {n - 1}), i -> array_join(slice(w, i, {n}), ' ')), cast(array() as array<string>))"
    found = f"array_distinct(concat({', '.join(gram(n) for n in range(1, NGRAMS + 1))}))"
    # grams outside the vocabulary weigh nothing, and do not lengthen the vector
    rows = f"filter(transform(g, k -> try_element_at(model[cast(crc32(k) % {SLOTS} as int)], k)), v -> v is not null)"
    logits = f"transform(aggregate(r, array_repeat(0D, {len(names)}), (s, v) -> zip_with(s, v, (a, b) -> a + b)), v -> v / sqrt(greatest(size(r), 1)))"
    z = f"zip_with({logits}, array({', '.join(f'{b!r}D' for b in bias)}), (a, b) -> a + b)"
    mine = "array_distinct(if(size(w) > 1, transform(sequence(1, size(w) - 1), i -> array_join(slice(w, i, 2), ' ')), w))"
    similar = f"coalesce(array_max(transform(try_element_at({templates}, x.family), t -> size(array_intersect(m, t)) / cast(size(t) as double))), 0D)"
    own = f"from_json({_quoted(json.dumps(TERMS))}, 'map<string,array<string>>')"
    named = f"coalesce(arrays_overlap(try_element_at({own}, x.family), g), false)"
    unknown = f"p[{len(names) - 1}]"
    likely = f"filter(transform({known}, (f, k) -> named_struct('family', f, 'probability', p[k])), x -> {unknown} < 0.5D and x.probability >= {SHARE}D * (1 - {unknown}))"
    compared = f"transform({likely}, x -> named_struct('family', x.family, 'probability', x.probability, 'similarity', {similar}, 'named', {named}))"
    out = f"transform(filter({compared}, x -> x.named or (x.similarity >= {match}D and x.probability >= 0.5D * (1 - {unknown}))), x -> named_struct('family', x.family, 'probability', x.probability, 'similarity', x.similarity))"
    softmax = "element_at(transform(array(transform(z, v -> exp(v - array_max(z)))), e -> transform(e, v -> v / aggregate(e, 0D, (t, n) -> t + n))), 1)"
    for name, value in (("m", mine), ("p", softmax), ("z", z), ("r", rows), ("g", found), ("model", model), ("w", f"regexp_extract_all(lower({p}), {_quoted('(' + WORDS + ')')}, 1)")):
        out = f"element_at(transform(array({value}), {name} -> {out}), 1)"
    return out


_FOUND = "array<struct<family:string,probability:double,similarity:double,paragraph:int>>"


def candidates(paragraph: str) -> str:
    """SQL array of the lines and sentences of a paragraph that use the language of licences, long ones in windows."""
    sentences = f"split(regexp_replace({paragraph}, '[ \\\\t\\\\r\\\\n]+', ' '), '(?<=[.;:!?]) ')"
    windows = f"transform(sequence(0, size(v) - 1, {WINDOW // 2}), i -> array_join(slice(v, i + 1, {WINDOW}), ' '))"
    cut = f"if(size(v) <= {WINDOW}, array(x), {windows})"
    parts = f"transform(filter(concat(split({paragraph}, '\\\\n'), {sentences}), x -> x rlike {_quoted(TRIGGER)}), x -> element_at(transform(array(split(x, '[ \\\\t\\\\r]+')), v -> {cut}), 1))"
    return f"filter(array_distinct(flatten({parts})), x -> x rlike {_quoted(TRIGGER)})"


def scan(docs: DataFrame, match: float = MATCH, column: str = "text") -> DataFrame:
    """``docs`` with ``licences``: array of (family, probability, similarity, paragraph), one for each family that a paragraph
    declares, the surest of its places, in order of paragraphs (from 0) and families.

    Null and empty texts have none. Rows, repeated ones too, and other columns stay as they are; a user's column ``licences``
    is replaced. Long texts are read whole; an empty table gives no rows.
    """
    paragraphs = f"filter(transform(split({column}, '\\\\n[ \\\\t\\\\r]*+\\\\n[ \\\\t\\\\r\\\\n]*+', -1), (p, i) -> named_struct('p', p, 'i', i)), x -> x.p rlike {_quoted(TRIGGER)})"
    best = "array_max(transform(filter(s, y -> y.family = f), y -> named_struct('probability', y.probability, 'similarity', y.similarity)))"
    merged = f"transform(array_sort(array_distinct(transform(s, y -> y.family))), f -> element_at(transform(array({best}), y -> named_struct('family', f, 'probability', y.probability, 'similarity', y.similarity, 'paragraph', x.i)), 1))"
    each = f"element_at(transform(array(flatten(transform({candidates('x.p')}, c -> {judged('c', match)}))), s -> {merged}), 1)"
    found = f"if({column} rlike {_quoted(TRIGGER)}, flatten(transform({paragraphs}, x -> {each})), cast(array() as {_FOUND}))"
    return docs.withColumn("licences", F.coalesce(F.expr(found), F.expr(f"cast(array() as {_FOUND})")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row of documents: families (distinct, sorted, comma-joined), n_licences, and the surest family with its
    probability and template similarity (null where there is none)."""
    docs = scan(columns(table(spark, sf_dir, "documents"), doc_id="long", text="string"))
    docs = docs.withColumn("best", F.expr("array_max(transform(licences, x -> named_struct('probability', x.probability, 'similarity', x.similarity, 'family', x.family)))"))
    return docs.select("doc_id", F.expr("array_join(array_sort(array_distinct(transform(licences, x -> x.family))), ',')").alias("families"), F.size("licences").cast("long").alias("n_licences"), F.col("best.family").alias("family"), F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"))
