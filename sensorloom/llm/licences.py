"""Licence families of paragraphs: a logistic regression on word n-grams, confirmed by templates.

The model is fitted on the driver from the statements below; texts are scored by built-in
functions alone.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statements by which licences of each family are named or granted.
TEMPLATES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under AGPL-3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "cc0": [
        "Licensed under CC0 1.0 Universal.",
        "Released into the public domain under CC0.",
        "This work is dedicated to the public domain.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under LGPL-3.0.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Confidential and proprietary. All rights reserved."],
}
#: Headings of licence texts, which confirm a line that holds nothing else.
HEADINGS = {
    "agpl": ["GNU Affero General Public License", "GNU Affero General Public License Version 3"],
    "apache": ["Apache License", "Apache License 2.0", "Apache License Version 2.0", "Apache License Version 2.0, January 2004"],
    "bsd": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "The BSD License", "The 3-Clause BSD License"],
    "cc0": ["CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International", "Attribution 4.0 International"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International", "Attribution-NonCommercial 4.0 International"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International", "Attribution-ShareAlike 4.0 International"],
    "gpl": ["GNU General Public License", "GNU General Public License Version 2", "GNU General Public License Version 3"],
    "lgpl": ["GNU Lesser General Public License", "GNU Lesser General Public License Version 2.1", "GNU Lesser General Public License Version 3"],
    "mit": ["MIT License", "The MIT License", "The MIT License MIT"],
    "mpl": ["Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0"],
}
#: SPDX identifiers of each family.
SPDX = {
    "agpl": "agpl-[0-9].*", "apache": "apache-[0-9].*", "bsd": "0?bsd(-[0-9]-clause.*)?", "cc0": "cc0-[0-9].*",
    "cc-by": "cc-by-[0-9].*", "cc-by-nc": "cc-by-nc-[0-9].*", "cc-by-sa": "cc-by-sa-[0-9].*",
    "gpl": "gpl-[0-9].*", "lgpl": "lgpl-[0-9].*", "mit": "mit(-.*)?", "mpl": "mpl-[0-9].*",
}
TAG = "spdx-license-identifier"
#: Statements with words of licences that name none.
OTHER = [
    "You need a license to drive a car.",
    "The license was granted by the city.",
    "Version 2.0 was released under a new name.",
    "The rights of the public are reserved to the state.",
    "Permission is required to use the software.",
    "See the license file for details.",
    "This software is licensed to the person named above.",
    "All of the general public may obtain a copy of the source code.",
    "The university of MIT released a work under the terms of the program.",
    "The apache helicopter and the gnu are free to use.",
    "A creative person works in the public domain of the commons.",
]
#: Words that make no feature by themselves.
STOP = set("a above all and any are at be by can for form free in into is it may met new of or see that the this to under use v was with without work works you".split())

#: Stems of which every statement holds one; nothing is left out for want of them.
ANCHORS = ["licens", "licenc", "rights reserved", "public domain", "hereby granted", "redistribut", "copyright", "creative commons", "mozilla public", "gpl", "cc0", "bsd"]

WORD = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
#: What ends a run of lines: the end of a line that ends a sentence, or a line without words.
SENTENCES = r"(?<=[.!?:;])[^\p{L}\p{N}\r\n]*[\r\n]+|(?>\r\n|[\r\n])[^\p{L}\p{N}\r\n]*(?>\r\n|[\r\n])"
UNKNOWN = "unknown"
#: Words of an n-gram; noisy copies of each statement; steps and penalty of the fit.
GRAMS, COPIES, STEPS, LASSO = 3, 24, 400, 2e-4
#: Calibrated probability that names a family, and the share of a template's word pairs that a
#: paragraph must hold to confirm it.
CERTAIN, CONFIRMED = 0.5, 0.6


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", text.lower())


def grams_of(words: list[str], sizes=range(1, GRAMS + 1)) -> set[str]:
    return {" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}


@dataclass
class Model:
    """``weights[gram, family]``; the last family is the unknown one. A gram holds at least one word
    that is not in ``STOP``; a paragraph without any is unknown by the bias."""

    families: list[str]
    grams: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[tuple[int, list[str]]]

    def cues(self) -> list[str]:
        """Words without which no family can outweigh the unknown one: of all words in n-grams,
        the common ones are left out as long as the n-grams made of those left out alone have too
        little weight for any family."""
        ahead = self.weights[:, :-1] - self.weights[:, -1:]
        out: set[str] = set()
        words = {w for g in self.grams for w in g.split() if w not in STOP}
        for word in sorted(words, key=lambda w: (len(w), w)):
            some = out | {word}
            rows = [set(g.split()) <= some | STOP for g in self.grams]
            most = self.bias[:-1] - self.bias[-1] + np.maximum(ahead[rows], 0).sum(axis=0)
            if most.max() < 0:
                out = some
        cues = words - out
        # a heading stands for a statement
        found = [words_of(h) for texts in HEADINGS.values() for h in texts]
        return sorted(cues | {max(h, key=len) for h in found if not cues & set(h)})


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(templates: dict[str, list[str]] = TEMPLATES, other: list[str] = OTHER) -> Model:
    """Learns from noisy copies of the statements: words of a licence are left out at random, and
    unknown ones get all statements' words in random order. Every fifth copy sets the temperature
    alone."""
    random = np.random.default_rng(0)
    families = [*sorted(templates), UNKNOWN]
    statements = [(families.index(f), words_of(t)) for f in sorted(templates) for t in templates[f]]
    all_words = sorted({w for _, words in statements for w in words})
    rows: list[tuple[int, set[str], bool]] = []
    unknown = len(families) - 1
    for label, words in statements + [(unknown, words_of(t)) for t in other]:
        for copy in range(COPIES):
            kept = [w for w in words if copy == 0 or random.random() > 0.1]
            rows.append((label, grams_of(kept), copy % 5 == 4))
    for copy in range(COPIES * 20):
        some = random.choice(all_words, int(random.integers(1, 9)))
        rows.append((unknown, grams_of(list(some)), copy % 5 == 4))
    grams = sorted(
        g for g in set().union(*(grams_of(w) for _, w in statements)) if not set(g.split()) <= STOP
    )
    index = {g: i for i, g in enumerate(grams)}
    x = np.zeros((len(rows), len(grams)))
    for i, (_, found, _) in enumerate(rows):
        x[i, [index[g] for g in found if g in index]] = 1
    y = np.eye(len(families))[[label for label, _, _ in rows]]
    aside = np.array([a for _, _, a in rows])
    learn, labels = x[~aside], y[~aside]
    # accelerated proximal gradient: the lasso leaves few weights
    w, b = np.zeros((len(grams), len(families))), np.zeros(len(families))
    rate = 2 * len(learn) / np.linalg.norm(np.hstack([learn, np.ones((len(learn), 1))]), 2) ** 2
    w0, b0 = w, b
    for step in range(STEPS):
        m = step / (step + 3)
        at, bias = w + m * (w - w0), b + m * (b - b0)
        g = (_softmax(learn @ at + bias) - labels) / len(learn)
        w0, b0 = w, b
        moved = at - rate * learn.T @ g
        w = np.sign(moved) * np.maximum(np.abs(moved) - rate * LASSO, 0)
        b = bias - rate * g.sum(axis=0)
    logits, held = x[aside] @ w + b, y[aside].astype(bool)
    grid = np.exp(np.linspace(np.log(0.1), np.log(5), 80))
    losses = [-np.log(np.maximum(_softmax(logits / t)[held], 1e-12)).mean() for t in grid]
    if b.argmax() != unknown:
        raise ValueError("a paragraph without any n-gram of a licence is not unknown")
    used = np.flatnonzero(np.abs(w).max(axis=1) > 0)
    kept = [grams[i] for i in used]
    return Model(
        families,
        kept,
        w[used].round(6),
        b.round(6),
        float(grid[int(np.argmin(losses))]),
        [(label, sorted(grams_of(words, (2,)))) for label, words in statements],
    )


def _numbers(values) -> Column:
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _grams(words: Column, n: int) -> Column:
    made = words
    for k in range(1, n):
        rest = F.slice(words, F.lit(k + 1), F.size(words))
        made = F.zip_with(made, rest, lambda a, b: F.concat(a, F.lit(" "), b))
    # what ran over the end is NULL
    return F.filter(made, lambda g: g.isNotNull()) if n > 1 else made


def _stated(words: Column) -> Column:
    """The words; of a heading, those of its family's first statement."""
    line = F.array_join(words, " ")
    for family, texts in HEADINGS.items():
        statement = F.array(*[F.lit(w) for w in words_of(TEMPLATES[family][0])])
        words = F.when(line.isin([" ".join(words_of(h)) for h in texts]), statement).otherwise(words)
    return words


def _tagged(text: Column) -> Column:
    """For every SPDX identifier that a tag in the text names, its family's first statement."""
    tags = F.regexp_extract_all(text, F.lit(TAG + r":([^\r\n]*)"), F.lit(1))
    ids = F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(t, F.lit(r"[a-z0-9.\-]+"), F.lit(0))))

    def statement(id: Column) -> Column:
        said = F.lit(None).cast("string")
        for family, form in SPDX.items():
            said = F.when(id.rlike(f"^{form}$"), F.lit(TEMPLATES[family][0].lower())).otherwise(said)
        return said

    return F.filter(F.transform(ids, statement), lambda t: t.isNotNull())


def paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``found``: for every line, and every run of lines up to one that ends a
    sentence or comes before a line without words, in order, a struct of family, probability,
    match, the best template's share of word pairs held, and whether it is such a run. Those that
    hold none of the model's cues are left out, as they can only be unknown."""
    cues = model.cues()

    def anchored(p: Column) -> Column:
        return reduce(lambda a, b: a | b, [p.contains(x) for x in cues])

    grams = F.from_json(F.lit(json.dumps(model.grams)), "array<string>")
    bias, k = _numbers(model.bias), len(model.families)
    weights = _numbers(model.weights.T.ravel())
    names = F.array(*[F.lit(f) for f in model.families])
    templates = F.from_json(
        F.lit(json.dumps([{"f": model.families[f], "pairs": pairs} for f, pairs in model.templates])),
        "array<struct<f string, pairs array<string>>>",
    )

    def logits(slots: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(k - 1)),
            lambda f: F.aggregate(
                slots,
                F.get(bias, f),
                lambda a, i: a + F.get(weights, f * len(model.grams) + i.cast("int") - 1),
            )
            / F.lit(model.temperature),
        )

    def best(x: Column) -> Column:
        total = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.exp(v - F.array_max(x)))
        return F.struct(
            F.get(names, (F.array_position(x, F.array_max(x)) - 1).cast("int")).alias("family"),
            (1 / total).alias("p"),
        )

    def match(pair: Column) -> Column:
        family, words = pair["best"]["family"], pair["words"]
        held = F.transform(
            F.filter(templates, lambda t: t["f"] == family),
            lambda t: F.size(F.array_intersect(t["pairs"], _grams(words, 2))) / F.size(t["pairs"]),
        )
        return F.struct(
            family.alias("family"),
            pair["best"]["p"].alias("p"),
            F.coalesce(F.array_max(held), F.lit(0.0)).alias("match"),
            pair["run"].alias("run"),
        )

    # most texts end at this test, which is plain search of bytes
    text = F.lower(F.col("text").cast("string"))
    tagged = text.contains(TAG)
    none = F.array().cast("array<string>")
    plain = F.when(tagged, F.regexp_replace(text, r"[^\r\n]*" + TAG + r":[^\r\n]*", "\n\n")).otherwise(text)
    lines = F.filter(F.split(plain, r"[\r\n]+"), anchored)
    runs = F.filter(F.split(plain, SENTENCES), lambda p: p.rlike(r"[\r\n]") & anchored(p))
    lines = F.concat(lines, F.when(tagged, _tagged(text)).otherwise(none))

    def words(parts: Column, run: bool) -> Column:
        def of(p: Column) -> Column:
            found = F.regexp_extract_all(p, F.lit(WORD), F.lit(0))
            return F.struct(_stated(found).alias("words"), F.lit(run).alias("run"))

        return F.transform(parts, of)

    parts = F.when(anchored(text) | tagged, F.concat(words(lines, False), words(runs, True)))
    return (
        docs.withColumn("parts", F.coalesce(parts, F.array().cast("array<struct<words:array<string>,run:boolean>>")))
        .withColumn("words", F.col("parts.words"))
        .withColumn("run", F.col("parts.run"))
        .withColumn(
            "slots",
            F.transform(
                "words",
                lambda w: F.transform(
                    F.array_intersect(F.concat(*[_grams(w, n) for n in range(1, GRAMS + 1)]), grams),
                    lambda g: F.array_position(grams, g),
                ),
            ),
        )
        .withColumn("best", F.transform(F.transform("slots", logits), best))
        .withColumn("found", F.transform(F.arrays_zip("best", "words", "run"), match))
    )


def scanned(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, licences, n_paragraphs, n_unconfirmed, score`` of every row of ``docs(doc_id, text)``.

    A paragraph is what stands between line breaks, or a notice wrapped over several lines: a run of
    lines up to the end of a sentence or a line without words, which counts where none of its
    lines names its family. Headings of licences that fill a line and SPDX tags stand for their
    family's first statement. ``licences`` lists the families, sorted and
    joined by commas, that the classifier names with probability ``CERTAIN`` or more and of which a
    template confirms at least ``CONFIRMED``; it is empty if there is none. ``n_paragraphs`` counts
    the paragraphs confirmed, ``n_unconfirmed`` those named only; ``score`` is the greatest
    probability of a confirmed one, else 0. NULL and empty texts have none. Rows with a NULL doc_id
    and repeated rows stay. Other columns are ignored; every row is scored where it is read,
    nothing is shuffled.
    """
    model = model or fit()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = F.filter("found", lambda x: (x["family"] != UNKNOWN) & (x["p"] >= CERTAIN))
    return (
        paragraphs(rows, model)
        .select("doc_id", named.alias("named"))
        .withColumn("lines", F.filter("named", lambda x: ~x["run"]))
        .withColumn("sure", F.filter("lines", lambda x: x["match"] >= CONFIRMED))
        .withColumn(
            "runs",
            F.filter(
                "named",
                lambda x: x["run"]
                & F.when(x["match"] >= CONFIRMED, ~F.array_contains("sure.family", x["family"]))
                .otherwise(~F.array_contains("lines.family", x["family"])),
            ),
        )
        .withColumn("named", F.concat("lines", "runs"))
        .withColumn("sure", F.filter("named", lambda x: x["match"] >= CONFIRMED))
        .select(
            "doc_id",
            F.array_join(F.array_sort(F.array_distinct(F.col("sure.family"))), ",").alias("licences"),
            F.size("sure").cast("long").alias("n_paragraphs"),
            (F.size("named") - F.size("sure")).cast("long").alias("n_unconfirmed"),
            F.coalesce(F.array_max(F.col("sure.p")), F.lit(0.0)).alias("score"),
        )
    )
