import re

import numpy as np
from pyspark.sql import functions as F

from sensorloom.llm import licences

SCHEMA = "doc_id long, text string, words string, found int, best int"


def brute(text, model):
    found = []
    for line in re.split(r"[\r\n]+", (text or "").lower()):
        if not any(a in line for a in licences.ANCHORS):
            continue
        words = licences.words_of(line)
        grams = licences.grams_of(words)
        x = model.bias + sum((model.weights[i] for i, g in enumerate(model.grams) if g in grams), 0 * model.bias)
        p = np.exp(x / model.temperature - (x / model.temperature).max())
        p /= p.sum()
        at = int(p.argmax())
        match = max((len(set(t) & grams) / len(t) for f, t in model.templates if f == at), default=0)
        if model.families[at] != licences.UNKNOWN and p[at] >= licences.CERTAIN:
            found.append((model.families[at], p[at], match))
    sure = [f for f in found if f[2] >= licences.CONFIRMED]
    return ",".join(sorted({f[0] for f in sure})), len(sure), len(found) - len(sure), round(max([f[1] for f in sure], default=0.0), 6)


def test_against_brute_force_and_no_python_in_the_plan(spark):
    texts = [t for f in licences.TEMPLATES.values() for t in f] + licences.OTHER
    texts += ["Intro.\nReleased under the MIT License.\r\nAll rights reserved.\n", None, "", "\n\n", "licensed"]
    texts += ["word " * 30_000 + "\nLicensed under CC BY 4.0.", "x\nThe MIT License of apache 2.0 gpl", "große licence ß"]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, texts[0], "x", 1, 2)] * 2
    model = licences.fit()
    out = licences.scanned(spark.createDataFrame(rows, SCHEMA), model)
    got = sorted((str(r[0]), *r[1:4], round(r[4], 6)) for r in out.collect())
    assert got == sorted((str(i), *brute(t, model)) for i, t, *_ in rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow(?!ay)|Exchange", plan)


def test_every_statement_is_found_as_its_family(spark):
    rows = [(f, t) for f, texts in licences.TEMPLATES.items() for t in texts]
    rows += [("", t) for t in licences.OTHER]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licences.scanned(docs).collect()}
    assert got == {i: f for i, (f, _) in enumerate(rows)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert licences.scanned(docs).agg(F.count("*")).first()[0] == 0


WRAPPED = {
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n\n1. Redistributions of source code must retain the above copyright\n   notice.\n",
    "gpl": " * This program is free software: you can redistribute it and/or modify\r\n * it under the terms of the GNU General Public License as published by\r\n * the Free Software Foundation, either version 3 of the License, or\r\n * (at your option) any later version.\r\n *\r\n",
    "agpl": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as published\n# by the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software.\n",
    "apache": "Licensed under the Apache License,\nVersion 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\n",
    "mpl": "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one.\n",
}


def test_wrapped_notices_headings_and_tags(spark):
    cases = [(f, t) for f, t in WRAPPED.items()]
    cases += [(f, "Some words before.\n\n" + t + "\nint main() {}") for f, t in WRAPPED.items()]
    cases += [(f, f"intro\n\n{h}\n\nmore words") for f, texts in licences.HEADINGS.items() for h in texts]
    cases += [
        ("mit", "// SPDX-License-Identifier: MIT\n#include <stdio.h>\nint a;"),
        ("apache,mit", "x\n# SPDX-License-Identifier: (MIT OR Apache-2.0)\r\ny"),
        ("gpl", "/* SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */"),
        ("apache,mit", "Licensed under the MIT License\nLicensed under the Apache License, Version 2.0"),
        ("", "SPDX-License-Identifier: CC-BY-ND-4.0"), ("", "The gnu\nis free\nto use 2.0 and 3"),
        ("", "The version\nof the source was moved to the public library. 3"),
    ]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licences.scanned(docs).collect()}
    assert [(got[i], t) for i, (_, t) in enumerate(cases)] == cases


def test_texts_without_cues_are_unknown():
    model = licences.fit()
    cues = set(model.cues())
    grams = [not cues & set(g.split()) for g in model.grams]
    ahead = np.maximum((model.weights[:, :-1] - model.weights[:, -1:])[grams], 0).sum(axis=0)
    assert (model.bias[:-1] - model.bias[-1] + ahead < 0).all()
