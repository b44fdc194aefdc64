import math
import re
from collections import Counter

import pytest
from docs import awkward, frame, prose
from pyspark.sql import functions as F

from tickbars.llm import license

NOTICES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "# Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "All rights reserved.", "license to the driver",
    "you may obtain a copy of the licence", "mit the version 2.0 of", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
]


def brute(texts, threshold=license.THRESHOLD):
    """The best template of all lines of all texts, without markers."""
    find = lambda t: re.findall(license.TERM, t.lower())
    n, df = len(texts), Counter(t for text in texts for t in set(find(text or "")))
    vocabulary = {t for terms in license.template_terms() for t in terms}
    idf = lambda t: math.log((n + 1) / ((df[t] if t in vocabulary else 0) + 1)) + 1
    vector = lambda counts: {t: k * idf(t) for t, k in counts.items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = [(name, vector(c)) for (name, _), c in zip(license.TEMPLATES, license.template_terms())]
    out = []
    for text in texts:
        best = None
        for line in (text or "").split("\n"):
            v = vector(Counter(find(line)))
            for name, t in templates:
                product = sum(x * t[k] for k, x in v.items() if k in t)
                score = round(product / (size(v) * size(t)), 6) if product else 0.0
                if score >= threshold and (best is None or (-score, name) < best):
                    best = (-score, name)
        out.append((best[1], -best[0]) if best else (None, None))
    return out


def test_own_licences_equal_scoring_every_line(spark):
    texts = [r[1] for r in awkward()[:10]] + [f"{prose(i, 30)}\n{n}\n{prose(i + 50, 20)}" for i, n in enumerate(NOTICES)] + NOTICES
    rows = [(f"p/{i}.txt", t) for i, t in enumerate(texts)]
    files = spark.createDataFrame(rows, "path string, text string").withColumns({c: F.lit("old") for c in ("row", "own", "license", "lines", "name")})
    got = {r.path: (r.own_license, r.own_score) for r in license.scan(files).collect()}
    for (path, _), (name, score) in zip(rows, brute(texts), strict=True):
        assert got[path][0] == name and got[path][1] == (None if score is None else pytest.approx(score, abs=2e-6))
    assert {v[0] for v in got.values()} >= {"Apache-2.0", "MIT", "CC-BY-NC-4.0", "GPL-3.0", "GPL-2.0", "Proprietary"}


def test_nearest_directory_above(spark):
    apache, mit = NOTICES[0], NOTICES[1]
    rows = [
        ("a/LICENSE", apache), ("a/x.py", "code"), ("a/b/c/y.py", "code"), ("a/b/LICENSE.txt", mit), ("a/b/z.py", f"{NOTICES[3]}\ncode"),
        ("ab/w.py", "code"), ("a/d/COPYING", "no licence here"), ("a/d/v.py", "code"), (None, "code"), ("LICENSE-x", None), ("t.py", None),
        ("a/b/LICENSE", apache), ("a/x.py", "code"),
    ]
    files = spark.createDataFrame(rows, "path string, text string")
    got = Counter((r.path, r.license, r.origin, r.origin_dir) for r in license.scan(files).collect())
    assert got == Counter([
        ("a/LICENSE", "Apache-2.0", "header", None), ("a/x.py", "Apache-2.0", "directory", "a"), ("a/x.py", "Apache-2.0", "directory", "a"),
        ("a/b/c/y.py", "Apache-2.0", "directory", "a/b"), ("a/b/LICENSE.txt", "MIT", "header", None), ("a/b/z.py", "GPL-3.0", "header", None),
        ("ab/w.py", None, None, None), ("a/d/COPYING", "Apache-2.0", "directory", "a"), ("a/d/v.py", "Apache-2.0", "directory", "a"),
        (None, None, None, None), ("LICENSE-x", None, None, None), ("t.py", None, None, None), ("a/b/LICENSE", "Apache-2.0", "header", None),
    ])


def test_empty(spark):
    docs = frame(spark, []).withColumn("path", F.lit("a/b"))
    assert license.scan(docs).count() == 0


HEADER = """# Copyright (c) 2020 Jane Doe. All rights reserved.
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""


def test_wrapped_inline_tagged_and_whole_notices(spark):
    whole = dict(license.notices.texts())
    sentence = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    apache = license.notices.NOTICES[15][1]
    about = {
        "wrapped": (f"{HEADER}{prose(1, 90)}", "GPL-3.0"),
        "older": (f"{HEADER.replace('version 3', 'version 2')}{prose(2, 90)}", "GPL-2.0"),
        "on one line": (f"// {apache} {prose(3, 60)}", "Apache-2.0"),
        "inline": (prose(4, 40).replace("\n", " ") + f" {sentence} " + prose(5, 40).replace("\n", " "), "MIT"),
        "title": (f"{prose(6, 9)} Mozilla Public License\nVersion 2.0 {prose(7, 30)}", "MPL-2.0"),
        "reserved": ("Copyright (c) 2020 Jane Doe. All rights reserved.", "Proprietary"),
        "tag": (f"// SPDX-License-Identifier: LGPL-2.1-or-later\n{prose(8, 50)}", "LGPL-2.1"),
        "tag of another": (f"// SPDX-License-Identifier: Zlib\n{prose(9, 50)}", None),
        "no notice": (prose(10, 300), None),
        **{f"whole {name}": (f"Copyright (c) 2020, Jane Doe.\nAll rights reserved.\n\n{text}", name) for name, text in whole.items()},
    }
    padding = [(f"p/{i}.txt", prose(200 + i, 60)) for i in range(60)]
    files = spark.createDataFrame([(k, text) for k, (text, _) in about.items()] + padding, "path string, text string")
    got = {r.path: r.own_license for r in license.scan(files).collect()}
    assert {k: got[k] for k in about} == {k: name for k, (_, name) in about.items()}
    assert not any(got[k] for k, _ in padding)


def test_windows_equal_scoring_every_window():
    texts = [f"{prose(i, 30)}\n{n}\n{prose(i + 50, 20)}" for i, n in enumerate(NOTICES)] + [HEADER, "mit license"]
    vocabulary = sorted({t for _, c in license.window_terms() for t in c})
    held = [set(re.findall(license.TERM, t.lower())) for t in texts]
    weights, rare = license.idf({t: sum(t in h for h in held) for t in vocabulary}, len(texts))
    weight = lambda t: weights.get(t, rare)
    norm = lambda v: math.sqrt(sum((k * weight(t)) ** 2 for t, k in v.items()))
    windows = license.Windows(weights, rare)
    for text in texts:
        terms, best = re.findall(license.TERM, text.lower()), None
        for name, counts in license.window_terms():
            n = sum(counts.values())
            least = license.SHORT_THRESHOLD if n < license.SHORT else license.THRESHOLD
            for at in range(max(len(terms) - n, 0) + 1):
                part = Counter(terms[at : at + n])
                score = sum(k * counts[t] * weight(t) ** 2 for t, k in part.items()) / norm(part) / norm(counts)
                if score >= least and (best is None or (name == "Proprietary", -score) < (best[0], best[1])):
                    best = (name == "Proprietary", -score, name)
        got = windows.best(text)
        assert (got is None) == (best is None) and (best is None or got[1] == pytest.approx(-best[1], abs=2e-6))
