"""Licences of files: TF-IDF cosine to templates, then the nearest directory above that has a licence file.

Every line of a text is a vector of its terms (lower-case runs of letters, digits and
``. + -`` inside words) weighted by count and inverse document frequency, counted over all
documents; terms that no template has weigh as the rarest ones do.  The licence of
a text is the template with the largest cosine of any of its lines, from THRESHOLD on.

A file named like a licence file (LICENSE, LICENCE, COPYING, NOTICE) speaks for its
directory.  A file without a licence of its own takes that of its directory, else of
the nearest one above: directories are joined with the directories of licence files
by path, and the deepest match stays.

So that a notice is found where it wraps over lines or stands inside a longer one, and
so that headers and whole licence files are compared as such, a window of as many terms
as a template has slides over the terms of the whole text, for each of the templates,
the notices in ``notices`` and the whole licences.  A text that has fewer terms than a
template is one window.  The window with the largest cosine counts, of equal ones the
longest.  Templates under SHORT terms, and tags, ask for SHORT_THRESHOLD: they share too
few terms with their likes.  A window settles the licence where no line does, where
it names another licence than the best line with a larger cosine, or where it is of
LONG terms and nearly equal (SURE).  All rights reserved stands beside most licences: it
yields to any of them.  ``own_score`` is the cosine of what settled the licence.

Only lines and windows with a marker are scored.  Markers are chosen so that the weights
of all other terms together can't bring any template to the threshold: none is lost.

Defined results: a null text has no licence of its own.  A null path is a file in a
directory of its own that no other is above.  Equal cosines: the template
first by name; several licence files in a directory: the best cosine, then the first
name.  Repeated rows are scored each.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import cache
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.llm import notices
from tickbars.session import stored

THRESHOLD = 0.6
SHORT, SHORT_THRESHOLD = 8, 0.85
LONG, SURE = 100, 0.95
RESERVED = "Proprietary"
TERM = r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]"
LICENCE_FILE = r"(?i)^(un)?(licen[sc]e|copying|notice)([.-].*)?$"

# Fixed texts: notices by which the licences ask or are wont to be named.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def template_terms() -> list[dict[str, int]]:
    """Counts of the terms of each template."""
    found = []
    for _, text in TEMPLATES:
        terms = re.findall(TERM, text.lower())
        found.append({t: terms.count(t) for t in set(terms)})
    return found


# Both BSD licences begin with this sentence; windows tell them apart by their whole texts.
_SHARED = ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted")


@cache
def window_terms() -> tuple[tuple[str, Counter], ...]:
    """Name and counts of the terms of each text that windows are compared with."""
    found = [*(t for t in TEMPLATES if t != _SHARED), *notices.NOTICES, *notices.texts()]
    return tuple((name, Counter(re.findall(TERM, text.lower()))) for name, text in found)


def _terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[dict[str, int], int]:
    """In how many documents each template term stands, and how many documents there are.

    The counts come back as a row for each template term at most.
    """
    vocabulary = sorted({t for terms in [*template_terms(), *(c for _, c in window_terms())] for t in terms})
    some = F.array_intersect(_terms(F.col(text)), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(some, F.array().cast("array<string>")))).alias("_term"))
    counts = {r["_term"]: r["n"] for r in rows.groupBy("_term").agg(F.count("*").alias("n")).collect()}
    return {t: counts.get(t, 0) for t in vocabulary}, counts.get("", 0)


def idf(frequencies: dict[str, int], n: int) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each term, and that of a term of no document."""
    weight = lambda df: math.log((n + 1) / (df + 1)) + 1
    return {t: weight(df) for t, df in frequencies.items()}, weight(0)


def _markers_of(squares: dict[str, float], threshold: float, chosen: set[str]) -> None:
    """Add to *chosen* what the template needs whose terms have these squared weights."""
    total = sum(squares.values())
    left = sum(v for k, v in squares.items() if k not in chosen)
    for t in sorted(squares, key=lambda t: (-squares[t], t)):
        if left < (threshold * 0.999) ** 2 * total:
            break
        if t not in chosen:
            chosen.add(t)
            left -= squares[t]


def markers(weights: dict[str, float], threshold: float = THRESHOLD) -> set[str]:
    """Terms of which a line must have one to reach the threshold with any template.

    By Cauchy and Schwarz, a line's cosine with a template is at most the share of
    the template's length that lies in the terms they have in common.
    """
    chosen: set[str] = set()
    for terms in template_terms():
        _markers_of({t: (n * weights[t]) ** 2 for t, n in terms.items()}, threshold, chosen)
    return chosen


class Windows:
    """The best window of a text, by the weights of the terms."""

    def __init__(self, weights: dict[str, float], rare: float, threshold: float = THRESHOLD):
        self.weights, self.rare = weights, rare
        self.templates = []
        self.by_marker = defaultdict(list)
        for name, counts in window_terms():
            n = sum(counts.values())
            vector = {t: k * weights[t] for t, k in counts.items()}
            squares = {t: w * w for t, w in vector.items()}
            least = max(threshold, SHORT_THRESHOLD) if n < SHORT else threshold
            marks: set[str] = set()
            _markers_of(squares, least, marks)
            for t in marks:
                self.by_marker[t].append(len(self.templates))
            self.templates.append((name, n, vector, squares, math.sqrt(sum(squares.values())), least))

    def best(self, text: str) -> tuple[str, float, int] | None:
        """Licence, cosine and terms of the window that counts; None where none reaches its threshold."""
        return self.best_of(re.findall(TERM, text.lower()))

    def best_of(self, terms: list[str]) -> tuple[str, float, int] | None:
        held = set(terms)
        hits = defaultdict(list)
        for t in held & self.by_marker.keys():
            at = [i for i, x in enumerate(terms) if x == t]
            for k in self.by_marker[t]:
                hits[k] += at
        best = None
        for k, at in hits.items():
            name, n, vector, squares, length, least = self.templates[k]
            # what the text has of the template bounds the cosine of each of its windows
            if math.sqrt(sum(squares[t] for t in held & squares.keys())) < least * 0.999 * length:
                continue
            score = round(max(self._cosines(terms, sorted(at), n, vector)) / length, 6)
            if score >= least:
                found = (name == RESERVED, -score, -n, name)
                best = found if best is None else min(best, found)
        return best and (best[3], -best[1], -best[2])

    def _cosines(self, terms: list[str], at: list[int], n: int, vector: dict[str, float]):
        """For each window of *n* terms with one of the places *at*: its cosine, times the template's length."""
        last = max(len(terms) - n, 0)
        start = end = 0  # the window now held is terms[start:end]
        counts, size, product = Counter(), 0.0, 0.0
        done = -1
        for place in at:
            for first in range(max(place - n + 1, done + 1, 0), min(place, last) + 1):
                if first >= end:
                    start = end = first
                    counts, size, product = Counter(), 0.0, 0.0
                while start < first:
                    t = terms[start]
                    w = self.weights.get(t, self.rare)
                    counts[t] -= 1
                    size -= (2 * counts[t] + 1) * w * w
                    product -= w * vector.get(t, 0.0)
                    start += 1
                while end < min(first + n, len(terms)):
                    t = terms[end]
                    w = self.weights.get(t, self.rare)
                    size += (2 * counts[t] + 1) * w * w
                    counts[t] += 1
                    product += w * vector.get(t, 0.0)
                    end += 1
                yield product / math.sqrt(size)
                done = first


def _has(text: Column, terms: set[str]) -> Column:
    """Whether a text has one of the terms, looked for by their first letters."""
    first = defaultdict(list)
    for t in sorted(terms):
        first[t[0]].append(re.escape(t[1:]))
    chosen = "|".join(f"{c}(?:{'|'.join(rests)})" for c, rests in first.items())
    return F.lower(text).rlike(rf"(?<![a-z0-9])(?:{chosen})(?![a-z0-9])")


class Lines:
    """The best line of a text, by the weights of the terms of TEMPLATES."""

    def __init__(self, weights: dict[str, float], rare: float, threshold: float = THRESHOLD):
        self.weights, self.rare, self.threshold = weights, rare, threshold
        self.markers = markers(weights, threshold)
        self.templates = []
        for (name, _), counts in zip(TEMPLATES, template_terms(), strict=True):
            vector = {t: n * weights[t] for t, n in counts.items()}
            self.templates.append((name, vector, math.sqrt(sum(w * w for w in vector.values()))))

    def best_of(self, lines: list[list[str]]) -> tuple[str, float] | None:
        """Licence and cosine; None where no line reaches the threshold."""
        best = None
        for terms in lines:
            if self.markers.isdisjoint(terms):
                continue
            line = {t: n * self.weights.get(t, self.rare) for t, n in Counter(terms).items()}
            size = math.sqrt(sum(w * w for w in line.values()))
            for name, vector, length in self.templates:
                product = sum(w * line[t] for t, w in vector.items() if t in line)
                score = round(product / (size * length), 6)
                if score >= self.threshold:
                    best = (-score, name) if best is None else min(best, (-score, name))
        return best and (best[1], -best[0])


def settled(text: str, lines: Lines, windows: Windows) -> tuple[str, float] | None:
    """Licence and cosine of a text, by its best line and its best window."""
    terms = [re.findall(TERM, line) for line in text.lower().split("\n")]
    line, window = lines.best_of(terms), windows.best_of(list(chain.from_iterable(terms)))
    if line is None or window is None:
        return line or (window and window[:2])
    (name, score), (other, cosine, n) = line, window
    better = cosine > score or (n >= LONG and cosine >= SURE) or name == RESERVED
    return (other, cosine) if other not in (name, RESERVED) and better else line


def own_licences(text: Column, every: dict[str, float], rare: float, threshold: float = THRESHOLD) -> Column:
    """license and score of a text; nulls where it has none of its own."""
    lines = Lines({t: every[t] for terms in template_terms() for t in terms}, rare, threshold)
    windows = Windows(every, rare, threshold)

    @F.pandas_udf("license string, score double")
    def found(texts: pd.Series) -> pd.DataFrame:
        best = [(settled(t, lines, windows) if t is not None else None) or (None, None) for t in texts]
        return pd.DataFrame(best, columns=["license", "score"]).astype({"score": "float64"})

    return found(F.when(_has(text, lines.markers | windows.by_marker.keys()), text))


def _above(directory: Column) -> Column:
    """The directory and all above it, each with its depth."""
    parts = F.split(directory, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda depth: F.struct(depth.alias("depth"), F.array_join(F.slice(parts, 1, depth), "/").alias("above")),
    )


def inherited(directories: DataFrame, licence_files: DataFrame) -> DataFrame:
    """For each directory the licence of the nearest directory, itself or above, that has a licence file.

    *directories* has ``directory``; *licence_files* ``directory``, ``name``, ``license`` and ``score``.
    """
    order = F.struct((-F.col("score")).alias("low"), F.col("name"), F.col("license"))
    speaking = licence_files.groupBy(F.col("directory").alias("above")).agg(F.min(order).alias("best"))
    chains = directories.where(F.col("directory").isNotNull()).distinct().select(
        "directory", F.explode(_above(F.col("directory"))).alias("up")
    ).select("directory", "up.depth", "up.above")
    nearest = F.max(F.struct(F.col("depth"), F.col("best.license").alias("license"), F.col("above"))).alias("near")
    return chains.join(speaking, "above").groupBy("directory").agg(nearest).select(
        "directory", F.col("near.license").alias("from_above"), F.col("near.above").alias("above")
    )


def scan(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of *files*, less its text: own_license, own_score, license, origin (header, directory) and origin_dir."""
    new = ["own_license", "own_score", "license", "origin", "origin_dir"]
    rest = [c for c in files.columns if c not in [text, *new]]
    frequencies, n = document_frequencies(files, text)
    weights, rare = idf(frequencies, n)
    # what is needed of each file, once: its columns and its own licence
    with_own = stored(
        files.select(
            F.struct(*rest).alias("own"), F.regexp_replace(F.col(path), r"/*[^/]*$", "").alias("directory"),
            F.regexp_extract(F.col(path), r"([^/]*)$", 1).alias("name"),
            own_licences(F.col(text), weights, rare, threshold).alias("found"),
        ).select("own", "directory", "name", "found.license", "found.score"),
        "files",
    )
    licence_files = with_own.where(F.col("name").rlike(LICENCE_FILE) & F.col("license").isNotNull())
    above = inherited(with_own.select("directory"), licence_files.select("directory", "name", "license", "score"))
    return with_own.join(above, "directory", "left").select(
        "own.*", F.col("license").alias("own_license"), F.col("score").alias("own_score"),
        F.coalesce("license", "from_above").alias("license"),
        F.when(F.col("license").isNotNull(), "header").when(F.col("from_above").isNotNull(), "directory").alias("origin"),
        F.when(F.col("license").isNull(), F.col("above")).alias("origin_dir"),
    )
