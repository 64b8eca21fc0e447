"""License scans: a trained paragraph classifier with template comparison.

Paragraphs are runs of lines that are not blank. Each line of a paragraph is classified, and so is
every window of its words, across lines, that holds ``min_share`` of a template's word pairs: a
notice wrapped over lines or inside a long paragraph is seen whole. Texts become counts of word
n-grams of one to three words from a vocabulary learned from the training rows. A sparse multinomial logistic regression names the
license family or ``unknown``. Training rows are the templates below with words dropped, cut and
surrounded by rule, hand-written sentences that only mention licenses, and a bounded sample of
lines of the corpus (parameter ``sample``) without half a confirmed template's wording as
``unknown``.
A temperature fitted on rows kept out of training calibrates the probabilities; a prediction
counts if it is not ``unknown``, reaches ``min_score``, and a template of that family confirms it
by sharing ``min_share`` of its word pairs.

Texts are scanned whole, paragraph by paragraph inside a task, and every notice counts. Null text has no paragraphs.
Repeated rows get equal answers. An empty table gives an empty result.
"""

import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

UNKNOWN = "unknown"
SAMPLE = 2000       # lines of the corpus that serve as negatives
MIN_SCORE, MIN_SHARE = 0.5, 0.6

# Customary license notices by family.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license version 3",
             "this program is licensed under the gnu affero general public license",
             "spdx-license-identifier agpl-3.0-or-later"],
    "apache-2.0": ["licensed under the apache license version 2.0",
                   "released under the apache 2.0 license",
                   "spdx-license-identifier apache-2.0",
                   "you may not use this file except in compliance with the license",
                   "you may obtain a copy of the license at apache.org licenses license-2.0"],
    "bsd": ["released under the bsd license", "licensed under the 3-clause bsd license",
            "spdx-license-identifier bsd-3-clause",
            "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"],
    "cc-by": ["licensed under cc by 4.0",
              "this work is licensed under a creative commons attribution 4.0 international "
              "license", "spdx-license-identifier cc-by-4.0"],
    "cc-by-nc": ["licensed under cc by-nc 4.0",
                 "this work is licensed under a creative commons attribution-noncommercial 4.0 "
                 "international license", "spdx-license-identifier cc-by-nc-4.0"],
    "cc-by-sa": ["licensed under cc by-sa 4.0",
                 "this work is licensed under a creative commons attribution-sharealike 4.0 "
                 "international license", "spdx-license-identifier cc-by-sa-4.0"],
    "cc0": ["released under cc0 1.0 universal", "spdx-license-identifier cc0-1.0",
            "this work is dedicated to the public domain under cc0",
            "this is free and unencumbered software released into the public domain"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "licensed under the gnu general public license version 2",
            "spdx-license-identifier gpl-3.0-or-later",
            "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license as published by the free software "
            "foundation"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1",
             "this library is licensed under the gnu lesser general public license",
             "spdx-license-identifier lgpl-2.1-or-later"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "spdx-license-identifier mit",
            "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0",
            "licensed under the mozilla public license version 2.0",
            "spdx-license-identifier mpl-2.0"],
    "proprietary": ["all rights reserved", "copyright all rights reserved",
                    "no part of this publication may be reproduced without prior written "
                    "permission"],
}
MENTIONS = [
    "you need a driving license to rent a car here", "the city issued a new license last year",
    "general public opinion on the matter was divided", "she studied at mit for three years",
    "the apache helicopter landed at noon", "the rights of all people are reserved in law",
    "version 3 of the report was released under pressure", "work is done under the table",
    "a public library with free entrance", "this program is on television every day",
    "the commons debated the creative industries", "he was granted permission to leave",
    "the software is free of errors", "terms of use apply to every visitor of the shop",
]
# End of fixed values.

_WORD = re.compile(r"[a-z0-9][a-z0-9.+-]*")


def words_of(line: str) -> list:
    return [w.rstrip(".-") for w in _WORD.findall(line.lower())]


def grams(words: list) -> list:
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def share_of_pairs(words: list, templates: dict) -> dict:
    """Per family, the largest share of a template's word pairs that the paragraph holds."""
    held = set(zip(words, words[1:])) | set(zip(words, words))
    return {family: max(len(pairs & held) / len(pairs) for pairs in each)
            for family, each in templates.items()}


def _template_pairs() -> dict:
    def pairs(words):
        return set(zip(words, words[1:])) or set(zip(words, words))
    return {f: [pairs(words_of(t)) for t in each] for f, each in TEMPLATES.items()}


def training_rows(negatives: list) -> list:
    """(family, words) by rule: whole, one word dropped, first and last part, surrounded."""
    rows = [(UNKNOWN, words_of(m)) for m in MENTIONS for _ in range(3)]
    confirm = _template_pairs()
    for line in negatives:
        words = words_of(line)
        if max(share_of_pairs(words, confirm).values()) < MIN_SHARE / 2:   # no part of a notice
            rows.append((UNKNOWN, words))
    around = [w for line in negatives[:50] for w in words_of(line)] or ["lorem", "ipsum", "dolor"]
    for family, templates in TEMPLATES.items():
        for template in templates:
            words = words_of(template)
            forms = [words] * 4 + [words[:i] + words[i + 1:] for i in range(len(words))
                                   if len(words) > 3]
            for k in range(6):
                before = [around[(7 * k + i) % len(around)] for i in range(k + 1)]
                after = [around[(11 * k + 5 + i) % len(around)] for i in range(2 * k)]
                forms.append(before + words + after)
            rows += [(family, f) for f in forms]
    return rows


class LicenseModel:
    """Vocabulary with one weight per family, and the calibration."""

    def __init__(self, families, weights, bias, scale):
        self.families, self.weights, self.bias, self.scale = families, weights, bias, scale
        self.signal = {w for g in weights for w in g.split(" ")}
        self.templates = _template_pairs()
        self.holders = {}       # word pair: numbers of the templates that hold it
        self.sizes = []         # (pairs, words) of every template
        for family, each in self.templates.items():
            for pairs, template in zip(each, TEMPLATES[family]):
                for pair in pairs:
                    self.holders.setdefault(pair, []).append(len(self.sizes))
                self.sizes.append((len(pairs), len(words_of(template))))

    def probabilities(self, words: list) -> list:
        z = list(self.bias)
        if not self.signal.isdisjoint(words):
            for gram in grams(words):
                row = self.weights.get(gram)
                if row:
                    z = [a + b for a, b in zip(z, row)]
        top = max(z)
        e = [math.exp((v - top) / self.scale) for v in z]
        return [v / sum(e) for v in e]

    def classify(self, line: str) -> tuple:
        """(family or ``unknown``, probability) of a paragraph, confirmed by a template."""
        return self.classify_words(words_of(line))

    def classify_words(self, words: list) -> tuple:
        p = self.probabilities(words)
        best = max(range(len(p)), key=p.__getitem__)
        family = self.families[best]
        if family != UNKNOWN and (p[best] < MIN_SCORE or max(
                share_of_pairs(words, {family: self.templates[family]}).values()) < MIN_SHARE):
            return UNKNOWN, 1.0 - p[best]
        return family, p[best]

    def windows(self, words: list) -> list:
        """Sorted (start, end) of word windows that hold enough pairs of a template.

        A window has twice the template's words at most; of overlapping ones of a template the
        fullest stays.
        """
        spots = {}
        for i, pair in enumerate(zip(words, words[1:])):
            for t in self.holders.get(pair, ()):
                spots.setdefault(t, []).append((i, pair))
        found = set()
        for t, hits in spots.items():
            pairs, n = self.sizes[t]
            held, at, best = {}, 0, None
            for i, pair in hits:
                held[pair] = held.get(pair, 0) + 1
                while i + 2 - hits[at][0] > 2 * n or held[hits[at][1]] > 1:
                    old = hits[at][1]
                    held[old] -= 1
                    if not held[old]:
                        del held[old]
                    at += 1
                if len(held) >= MIN_SHARE * pairs:
                    window = (len(held), hits[at][0], i + 2)
                    if best and window[1] >= best[2]:
                        found.add(best[1:])
                        best = None
                    if best is None or window[0] > best[0]:
                        best = window
            if best:
                found.add(best[1:])
        return sorted(found)

    def notices(self, text: str) -> tuple:
        """(number of paragraphs, sorted (first line, family, score) of the notices) of a text.

        A window counts if no better one overlaps. With one line in it that is a notice of the same
        family it is that notice from its first line on; other lines found alone stand for it.
        """
        found, total, paragraph = [], 0, []
        for number, line in enumerate([*text.split("\n"), ""]):
            if line.strip():
                paragraph.append((number, words_of(line)))
            elif paragraph:
                total += 1
                found += self._paragraph(paragraph)
                paragraph = []
        return total, found

    def _paragraph(self, rows: list) -> list:
        found = {}
        for number, words in rows:
            family, score = self.classify_words(words)
            if family != UNKNOWN:
                found[number] = family, score
        alone = set(found)
        words = [w for _, part in rows for w in part]
        owner = [number for number, part in rows for _ in part]
        options = []
        for a, b in self.windows(words):
            family, score = self.classify_words(words[a:b])
            if family != UNKNOWN:
                options.append((-score, a, b, family))
        used = []
        for score, a, b, family in sorted(options):
            inside = sorted(alone.intersection(owner[a:b]))
            if (all(b <= x or y <= a for x, y in used)
                    and (not inside or len(inside) == 1 and found[inside[0]][0] == family)):
                used.append((a, b))
                for number in inside:
                    score = min(score, -found.pop(number)[1])
                alone.difference_update(inside)
                if owner[a] not in found or found[owner[a]][1] < -score:
                    found[owner[a]] = family, -score
        return sorted((n, family, score) for n, (family, score) in found.items())


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> LicenseModel:
    """Train on the templates and the ``sample`` lines of smallest hash.

    A bound on the hash leaves about ``sample`` times the lines of a document before the
    tasks send their smallest to the driver, whatever the size of the corpus.
    """
    spark = docs.sparkSession
    share = min(1.0, sample / max(docs.count(), 1))
    place = F.pmod(F.xxhash64("text", "line"), F.lit(1 << 40))
    chosen = (docs.select(F.xxhash64(f"`{text}`").alias("text"),
                          F.explode(F.split(f"`{text}`", "\n")).alias("line"))
              .select("line", place.alias("place"))
              .where((F.col("place") <= int(share * (1 << 40))) & (F.trim("line") != ""))
              .orderBy("place", "line").limit(sample).collect())
    rows = training_rows([r["line"] for r in chosen])
    families = sorted({f for f, _ in rows})
    seen = {}
    for family, words in rows:
        for g in set(grams(words)):
            seen.setdefault(g, set()).add(family)
    known = {w for each in TEMPLATES.values() for t in each for w in words_of(t)}
    known |= {w for m in MENTIONS for w in words_of(m)}
    vocabulary = {g: i for i, g in enumerate(sorted(
        g for g in seen if all(w in known for w in g.split(" "))))}

    def vector(words):
        counts = {}
        for g in grams(words):
            if g in vocabulary:
                counts[vocabulary[g]] = 1.0
        return Vectors.sparse(len(vocabulary), counts)
    data = [(float(families.index(f)), vector(w), i % 5 == 4) for i, (f, w) in enumerate(rows)]
    frame = spark.createDataFrame(
        [(y, x) for y, x, out in data if not out], ["label", "features"]).coalesce(1)
    fitted = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5,
                                standardization=False, maxIter=100).fit(frame.cache())
    frame.unpersist()
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: [float(v) for v in matrix[:, i]] for g, i in vocabulary.items()
               if matrix[:, i].any()}
    bias = [float(v) for v in fitted.interceptVector.toArray()]
    scores = [(matrix @ x.toArray() + bias, int(y)) for y, x, out in data if out]

    def loss(scale):
        total = 0.0
        for z, y in scores:
            z = z / scale
            total += z.max() + math.log(sum(math.exp(v - z.max()) for v in z)) - z[y]
        return total
    return LicenseModel(families, weights, bias, min((0.1 * 1.2 ** i for i in range(24)), key=loss))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", model: LicenseModel = None,
         ) -> DataFrame:
    """Rows (doc_id, n_paragraphs, n_license, families, family, score, lines).

    ``n_license`` notices; ``families`` sorted and joined by commas, ``family`` that of the best
    notice (ties: the first), ``lines`` the numbers of the lines where notices begin, from 0.
    """
    model = model or fit(docs, text)
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = dict(slim.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text):
        total, found = shared.value.notices(text or "")
        best = max(found, key=lambda f: f[2]) if found else (None, None, 0.0)
        return (total, len(found), ",".join(sorted({f for _, f, _ in found})), best[1], best[2],
                [n for n, _, _ in found])

    def run(batches):
        import pyarrow as pa
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                 pa.list_(pa.int32())]
        for batch in batches:
            rows = [one(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[i] for r in rows], k)
                                    for i, k in enumerate(kinds)]],
                names=["doc_id", "n_paragraphs", "n_license", "families", "family", "score",
                       "lines"])
    return slim.mapInArrow(run, f"doc_id {kind}, n_paragraphs bigint, n_license bigint, "
                                "families string, family string, score double, lines array<int>")
