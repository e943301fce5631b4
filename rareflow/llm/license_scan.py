"""Licence notices in paragraphs, by a trained classifier and a comparison with templates.

A paragraph is a line with a word, or neighbouring lines that a notice may be wrapped over.
Its words and pairs of words feed a sparse multinomial logistic regression whose classes
are the licence families and ``none``. It is trained on
variants of short notices of each family and on paragraphs of the corpus.
Notices of families that it never saw set the chance below which a paragraph that looks
like a licence is ``unknown``; a family must also share most words of one of its
templates. Runs on DataFrame functions and Spark's own JVM-side models only.
"""

from __future__ import annotations

import random

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.llm.common import whole, written

#: Short notices of each family, as they stand at the end of a text.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This file is distributed under the terms of the Apache License 2.0.",
        "You may not use this file except in compliance with the Apache License, Version 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is available under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License.",
        "Distributed under the GPL version 3 or any later version.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This text is shared under the Creative Commons Attribution NonCommercial 4.0 International License.",
        "Creative Commons BY-NC 4.0, no commercial use.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This text is shared under the Creative Commons Attribution 4.0 International License.",
        "Creative Commons BY 4.0, free to share with credit.",
    ],
    "public-domain": [
        "This work is in the public domain.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "No rights reserved, CC0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced without permission of the publisher.",
        "Confidential and proprietary, unauthorised copying is prohibited.",
    ],
}
#: Notices of other families: they only calibrate the class ``unknown``.
FOREIGN = [
    "Licensed under the Mozilla Public License 2.0.",
    "This code is released under the zlib license.",
    "Made available under the Eclipse Public License.",
    "Licensed under the EUPL, version 1.2.",
    "Released under the Artistic License 2.0.",
    "This font is licensed under the SIL Open Font License.",
    "Distributed under the Boost Software License.",
    "Licensed for evaluation use only under the vendor agreement.",
]
NONE, UNKNOWN = "none", "unknown"
#: Paragraphs of the corpus in the training rows, and variants of each notice.
BACKGROUND_ROWS, VARIANTS = 3000, 24
#: N-grams that fewer training rows have are left out; most n-grams that are kept.
LEAST_ROWS, MOST_GRAMS = 3, 20_000
ITERATIONS = 25
TRAIN_TASKS = 4
SEED = 2
#: The share of a template's words that confirms its family.
CONFIRMING = 0.6
#: Words of templates that any text may have. A notice has some other word of its template as well.
COMMON = frozenset("a and any are be by can for in is it no of or the this to with you".split())


def known_words(notice: str) -> list[str]:
    return sorted(set("".join(c if c.isalnum() else " " for c in notice.lower()).split()))


TELLING = sorted({w for notices in TEMPLATES.values() for n in notices for w in known_words(n)} - COMMON)
#: Between the first and the last line of a wrapped notice stand fewer words, twice the longest template.
NEAR = 2 * max(len(n.split()) for notices in TEMPLATES.values() for n in notices)


def paragraph_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def once(value: Column) -> Column:
    """``value`` behind a generator, which filters are not pushed below, so it is worked out once a row."""
    return F.explode(F.array(value))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, paragraph, words): every line with a word, numbered from 0 over all lines."""
    lines = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(whole(docs[text_col]), "\n")).alias("paragraph", "line"))
    rows = lines.select("id", F.col("paragraph").cast("long").alias("paragraph"), once(paragraph_words(F.col("line"))).alias("words"))
    return rows.where(F.size("words") > 0)


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, paragraph, last, words): every line with a word, and runs of neighbouring lines.

    A run goes from line ``paragraph`` to line ``last``, has no line without words, fewer
    than ``NEAR`` words between its first and last line, and a word of ``TELLING``, without
    which no template confirms it. ``row`` tells the rows of ``docs`` apart.
    """
    text = whole(docs[text_col])
    telling = F.array(*map(F.lit, TELLING))
    lines = F.transform(F.split(text, "\n"), paragraph_words)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), once(lines).alias("lines"))
    rows = rows.select("*", once(F.transform("lines", F.size)).alias("sizes"))
    wrapped = F.exists("lines", lambda words: F.arrays_overlap(words, telling))
    rows = rows.select("*", once(wrapped).alias("wrapped"))

    def more(first: Column) -> Column:
        """How many lines after ``first`` a run may take."""
        start = F.struct(F.lit(0).alias("between"), F.lit(0).alias("n"), F.lit(True).alias("open"))

        def step(run: Column, size: Column) -> Column:
            goes_on = run["open"] & (size > 0) & (run["between"] < NEAR)
            return F.struct(
                (run["between"] + size).alias("between"), (run["n"] + goes_on.cast("int")).alias("n"), goes_on.alias("open")
            )

        none = F.get("sizes", first) == 0
        return F.when(none, 0).otherwise(F.aggregate(F.slice("sizes", first + 2, F.lit(NEAR + 1)), start, step, lambda run: run["n"]))

    def near(first: Column) -> Column:
        n = F.when(F.col("wrapped"), more(first)).otherwise(F.lit(0))
        return F.struct(first.alias("first"), F.slice("lines", first + 1, n + 1).alias("near"))

    starts = F.transform(F.sequence(F.lit(0), F.size("lines") - 1), near)
    rows = rows.select("row", "id", F.inline(starts)).where(F.size(F.get("near", F.lit(0))) > 0)
    runs = F.transform(
        F.sequence(F.lit(1), F.size("near")),
        lambda n: F.struct((F.col("first") + n - 1).alias("last"), F.flatten(F.slice("near", 1, n)).alias("words")),
    )
    rows = rows.select("row", "id", F.col("first").cast("long").alias("paragraph"), F.inline(runs))
    rows = rows.withColumn("last", F.col("last").cast("long"))
    return rows.where((F.col("last") == F.col("paragraph")) | F.arrays_overlap("words", telling))


def grams(words: Column) -> Column:
    """The words and the pairs of words of a paragraph."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i))
    )
    return F.when(F.size(words) > 1, F.concat(words, pairs)).otherwise(words)


def _variants(notices: list[str], draw: random.Random) -> list[str]:
    """Each notice as it is, and with a word or two lost or strange words around it."""
    out = []
    for notice in notices:
        out += [notice] * 4
        for _ in range(VARIANTS):
            words = notice.split()
            for _ in range(draw.randint(0, 2 if len(words) > 5 else 0)):
                words.pop(draw.randrange(len(words)))
            extra = ["".join(draw.choice("abcdefghilmnoprstu") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(0, 4))]
            out.append(" ".join([*extra[:2], *words, *extra[2:]]))
    return out


def _table(spark: SparkSession, rows: list[tuple[str, float]]) -> DataFrame:
    table = spark.createDataFrame(rows, "line string, label double")
    return table.select(paragraph_words(F.col("line")).alias("words"), "label")


def similarity(words: Column, family: Column) -> Column:
    """The largest share of a template's words, over the family's templates, that ``words`` has."""
    out = F.lit(0.0)
    for name, notices in TEMPLATES.items():
        shares = []
        for notice in notices:
            known = known_words(notice)
            shares.append(F.size(F.array_intersect(words, F.array(*map(F.lit, known)))) / F.lit(float(len(known))))
        out = F.when(family == name, F.greatest(*shares)).otherwise(out)
    return out


def _looks_like_a_notice(words: Column) -> Column:
    return F.greatest(*(similarity(words, F.lit(name)) for name in TEMPLATES)) >= CONFIRMING


class LicenceModel:
    """Class names, each class's constant, the n-grams with a weight in some class, the chance to reach."""

    def __init__(self, names: list[str], constants: list[float], weights: dict[str, list[float]], least: float = 0.0):
        self.names, self.constants, self.weights, self.least = names, constants, weights, least

    def _raw(self) -> Column:
        """Each class's linear score: its constant and the weights of the n-grams that have some."""
        start = F.array(*map(F.lit, self.constants))
        if not self.weights:
            return start
        table = F.create_map(*(c for g, w in self.weights.items() for c in (F.lit(g), F.array(*map(F.lit, w)))))
        hits = F.filter(F.array_distinct(grams(F.col("words"))), lambda g: g.isin(list(self.weights)))
        return F.aggregate(
            hits, start, lambda total, g: F.zip_with(total, F.element_at(table, g), lambda a, b: a + b)
        )

    def chances(self, rows: DataFrame) -> DataFrame:
        """Adds family (the likeliest but none), chance, and none (the chance of no licence)."""
        known = F.slice("raw", 1, len(self.names) - 1)
        out = rows.select("*", once(self._raw()).alias("raw"))
        out = out.withColumn("top", F.array_max(known))
        total = F.aggregate("raw", F.lit(0.0), lambda t, x: t + F.exp(x - F.col("top")))
        out = out.withColumn("total", total)
        names = F.array(*map(F.lit, self.names))
        return out.select(
            *rows.columns,
            F.get(names, (F.array_position("raw", F.col("top")) - 1).cast("int")).alias("family"),
            (1 / F.col("total")).alias("chance"),
            (F.exp(F.get("raw", F.lit(len(self.names) - 1)) - F.col("top")) / F.col("total")).alias("none"),
        )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenceModel:
    """Trains on variants of the templates and at most ``BACKGROUND_ROWS`` paragraphs.

    Without paragraphs in the corpus the background is a few made-up words.
    """
    spark = docs.sparkSession
    names = [*TEMPLATES, NONE]
    draw = random.Random(SEED)
    made, checked = [], []
    for label, notices in enumerate(TEMPLATES.values()):
        lines = _variants(notices, draw)
        made += [(line, float(label)) for i, line in enumerate(lines) if i % 4]
        checked += [(line, 1.0) for i, line in enumerate(lines) if not i % 4]
    checked += [(line, 0.0) for line in _variants(FOREIGN, draw)]
    none = float(len(names) - 1)
    made += [("lorem ipsum dolor", none), ("sit amet", none), ("consectetur", none)]
    lines = background(docs, id_col, text_col).select("words", F.lit(none).alias("label"))
    rows = _table(spark, made).unionByName(lines).select(grams(F.col("words")).alias("grams"), "label")
    rows = written(rows, "licence-train").coalesce(TRAIN_TASKS)
    counter = CountVectorizer(
        inputCol="grams", outputCol="features", vocabSize=MOST_GRAMS, minDF=LEAST_ROWS, binary=True
    ).fit(rows)
    learner = LogisticRegression(maxIter=ITERATIONS, regParam=2e-4, elasticNetParam=0.5, family="multinomial")
    fitted = learner.fit(counter.transform(rows).select("features", "label"))
    matrix = fitted.coefficientMatrix.toArray()
    weights = {
        gram: [float(w) for w in matrix[:, i]] for i, gram in enumerate(counter.vocabulary) if matrix[:, i].any()
    }
    model = LicenceModel(names, [float(c) for c in fitted.interceptVector.toArray()], weights)
    got = model.chances(_table(spark, checked)).where("none < 0.5").select("chance", "label").collect()
    model.least = _threshold([(r["chance"], r["label"] > 0) for r in got])
    return model


def background(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``BACKGROUND_ROWS`` paragraphs that don't look like a notice, fewer only if there are no more.

    About as many texts are drawn by a hash, at any size of the table, and of their
    paragraphs those of least hash.
    """
    share = min(1.0, BACKGROUND_ROWS / max(1, docs.count()))
    highest = min(2**63 - 1, int(-(2**63) + share * 2**64))
    some = docs.select(F.col(id_col), F.col(text_col)).where(F.xxhash64(id_col, F.lit(SEED)) <= F.lit(highest))
    lines = paragraphs(some, id_col, text_col).where(~_looks_like_a_notice(F.col("words"))).select("words")
    return lines.orderBy(F.xxhash64("words"), "words").limit(BACKGROUND_ROWS)


def _threshold(found: list[tuple[float, bool]]) -> float:
    """The chance that parts known notices from foreign ones with the fewest errors, at least one half."""
    best, least = None, 0.5
    for t in sorted({0.5, *(round(c, 4) for c, _ in found if c >= 0.5)}):
        wrong = sum((c >= t) != known for c, known in found)
        if best is None or wrong < best:
            best, least = wrong, t
    return least


def _apart(found: Column) -> Column:
    """Those that overlap none before them, of runs in the order of last lines, shorter ones first."""
    kind = "array<struct<last:bigint,lines:bigint,paragraph:bigint,family:string,chance:double,similarity:double,confirmed:boolean>>"
    start = F.struct(F.lit(-1).cast("long").alias("end"), F.array().cast(kind).alias("kept"))

    def step(done: Column, run: Column) -> Column:
        kept = F.struct(run["last"].alias("end"), F.concat(done["kept"], F.array(run)).alias("kept"))
        return F.when(run["paragraph"] > done["end"], kept).otherwise(done)

    return F.aggregate(found, start, step, lambda done: done["kept"])


def scan(
    docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, paragraph, family, chance, similarity, confirmed) of every paragraph with a licence.

    ``paragraph`` is the number of its first line, from 0 over all lines. A family that is
    not sure enough, or that no template confirms, is ``unknown``. Neighbouring lines count
    together where no fewer of them do; a confirmed family takes its lines first, what is
    ``unknown`` has no line of it. Null, empty and blank texts have no paragraph. Repeated
    rows are scanned each for itself, a null id stays null and an empty table gives no rows.
    """
    found = model.chances(passages(docs, id_col, text_col)).where("none < 0.5")
    found = found.withColumn("similarity", F.round(similarity(F.col("words"), F.col("family")), 6))
    sure = F.coalesce((F.col("chance") >= model.least) & (F.col("similarity") >= CONFIRMING), F.lit(False))
    found = found.select(
        "row", "id", "last", (F.col("last") - F.col("paragraph")).alias("lines"), "paragraph",
        F.when(sure, F.col("family")).otherwise(F.lit(UNKNOWN)).alias("family"),
        F.round("chance", 6).alias("chance"), "similarity", sure.alias("confirmed"),
    )
    run = F.struct("last", "lines", "paragraph", "family", "chance", "similarity", "confirmed")
    texts = found.groupBy("row", "id").agg(F.sort_array(F.collect_list(run)).alias("found"))
    texts = texts.select("id", "found", once(_apart(F.filter("found", lambda r: r["confirmed"]))).alias("sure"))

    def free(r: Column) -> Column:
        taken = F.exists("sure", lambda s: (s["paragraph"] <= r["last"]) & (r["paragraph"] <= s["last"]))
        return ~r["confirmed"] & ~taken

    out = texts.select("id", F.inline(F.concat("sure", _apart(F.filter("found", free)))))
    return out.select(F.col("id").alias(id_col), "paragraph", "family", "chance", "similarity", "confirmed")
