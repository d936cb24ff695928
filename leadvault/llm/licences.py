"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Paragraphs (blocks of lines between blank ones) are read in overlapping windows of words, which become
sparse counts of hashed words and word pairs. A multinomial logistic regression, trained on the templates inside windows
of the same size against windows of the corpus, tells licence families from the class `unknown`; its probabilities are
calibrated by a temperature chosen on held-out windows. A named family counts as confirmed if the window holds most
word triples of one of the family's templates.

DataFrame operations and Spark's own linear model only. The model is fitted on the windows of a bounded sample of
documents (`sample_docs`); every window of every document is classified."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm.common import stored

UNKNOWN = "unknown"
#: Documents whose paragraphs teach the class `unknown` (expected number, drawn by hash of the id).
SAMPLE_DOCS = 1000
FEATURES = 1 << 13
#: Sampled windows that the templates are put into to teach the families.
SURROUNDINGS = 256
#: Words of a window, and those it shares with the next: the longest template less one word, so each notice is whole in one.
WINDOW, OVERLAP = 48, 20
#: A family is named from this calibrated probability on, and confirmed from this share of a template's triples on.
NAMED, CONFIRMED = 0.5, 0.8
TEMPERATURES = (0.5, 1.0, 1.5, 2.0, 3.0, 5.0)

#: Well-known licence notices by family.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "terms of the GNU General Public License as published by"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("lgpl-3.0", "terms of the GNU Lesser General Public License as published by"),
    ("agpl-3.0", "terms of the GNU Affero General Public License as published by"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
]
FAMILIES = sorted({f for f, _ in TEMPLATES})
CLASSES = [UNKNOWN, *FAMILIES]
_WORD = r"([\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*)"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD))


def _pairs(words: Column) -> Column:
    """Words and pairs of neighbouring words."""
    at = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.concat(words, F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i))))


def _triples(words: Column) -> Column:
    """Distinct word triples; shorter texts are one."""
    at = F.when(F.size(words) > 2, F.sequence(F.lit(2), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    found = F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), F.get(words, i))))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.concat_ws(" ", words)))


def coverage(triples: Column, family: str) -> Column:
    """The largest share of a template's word triples that is among `triples`."""
    shares = []
    for name, template in TEMPLATES:
        if name == family:
            wanted = _triples(words_of(F.lit(template)))
            shares.append(F.size(F.array_intersect(wanted, triples)) / F.size(wanted))
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


@dataclass(frozen=True)
class Model:
    hashing: HashingTF
    regression: LogisticRegressionModel
    temperature: float


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, position, part, words): all windows of all paragraphs of `docs` that have a word. `row` tells rows of
    one doc_id apart, `position` is the paragraph's number and `part` the window's first word."""
    blocks = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row")).select(
        "doc_id", "row", F.posexplode(F.split("text", r"\n\s*\n")).alias("position", "block"))
    found = blocks.select("doc_id", "row", "position", F.explode(F.array(words_of(F.col("block")))).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - OVERLAP, F.lit(1)), F.lit(WINDOW - OVERLAP))
    return found.select("doc_id", "row", "position", "all", F.explode(starts).alias("part")).select(
        "doc_id", "row", "position", "part", F.explode(F.array(F.slice("all", F.col("part"), F.lit(WINDOW)))).alias("words"))


def _examples(spark: SparkSession, docs: DataFrame, sample_docs: int) -> DataFrame:
    """(class, words, weight, held): templates alone, with words missing, and inside sampled windows; and the sampled
    windows themselves unless a template covers them. `held` marks the fold kept for calibration."""
    rows = docs.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = docs.where(F.col("doc_id").isNotNull() & (draw < min(1.0, sample_docs / max(rows, 1))))
    plain = windows(drawn).drop("row")
    plain = plain.select("*", F.explode(F.array(_triples(F.col("words")))).alias("triples"))
    covered = F.greatest(*[coverage(F.col("triples"), f) for f in FAMILIES])
    plain = stored(spark, plain.where(covered < CONFIRMED / 2).withColumn("key", F.xxhash64("doc_id", "position", "part")).drop("triples"), "plain")
    notices = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(float(CLASSES.index(f))).alias("class"), words_of(F.lit(t)).alias("notice")) for f, t in TEMPLATES])))
    around = plain.orderBy("key").limit(SURROUNDINGS).select("key", F.col("words").alias("near"))
    several = notices.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        "class", F.slice("notice", F.least(F.lit(1) + F.col("cut").bitwiseAND(F.lit(1)), F.size("notice")),
                         F.greatest(F.size("notice") - F.col("cut").bitwiseAND(F.lit(1)) - F.shiftright("cut", 1), F.lit(1))).alias("words"))
    # A fixed number of notices (four a template), each once per number, meets as many numbered surroundings.
    nears = around.agg(F.collect_list(F.struct("key", "near")).alias("all")).select(F.posexplode("all").alias("at", "a"))
    # The notice begins anywhere; one half of the windows is as large as can be, the other as short lines are.
    room = F.when(F.col("at") % 2 == 0, F.lit(WINDOW) - F.size("words")).otherwise(F.lit(24))
    inside = several.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SURROUNDINGS - 1)))).join(nears, "at").withColumn(
        "left", F.pmod(F.col("at") * 7 + F.size("words"), room + 1).cast("int")).select(
        "class", F.concat(F.slice("a.near", F.lit(1), F.col("left")), "words", F.slice("a.near", F.col("left") + 1, room - F.col("left"))).alias("words"),
        F.col("a.key").alias("key"))
    told = several.select("class", "words", F.lit(1).cast("long").alias("key")).unionByName(inside).withColumn(
        "key", F.xxhash64("class", "words", "key")).unionByName(plain.select(F.lit(0.0).alias("class"), "words", "key"))
    told = stored(spark, told.withColumn("held", F.pmod("key", F.lit(4)) == 0), "examples")
    sizes = told.groupBy("class").agg(F.count("*").alias("n"))
    return told.join(sizes, "class").withColumn("weight", F.when(F.col("class") == 0, 4.0).otherwise(1.0) * 1000.0 / F.col("n"))


def fit(spark: SparkSession, docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from the templates and a sample of `docs` (doc_id, text). Without documents the templates alone teach."""
    hashing = HashingTF(inputCol="terms", outputCol="features", numFeatures=FEATURES, binary=True)
    told = hashing.transform(_examples(spark, docs, sample_docs).withColumn("terms", _pairs(F.col("words"))))
    regression = LogisticRegression(labelCol="class", weightCol="weight", family="multinomial", maxIter=40, regParam=1e-4)
    model = regression.fit(told.where(~F.col("held")).select("class", "weight", "features").coalesce(2))
    raw = vector_to_array("rawPrediction")
    held = model.transform(told.where("held")).select("weight", raw.alias("raw"), F.col("class").cast("int").alias("at"))
    loss = {t: F.sum(F.col("weight") * (F.log(_exps(F.col("raw"), t)) + F.array_max("raw") / t - F.get("raw", F.col("at")) / t))
            for t in TEMPERATURES}
    losses = held.agg(*[x.alias(str(k)) for k, x in enumerate(loss.values())]).first()
    best = min((x, k) for k, x in enumerate(losses) if x is not None)[1] if any(x is not None for x in losses) else 1
    return Model(hashing, model, TEMPERATURES[best])


def _exps(raw: Column, temperature: float) -> Column:
    """The sum of exp(raw / temperature), counted from the largest."""
    return F.aggregate(raw, F.lit(0.0), lambda a, x: a + F.exp((x - F.array_max(raw)) / temperature))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, row, position, family, probability, covered, confirmed) for the windows of `docs` that are named a licence.
    A window with notices of several families has a row for each: `probability` is that of the family against unknown."""
    terms = windows(docs).withColumn("terms", _pairs(F.col("words")))
    scored = model.regression.transform(model.hashing.transform(terms))
    raw, t = F.col("raw"), model.temperature
    unknown = F.exp((F.get(raw, F.lit(0)) - F.array_max(raw)) / t) / _exps(raw, t)
    licence = scored.where(F.col("prediction") > 0).select("doc_id", "row", "position", "words", vector_to_array("rawPrediction").alias("raw"))
    against = F.transform(F.array(*[F.lit(k) for k in range(1, len(CLASSES))]), lambda k: F.struct(
        F.get(F.array(*[F.lit(c) for c in CLASSES]), k),
        1 / (1 + F.exp((F.get(raw, F.lit(0)) - F.get(raw, k)) / t))))
    named = licence.where(unknown <= 1 - NAMED).select(
        "doc_id", "row", "position", F.explode(F.array(_triples(F.col("words")))).alias("triples"), against.cast("array<struct<family:string,probability:double>>").alias("against"))
    named = named.select("doc_id", "row", "position", "triples", F.inline("against")).where(F.col("probability") >= NAMED)
    covered = F.coalesce(*[F.when(F.col("family") == f, coverage(F.col("triples"), f)) for f in FAMILIES])
    return named.withColumn("covered", covered).withColumn("confirmed", F.col("covered") >= CONFIRMED).drop("triples")


def scan(spark: SparkSession, docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, n_named, n_confirmed, families, probability, covered), one row per doc_id of `docs` (doc_id, text,
    others ignored). n_named and n_confirmed count paragraphs. `families`: the confirmed ones by name, comma-joined; probability and covered: the largest of
    the confirmed. Null and empty texts have none; rows of one doc_id (repeated rows, null ids) are told together."""
    model = fit(spark, docs, sample_docs)
    good, paragraph = F.col("confirmed"), F.struct("row", "position")
    found = classify(docs, model).groupBy("doc_id").agg(
        F.size(F.collect_set(paragraph)).cast("long").alias("n_named"),
        F.size(F.collect_set(F.when(good, paragraph))).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(good, F.col("family")))), ",").alias("families"),
        F.max(F.when(good, F.col("probability"))).alias("probability"), F.max(F.when(good, F.col("covered"))).alias("covered"))
    ids = docs.select(F.col("doc_id").cast("long").alias("_id")).distinct()
    return ids.join(found, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select(
        F.col("_id").alias("doc_id"), F.coalesce("n_named", F.lit(0)).alias("n_named"),
        F.coalesce("n_confirmed", F.lit(0)).alias("n_confirmed"), F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"), F.coalesce("covered", F.lit(0.0)).alias("covered"))
