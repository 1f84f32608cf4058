"""Licence scan by a positional index of seldom words.

The templates' words form an index word -> (template, place). Over all documents the scan counts in how many each of those words
occurs; the word of a key phrase with the highest inverse frequency is its anchor. A document's anchors are looked up and
give candidate origins, (template, place in the document less place in the template). The postings of all other words
are intersected with them by that relative position. A candidate holds if its mandatory key phrase stands there word
for word; its score is the share of the template's inverse frequency that was found.

All of it is DataFrame operations. A text is split twice: for the counts, and for the places. Tables with the size of
the templates are the only ones that reach the driver.

Defined results for odd input: a null or empty text has no words, no places, empty labels and score 0; rows equal in
number and text get the same row each; a null doc_id stays null; texts of any length are read whole; an empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import lower_ascii, stored

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` are the words; this is what stands between them.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
EDGES = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    #: mandatory, within ``words``
    key: str
    #: whether every place counts, not only the label
    base: bool = False

    def postings(self) -> list[tuple[str, int, bool]]:
        words, key = self.words.split(), self.key.split()
        start = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        return [(w, i, start <= i < start + len(key)) for i, w in enumerate(words)]


#: Phrases and openings of common licences.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "copy modify and or distribute"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased."""
    trimmed = F.btrim(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(EDGES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BETWEEN))


def frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each word of the templates."""
    words = F.array_distinct(F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary))))
    # the empty word stands for the document itself
    counts = docs.select(F.explode(F.concat(F.array(F.lit("")), words)).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    return found.pop("", 0), found


def _index(spark: SparkSession, templates: tuple[Template, ...], total: int, counts: dict[str, int]) -> DataFrame:
    """(word, template, label, base, at, key, anchor, weight, keys, all_weight): the postings."""
    rows = []
    for number, t in enumerate(templates):
        postings = t.postings()
        weight = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w, _, _ in postings}
        anchor = min((w for w, _, k in postings if k), key=lambda w: (-weight[w], w))
        whole, keys = math.fsum(weight[w] for w, _, _ in postings), sum(k for _, _, k in postings)
        rows += [(w, number, t.label, t.base, at, k, k and w == anchor, weight[w], keys, whole) for w, at, k in postings]
    return spark.createDataFrame(rows, "word string, template int, label string, base boolean, at int, key boolean, "
                                       "anchor boolean, weight double, keys int, all_weight double")


def places(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, sig, template, label, base, origin, score): the templates that hold, and where."""
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.words.split()})
    total, counts = frequencies(docs, vocabulary)
    index = _index(spark, templates, total, counts)
    anchors = [F.lit(r["word"]) for r in index.where("anchor").select("word").distinct().collect()]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("sig"), words_of(F.col("text")).alias("words"))
    known = words.where(F.arrays_overlap("words", F.array(*anchors)))
    # places of the templates' words, in documents that have an anchor
    hits = known.select("doc_id", "sig", F.posexplode("words").alias("pos", "word")) \
        .where(F.col("word").isin(vocabulary)).distinct()
    hits, _ = stored(hits, "licence-hits")
    placed = hits.join(index, "word").withColumn("origin", F.col("pos") - F.col("at"))
    key = ["doc_id", "sig", "template", "origin"]
    candidates = placed.where("anchor").select(*key).distinct().alias("c")
    both = placed.alias("p")
    agree = F.col("p.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("p.sig") == F.col("c.sig")) \
        & (F.col("p.template") == F.col("c.template")) & (F.col("p.origin") == F.col("c.origin"))
    return both.join(candidates, agree, "left_semi").groupBy(*key, "label", "base", "keys", "all_weight").agg(
        F.count_if("key").alias("found"), F.sum("weight").alias("weight")).where("found = keys").select(
            *key, "label", "base", F.when(F.col("all_weight") > 0, F.round(F.least(F.col("weight") / F.col("all_weight"), F.lit(1.0)), 6))
            .otherwise(F.lit(1.0)).alias("score"))


def licence_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    base = F.col("base")
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  no more than the templates' labels
    found = places(docs, templates).groupBy("doc_id", "sig").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("origin"))).alias("first_word"),
        F.max(F.when(base, F.col("origin"))).alias("last_word"), names(F.when(base, F.col("label"))).alias("base_labels"),
        names("label").alias("labels"), F.max("score").alias("score")).alias("f")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("sig"),
                       F.size(words_of(F.col("text"))).cast("bigint").alias("n_words")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.sig") == F.col("f.sig"))
    return rows.join(found, same, "left").select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
