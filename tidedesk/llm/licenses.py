"""License scans by diagonal voting; DataFrame functions only.

Every run of ``k`` consecutive words of a document has a cyclic-polynomial hash of its word hashes. Spark joins
these hashes to the positions where the templates hold them; a hit at document position p and template
position t is a vote for diagonal p - t. Votes are counted per document, template and diagonal. A template
shorter than ``LONG`` words is found where its diagonal has every vote, that is, where its words stand one
after another. Of a longer one, diagonals at most ``SLACK`` apart are merged (a word put in or left out moves
the rest of a notice to the next diagonal), and the merged span counts if it covers ``COVER`` of the template
in no more than ``STRETCH`` times its length. A hit needs equal words, not only equal hashes.

Words are maximal runs of letters, digits and non-ASCII characters after A-Z is lower-cased.

Defined cases: null or empty texts have no words, no place and score 0; rows that repeat an id and text get
equal results, each its own row, and votes of such rows count once; rows that repeat an id with other texts, or
have none, are judged by their own text; an empty table gives no rows. Further input columns are ignored.
Templates are a bounded list of the library's own; a longer table of them is broadcast only below
``BROADCAST_ROWS`` positions and joined by shuffle beyond.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidedesk.llm.decontaminate import words
from tidedesk.session import materialize

#: Words in a hashed run: templates shorter than ``LONG`` words use ``SHORT``.
SHORT, LONG = 2, 5
SLACK, COVER, STRETCH = 3, 0.75, 1.5
BROADCAST_ROWS = 500_000

# The phrases that the results must find.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Own templates: shorter names, and opening sentences of notices.
MORE = [
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
     " granted", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general"
     " public license", "gpl"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "apache"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
]


def rotated(h: Column, n: int) -> Column:
    """The bits of a long turned left by ``n``."""
    return F.shiftleft(h, n).bitwiseOR(F.shiftrightunsigned(h, 64 - n)) if n else h


def gram_hash(ws: list[Column]) -> Column:
    """Cyclic polynomial of word hashes: from one run to the next the old word's bits leave and the new word's enter."""
    k = len(ws)
    return reduce(lambda a, b: a.bitwiseXOR(b), [rotated(F.xxhash64(w), k - 1 - i) for i, w in enumerate(ws)])


def grams(df: DataFrame, keep: list[str], text: Column) -> DataFrame:
    """``pos, gram, k, h`` of every run of ``SHORT`` and of ``LONG`` words, beside the columns in ``keep``."""
    listed = df.select(*keep, words(text).alias("_w"))
    shifted = [F.slice("_w", i + 1, F.greatest(F.size("_w"), F.lit(1))) for i in range(LONG)]
    placed = listed.select(*keep, F.posexplode(F.arrays_zip(*[s.alias(f"w{i}") for i, s in enumerate(shifted)])).alias("pos", "g"))
    ws = [F.col("g").getField(f"w{i}") for i in range(LONG)]
    runs = F.array(*[F.when(ws[k - 1].isNotNull(), F.struct(F.lit(k).alias("k"), gram_hash(ws[:k]).alias("h"))) for k in (SHORT, LONG)])
    each = placed.select(*keep, "pos", *[w.alias(f"w{i}") for i, w in enumerate(ws)], F.explode(runs).alias("r"))
    return each.select(*keep, "pos", *[f"w{i}" for i in range(LONG)], "r.k", "r.h").filter("k is not null")


def template_positions(spark: SparkSession, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """``h, k, run, template, label, base, tpos, size, n_grams`` of each run of each template, by its own run length."""
    listed = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(text).alias("text"), F.lit(label).alias("label"), F.lit(base).alias("base"))
                       for i, (text, label, base) in enumerate(templates)])
    rows = spark.range(1).select(F.inline(listed))
    sized = rows.withColumn("size", F.size(words(F.col("text"))))
    short = F.when(F.col("size") < LONG, SHORT).otherwise(LONG)
    each = grams(sized, ["template", "label", "base", "size"], F.col("text")).filter(F.col("k") == short)
    return each.select("h", "k", _run(F.col("k")).alias("run"), "template", "label", "base", F.col("pos").alias("tpos"), "size",
                       (F.col("size") - F.col("k") + 1).alias("n_grams"))


def _run(k: Column) -> Column:
    """The words of a run, set apart by a character that no word holds."""
    parts = [F.col(f"w{i}") for i in range(LONG)]
    return F.when(k == SHORT, F.concat_ws(" ", *parts[:SHORT])).otherwise(F.concat_ws(" ", *parts))


def votes(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """One row per hit: ``doc_id, hash, hash2, template, label, base, size, n_grams, k, pos, tpos``; each once."""
    if positions.count() <= BROADCAST_ROWS:
        positions = F.broadcast(positions)
    keyed = docs.select("doc_id", *_text_key(), "text")
    found = grams(keyed, ["doc_id", "hash", "hash2"], F.col("text"))
    met = found.join(positions.withColumnRenamed("h", "th").withColumnRenamed("k", "tk"),
                     (F.col("h") == F.col("th")) & (F.col("k") == F.col("tk"))).filter(_run(F.col("k")) == F.col("run"))
    columns = ["doc_id", "hash", "hash2", "template", "label", "base", "size", "n_grams", "k", "pos", "tpos"]
    return met.groupBy(*columns).agg(F.lit(1).alias("one")).drop("one")


def _text_key() -> list[Column]:
    return [F.xxhash64("text").alias("hash"), F.xxhash64(F.lit("second"), "text").alias("hash2")]


KEY = ["doc_id", "hash", "hash2"]


def diagonals(hits: DataFrame) -> DataFrame:
    """Votes per document, template and diagonal, with the template positions they stand at."""
    return hits.withColumn("diagonal", F.col("pos") - F.col("tpos")).groupBy(
        *KEY, "template", "label", "base", "size", "n_grams", "k", "diagonal",
    ).agg(F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"),
          F.collect_set("tpos").alias("at"))  # at most a template's length


def spans(voted: DataFrame) -> DataFrame:
    """``key, label, base, start, length, cover`` of every verified span.

    Merging looks from each diagonal of a long template to the one before it in the same document. A document's
    diagonals are at most its words.
    """
    exact = voted.filter((F.col("size") < LONG) & (F.col("votes") == F.col("n_grams"))).select(
        *KEY, "label", "base", F.col("diagonal").alias("start"), F.col("size").alias("length"), F.lit(1.0).alias("cover"))
    order = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order)) > SLACK, F.lit(True))
    grouped = voted.filter(F.col("size") >= LONG).withColumn("new", new.cast("int")).withColumn("part", F.sum("new").over(order))
    merged = grouped.groupBy(*KEY, "template", "label", "base", "size", "k", "part").agg(
        F.min("first").alias("start"), F.max(F.col("last") + F.col("k")).alias("stop"),
        F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"))
    # each vote covers k words of the template
    reached = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    judged = merged.withColumn("cover", reached / F.col("size")).filter(
        (F.col("cover") >= COVER) & (F.col("stop") - F.col("start") <= STRETCH * F.col("size")))
    return exact.unionByName(judged.select(*KEY, "label", "base", "start", (F.col("stop") - F.col("start")).alias("length"), "cover"))


def _templates() -> list[tuple[str, str, bool]]:
    return [(t, label, True) for t, label in PHRASES] + [(t, label, False) for t, label in MORE]


def find_spans(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None) -> DataFrame:
    """Every license span of ``docs``; ``templates`` are ``(words, label, base)``."""
    positions = materialize(template_positions(docs.sparkSession, templates or _templates()), "license-positions")
    return spans(materialize(diagonals(votes(docs, positions)), "license-diagonals"))


def report(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    base = F.when(F.col("base"), F.col("start"))
    per_doc = found.groupBy(*KEY).agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("own"), F.collect_set("label").alias("every"),
        F.max("cover").alias("score"))
    listed = per_doc.select(*[F.col(c).alias(f"_{c}") for c in KEY], "n_base", "first_word", "last_word", "score",
                            *[F.array_join(F.array_sort(c), ",").alias(out) for c, out in (("own", "base_labels"), ("every", "labels"))])
    sized = docs.select("doc_id", *_text_key(), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("hash") == F.col("_hash")) & (F.col("hash2") == F.col("_hash2"))
    return sized.join(listed, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def scan(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None) -> DataFrame:
    """Find and report in one call; the spans are written once."""
    return report(docs, materialize(find_spans(docs, templates), "license-spans"))
