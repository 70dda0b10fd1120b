"""License scan: an exact set-similarity join between text blocks and templates.

Only DataFrame and SQL functions run here. A block is a line, or a window of
neighbouring words of the text as long as the template (fewer only if the text
has fewer), wherever lines end; so notices wrapped over lines are met too. A
block's words are a set; a template (the words of a license notice) is met when
the block holds at least ``least`` of the template's words. Words are ordered by
how many documents hold them, rarest first, counted over all documents; then

* prefix filter: a block that meets a template of n words with at least
  k = ceil(least * n) of them holds one of its n - k + 1 rarest words, so only
  these words are joined;
* length filter: the block has at least k different words;
* positional filter: a block whose rarest match is the template's p-th word
  can share at most n - p + 1 words;

and the rest is verified by the size of the intersection. Windows are looked
for around each prefix word only: the words up to a template's length before
and behind it must hold k of the template's words, and then each window with
the prefix word is verified. The side of the
templates has at most a few hundred words, however large the documents are,
and is the only broadcast; blocks without any prefix word never leave the scan.

Base places are phrases whose words stand one after the other.

Defined results: a null text counts as empty (0 words, no labels, score 0);
repeated rows come back as often as they came, each with its own labels; a
null doc_id is kept; other columns do not matter; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word after lower-casing A-Z, what stands between words, and a word before lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# FIXED VALUES: base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# FIXED VALUES: openings of public license notices, by label.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this work is licensed under the gnu general public license version": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}


def words(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN), lambda w: w != "")


def holds_any(text: Column, tokens: list[str]) -> Column:
    """If one of the tokens stands in the text as a word (ASCII case does not matter)."""
    inside = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    return text.rlike(f"(?i)(?<!{inside})(?:{'|'.join(sorted(tokens))})(?!{inside})")


def template_table(docs: DataFrame, templates: dict[str, str], least: float) -> tuple[DataFrame, list[str]]:
    """(template, label, tokens, length, n, k, token, place) of each prefix word, and all prefix words.

    The frequency of each template word is counted over all documents; the
    result has one row for each template word and comes to the driver.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.split()})
    counted = (docs.where("text is not null")
               .select(F.explode(F.array_intersect(words(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("token"))
               .groupBy("token").count().collect())
    found = {r["token"]: r["count"] for r in counted}
    rows = []
    for number, (text, label) in enumerate(sorted(templates.items())):
        tokens = sorted(set(text.split()), key=lambda w: (found.get(w, 0), w))
        n = len(tokens)
        k = -int(-least * n // 1)
        rows += [(number, label, tokens, len(text.split()), n, k, tokens[p], p + 1) for p in range(n - k + 1)]
    schema = "template int, label string, template_tokens array<string>, length int, n int, k int, token string, place int"
    return spark.createDataFrame(rows, schema), sorted({r[6] for r in rows})


def surroundings(text_words: Column, tokens: list[str], most: int) -> Column:
    """Array of (token, before, words) of each place of a token: up to ``most`` - 1 words before it and behind it."""
    def place(w: Column, i: Column) -> Column:
        before = F.least(i, F.lit(most - 1))
        return F.when(w.isin(tokens), F.struct(w.alias("token"), before.alias("before"), (i - before + 1).alias("start")))

    found = F.filter(F.transform(text_words, place), lambda x: x.isNotNull())
    return F.transform(found, lambda x: F.struct(x["token"].alias("token"), x["before"].alias("before"),
                                                 F.slice(text_words, x["start"], x["before"] + most).alias("words")))


def windows_met(near: DataFrame, prefix: DataFrame) -> DataFrame:
    """(row_id, label, share) of the templates that windows around prefix words meet."""
    start = F.greatest(F.col("before") - F.col("length") + 1, F.lit(0))
    held = lambda w: F.size(F.array_intersect(w, F.col("template_tokens")))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.col("length") + 1, F.lit(1)))
    return (near.join(F.broadcast(prefix), "token")
            .withColumn("words", F.slice("words", start + 1, F.col("before") - start + F.col("length")))
            .where(held(F.col("words")) >= F.col("k"))
            .withColumn("shared", F.array_max(F.transform(starts, lambda i: held(F.slice("words", i, F.col("length"))))))
            .where("shared >= k")
            .select("row_id", "label", (F.col("shared") / F.col("n")).alias("share")))


def phrase_places(text_words: str, phrases: dict[str, str]) -> Column:
    """All places of the phrases: array of (start, label), found at their last words."""
    def places(parts: list[str], label: str) -> Column:
        back = len(parts) - 1

        def place(w: Column, i: Column) -> Column:
            met = (w == parts[-1]) & (i >= back)
            for d, part in enumerate(parts[:-1]):
                met = met & F.coalesce(F.get(text_words, F.greatest(i - (back - d), F.lit(0))) == part, F.lit(False))
            return F.when(met, F.struct((i - back).cast("long").alias("start"), F.lit(label).alias("label")))

        return F.filter(F.transform(text_words, place), lambda x: x.isNotNull())

    return F.concat(*[places(p.split(), label) for p, label in phrases.items()])


def license_scan(docs: DataFrame, least: float = 0.8, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``least``: share of a template's words that a block must hold. ``score``:
    1 with a base place, else the largest share of a template met, else 0.
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    prefix, tokens = template_table(docs, templates, least)
    lasts = sorted({p.split()[-1] for p in phrases})
    lines = F.when(holds_any(F.col("text"), tokens), F.filter(F.split("text", "\n"), lambda line: holds_any(line, tokens)))
    wrapped = F.when(F.contains(F.col("text"), F.lit("\n")) & holds_any(F.col("text"), tokens), words(F.col("text")))
    scanned = (docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.regexp_count("text", F.lit(RAW_WORD)).cast("long").alias("n_words"),
                           F.when(holds_any(F.col("text"), lasts), words(F.col("text"))).alias("words"), lines.alias("blocks"), wrapped.alias("wrapped"))
               .select("row_id", "doc_id", "n_words", phrase_places("words", phrases).alias("places"), "blocks",
                       surroundings(F.col("wrapped"), tokens, max(len(t.split()) for t in templates)).alias("near")))
    scanned = common.stored(scanned)
    blocks = (scanned.where("size(blocks) > 0").select("row_id", F.posexplode("blocks").alias("block", "line"))
              .select("row_id", "block", F.array_distinct(words(F.col("line"))).alias("tokens")))
    met = (blocks.select("row_id", "block", "tokens", F.explode("tokens").alias("token"))
           .join(F.broadcast(prefix), "token")
           .where(F.size("tokens") >= F.col("k"))
           .groupBy("row_id", "block", "template").agg(F.min("place").alias("place"), F.first("tokens").alias("tokens"), F.first("template_tokens").alias("template_tokens"),
                                                       F.first("label").alias("label"), F.first("n").alias("n"), F.first("k").alias("k"))
           .where("n - place + 1 >= k")
           .withColumn("shared", F.size(F.array_intersect("tokens", "template_tokens")))
           .where("shared >= k")
           .select("row_id", "label", (F.col("shared") / F.col("n")).alias("share")))
    near = scanned.where("size(near) > 0").select("row_id", F.explode("near").alias("near")).select("row_id", "near.*")
    met = met.unionByName(windows_met(near, prefix)).groupBy("row_id").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    both = F.array_distinct(F.concat(F.coalesce(base, F.array().cast("array<string>")), F.coalesce("found", F.array().cast("array<string>"))))
    starts = F.transform("places", lambda p: p["start"])
    n_base = F.greatest(F.size("places"), F.lit(0)).cast("long")
    text_of = lambda labels: F.array_join(F.array_sort(F.coalesce(labels, F.array().cast("array<string>"))), ",")
    return (scanned.drop("blocks", "near").join(met, "row_id", "left")
            .select("doc_id", "n_words", n_base.alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                    text_of(base).alias("base_labels"), text_of(both).alias("labels"),
                    F.when(n_base > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score")))
