"""Operator 4: license statements by exact set-similarity join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import lower_ascii, split_words, stored

#: The phrases of the base result and their labels.
# each ends with the word 'license'
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Opening statements of public licenses, by label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
]
#: Share of a template's distinct words that a block must hold.
CONTAINMENT = 0.8


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase among the words."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return found

    return F.when(F.size(words) >= len(parts), F.filter(starts, here)).otherwise(F.array().cast("array<int>"))


def run_step(templates: list[tuple[str, str]]) -> int:
    """Words from the start of one run to the start of the next: those of the longest template.

    A run is twice as long, so every stretch of up to one word more than a template lies in a run.
    """
    return max([len(text.split()) for _, text in templates], default=1)


def _read_texts(docs: DataFrame, vocabulary: list[str], step: int) -> DataFrame:
    """One pass over the texts: base results, and of each run of words the template words it holds."""
    split = docs.select(
        "doc_id",
        F.contains(F.lower(F.coalesce("text", F.lit(""))), F.lit("license")).alias("named"),
        split_words(lower_ascii(F.col("text"))).alias("words"),
    )
    none = F.array().cast("array<int>")
    places = [F.when(F.col("named"), _places(F.col("words"), p)).otherwise(none) for p in PHRASES]
    marked = split.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.struct(*[x.alias(f"p{i}") for i, x in enumerate(places)]).alias("places"),
        F.transform("words", lambda w: F.when(w.isin(vocabulary), w)).alias("marked"),
    )

    def in_run(i: Column) -> Column:
        run = F.slice("marked", i * step + 1, 2 * step)
        return F.struct(F.size(run).alias("n"), F.array_distinct(F.array_compact(run)).alias("held"))

    runs = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("marked") / step).cast("int") - 2))
    return marked.select(
        "doc_id",
        F.monotonically_increasing_id().alias("at"),
        "n_words",
        "places",
        F.filter(F.transform(runs, in_run), lambda b: F.size(b["held"]) > 0).alias("blocks"),
    )


def license_scan(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT
) -> DataFrame:
    """License labels of every document.

    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Base: starts of
    the phrases over the whole text. A text block is a run of twice as many words as the longest
    template has, whatever the line ends; runs overlap by half, so a statement lies whole in one of
    them however it is wrapped, and words far apart share none. The method adds the labels of all
    templates of which a run holds at least ``containment`` of the distinct words, whatever their
    order: an exact set-similarity join of runs with templates. Template words are ordered by the
    number of runs that hold them, rarest first. A run that meets the threshold holds one of a
    template's first (words - needed + 1) words (prefix filter), has at least as many words as are
    needed (length filter), and from its first shared word on the template has enough words left
    (positional filter); the pairs left are counted exactly.

    ``score`` is the largest containment of any template met, 1 if a phrase stands in the text,
    else 0. Null texts are empty: no words, no labels (''), null places. Rows that repeat are
    scored each. Extra columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    sets = [(i, label, sorted(set(text.split()))) for i, (label, text) in enumerate(templates)]
    vocabulary = sorted({w for _, _, words in sets for w in words}) or [""]
    texts = stored(_read_texts(docs, vocabulary, run_step(templates)), "license-texts")

    blocks = texts.select("at", F.explode("blocks").alias("b")).select("at", "b.n", "b.held")
    common = {r.w: r.n for r in blocks.select(F.explode("held").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    prefix = []
    for i, label, words in sets:
        ordered = sorted(words, key=lambda w: (common.get(w, 0), w))
        needed = max(1, math.ceil(containment * len(ordered) - 1e-9))
        for at, word in enumerate(ordered[: len(ordered) - needed + 1]):
            prefix.append((word, i, label, at, needed, ordered))
    schema = "w string, template int, label string, place int, needed int, words array<string>"
    prefixes = stored(docs.sparkSession.createDataFrame(prefix, schema).coalesce(1), "license-prefixes")

    rare = sorted({p[0] for p in prefix}) or [""]
    shared = blocks.withColumn("w", F.explode(F.filter("held", lambda w: w.isin(rare))))
    fits = (F.col("n") >= F.col("needed")) & (F.size("held") >= F.col("needed"))
    enough = F.size("words") - F.col("place") >= F.col("needed")
    candidates = shared.join(prefixes, "w").filter(fits & enough)
    overlap = F.size(F.array_intersect("held", "words"))
    met = candidates.filter(overlap >= F.col("needed")).select("at", "label", (overlap / F.size("words")).alias("share"))
    by_row = met.groupBy("at").agg(F.collect_set("label").alias("met"), F.max("share").alias("share"))

    starts = F.concat(*[F.col(f"places.p{i}") for i in range(len(PHRASES))])
    base = F.array_compact(
        F.array(*[F.when(F.size(f"places.p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())])
    )
    return texts.join(by_row, "at", "left").select(
        "doc_id",
        "n_words",
        F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_distinct(F.concat(base, F.coalesce("met", F.array().cast("array<string>"))))), ","
        ).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
