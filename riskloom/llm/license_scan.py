"""License scan by diagonal voting, in built-in functions only.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. All rolling
k-word hashes of a document are joined with the hashes of the license templates; each hit
votes for the diagonal it lies on (its place in the document minus its place in the
template). Neighbouring diagonals of a template are merged, so that an inserted or missing
word does not split a span, and a span is verified: enough of the template's k-grams, hardly
longer than the template, and words that are equal where they are aligned. Notices that differ
in a word find each other's places: a span stands only if no verified span of another label that
overlaps it is better, by share of the k-grams, then by length of the template.

The join is made in two steps. The few hundred template hashes are a constant set, so a
document keeps only the places whose hash is among them, with the words around each. The
places are then joined with the template positions, a broadcast table whose size depends on
the templates alone.

Base labels come from fixed phrases whose words stand consecutively; they are never taken
away. A score is 1 where a base phrase stands, else the largest share of a template's
k-grams on merged diagonals, verified or not.

Defined cases: a null or empty text has no words, no labels and score 0. Rows that share
doc_id and text get the same result each. Null ids are looked up like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import materialize

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label and notice, from the public texts of the licenses.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

K = 3
GAP = 2
COVERED = 0.6
LONGER = 1.05
ALIGNED = 0.5

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words, A-Z lower-cased. The two letters that lower() would turn into ASCII ones are
    replaced first; what it does to other letters does not matter for ASCII words."""
    value = text_or_empty(text)
    for letter in "İK":
        value = F.replace(value, F.lit(letter), F.lit("ı"))
    return F.filter(F.split(F.lower(value), SEPARATORS), lambda w: w != "")


def _refuse_short(texts: Sequence[str], k: int) -> None:
    """A text of fewer than k words has no k-gram and would never be found."""
    short = [t for t in texts if len(t.split()) < k]
    if short:
        raise ValueError(f"phrases and templates need at least {k} words: {short}")


def _gram(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(k)])


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """template, label, place, gram, t_words: a row per k-gram of a template."""
    _refuse_short([t for _, t in templates], k)
    rows = [
        F.struct(
            F.lit(i).alias("template"),
            F.lit(label).alias("label"),
            F.split(F.lit(text), " +").alias("t_words"),
        )
        for i, (label, text) in enumerate(templates)
    ]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    places = F.sequence(F.lit(0), F.size("t_words") - k)
    return table.where(F.size("t_words") >= k).select(
        "template", "label", "t_words", F.explode(places).alias("place")
    ).withColumn("gram", _gram(F.col("t_words"), F.col("place"), k))


def _constants(templates: Sequence[tuple[str, str]], phrases: dict[str, str], k: int) -> list[Column]:
    """The hashes of all k-grams of templates and phrases, folded by the optimizer."""
    _refuse_short([*(t for _, t in templates), *phrases], k)
    grams = set()
    for text in [*(t for _, t in templates), *phrases]:
        words = text.split()
        grams |= {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    return [F.xxhash64(*map(F.lit, g)) for g in sorted(grams)]


def _stands(words: Column, at: Column, phrase: str) -> Column:
    out = F.lit(True)
    for i, word in enumerate(phrase.split()):
        out &= F.coalesce(F.get(words, at + i) == word, F.lit(False))
    return out


def _starts(phrase: str) -> Column:
    return F.filter("hits", lambda i: _stands(F.col("words"), i, phrase))


def places(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    k: int = K,
) -> DataFrame:
    """A row per document: its counts, base places, and the hits with the words around them."""
    reach = max(len(t.split()) for _, t in templates)
    grams = _constants(templates, phrases, k)
    at = F.when(
        F.size("words") >= k,
        F.filter(
            F.sequence(F.lit(0), F.size("words") - k), lambda i: _gram(F.col("words"), i, k).isin(grams)
        ),
    ).otherwise(F.array().cast("array<int>"))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text_or_empty("text"), 256).alias("text_key"),
        words_of("text").alias("words"),
    ).withColumn("hits", at)
    # Every phrase has at least k words, so it starts at a hit.
    base = {phrase: _starts(phrase) for phrase in phrases}
    starts = F.concat(*base.values())
    labels = F.array(*[F.when(F.size(b) > 0, F.lit(phrases[p])) for p, b in base.items()])
    around = F.transform(
        "hits",
        lambda i: F.struct(
            i.alias("i"),
            F.greatest(i - reach, F.lit(0)).alias("start"),
            F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + k)).alias("near"),
        ),
    )
    return found.select(
        "doc_id",
        "text_key",
        F.size("words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base"),
        around.alias("around"),
    )


def spans(
    found: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = K
) -> DataFrame:
    """doc_id, text_key, label, first, last, covered, verified: merged diagonals. Of verified
    spans of different labels that overlap only the best stays verified."""
    known = F.broadcast(template_grams(found.sparkSession, templates, k))
    hits = found.where(F.size("around") > 0).select(
        "doc_id", "text_key", F.explode("around").alias("hit")
    )
    hits = hits.select("doc_id", "text_key", "hit.*").withColumn(
        "gram", _gram(F.col("near"), F.col("i") - F.col("start"), k)
    )
    shift = F.col("i") - F.col("place") - F.col("start")
    equal = F.filter(
        F.sequence(F.lit(0), F.size("t_words") - 1),
        lambda j: F.when(shift + j >= 0, F.get("near", shift + j) == F.get("t_words", j)),
    )
    votes = hits.join(known, "gram").select(
        "doc_id",
        "text_key",
        "template",
        "label",
        "place",
        "i",
        (F.col("i") - F.col("place")).alias("diagonal"),
        F.size(equal).alias("equal"),
        F.size("t_words").alias("t_size"),
    )
    votes = votes.distinct()  # rows that repeat a document vote once
    one = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal", "i")
    apart = F.col("diagonal") - F.lag("diagonal").over(one) > GAP
    votes = votes.withColumn("new", F.coalesce(apart, F.lit(False)).cast("int"))
    votes = votes.withColumn("span", F.sum("new").over(one))
    merged = votes.groupBy("doc_id", "text_key", "template", "label", "span", "t_size").agg(
        F.countDistinct("place").alias("places"),
        F.min("i").alias("first"),
        (F.max("i") + k - 1).alias("last"),
        F.max("equal").alias("equal"),
    )
    covered = F.col("places") / (F.col("t_size") - (k - 1))
    length = F.col("last") - F.col("first") + 1
    longest = F.greatest(F.ceil(F.col("t_size") * LONGER), F.col("t_size") + GAP)
    merged = merged.withColumn("covered", covered).withColumn(
        "verified",
        (covered >= COVERED)
        & (length <= longest)
        & (F.col("equal") >= F.col("t_size") * ALIGNED),
    )
    merged = merged.withColumn(
        "quality", F.struct("covered", "t_size", (-F.col("template")).alias("earlier"))
    )
    # A verified span is hardly longer than its template, so those that overlap start close by;
    # their number follows from the templates, not from the document.
    reach = max(len(t.split()) for _, t in templates)
    reach = max(ceil(reach * LONGER), reach + GAP)
    close = Window.partitionBy("doc_id", "text_key").orderBy("first").rangeBetween(-reach, reach)
    rival = F.when(F.col("verified"), F.struct("label", "first", "last", "quality"))
    merged = merged.withColumn("rivals", F.collect_list(rival).over(close))
    beaten = F.exists(
        "rivals",
        lambda r: (r["label"] != F.col("label"))
        & (r["first"] <= F.col("last"))
        & (r["last"] >= F.col("first"))
        & (r["quality"] > F.col("quality")),
    )
    return merged.withColumn("verified", F.col("verified") & ~beaten).drop("rivals", "quality")


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    k: int = K,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = materialize(places(docs, phrases, templates, k), "license-places")
    judged = spans(found, templates, k).groupBy("doc_id", "text_key").agg(
        F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("own"),
        F.max("covered").alias("covered"),
    )
    own = judged.select(
        F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "own", "covered"
    )
    joined = found.join(
        own,
        F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")),
        "left",
    )
    labels = F.array_union("base", F.coalesce("own", F.array().cast("array<string>")))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("covered", F.lit(0.0)))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.least(score, F.lit(1.0)).alias("score"),
    )
