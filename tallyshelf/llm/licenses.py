"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

DataFrame functions only. Words are runs of ASCII letters and digits and of non-ASCII characters,
A-Z lower-cased. Phrases are found where their words follow each other.

Templates are sets of word pairs: two words that follow each other, so that word order counts. A block is
a window of ``2 * stride`` pairs; windows begin at every ``stride``-th word of the whole text, whatever its
lines, and ``stride`` is the length of the longest template, so a notice that stands in one piece lies
wholly within a window. A block meets a template of n pairs if it holds at least o = ceil(threshold * n)
of them. A word that sets licenses apart stands in two pairs, so a notice of another license lacks both.

Pairs are ordered by their frequency over all blocks, rarest first, in templates and blocks. A template and
a block that meet share one of the template's first n - o + 1 pairs, and one of the block's first m - o + 1
of m (prefix filter); m is at least o (length filter); no more pairs can be common than either side has from
the first common one on (positional filter). Blocks are joined to templates on prefix pairs, each two once,
on their first common one. What is left is counted exactly.

The list of known pairs and the prefix table have the size of the templates, whatever the corpus; only they
come to the driver or are sent to all tasks.

Defined cases: a null text is empty; a text without words has no places, labels or score; rows are
told apart by content, so repeated rows get the same result each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from tallyshelf.llm import shared

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# License notices, in words.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license version 3"],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "released under the bsd license",
    ],
    "cc-by": ["creative commons attribution 4 0"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license"],
}

#: Words of a text that is not lower-cased yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD_CHARACTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def alone(inner: str) -> str:
    """A pattern, ASCII case ignored, that stands between non-word characters."""
    return f"(?i)(?<!{_WORD_CHARACTER})(?:{inner})(?!{_WORD_CHARACTER})"


def places(words: Column, phrase: str) -> Column:
    """Starts of the phrase in an array of words."""
    parts = phrase.split()
    here = lambda i: reduce(lambda a, b: a & b, (F.get(words, i + k) == w for k, w in enumerate(parts)))
    last = F.size(words) - len(parts)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def phrase_facts(text: Column, phrases: Mapping[str, str]) -> Column:
    """Struct (n_base, first_word, last_word, base) of a text; the words are listed only where a phrase stands."""
    any_phrase = alone("|".join(_GAP.join(p.split()) for p in phrases))
    words = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    starts = F.transform(
        F.array(words),
        lambda w: F.struct(*(places(w, p).alias(f"p{i}") for i, p in enumerate(phrases))),
    )[0]

    def summed(s: Column) -> Column:
        each = [s[f"p{i}"] for i in range(len(phrases))]
        every = F.concat(*each)
        labels = F.array_distinct(
            F.filter(F.array(*(F.when(F.size(x) > 0, F.lit(label)) for x, label in zip(each, phrases.values()))), lambda x: x.isNotNull())
        )
        return F.struct(
            F.size(every).cast("long").alias("n_base"),
            F.array_min(every).cast("long").alias("first_word"),
            F.array_max(every).cast("long").alias("last_word"),
            labels.alias("base"),
        )

    none = F.struct(
        F.lit(0).cast("long").alias("n_base"),
        F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"),
        F.array().cast("array<string>").alias("base"),
    )
    return F.when(text.rlike(any_phrase), F.transform(F.array(starts), summed)[0]).otherwise(none)


def pairs_of(words: Sequence[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def template_sets(templates: Mapping[str, Sequence[str]]) -> list[tuple[str, list[str]]]:
    return [(label, pairs_of(text.split())) for label, texts in templates.items() for text in texts]


def stride_of(templates: Mapping[str, Sequence[str]]) -> int:
    return max(len(text.split()) for texts in templates.values() for text in texts)


def least_of(pairs: Sequence[str], threshold: float) -> int:
    return ceil(threshold * len(pairs) - 1e-9)


def known_pairs(text: Column, known: Sequence[str]) -> Column:
    """``place, pair`` of the known word pairs of a text; the words are listed only where one stands."""
    followers: dict[str, list[str]] = {}
    for pair in known:
        first, second = pair.split()
        followers.setdefault(first, []).append(second)
    any_pair = alone("|".join(f"{first}{_GAP}(?:{'|'.join(seconds)})" for first, seconds in followers.items()))
    words = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    firsts, every = F.array(*map(F.lit, followers)), F.array(*map(F.lit, known))

    def found(w: Column) -> Column:
        # Most words begin no known pair and are passed over before a pair is written down.
        begun = F.filter(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.array_contains(firsts, F.get(w, i)))
        pairs = F.transform(begun, lambda i: F.struct(i.alias("place"), F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)).alias("pair")))
        return F.filter(pairs, lambda p: F.array_contains(every, p["pair"]))

    none = F.array().cast("array<struct<place:int,pair:string>>")
    return F.when(text.rlike(any_pair), F.transform(F.array(words), lambda w: found(w))[0]).otherwise(none)


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = 0.8,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a phrase stands, else the largest share of a template that a block meets, else 0.
    Intermediate tables are written when this is called.
    """
    spark = docs.sparkSession
    scratch = shared.Scratch(spark, "licenses")
    sets, stride = template_sets(templates), stride_of(templates)
    known = sorted({pair for _, pairs in sets for pair in pairs})
    body = F.col("body")
    rows = docs.select(F.col(key).alias("id"), *shared.row_key(F.col(key), F.col(text)), shared.whole(F.col(text)).alias("body"))
    facts = rows.select(
        "id", "row_a", "row_b",
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_words"),
        phrase_facts(body, phrases).alias("found"),
        known_pairs(body, known).alias("hits"),
    )
    facts = scratch.write(facts.select("id", "row_a", "row_b", "n_words", "found.*", "hits"))

    # A pair lies in two windows, at the start of a text in one.
    hits = facts.select("row_a", "row_b", F.explode("hits").alias("hit")).select("row_a", "row_b", "hit.*")
    window = F.floor(F.col("place") / F.lit(stride)).cast("int")
    hits = hits.withColumn("window", F.explode(F.sequence(F.greatest(window - 1, F.lit(0)), window)))
    blocks = hits.groupBy("row_a", "row_b", "window").agg(F.collect_set("pair").alias("pairs"))
    least = [least_of(pairs, threshold) for _, pairs in sets]
    blocks = scratch.write(blocks.where(F.size("pairs") >= min(least)))

    # Global frequency of every known pair, in blocks.
    counts = blocks.select(F.explode("pairs").alias("pair")).groupBy("pair").count()
    frequency = {r["pair"]: r["count"] for r in counts.collect()}
    by_rarity = sorted(known, key=lambda pair: (frequency.get(pair, 0), pair))
    rank = {pair: n for n, pair in enumerate(by_rarity)}
    prefix_rows = []
    for (label, pairs), o in zip(sets, least):
        ordered = sorted(rank[pair] for pair in pairs)
        prefix = ordered[: len(ordered) - o + 1]
        prefix_rows += [(r, label, place, prefix, ordered, o) for place, r in enumerate(prefix)]
    table = spark.createDataFrame(
        prefix_rows, "rank int, label string, place int, prefix array<int>, ordered array<int>, least int"
    )

    places = F.array(*map(F.lit, by_rarity))
    ranks = F.sort_array(F.transform("pairs", lambda pair: (F.array_position(places, pair) - 1).cast("int")))
    block = blocks.select("row_a", "row_b", ranks.alias("own"))
    begin = F.slice("own", F.lit(1), F.size("own") - min(least) + 1)
    block = block.select("row_a", "row_b", "own", F.posexplode(begin).alias("at", "rank"))
    met = block.join(F.broadcast(table), "rank")
    left = F.least(F.size("own") - F.col("at"), F.size("ordered") - F.col("place"))
    met = met.where(F.size("own") >= F.col("least")).where(left >= F.col("least"))
    met = met.where(F.array_min(F.array_intersect("prefix", "own")) == F.col("rank"))
    common = F.size(F.array_intersect("ordered", "own"))
    met = met.select("row_a", "row_b", "label", "least", common.alias("common"), F.size("ordered").alias("n"))
    met = met.where(F.col("common") >= F.col("least"))
    met = met.groupBy("row_a", "row_b").agg(
        F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("n")).alias("share")
    )

    joined = facts.drop("hits").join(met, ["row_a", "row_b"], "left")
    labels = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        F.col("id").alias(key),
        "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
