"""License scans: phrases, and an exact set-similarity join of text blocks with templates; DataFrame functions only.

Blocks are all windows of 32 words, or of twice the longest template's where that is more; those that begin with a template's word are compared, as any other holds no more
template words than the one from its first template word on.  A block meets a template when it
holds at least the threshold's share of the template's distinct words.  Template words are ordered by their
document frequency in the scanned table, rarest first.  A block that meets a template then has one of its first
|T| - need + 1 words (prefix), at least ``need`` template words at all (length), and enough words left after the
first common one on both sides (position).  Templates are indexed by their prefix words: a block looks up those that
it holds and meets only the templates found; of these, those that pass the other filters are compared in full.
Documents without any prefix word never form blocks.  The template side is a constant of bounded size, so the join
needs no shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases of the base labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: Templates of the method's labels.
TEMPLATES = (
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2-text", "licensed under the apache license version 2 0 you may not use this file except in compliance"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-text", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-text", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-text", "licensed under cc by nc 4 0"),
    ("mit-notice", "released under the mit license"),
    ("apache-2-notice", "licensed under the apache license version 2 0"),
    ("all-rights-reserved", "all rights reserved"),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH, STRIDE = 32, 1
#: More words of templates than this are refused, as every plan holds them.
TEMPLATE_WORDS = 20_000


def need(tokens, threshold: float) -> int:
    return math.ceil(threshold * len(tokens) - 1e-9)


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def scan(docs: DataFrame, *, id_col="doc_id", text_col="text", phrases=None, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words: runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters.  score is the largest share of a
    template that a block holds, 1 where a phrase stands, 0 where nothing meets the threshold.  A null or empty
    text has no words, no labels ('') and null places.  Repeated rows stay repeated; an empty table gives an empty
    result; other columns are not read.
    templates: pairs of label and text, or a table of them (columns label, text); their words are taken in the same way.
    """
    phrases = phrases or PHRASES
    if isinstance(templates, DataFrame):
        templates = templates.where(F.col("label").isNotNull() & F.col("text").isNotNull()).select("label", "text").limit(TEMPLATE_WORDS + 1).collect()
    templates = [(label, words) for label, text in templates if (words := template_words(text))]
    if sum(len(words) for _, words in templates) > TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {TEMPLATE_WORDS} words")
    width = max([WIDTH, *(2 * len(words) for _, words in templates)])
    # lower() folds one more letter, the Kelvin sign, to ASCII
    flat = F.lower(F.replace(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SEPARATORS, " "), F.lit("\u212a"), F.lit("\u212b")))
    rows = docs.select(F.col(id_col).alias("id"), F.concat(F.lit(" "), F.trim(flat), F.lit(" ")).alias("p"))
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    rows = rows.withColumn("n_words", F.when(F.length("p") <= 2, F.lit(0)).otherwise(spaces(F.col("p")) - 1).cast("long"))
    counts, firsts, lasts, names = [], [], [], []
    for label, phrase in phrases.items():
        there = F.contains("p", F.lit(f" {phrase} "))
        parts = F.split("p", f" {phrase}(?= )")
        counts.append(F.when(there, F.size(parts) - 1).otherwise(F.lit(0)).cast("long"))
        firsts.append(F.when(there, spaces(F.element_at(parts, 1))).cast("long"))
        lasts.append(F.when(there, F.col("n_words") - (spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())).cast("long"))
        names.append(F.when(there, F.lit(label)))
    rows = rows.withColumns({
        "n_base": sum(counts[1:], counts[0]),
        "first_word": F.least(*firsts) if len(firsts) > 1 else firsts[0],
        "last_word": F.greatest(*lasts) if len(lasts) > 1 else lasts[0],
        "base": F.array_compact(F.array(*names)),
    })

    # document frequency of the templates' words: a table of at most as many rows as they have words
    known = sorted({w for _, t in templates for w in t})
    has = F.array_intersect(F.split("p", " "), F.array(*map(F.lit, known)))
    frequency = {r.word: r.n for r in rows.select(F.explode(has).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    ordered = sorted(known, key=lambda w: (frequency.get(w, 0), w))
    sets = [(label, [w for w in ordered if w in set(words)]) for label, words in templates]
    prefixes = [tokens[: len(tokens) - need(tokens, threshold) + 1] for _, tokens in sets]
    union = sorted({w for first in prefixes for w in first})
    literal = F.array(*[F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, tokens)).alias("tokens"), F.lit(need(tokens, threshold)).alias("need")) for label, tokens in sets])
    index = F.create_map(*[x for w in union for x in (F.lit(w), F.array(*[F.lit(i + 1) for i, first in enumerate(prefixes) if w in first]))])
    every = F.array(*map(F.lit, ordered))
    words = F.split(F.trim("p"), " ")
    # one lambda variable keeps the words from being split once per block
    places = F.sequence(F.lit(0), F.greatest(F.col("n_words") - 1, F.lit(0)).cast("int"), F.lit(STRIDE))
    starts = lambda w: F.filter(places, lambda i: F.array_contains(every, F.get(w, i)))
    blocks = F.flatten(F.transform(F.array(words), lambda w: F.transform(starts(w), lambda i: F.array_intersect(every, F.slice(w, i + 1, F.lit(width))))))

    firsts_of = F.array(*map(F.lit, union))
    found = lambda b: F.array_distinct(F.flatten(F.transform(F.array_intersect(b, firsts_of), lambda w: F.element_at(index, w))))

    def left(t, b):
        first = F.element_at(F.array_intersect(t["tokens"], b), 1)
        return 1 + F.least(F.size(t["tokens"]) - F.array_position(t["tokens"], first), F.size(b) - F.array_position(b, first))

    shared = lambda t, b: F.size(F.array_intersect(t["tokens"], b))
    meets = lambda t, b: (F.size(b) >= t["need"]) & (left(t, b) >= t["need"]) & (shared(t, b) >= t["need"])
    of = lambda b: F.filter(F.transform(found(b), lambda i: F.element_at(literal, i)), lambda t: meets(t, b))
    hits = F.flatten(F.transform(blocks, lambda b: F.transform(of(b), lambda t: F.struct(t["label"].alias("label"), (shared(t, b) / F.size(t["tokens"])).alias("share")))))
    near = F.arrays_overlap(words, firsts_of)
    rows = rows.withColumn("hits", F.when(near, F.array_distinct(hits)))
    method = F.coalesce(F.transform("hits", lambda h: h["label"]), F.array().cast("array<string>"))
    share = F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0))
    joined = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    return rows.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        joined(F.col("base")).alias("base_labels"), joined(F.concat("base", method)).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(share).alias("score"),
    )


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    values = ", ".join(f"('{label}', {sorted(set(text.split()))!r})" for label, text in TEMPLATES)
    phrases = ", ".join(f"('{label}', {text.split()!r})" for label, text in PHRASES.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
       FROM documents),
t(label, tokens) AS (VALUES {values}),
f(label, words) AS (VALUES {phrases}),
h AS (SELECT r, label, unnest(list_filter(range(len(w) - len(words) + 1), lambda i: w[i + 1 : i + len(words)] = words)) place
      FROM d, f WHERE list_has_all(w, words)),
b AS (SELECT r, count(*) n, min(place) lo, max(place) hi, list(DISTINCT label) labels FROM h GROUP BY r),
k AS (SELECT r, w[i + 1 : i + {WIDTH}] x FROM (SELECT r, w, unnest(range(0, len(w), {STRIDE})) i FROM d)),
m AS (SELECT r, label, len(list_intersect(tokens, x)) / len(tokens)::DOUBLE share FROM k, t WHERE list_has_any(x, tokens)),
g AS (SELECT r, list(DISTINCT label) labels, max(share) share FROM m WHERE share >= 0.8 - 1e-9 GROUP BY r)
SELECT doc_id, len(w) n_words, coalesce(n, 0) n_base, lo first_word, hi last_word,
       coalesce(list_aggregate(list_sort(b.labels), 'string_agg', ','), '') base_labels,
       coalesce(list_aggregate(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(g.labels, [])))), 'string_agg', ','), '') labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE score
FROM d LEFT JOIN b USING (r) LEFT JOIN g USING (r)
"""


OP8_SQL = _sql()
