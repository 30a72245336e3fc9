"""License scan: exact phrases, and an exact set-similarity join of text blocks with license statements.

A text block is a run of words, whatever the line ends between them: blocks begin at every multiple of the longest template's
length and are twice as long, so that each passage as long as a template lies within one of them, wrapped or not. A block matches a
template if it contains at least THRESHOLD of the template's distinct words. The join orders
all template words by the number of blocks that hold them, rarest first. With a = ceil(THRESHOLD x size of the template), a match
must share one of the template's first (size - a + 1) words in that order (prefix filter), have a of the words at all (length
filter), and have room for a words from the shared one on (positional filter); what passes is verified exactly. Only DataFrame
functions are used. The templates are a fixed list, so the index that is broadcast has a fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import ascii_lower, materialize, text_or_empty

# The phrases of the base scan.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Statements by which works are licensed, and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version"),
    ("agpl", "licensed under the gnu affero general public license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version of the license or at your option any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
]
THRESHOLD = 0.9

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def spaced_words(text: Column) -> Column:
    """The words of text, lower-cased in A-Z, each with one space before it, and one after the last; empty without words."""
    line = F.trim(ascii_lower(F.regexp_replace(text, NOT_WORD, " ")))
    return F.when(line == "", F.lit("")).otherwise(F.concat(F.lit(" "), line, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_columns(line: Column, n_words: Column) -> dict[str, Column]:
    """n_base, first_word, last_word and base (labels) for spaced words."""
    wide = F.replace(line, F.lit(" "), F.lit("  "))
    count, first, last, labels = F.lit(0).cast("bigint"), [], [], []
    for phrase, label in PHRASES.items():
        own = F.lit(f" {phrase} ")
        has = F.contains(line, own)
        doubled = " " + phrase.replace(" ", "  ") + " "
        places = (F.char_length(wide) - F.char_length(F.replace(wide, F.lit(doubled), F.lit("")))) / len(doubled)
        count = count + F.when(has, places.cast("bigint")).otherwise(0)
        first.append(F.when(has, _spaces(F.substring_index(line, f" {phrase} ", 1))))
        last.append(F.when(has, n_words - _spaces(F.substring_index(line, f" {phrase} ", -1)) - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    return {"n_base": count, "first_word": F.least(*first).cast("bigint"), "last_word": F.greatest(*last).cast("bigint"), "base": F.array_compact(F.array(*labels))}


def template_sets(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> list[tuple[str, frozenset[str], int]]:
    """Label, distinct words and required overlap of each template."""
    sets = [(label, frozenset(text.split())) for label, text in templates]
    return [(label, words, math.ceil(threshold * len(words) - 1e-9)) for label, words in sets]


def span_of(templates: list[tuple[str, str]]) -> int:
    """The words of the longest template."""
    return max(len(text.split()) for _, text in templates)


def block_words(docs: DataFrame, vocabulary: list[str], span: int) -> DataFrame:
    """doc_id, h, block, words: the template words of every block that holds one: those of 2 x span words from block x span on. h tells
    texts of equal doc_id apart."""
    spaced = docs.select("doc_id", F.xxhash64("text").alias("h"), F.array_remove(F.split(ascii_lower(F.col("text")), NOT_WORD), "").alias("all"))
    last = F.greatest(F.ceil(F.size("all") / span).cast("int") - 2, F.lit(0))
    listed = F.array(*map(F.lit, vocabulary))
    blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.array_intersect(F.slice("all", k * span + 1, 2 * span), listed))
    rows = spaced.select("doc_id", "h", F.posexplode(blocks).alias("block", "words"))
    return rows.filter(F.size("words") > 0)


def matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, h, block, label, score: every block and template whose containment reaches threshold, docs being (doc_id, text)."""
    spark = docs.sparkSession
    sets = template_sets(templates, threshold)
    vocabulary = sorted(frozenset().union(*(words for _, words, _ in sets)))
    blocks = materialize(block_words(docs, vocabulary, span_of(templates)), "blocks")
    seen = blocks.select(F.explode("words").alias("word")).groupBy("word").count()
    found = dict(seen.collect())  # one row for each template word at most
    ranked = sorted(vocabulary, key=lambda w: (found.get(w, 0), w))
    place = {w: i for i, w in enumerate(ranked)}
    index = []
    for number, (label, words, need) in enumerate(sets):
        ordered = sorted(words, key=place.__getitem__)
        index += [(w, number, label, p, len(ordered), need, ordered) for p, w in enumerate(ordered[: len(ordered) - need + 1])]
    prefixes = spark.createDataFrame(index, "word string, template int, label string, t_pos int, t_size int, need int, t_words array<string>")
    least = min(need for _, _, need in sets)
    # the order of the first argument is kept, so a block's words come rarest first
    ordered = blocks.withColumn("words", F.array_intersect(F.array(*map(F.lit, ranked)), "words")).withColumn("size", F.size("words")).filter(F.col("size") >= least)
    probes = ordered.select("doc_id", "h", "block", "words", "size", F.posexplode(F.slice("words", F.lit(1), F.col("size") - least + 1)).alias("b_pos", "word"))
    candidates = probes.join(F.broadcast(prefixes), "word").filter(
        (F.col("size") >= F.col("need")) & (F.lit(1) + F.least(F.col("t_size") - F.col("t_pos"), F.col("size") - F.col("b_pos")) - 1 >= F.col("need"))
    )
    shared = F.size(F.array_intersect("words", "t_words"))
    exact = candidates.withColumn("shared", shared).filter("shared >= need")
    return exact.groupBy("doc_id", "h", "block", "template").agg(F.first("label").alias("label"), F.max(F.col("shared") / F.col("t_size")).alias("score"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of docs (doc_id, text).

    score is 1 with a base label, else the best containment of a template, else 0. Null and empty texts have no words and no
    labels (empty strings). Null doc_ids and repeated rows are scanned row by row.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    by_text = matches(own, templates, threshold).groupBy("doc_id", "h").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    by_text = by_text.select(F.col("doc_id").alias("m_id"), F.col("h").alias("m_h"), "more", "best")
    rows = own.select("doc_id", F.xxhash64("text").alias("h"), spaced_words(F.col("text")).alias("line"))
    rows = rows.withColumn("n_words", F.greatest(_spaces(F.col("line")) - 1, F.lit(0)).cast("bigint"))
    rows = rows.select("doc_id", "h", "n_words", *(c.alias(name) for name, c in phrase_columns(F.col("line"), F.col("n_words")).items()))
    joined = rows.join(by_text, rows.doc_id.eqNullSafe(by_text.m_id) & (rows.h == by_text.m_h), "left")
    listed = lambda c: F.array_join(F.array_sort(c), ",")
    every = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", listed(F.col("base")).alias("base_labels"), listed(every).alias("labels"), score.alias("score"))


def oracle_sql() -> str:
    """The scan as brute force in DuckDB: every block against every template."""
    span = span_of(TEMPLATES)
    rows = ", ".join(f"('{label}', [{', '.join(repr(w) for w in sorted(words))}], {need})" for label, words, need in template_sets())
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    starts = []
    for phrase in PHRASES:
        parts = phrase.split()
        test = " and ".join(f"coalesce(w[i + {k + 1}] = '{p}', false)" for k, p in enumerate(parts))
        starts.append(f"list_filter(range(0, len(w)), lambda i: {test})")
    labels = ", ".join(f"case when len(p{k}) > 0 then '{label}' end" for k, label in enumerate(PHRASES.values()))
    return f"""
with d as (select doc_id, {lower} as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{word}') as w from d),
p as (select doc_id, t, len(w) as n_words, {', '.join(f'{s} as p{k}' for k, s in enumerate(starts))} from w),
b as (select *, list_concat({', '.join(f'p{k}' for k in range(len(PHRASES)))}) as places,
      list_filter([{labels}], lambda x: x is not null) as base from p),
templates(label, words, need) as (values {rows}),
starts as (select doc_id, w, unnest(range(0, greatest(ceil(len(w) / {span}.0)::bigint - 1, 1))) as k from w),
lines as (select distinct doc_id, list_distinct(w[(k * {span} + 1):(k * {span} + 2 * {span})]) as lw from starts),
hits as (select doc_id, label, len(list_intersect(lw, words)) / len(words) as score from lines join templates
         on len(list_intersect(lw, words)) >= need),
m as (select doc_id, list(distinct label) as more, max(score) as best from hits group by doc_id)
select doc_id, n_words::bigint as n_words, len(places)::bigint as n_base, list_min(places)::bigint as first_word,
       list_max(places)::bigint as last_word, array_to_string(list_sort(base), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') as labels,
       case when len(base) > 0 then 1.0 else coalesce(best, 0) end::double as score
from b left join m using (doc_id)
"""
