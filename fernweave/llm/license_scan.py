"""License scans as an exact set-similarity join, in DataFrame functions only.

A template is the set of words of a license notice. A text block is a line and,
as notices are hard-wrapped, the words that follow it in its paragraph, as many
as the longest template has; so any notice lies in a block, however its lines
are parted. A block meets a template if it holds at least ``THRESHOLD`` of the template's
words. All words of templates are ordered by their number of blocks in the
whole corpus, the rarest first. With ``need`` words of a template's ``n``
wanted, a block must hold one of the template's first ``n - need + 1`` words
(prefix filter), have ``need`` template words at all (length filter), and its
first common word must leave enough words behind it on both sides (positional
filter). The prefixes make an inverted index from words to templates, a literal
as small as the templates; blocks look their words up in it, and the
intersection of what is left is counted. So every pair is found, without a
shuffle of texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernweave.llm.common import table

#: Characters between words, after A-Z are lower-cased (fixed by the contract); a line feed parts blocks.
GAP = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values of the contract: phrase and label.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Opening words of public license notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Share of a template's words that a block must hold.
THRESHOLD = 0.9


def words(text: str) -> list[str]:
    """Distinct words of a template, in order."""
    return list(dict.fromkeys(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w))


@dataclass(frozen=True)
class Template:
    """Positions of a template's words in the global order, ascending."""

    label: str
    ranks: tuple[int, ...]
    need: int

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.ranks[: len(self.ranks) - self.need + 1]


def array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def normal(text: Column) -> Column:
    """Words parted by single spaces, blocks by line feeds; null is empty."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP, " ")


def block_words(block: Column, vocabulary: list[str]) -> Column:
    """Distinct template words of a block."""
    return F.array_intersect(F.split(block, " "), array(vocabulary))


def global_order(df: DataFrame, text: str, templates: list[tuple[str, str]]) -> list[str]:
    """All template words by their number of blocks in the whole table, rarest first; ties by code point."""
    vocabulary = sorted({w for _, t in templates for w in words(t)})
    found = (
        df.select(F.explode(F.split(normal(F.col(f"`{text}`")), "\n")).alias("block"))
        .select(F.explode(block_words(F.col("block"), vocabulary)).alias("word"))
        .groupBy("word")
        .count()
    )
    counts = {r["word"]: r["count"] for r in found.collect()}  # a row for each template word at most
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def matches(blocks: Column, order: list[str], templates: list[Template]) -> Column:
    """Array of (label, share of the template's words) for each pair of a block and a template that meets the threshold."""
    rank = F.create_map(*[F.lit(x) for i, w in enumerate(order) for x in (w, i)])
    by_prefix: dict[int, list[int]] = {}
    for k, t in enumerate(templates):
        for r in t.prefix:
            by_prefix.setdefault(r, []).append(k)
    index = F.create_map(*[x for r, ks in sorted(by_prefix.items()) for x in (F.lit(r), array(ks))])
    prefixes = array(sorted(by_prefix))
    all_ = F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"),
                F.lit(t.need).alias("need"),
                F.lit(len(t.ranks)).alias("n"),
                array(t.ranks).alias("ranks"),
                array(t.prefix).alias("prefix"),
            )
            for t in templates
        ]
    )

    def passes(own: Column, t: Column) -> Column:
        first = F.get(F.array_intersect(own, t["prefix"]), 0)
        behind = F.least(t["n"] - F.array_position(t["ranks"], first), F.size(own) - F.array_position(own, first))
        return (F.size(own) >= t["need"]) & (behind + 1 >= t["need"])

    def met(own: Column) -> Column:
        numbers = F.array_distinct(F.flatten(F.transform(F.array_intersect(own, prefixes), lambda r: index[r])))
        candidates = F.filter(F.transform(numbers, lambda k: F.get(all_, k)), lambda t: passes(own, t))
        counted = F.transform(
            candidates,
            lambda t: F.struct(
                t["label"].alias("label"),
                F.size(F.array_intersect(own, t["ranks"])).alias("common"),
                t["need"].alias("need"),
                t["n"].alias("n"),
            ),
        )
        return F.transform(
            F.filter(counted, lambda t: t["common"] >= t["need"]),
            lambda t: F.struct(t["label"].alias("label"), (t["common"] / t["n"]).alias("share")),
        )

    least = min(t.need for t in templates)
    held = F.filter(F.transform(blocks, lambda b: block_words(b, order)), lambda b: F.size(b) >= least)
    ranked = F.transform(held, lambda b: F.array_sort(F.transform(b, lambda w: rank[w])))
    return F.flatten(F.transform(ranked, met))


def wrapped_blocks(lines: Column, most: int) -> Column:
    """Each line with the ``most`` words behind it, up to the next line without words."""

    def block(line: Column, i: Column) -> Column:
        def longer(s: Column, x: Column) -> Column:
            new = F.call_function("substring_index", F.trim(x), F.lit(" "), s["left"])
            more = F.struct(F.concat_ws(" ", s["text"], new).alias("text"), (s["left"] - F.size(F.split(new, " "))).alias("left"))
            end = F.struct(s["text"].alias("text"), F.lit(0).alias("left"))
            return F.when(s["left"] == 0, s).when(F.trim(x) == "", end).otherwise(more)

        left = F.when(F.trim(line) == "", F.lit(0)).otherwise(F.lit(most))
        return F.aggregate(F.slice(lines, i + 2, most), F.struct(line.alias("text"), left.alias("left")), longer, lambda s: s["text"])

    return F.transform(lines, block)


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    threshold: float = THRESHOLD,
    wrapped: bool = True,
) -> DataFrame:
    """Append n_words, the phrases' places, labels and the score to each row, all as DataFrame functions.

    Null and empty texts have no words, no places (null) and no labels (the
    empty string). Texts are read whole. Repeated rows are scanned alike; an
    empty table gives an empty one; columns with clashing names give way.
    ``score`` is 1 where a phrase stands, else the largest share of a
    template's words that a block holds, if at least ``threshold``, else 0.
    Without ``wrapped`` a block is a single line.
    """
    order = global_order(df, text, templates)
    at = {w: i for i, w in enumerate(order)}
    ranked = [
        Template(label, tuple(sorted(at[w] for w in words(t))), math.ceil(threshold * len(words(t)) - 1e-9))
        for label, t in templates
    ]
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    one = df.select(*kept, normal(F.col(f"`{text}`")).alias("__normal"))
    flat = F.concat(F.lit(" "), F.trim(F.regexp_replace("__normal", "[ \n]+", " ")), F.lit(" "))
    two = one.select(*[f"`{c.name}`" for c in one.schema], flat.alias("__flat"))
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    n_words = F.when(F.col("__flat") == "  ", F.lit(0)).otherwise(spaces(F.col("__flat")) - 1).cast("long")
    lines = F.split("__normal", "\n")
    if wrapped:
        # Only texts that meet a template as a whole can do so in a block.
        two = two.withColumns({"__lines": lines, "__whole": matches(F.array("__flat"), order, ranked)})
        blocks = wrapped_blocks(F.col("__lines"), longest(templates))
        met = F.when(F.size("__whole") > 0, matches(blocks, order, ranked)).otherwise(F.col("__whole"))
    else:
        met = matches(lines, order, ranked)
    three = two.withColumns(
        {
            "__n": n_words,
            "__met": met,
            "__has": F.array(*[F.contains("__flat", F.lit(f" {p} ")) for p, _ in phrases]),
        }
    )
    counts, firsts, lasts = [], [], []
    for i, (phrase, _) in enumerate(phrases):
        has, key, wide = F.col("__has")[i], f" {phrase} ", f" {phrase.replace(' ', '  ')} "
        doubled = F.replace("__flat", F.lit(" "), F.lit("  "))  # so that places next to each other share no space
        cut = F.length(doubled) - F.length(F.replace(doubled, F.lit(wide), F.lit("")))
        before = F.expr(f"substring(__flat, 1, instr(__flat, '{key}'))")
        after = F.substring_index("__flat", key, -1)
        counts.append(F.when(has, (cut / len(wide)).cast("long")).otherwise(F.lit(0).cast("long")))
        firsts.append(F.when(has, (spaces(before) - 1).cast("long")))
        # What follows the last place is its words, each with a space behind it.
        lasts.append(F.when(has, F.col("__n") - spaces(after) - len(phrase.split(" "))))
    base = F.filter(F.array(*[F.when(F.col("__has")[i], F.lit(label)) for i, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull())
    four = three.withColumns(
        {
            "n_words": F.col("__n"),
            "n_base": sum(counts[1:], counts[0]),
            "first_word": F.least(*firsts),
            "last_word": F.greatest(*lasts),
            "__base": base,
        }
    )
    both = F.array_union("__base", F.transform("__met", lambda m: m["label"]))
    best = F.coalesce(F.array_max(F.transform("__met", lambda m: m["share"])), F.lit(0.0))
    return four.withColumns(
        {
            "base_labels": F.array_join(F.array_sort(F.array_distinct("__base")), ","),
            "labels": F.array_join(F.array_sort(both), ","),
            "score": F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best),
        }
    ).drop("__normal", "__flat", "__lines", "__whole", "__n", "__met", "__has", "__base")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def longest(templates: list[tuple[str, str]]) -> int:
    """Words of the longest template, repeated ones counted."""
    return max(len(re.findall("[a-z0-9]+", t.lower())) for _, t in templates)


def _oracle() -> str:
    values = ", ".join(f"('{label}', {words(t)!r}, {math.ceil(THRESHOLD * len(words(t)) - 1e-9)})" for label, t in TEMPLATES)
    phrases = ", ".join(f"({p.split(' ')!r}, '{label}')" for p, label in PHRASES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d
), phrase(p, label) AS (VALUES {phrases}
), place AS (
  SELECT rid, label, i - 1 AS start FROM (
    SELECT rid, label, p, words, unnest(list_filter(range(1, len(words) - len(p) + 2), lambda k: words[k] = p[1])) AS i
    FROM w, phrase) WHERE words[i:i + len(p) - 1] = p
), base AS (
  SELECT rid, count(*) AS n, min(start) AS a, max(start) AS z, list_sort(list(DISTINCT label)) AS labels FROM place GROUP BY rid
), template(label, words, need) AS (VALUES {values}
), line AS (
  SELECT rid, i, regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS own
  FROM (SELECT rid, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM (SELECT rid, string_split(t, chr(10)) AS lines FROM w))
), numbered AS (
  SELECT *, count(*) FILTER (len(own) = 0) OVER (PARTITION BY rid ORDER BY i) AS part FROM line
), started AS (
  SELECT *, sum(len(own)) OVER (PARTITION BY rid, part ORDER BY i) - len(own) AS before FROM numbered WHERE len(own) > 0
), part AS (
  SELECT rid, part, flatten(list(own ORDER BY i)) AS words FROM started GROUP BY rid, part
), block AS (
  SELECT rid, list_distinct(words[before + 1 : before + len(own) + {longest(TEMPLATES)}]) AS own FROM started JOIN part USING (rid, part)
), met AS (
  SELECT rid, label, len(list_intersect(own, words))::DOUBLE / len(words) AS share
  FROM block, template WHERE len(own) >= need AND len(list_intersect(own, words)) >= need
), method AS (
  SELECT rid, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN method USING (rid)
"""


QUERIES = {"op8_license_scan": op8_license_scan}
ORACLE = _oracle()
ORACLES = {"op8_license_scan": ORACLE}
