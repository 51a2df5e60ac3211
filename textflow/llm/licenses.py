"""License notices: an exact set-similarity join of blocks of words with templates, by containment."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions.text import bind
from textflow.llm.tables import lower_ascii, without

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Bound of the side that is held in the plan: words of all templates together.
MOST_TEMPLATE_WORDS = 20_000


@dataclass(frozen=True)
class Template:
    """A notice. A block of words holds it if at least `least` percent of its different words are in the block; a
    `phrase` needs all of them, and then counts where its words stand one after the other."""

    label: str
    text: str
    least: int = 80
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), self.text)
        return [w for w in re.split(BETWEEN_WORDS, lowered) if w]

    @property
    def stride(self) -> int:
        """Blocks are `2 * stride` words and begin at each multiple of it, so any run of `stride` words is in one."""
        return 1 << max(0, len(self.words) - 1).bit_length()

    @property
    def need(self) -> int:
        return math.ceil(len(set(self.words)) * (100 if self.phrase else self.least) / 100)


# Phrases of the contract, and notices as licenses recommend them.
PHRASES = (
    Template("cc-by", "cc by", phrase=True),
    Template("gpl", "general public license", phrase=True),
    Template("reserved", "all rights reserved", phrase=True),
)
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    Template("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "CC BY-NC", least=100),
    Template("cc-by-sa", "CC BY-SA", least=100),
    Template("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("warranty", "the software is provided as is, without warranty of any kind, express or implied"),
)


def words_of(text: Column) -> Column:
    """The words of a text; of a null one, none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), lambda w: w != "")


def frequencies(documents: DataFrame, templates: Sequence[Template], text: str = "text") -> dict[str, int]:
    """For each word of the templates the number of texts that hold it, over all texts."""
    tokens = sorted({w for t in templates for w in t.words})
    if not tokens:
        return {}
    held = documents.select(F.explode(F.array_intersect(F.lit(tokens), words_of(F.col(text)))).alias("token"))
    # One row for each template word at most.
    return {r.token: r.n for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}


class Index:
    """The templates as literals of a plan: words in the global order, and for each word of a prefix its templates."""

    def __init__(self, templates: Sequence[Template], counts: Mapping[str, int]) -> None:
        templates = [t for t in templates if t.words]
        if sum(len(t.words) for t in templates) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words")
        self.templates = templates
        order = lambda w: (counts.get(w, 0), w)
        self.ranked = sorted({w for t in templates for w in t.words}, key=order)
        self.sets = [sorted(set(t.words), key=order) for t in templates]
        # The rarest words of a template, of which a block that holds it has at least one.
        self.prefixes: dict[str, list[tuple[int, int]]] = {}
        for k, (t, tokens) in enumerate(zip(templates, self.sets, strict=True)):
            for j, token in enumerate(tokens[: len(tokens) - t.need + 1]):
                self.prefixes.setdefault(token, []).append((k, j))

    def held(self, words: Column) -> Column:
        """All `template, start, end, containment` of blocks that hold a template, in words from 0."""
        strides, needs = F.lit([t.stride for t in self.templates]), F.lit([t.need for t in self.templates])
        sizes, sets = F.lit([len(s) for s in self.sets]), F.array(*[F.lit(s) for s in self.sets])
        places = [F.array(*[F.struct(F.lit(k).alias("t"), F.lit(j).alias("j")) for k, j in p]) for p in self.prefixes.values()]
        postings = F.create_map(*[c for token, p in zip(self.prefixes, places, strict=True) for c in (F.lit(token), p)])
        window = lambda t, block: F.slice(words, block * F.get(strides, t) + 1, 2 * F.get(strides, t))

        def possible(token: Column, t: Column, j: Column, block: Column) -> Column:
            """Length and positional filter: what follows the shared word on both sides, in the global order, and the
            word itself must reach the needed overlap. The first shared word of a pair passes if the pair is one."""
            shared = F.array_intersect(F.lit(self.ranked), window(t, block))
            left = bind(shared, lambda b: F.size(b) - F.array_position(b, token) + 1)
            return F.least(left, F.get(sizes, t) - j) >= F.get(needs, t)

        def around(i: Column) -> Column:
            token = F.get(words, i)

            def blocks(p: Column) -> Column:
                last = F.floor(i / F.get(strides, p["t"])).cast("int")
                given = F.filter(F.array(last - 1, last), lambda b: (b >= 0) & possible(token, p["t"], p["j"], b))
                return F.transform(given, lambda b: F.struct(p["t"].alias("t"), b.alias("block")))

            return F.flatten(F.transform(F.element_at(postings, token), blocks))

        def verified(c: Column) -> Column:
            shared = F.size(F.array_intersect(F.get(sets, c["t"]), window(c["t"], c["block"])))
            start = c["block"] * F.get(strides, c["t"])
            return F.struct(
                c["t"].alias("template"),
                start.alias("start"),
                F.least(start + 2 * F.get(strides, c["t"]), F.size(words)).alias("end"),
                F.when(shared >= F.get(needs, c["t"]), shared / F.get(sizes, c["t"])).alias("containment"),
            )

        hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(list(self.prefixes)), i)), lambda i: i.isNotNull())
        candidates = F.array_distinct(F.flatten(F.transform(hits, around)))
        return F.filter(F.transform(candidates, verified), lambda f: f["containment"].isNotNull())

    def placed(self, words: Column, held: Column) -> Column:
        """All `template, start` at which the words of a phrase stand one after the other, in blocks that hold it."""
        phrases = [k for k, t in enumerate(self.templates) if t.phrase]
        sequences = F.array(*[F.lit(t.words) for t in self.templates])

        def starts(f: Column) -> Column:
            sequence = F.get(sequences, f["template"])
            every = F.sequence(f["start"], F.greatest(f["end"] - F.size(sequence), f["start"]))
            right = F.filter(every, lambda i: F.slice(words, i + 1, F.size(sequence)) == sequence)
            return F.transform(right, lambda i: F.struct(f["template"].alias("template"), i.alias("start")))

        of_phrases = F.filter(held, lambda f: f["template"].isin(phrases))
        return F.array_distinct(F.flatten(F.transform(of_phrases, starts)))

    def labels(self, found: Column) -> Column:
        names = F.lit([t.label for t in self.templates])
        return F.array_sort(F.array_distinct(F.transform(found, lambda f: F.get(names, f["template"]))))


NONE = "array<struct<template:int,start:int,end:int,containment:double>>"
NOWHERE = "array<struct<template:int,start:int>>"


def scan(
    documents: DataFrame, templates: Sequence[Template] = (*PHRASES, *NOTICES), text: str = "text"
) -> DataFrame:
    """Rows with `n_words`, `blocks` (every block that holds a template: its number, words from `start` to `end`,
    containment), `places` (every place of a phrase), `labels` (of blocks, and of phrases that have a place),
    `base_labels` (of places alone) and `score` (the greatest containment of a notice, 1 with a place, else 0).

    Words are ordered by the number of texts that hold them, counted over all texts. A block can hold a template only
    if one of the template's rarest words is in it, so texts without such a word cost one look-up for each word; the
    length and positional filters then leave out blocks whose rest cannot reach the threshold, and whole sets decide.
    All of this is in the row: no text and no word moves between tasks, and neither a frequent notice nor many copies
    make a group. The templates are in the plan; their size is bounded, and more raise an error.

    A null or empty text has no words, no blocks and score 0. Each row is judged by itself, so ids may repeat or be
    null. Columns of the new names are replaced. An empty table gives no rows; without templates nothing is found.
    """
    counts = frequencies(documents, templates, text) if templates else {}
    index = Index(templates, counts)
    rows = without(documents, "n_words", "blocks", "places", "labels", "base_labels", "score")

    def judged(words: Column) -> Column:
        held = index.held(words) if index.prefixes else F.lit(None).cast(NONE)
        return bind(held, lambda h: F.struct(F.size(words).cast("bigint").alias("n_words"), h.alias("blocks"),
                                             placed(words, h).alias("places")))

    def placed(words: Column, held: Column) -> Column:
        return index.placed(words, held) if any(t.phrase for t in index.templates) else F.lit(None).cast(NOWHERE)

    found = rows.withColumn("__found", bind(words_of(F.col(text)), judged)).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.col("__found.n_words").alias("n_words"),
        F.coalesce("__found.blocks", F.array().cast(NONE)).alias("blocks"),
        F.coalesce("__found.places", F.array().cast(NOWHERE)).alias("places"),
    )
    phrases = [k for k, t in enumerate(index.templates) if t.phrase]
    notices = F.filter("blocks", lambda f: ~f["template"].isin(phrases))
    best = F.coalesce(F.array_max(F.transform(notices, lambda f: f["containment"])), F.lit(0.0))
    base = index.labels(F.col("places")) if index.templates else F.array().cast("array<string>")
    others = index.labels(notices) if index.templates else F.array().cast("array<string>")
    return found.withColumns(
        {
            "labels": F.array_sort(F.array_union(base, others)),
            "base_labels": base,
            "score": F.when(F.size("places") > 0, 1.0).otherwise(best),
        }
    )
