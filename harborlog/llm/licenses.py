"""License notices: base phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words anywhere in the text, line ends being mere blanks. Its width comes from the template: the
template's number of words over the threshold. A template is found where a block has at least the threshold's share of the
template's distinct words. The words of the templates are ordered by their number in the whole corpus, rarest first. A block that
reaches the threshold has one of the template's first ``|T| - need + 1`` words (prefix filter), has ``need`` words of the
template at all (length filter), and at each place of the order has enough words before it and left behind it on both sides
(positional filter, which the last place turns into the exact containment).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlog.llm.bytewords import NO_TERM, Words, slices, words

# The base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Notices by which public licenses are usually declared, and opening or main paragraphs of their texts.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Released under the terms of the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
]
PERCENT = 90


def _hashes(text: str) -> np.ndarray:
    return words(pa.array([text]), NO_TERM).hash


@dataclass(frozen=True)
class Blocks:
    """First and last word and containment of blocks, ascending by their first words."""

    start: np.ndarray
    last: np.ndarray
    containment: np.ndarray

    def where(self, keep: np.ndarray) -> Blocks:
        return Blocks(self.start[keep], self.last[keep], self.containment[keep])

    def cover(self, start: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether each of the given blocks lies within one of these."""
        until = np.append(-1, np.maximum.accumulate(self.last))
        return until[np.searchsorted(self.start, start, "right")] >= last


class Templates:
    """The templates' words, and blocks that are close enough to one."""

    def __init__(self, templates: list[tuple[str, str]], percent: int):
        self.labels = [label for label, _ in templates]
        hashes = [_hashes(text) for _, text in templates]
        self.sets = [np.unique(h) for h in hashes]
        self.need = [-(-percent * len(s) // 100) for s in self.sets]
        self.width = [-(-100 * len(h) // percent) for h in hashes]
        self.vocabulary = np.unique(np.concatenate(self.sets))
        #: By which texts are kept apart, so that no block lies in two.
        self.apart = max(self.width)

    def known(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of template words, and which they are."""
        at = np.minimum(np.searchsorted(self.vocabulary, found.hash), len(self.vocabulary) - 1)
        place = np.flatnonzero(self.vocabulary[at] == found.hash)
        return place, at[place]

    def count(self, found: Words) -> np.ndarray:
        return np.bincount(self.known(found)[1], minlength=len(self.vocabulary))

    def order(self, counts: np.ndarray) -> None:
        """Order each template's words by their counts in the corpus, rarest first."""
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((self.vocabulary, counts))] = np.arange(len(counts))
        own = [np.searchsorted(self.vocabulary, s) for s in self.sets]
        self.ordered = [words[np.argsort(rank[words])] for words in own]

    def search(self, found: Words, row: np.ndarray) -> dict[int, Blocks]:
        """Blocks close enough to each template, of those that start and end with words of it."""
        place, word = self.known(found)
        place = place + row[place] * self.apart
        by_word = np.argsort(word, kind="stable")
        edges = np.searchsorted(word[by_word], np.arange(len(self.vocabulary) + 1))
        # Where each word occurs, ascending, and a place behind all texts.
        occurs = [np.append(place[by_word[a:b]], np.iinfo(np.int64).max) for a, b in zip(edges[:-1], edges[1:])]
        return {t: blocks for t in range(len(self.sets)) if (blocks := self._near(t, occurs)) is not None}

    def _near(self, t: int, occurs: list[np.ndarray]) -> Blocks | None:
        ordered, need, width = self.ordered[t], self.need[t], self.width[t]
        prefix = np.sort(np.concatenate([occurs[w][:-1] for w in ordered[: len(ordered) - need + 1]]))
        if not len(prefix):
            return None
        mine = np.sort(np.concatenate([occurs[w][:-1] for w in ordered]))
        # Prefix filter: starts of blocks that reach a word of the prefix.
        opened = np.zeros(len(mine) + 1, np.int64)
        np.add.at(opened, np.searchsorted(mine, prefix - width + 1), 1)
        np.add.at(opened, np.searchsorted(mine, prefix, "right"), -1)
        at = np.flatnonzero(np.cumsum(opened[:-1]) > 0)
        # Length filter.
        size = np.searchsorted(mine, mine[at] + width) - at
        at, size = at[size >= need], size[size >= need]
        start = mine[at]
        shared, last = np.zeros(len(start), np.int64), start.copy()
        for behind, w in zip(range(len(ordered) - 1, -1, -1), ordered):
            follows = occurs[w][np.searchsorted(occurs[w], start)]
            there = follows < start + width
            shared += there
            last = np.where(there, np.maximum(last, follows), last)
            # The positional filter: of the block's words, those shared so far and the rest of either side.
            keep = shared + np.minimum(behind, size - shared) >= need
            start, size, shared, last = start[keep], size[keep], shared[keep], last[keep]
            if not len(start):
                return None
        return Blocks(start, last, shared / len(ordered))

    def best(self, near: dict[int, Blocks]) -> Iterator[tuple[int, Blocks]]:
        """Per template its blocks but those within a block of greater containment, or of an equal one whose template includes it."""
        for t, blocks in near.items():
            beaten = np.zeros(len(blocks.start), bool)
            for u, others in near.items():
                if u == t:
                    continue
                wider = len(self.sets[u]) > len(self.sets[t]) and np.isin(self.sets[t], self.sets[u]).all()
                for c in np.unique(blocks.containment):
                    mine = np.flatnonzero(blocks.containment == c)
                    better = others.containment >= c if wider else others.containment > c
                    beaten[mine] |= others.where(better).cover(blocks.start[mine], blocks.last[mine])
            if not beaten.all():
                yield t, blocks.where(~beaten)


def scan(
    df: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT,
    text: str = "text", identity: str = "doc_id",
) -> DataFrame:
    """Per row: identity, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case. labels has the base
    labels and those of the templates found; of a block and one within it that of greater containment counts, and the wider of two
    templates of which one includes the other. Words may stand in any order within a block, but not scattered beyond it.
    score is the best containment, and 1 where a base phrase stands. Null and empty texts have no words and score 0; repeated rows
    and null identities give a row each, and other columns don't matter.
    """
    spark = df.sparkSession
    rows = df.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    known = Templates(templates, percent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.vocabulary), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += known.count(words(part.column("text"), NO_TERM))
        yield pa.record_batch({"word": pa.array(range(len(total)), pa.int32()), "n": pa.array(total)})

    counts = np.zeros(len(known.vocabulary), np.int64)
    for r in rows.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[r["word"]] = r["n"]  # one row per word of the templates
    known.order(counts)
    shared = spark.sparkContext.broadcast(known)
    phrases = [(_hashes(p), label) for p, label in BASE]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column("text")
                found = words(column, NO_TERM)
                n = np.diff(found.first)
                row = np.repeat(np.arange(len(column)), n)
                starts: dict[int, list[int]] = {}
                base: dict[int, set[str]] = {}
                for phrase, label in phrases:
                    at = np.flatnonzero(found.hash[: max(0, len(found.hash) - len(phrase) + 1)] == phrase[0])
                    for j in range(1, len(phrase)):
                        at = at[found.hash[at + j] == phrase[j]]
                    at = at[row[at] == row[at + len(phrase) - 1]]
                    for p in at.tolist():
                        starts.setdefault(row[p], []).append(p - int(found.first[row[p]]))
                        base.setdefault(row[p], set()).add(label)
                labels = {k: set(v) for k, v in base.items()}
                score = {k: 1.0 for k in base}
                # A place with what keeps texts apart ascends with the text, so it tells the text.
                spread = found.first[:-1] + np.arange(len(column)) * index.apart
                for t, blocks in index.best(index.search(found, row)):
                    texts = np.searchsorted(spread, blocks.start, "right") - 1
                    for k, containment in zip(texts.tolist(), blocks.containment.tolist()):
                        labels.setdefault(k, set()).add(index.labels[t])
                        score[k] = max(score.get(k, 0.0), containment)
                every = range(len(column))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(n, pa.int64()), pa.array([len(starts.get(k, ())) for k in every], pa.int64()),
                        pa.array([min(starts[k]) if k in starts else None for k in every], pa.int64()),
                        pa.array([max(starts[k]) if k in starts else None for k in every], pa.int64()),
                        pa.array([",".join(sorted(base.get(k, ()))) for k in every]),
                        pa.array([",".join(sorted(labels.get(k, ()))) for k in every]),
                        pa.array([score.get(k, 0.0) for k in every], pa.float64()),
                    ],
                    names=[identity, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return rows.mapInArrow(
        search, f"`{identity}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
