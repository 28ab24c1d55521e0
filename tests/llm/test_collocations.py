"""Collocations against a plain count of everything, with small limits so that the frontier moves, and in odd cases."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import low

from harborlog.llm import collocations

SCHEMA = "text string, lang string, word string, w1 long, a string, rank string"


def plain(rows, first, least, inside=80):
    f: dict = {}
    for text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(a for words, a in counts.items() if len(words) == 1)
        candidates = {words: a for words, a in counts.items() if len(words) > 1 and a >= least}
        covered: Counter = Counter()
        for words, a in candidates.items():
            for k in range(2, len(words)):
                for i in range(len(words) - k + 1):
                    part = words[i : i + k]
                    covered[part] = max(covered[part], a)
        kept = []
        for words, a in candidates.items():
            if 100 * covered[words] >= inside * a and words in covered:
                continue
            score, _, left, right = min(
                (2_000_000 * a // (counts[words[:k]] + counts[words[k:]]), k, counts[words[:k]], counts[words[k:]]) for k in range(1, len(words))
            )
            kept.append((-score, -a, " ".join(words).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(row) for row in frame.collect())


def texts(seed, n, langs):
    """Words of very uneven frequency, fixed phrases within others, and phrases over which pieces end."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "x-y", "Ü"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = [" ".join(chance.choices(vocabulary, k=chance.randint(2, 6))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [chance.choice(fixed) if chance.random() < 0.3 else chance.choices(vocabulary, weights)[0] for _ in range(chance.randint(0, 40))]
        text = "".join(part.upper() * (chance.random() < 0.1) or part for part in (p + chance.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!"]) for p in parts))
        rows.append((text, langs[i % len(langs)], "x", 1, "y", "z"))
    return rows


@pytest.mark.parametrize("first, least", [(1, 2), (7, 2), (40, 3), (100_000, 1)])
def test_same_as_plain(spark, first, least):
    rows = texts(first, 150, ["en", "en", "en", "de", None, "und"])
    assert found(collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), first=first, least=least)) == plain(rows, first, least)


def test_more_rounds_where_the_best_are_dropped(spark):
    """The best pairs all lie within longer phrases, so the first level is not enough and the frontier moves on."""
    rows = [(f"a{i} b{i} c{i} d{i}", "en", None, None, None, None) for i in range(40) for _ in range(5)]
    rows += [(f"p{i} q{i}. q{i} r", "en", None, None, None, None) for i in range(60) for _ in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for first in (10, 45):
        assert found(collocations.collocations(frame, first=first, least=2)) == plain(rows, first, 2)


def test_odd_tables(spark):
    rows = [(None, None), ("", "en"), (" \t\n.", "en"), ("one", "en"), ("One ONE one", "en"), ("tie tie. tie tie", None)]
    rows = [(text, lang, None, None, None, None) for text, lang in rows] * 3
    assert found(collocations.collocations(spark.createDataFrame(rows, SCHEMA), first=3, least=2)) == plain(rows, 3, 2)
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None,) * 6], SCHEMA)).collect() == []


def test_long_texts_across_rows_and_slices(spark):
    """A text of one word without a break, and a long one that fills several rows of its sequence."""
    chance = random.Random(9)
    rows = [("again " * 5_000, "en"), (" ".join(chance.choices(["p", "q", "r", "s"], k=9_000)), "en"), ("x" * 400_000 + " y", "de")]
    rows = [(text, lang, None, None, None, None) for text, lang in rows]
    assert found(collocations.collocations(spark.createDataFrame(rows, SCHEMA), first=50, least=2)) == plain(rows, 50, 2)


def test_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a = 4_000_000_000_000_000_000
    row = spark.range(1).select(collocations.ratio(F.lit(a), F.lit(a)).alias("x"), collocations.ratio(F.lit(a), F.lit(a - 1)).alias("y")).first()
    assert (row.x, row.y) == (2_000_000, 2_000_000 * a // (a - 1))


def test_counting_holds_a_bounded_part_of_a_long_sequence():
    """A task's memory doesn't follow the words it is given: 2 million of them took 320 MB."""
    words = np.random.default_rng(3).integers(1, 1 << 60, 1 << 21)
    rows = words.reshape(-1, collocations.ROW_WORDS)
    batches = [
        pa.record_batch({"lang": pa.array(["en"] * 64), "hashes": pa.array(list(rows[at : at + 64]), pa.list_(pa.int64())), "skip": pa.array([0] * 64, pa.int32())})
        for at in range(0, len(rows), 64)
    ]
    tracemalloc.start()
    n = sum(made.num_rows for made in collocations._counter(2, None, None, None, None)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == (collocations.ROW_WORDS - 1) * len(rows)
    assert peak < 100 << 20
