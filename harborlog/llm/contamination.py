"""Search for test items inside documents: MinHash sketches by size, verified by exact shingle containment.

Sampled bands of MinHashes lose recall when an item of thirty shingles lies in a document of thousands: the Jaccard similarity
that the document's size class asks for is then far below 1 %. So the sketch is the item's own: its least hashes under one
permutation of all shingles, as many as its size class needs for any document of enough containment to hold one of them (more
than the share of shingles that may be missing). Documents are partitioned by size as well: a document is held against the
size classes only whose smallest item can reach the threshold in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlog.llm.bytewords import mixed, shingles, slices, tidied, words

#: Bytes of item texts in one pass over the documents; further items take further passes.
BLOCK_BYTES = 8 << 20


class SizeClass(NamedTuple):
    """Items of 2**k to 2**(k+1)-1 shingles."""

    needed: int  # least number of shingles a document must have
    sketch: np.ndarray  # sorted hashes
    item: np.ndarray  # of each of them


class Index(NamedTuple):
    ids: list
    sets: list[np.ndarray]
    classes: list[SizeClass]


def build(ids: list, texts: list, percent: int) -> Index:
    found = words(pa.array(texts, pa.large_string()))
    sets = [np.unique(shingles(found.hash[a:b])) for a, b in zip(found.first[:-1], found.first[1:])]
    by_class: dict[int, list[int]] = {}
    for i, own in enumerate(sets):
        if len(own):
            by_class.setdefault(len(own).bit_length(), []).append(i)
    classes = []
    for members in by_class.values():
        hashes, items = [], []
        for i in members:
            q = len(sets[i])
            size = q - -(-percent * q // 100) + 1
            least = sets[i][np.argsort(mixed(sets[i]))[:size]]
            hashes.append(least)
            items.append(np.full(len(least), i))
        key, item = np.concatenate(hashes), np.concatenate(items)
        order = np.argsort(key, kind="stable")
        classes.append(SizeClass(min(-(-percent * len(sets[i]) // 100) for i in members), key[order], item[order]))
    return Index(ids, sets, classes)


def _hits(index: Index, own: np.ndarray, percent: int) -> Iterator[tuple[int, int, int]]:
    """own: the shingles of one document, repeats included."""
    candidates: set[int] = set()
    for needed, sketch, item in index.classes:
        if len(own) < needed:
            continue
        low, high = np.searchsorted(sketch, own), np.searchsorted(sketch, own, "right")
        for i in np.flatnonzero(high > low).tolist():
            candidates.update(item[low[i] : high[i]].tolist())
    for i in sorted(candidates):
        q = len(index.sets[i])
        shared = int(np.isin(index.sets[i], own).sum())
        if shared * 100 >= q * percent:
            yield i, q, shared


def find_items(
    documents: DataFrame, items: DataFrame, percent: int = 80,
    text: str = "text", identity: str = "doc_id", item_text: str = "text", item_identity: str = "item_id",
) -> DataFrame:
    """Pairs of a document and an item of which it has at least ``percent`` % of the distinct five-word shingles.

    Columns: identity, item identity, n_item (shingles of the item), n_shared, containment. Words are blank-separated, A-Z in
    lower case; fewer than five words are one shingle of their own. Items and documents without words are in no pair. Repeated
    rows of either side give repeated pairs. Shingles are compared by 64-bit hashes.
    """
    spark = documents.sparkSession
    tests = items.select(F.col(item_identity).alias("item"), F.col(item_text).alias("text"))
    total = tests.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = -(-int(total) // BLOCK_BYTES) or 1
    texts = documents.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in [*texts.schema, *tests.schema]}

    def search(index) -> DataFrame:
        kind = pa.int64() if kinds["item"] == "bigint" else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = index.value
            every = np.unique(np.concatenate([c.sketch for c in known.classes])) if known.classes else np.zeros(0, np.uint64)
            mark = np.zeros(1 << 16, bool)
            mark[(every >> np.uint64(48)).astype(np.int64)] = True
            for batch in batches:
                for part in slices(batch, "text"):
                    found = words(part.column("text"))
                    rows, item, n_item, n_shared = [], [], [], []
                    for k, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist())):
                        own = shingles(found.hash[a:b])
                        if mark[(own >> np.uint64(48)).astype(np.int64)].any():
                            for i, q, shared in _hits(known, own, percent):
                                rows.append(k)
                                item.append(known.ids[i])
                                n_item.append(q)
                                n_shared.append(shared)
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [part.column("id").take(pa.array(rows)), pa.array(item, kind), pa.array(n_item, pa.int64()), pa.array(n_shared, pa.int64())],
                            names=["id", "item", "n_item", "n_shared"],
                        )

        return texts.mapInArrow(tidied(run), f"id {kinds['id']}, item {kinds['item']}, n_item long, n_shared long")

    out = None
    for n in range(blocks):
        block = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n).toArrow()
        part = search(spark.sparkContext.broadcast(build(block["item"].to_pylist(), block["text"].to_pylist(), percent)))
        out = part if out is None else out.unionByName(part)
    return out.select(
        F.col("id").alias(identity), F.col("item").alias(item_identity), "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )
