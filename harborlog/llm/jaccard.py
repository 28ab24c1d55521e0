"""Exact Jaccard join of documents on word shingles, as connected components.

A pair that links shares a token among the first ``n - ceil(t n) + 1`` of each document, whatever the order of tokens. Three
orders are used: rarest first (by counts over all documents), by hash, and by hash backwards. The first gives candidates by a
join on its prefix tokens, the other two must agree on prefixes before the sets are intersected exactly. Before sets are moved
at all, parity sketches leave out pairs that differ in too many tokens for certain.

Equal sets are one class from the start. A class proposes few candidates per round, to one pivot of each block of a shared
token; classes already connected need no further link between them. After some rounds every remaining pair of a block whose
ends aren't connected yet is verified, so that no link is missed and blocks of near copies aren't expanded into all pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlog.llm.bitmaps import PLACES_BITS, marked, table_of
from harborlog.llm.bytewords import give_back, mixed, shingles, slices, tidied, words
from harborlog.plans import Scratch, give_back_heap, stored

#: Counters of shingles, by their leading bits. All documents count; the bound is on resolution only, and any order is right.
COUNTER_BITS = 26
CHUNK_BITS = 16
#: Shingles whose counters a task sends together.
TOGETHER = 1 << 22
#: A counter is known by the last of these that it reaches: four bits.
LEVELS = np.array([0, 1, 2, 3, 4, 5, 6, 8, 12, 16, 32, 128, 512, 2048, 8192, 32768])
#: Leading bits by which prefix tokens are told apart when those of several classes are looked for, and how many of them make a chunk.
APART_BITS = 40
APART_CHUNKS_BITS = 12
#: Bits of a set's parity sketch. Two sketches differ in no more bits than their sets differ in tokens.
SKETCH_BITS = 2048
#: 64-bit words of the sketch that goes with every posting of the last round.
FOLDED = 8
#: Least tokens of a class that go with them: a pair is left to the first of these that both have.
FIRST_TOKENS = 8
PIVOT_ROUNDS = 4
PROPOSALS = 6


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    found = words(column)
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        yield np.unique(shingles(found.hash[low:high]))


def _packed(places: np.ndarray, width: int = 2) -> bytes:
    """Ascending places of ``width`` bytes, as steps of which low and high bytes stand apart: the high ones are mostly 0."""
    steps = np.diff(places, prepend=places.dtype.type(0))
    return zlib.compress(steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def _unpacked(steps: bytes, width: int = 2) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(steps), np.uint8).reshape(width, -1)
    return np.cumsum(sum(plane.astype(np.int64) << 8 * i for i, plane in enumerate(planes)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counters that shingles belong to, a place for each shingle, by chunk."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        places = np.sort(np.concatenate(held))
        chunk = places >> np.uint32(CHUNK_BITS)
        first = np.flatnonzero(np.diff(chunk, prepend=-1))
        low = (places & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.int32)
        parts = [_packed(low[a:b]) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(low)])]
        held.clear()
        return pa.record_batch({"chunk": pa.array(chunk[first].astype(np.int32)), "counts": pa.array(parts, pa.binary())})

    size = 0
    for batch in batches:
        for part in slices(batch, "text"):
            every = np.concatenate([np.zeros(0, np.uint64), *_sets(part.column("text"))])
            held.append((every >> np.uint64(64 - COUNTER_BITS)).astype(np.uint32))
            size += len(every)
            if size >= TOGETHER:
                yield flush()
                size = 0
    if size:
        yield flush()


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << CHUNK_BITS, np.int64)
    for x in rows["counts"]:
        total += np.bincount(_unpacked(x), minlength=1 << CHUNK_BITS)
    level = (np.searchsorted(LEVELS, total, "right") - 1).astype(np.uint8)
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "counts": [(level[::2] | level[1::2] << 4).tobytes()]})


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """In how many rows shingles occur, by counter, as levels of four bits; a fixed size, so it may go to the driver."""
    merged = texts.mapInArrow(tidied(_count), "chunk int, counts binary").groupBy("chunk").applyInPandas(_merge, "chunk int, counts binary")
    total = np.zeros((1 << COUNTER_BITS >> CHUNK_BITS, 1 << CHUNK_BITS >> 1), np.uint8)
    for row in merged.toLocalIterator():
        total[row["chunk"]] = np.frombuffer(row["counts"], np.uint8)
    return total.reshape(-1)


def level_of(counts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    place = (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
    return counts[place >> 1] >> (place.astype(np.uint8) & 1) * 4 & 15


def _sketch(own: np.ndarray) -> np.ndarray:
    odd = np.bincount((own & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _folded(i: int) -> Column:
    """A word of the parity sketch of fewer bits."""
    return reduce(Column.bitwiseXOR, (F.col("sketch")[k] for k in range(i, SKETCH_BITS // 64, FOLDED)))


def _picked(batch: pa.RecordBatch, copied, want: bool) -> pa.RecordBatch:
    """The rows whose class may have other rows, or those whose class has none for certain."""
    return batch.filter(pa.array(marked(copied, batch.column("d1").to_numpy().view(np.uint64)) == want))


def _copies(copied):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _picked(batch, copied.value, True)

    return run


def _apart(copied):
    """Leading bits of tokens, by chunk; of rows that are a class of their own, or of all rows without ``copied``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            places = np.sort(np.concatenate(held)).astype(np.int64)
            chunk = places >> APART_BITS - APART_CHUNKS_BITS
            first = np.flatnonzero(np.diff(chunk, prepend=-1))
            low = places & (1 << APART_BITS - APART_CHUNKS_BITS) - 1
            parts = [_packed(low[a:b], 4) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(low)])]
            held.clear()
            return pa.record_batch({"chunk": pa.array(chunk[first].astype(np.int32)), "places": pa.array(parts, pa.binary())})

        size = 0
        for batch in batches:
            part = batch if copied is None else _picked(batch, copied.value, False)
            token = part.column("tokens").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            held.append(token >> np.uint64(64 - APART_BITS))
            size += len(token)
            if size >= TOGETHER:
                yield flush()
                size = 0
        if size:
            yield flush()

    return run


def _several(rows: pd.DataFrame) -> pd.DataFrame:
    places = np.sort(np.concatenate([_unpacked(x, 4) for x in rows["places"]]))
    again = np.zeros(1 << PLACES_BITS - APART_CHUNKS_BITS, bool)
    again[places[1:][places[1:] == places[:-1]] >> APART_BITS - PLACES_BITS] = True
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "bits": [np.packbits(again, bitorder="little").tobytes()]})


def shared_tokens(own: DataFrame, others: DataFrame, copied) -> np.ndarray:
    """A table of bits like ``bitmaps.table_of``: tokens that several rows have, of ``own`` that are no copies and all of ``others``."""
    schema = "chunk int, places binary"
    places = own.select("d1", "tokens").mapInArrow(tidied(_apart(copied)), schema).unionByName(others.select("tokens").mapInArrow(tidied(_apart(None)), schema))
    bits = np.zeros((1 << APART_CHUNKS_BITS, 1 << PLACES_BITS - APART_CHUNKS_BITS >> 3), np.uint8)
    for row in places.groupBy("chunk").applyInPandas(_several, "chunk int, bits binary").toLocalIterator():
        bits[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def _postings(table, copied):
    """Tokens that several classes may have, one a row; of rows that are a class of their own, or of all rows without ``copied``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            batch = batch if copied is None else _picked(batch, copied.value, False)
            n = pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False).astype(np.int64)
            token = batch.column("tokens").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keep = np.flatnonzero(marked(bits, token))
            row = pa.array(np.repeat(np.arange(batch.num_rows), n)[keep])
            yield pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), batch.column("id").take(row), batch.column("n").take(row)], names=["token", "id", "n"])

    return run


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _described(percent: int, counts, with_set: bool):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = counts.value if counts is not None else None
        for batch in batches:
            for part in slices(batch, "text"):
                n, one, two, tokens, sketches = [], [], [], [], []
                for own in _sets(part.column("text")):
                    n.append(len(own))
                    if with_set:
                        tokens.append(own.view(np.int64))
                        continue
                    # Two independent sums over the set tell sets apart.
                    one.append(int(mixed(own).sum(dtype=np.uint64).astype(np.int64)))
                    two.append(int(mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    sketches.append(_sketch(own))
                    often = level_of(number, own)
                    size = prefix_size(len(own), percent) if len(own) else 0
                    tokens.append(own[np.lexsort((own, often))[:size]].view(np.int64))
                if with_set:
                    found = {"id": part.column("id"), "as_a": part.column("as_a"), "as_b": part.column("as_b"), "n": pa.array(n, pa.int64()), "tokens": pa.array(tokens, pa.list_(pa.int64()))}
                else:
                    found = {
                        "id": part.column("id"), "n": pa.array(n, pa.int64()), "d1": pa.array(one, pa.int64()), "d2": pa.array(two, pa.int64()),
                        "tokens": pa.array(tokens, pa.list_(pa.int64())), "sketch": pa.array(sketches, pa.list_(pa.int64())),
                    }
                yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))

    return describe


def _near(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _flat(tree: DataFrame) -> DataFrame:
    """tree: node, up (each lower than its node). Point every node at the root."""
    while True:
        above = tree.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = stored(tree.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")))
        tree = step.select("node", "up")
        if step.where("moved").isEmpty():
            return tree


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels: id, label. links: a, b (labels). Every label becomes the least label it is connected to."""
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct())
    while not edges.isEmpty():
        tree = _flat(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up")))
        labels = stored(labels.join(tree, labels["label"] == tree["node"], "left").select("id", F.coalesce("up", "label").alias("label")))
        for end in ("hi", "lo"):
            edges = edges.join(tree.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        edges = stored(edges.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).where("hi <> lo").distinct())
    return labels


def met_first(token: Column) -> Column:
    """Of columns fa and fb, the least tokens of two classes: none below ``token`` is in both."""
    return ~F.exists("fa", lambda x: (x < token) & F.array_contains("fb", x))


def jaccard_components(df: DataFrame, text: str = "text", identity: str = "doc_id", percent: int = 80) -> DataFrame:
    """Per row of ``df``: the identity, n_shingles and component_id.

    Shingles are five blank-separated words, A-Z in lower case; fewer words are one shingle. Two rows link when their
    intersection is at least ``percent`` % of their union. component_id is the least identity that links reach. A row
    without words links with nothing and is its own component. Repeated rows are one class; null identities have a null
    component unless an equal or linked row has an identity. Shingles are compared by 64-bit hashes.
    """
    spark = df.sparkSession
    texts = df.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    counts = spark.sparkContext.broadcast(shingle_counts(texts.select("text")))
    give_back()
    wide = Scratch(spark, "described")
    described = stored(
        texts.mapInArrow(tidied(_described(percent, counts, False)), "id long, n long, d1 long, d2 long, tokens array<bigint>, sketch array<bigint>"), scratch=wide
    )
    counts.destroy()
    base = stored(described.select("id", "n", "d1", "d2"))
    whole = described.where("n > 0 and id is not null")
    classes = stored(whole.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.count(F.lit(1)).alias("c")))
    heads = classes.select("id", "d1", "d2")
    # Only rows whose class may have others move to find out which one stands for it.
    copied = table_of(classes.where("c > 1"), "d1")
    listed = whole.select("id", "n", "d1", "d2", "tokens")
    others = listed.mapInArrow(tidied(_copies(copied)), listed.schema).join(heads, ["id", "d1", "d2"], "left_semi")
    others = stored(others.dropDuplicates(["id", "d1", "d2"]).select("id", "n", "tokens"), scratch=wide)
    # Tokens of a single class go before postings move.
    shared = spark.sparkContext.broadcast(shared_tokens(listed, others, copied))
    give_back()
    posted = "token long, id long, n long"
    postings = listed.select("id", "n", "d1", "tokens").mapInArrow(tidied(_postings(shared, copied)), posted).unionByName(others.mapInArrow(tidied(_postings(shared, None)), posted))
    live = stored(postings.groupBy("token", "id").agg(F.first("n").alias("n")))
    copied.destroy()
    shared.destroy()
    names = stored(live.select("id").distinct())
    named = heads.join(names, "id", "left_semi")
    sketches = stored(whole.join(named, ["id", "d1", "d2"], "left_semi").select("id", "d1", "d2", "sketch").dropDuplicates(["id", "d1", "d2"]).select("id", "sketch"))
    # Prefixes and sketches of all rows have done their work.
    wide.delete()
    give_back_heap(spark)
    labels = names.select("id", F.col("id").alias("label"))

    def verified(pairs: DataFrame) -> DataFrame:
        """pairs: a, b, their sizes and labels. Those that link, as pairs of labels."""
        differ = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda total, n: total + n)
        close = (
            pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
            # Of a + b tokens no more than (1 - t) / (1 + t) may be on one side only.
            .where(differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
            .select("a", "b", "la", "lb")
        )
        pairs = stored(close)
        if pairs.isEmpty():
            return pairs.select(F.col("la").alias("a"), F.col("lb").alias("b"))
        ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(True).alias("first")), F.struct(F.col("b").alias("id"), F.lit(False).alias("first"))))
        ids = stored(pairs.select(ends.alias("end")).groupBy("end.id").agg(F.max("end.first").alias("as_a"), F.max(~F.col("end.first")).alias("as_b")))
        own = texts.join(ids, "id").dropDuplicates(["id", "text"])
        kept = Scratch(spark, "sets")
        sets = stored(own.mapInArrow(tidied(_described(percent, None, True)), "id long, as_a boolean, as_b boolean, n long, tokens array<bigint>"), scratch=kept)
        # Pivots are few: most sets are the one end only, and move once.
        x = sets.where("as_a").select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
        y = sets.where("as_b").select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
        both = pairs.join(x, "a").join(y, "b")

        def prefix(t: str, n: str) -> Column:
            return F.col(n) - F.ceil(F.col(n) * percent / 100) + 1

        # The sets are sorted by hash: prefixes of the second and third order are their two ends.
        second = F.arrays_overlap(F.slice("ta", F.lit(1), prefix("ta", "na").cast("int")), F.slice("tb", F.lit(1), prefix("tb", "nb").cast("int")))
        third = F.arrays_overlap(
            F.slice("ta", (F.col("na") - prefix("ta", "na") + 1).cast("int"), prefix("ta", "na").cast("int")),
            F.slice("tb", (F.col("nb") - prefix("tb", "nb") + 1).cast("int"), prefix("tb", "nb").cast("int")),
        )
        common = F.size(F.array_intersect("ta", "tb"))
        links = stored(both.where(second & third).where(common * 100 >= (F.col("na") + F.col("nb") - common) * percent).select(F.col("la").alias("a"), F.col("lb").alias("b")))
        kept.delete()
        return links

    for turn in range(PIVOT_ROUNDS):
        named = live.join(labels, "id") if turn else live.withColumn("label", F.col("id"))
        order = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
        pivots = named.groupBy("token").agg(F.min_by(F.struct("id", "n", "label"), order).alias("p"))
        proposals = (
            named.join(pivots, "token")
            .where((F.col("label") != F.col("p.label")) & _near(F.col("n"), F.col("p.n"), percent))
            .groupBy(
                F.col("id").alias("a"), F.col("p.id").alias("b"), F.col("n").alias("na"), F.col("p.n").alias("nb"),
                F.col("label").alias("la"), F.col("p.label").alias("lb"),
            )
            .agg(F.count(F.lit(1)).alias("c"))
        )
        best = Window.partitionBy("a").orderBy(F.desc("c"), "b")
        pairs = stored(proposals.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PROPOSALS).drop("c", "place"))
        if pairs.isEmpty():
            break
        labels = merged(labels, verified(pairs))
        give_back_heap(spark)

    # All that is left: both ends share a token, and nothing connects them so far.
    named = stored(live.join(labels, "id").select("token", "id", "n", "label"))
    open_blocks = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    folded = sketches.select("id", *(_folded(i).alias(f"s{i}") for i in range(FOLDED)))
    rest = stored(named.join(open_blocks, "token").join(folded, "id"))
    # A token that both ends have is an open block as well, so the least one that they share never leaves a pair to another.
    first = stored(rest.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("token")), 1, FIRST_TOKENS).alias("first")))
    rest = rest.join(first, "id")
    a = rest.select("token", F.col("id").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"), F.col("first").alias("fa"), *(F.col(f"s{i}").alias(f"a{i}") for i in range(FOLDED)))
    b = rest.select("token", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"), F.col("first").alias("fb"), *(F.col(f"s{i}").alias(f"b{i}") for i in range(FOLDED)))
    differ = reduce(Column.__add__, (F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(FOLDED)))
    # The filters meet within the join: a pair that fails one of them is never a row.
    close = (F.col("la") < F.col("lb")) & _near(F.col("na"), F.col("nb"), percent) & (differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
    pairs = a.join(b, (a["token"] == b["token"]) & close & met_first(a["token"])).select("a", "b", "na", "nb", "la", "lb").distinct()
    labels = merged(labels, verified(stored(pairs)))

    named = classes.select("d1", "d2", "id").join(labels, "id", "left").select("d1", "d2", F.coalesce("label", "id").alias("class"))
    found = base.select("id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return found.select(F.col("id").alias(identity), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("id")).alias("component_id"))
