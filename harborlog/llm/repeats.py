"""Removal of long passages that occur earlier in the corpus, exactly and by bytes.

Every string of ``length`` bytes has one anchor: the piece of ``PIECE`` bytes within it whose hash is least (the last such).
Equal strings have equal anchors at equal places, so only occurrences of the same anchor are compared, and anchors that occur
once are left aside. An occurrence of an anchor stands for a run of strings; its context is the text they span. Equal contexts
are one class, of which all but the first are repeats as a whole. Where an anchor has several classes, the strings of their
first occurrences are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from harborlog.llm.bitmaps import marked, table_of
from harborlog.llm.bytewords import _tables_for, mixed, raw, slices, span_hashes
from harborlog.llm.shards import number_rows
from harborlog.plans import stored

PIECE = 20
#: Bytes of a text that are walked at once.
STRETCH = 1 << 18


def _last_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the last least value of every run of ``width`` values."""
    # Least by (value, later place first): ties are rare, so they are broken by comparing places where values are equal.
    place = np.arange(len(values))
    best, at, step = values.copy(), place.copy(), 1
    n = len(values)
    size = 1
    while size * 2 <= width:
        m = n - size * 2 + 1
        take = best[size : size + m] <= best[:m]
        best, at = np.where(take, best[size : size + m], best[:m]), np.where(take, at[size : size + m], at[:m])
        size *= 2
    m = n - width + 1
    shift = width - size
    take = best[shift : shift + m] <= best[:m]
    return np.where(take, at[shift : shift + m], at[:m])


def _anchors(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of one text, stretch by stretch: where it starts, then hash, place, first and last string of each anchor.

    A run of strings with one anchor may be cut where two stretches meet, at places that depend on the text's start only.
    """
    width = length - PIECE + 1
    low = 0
    while low + length <= len(data):
        part = data[low : low + STRETCH + length - 1]
        power, inverse = _tables_for(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        pieces = mixed((sums[PIECE:] - sums[:-PIECE]) * inverse[: len(part) - PIECE + 1])
        at = _last_least(pieces, width)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:] - 1, [len(at) - 1]))
        yield low, pieces[at[first]], at[first], first, last
        low += STRETCH


def _all_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                data, offsets = raw(part.column("text"))
                found = [anchor for a, b in zip(offsets[:-1], offsets[1:]) for _, anchor, *_ in _anchors(data[a:b], length)]
                if found:
                    anchor, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.record_batch({"anchor": pa.array(anchor.view(np.int64)), "n": pa.array(n, pa.int64())})

    return run


def _place_hash(doc: np.ndarray | int, start: np.ndarray) -> np.ndarray:
    """A 64-bit hash of an occurrence: where its first string starts."""
    return mixed(mixed(np.asarray(doc, np.int64).view(np.uint64)) + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _in_doc(doc: int, data: np.ndarray, length: int, bits: np.ndarray, places: np.ndarray | None = None) -> Iterator[tuple]:
    """Of one text: the bytes of a stretch, where it starts, then hash, place, first and last string of each anchor marked in ``bits``
    (and in ``places``, by document and start)."""
    for low, anchor, at, first, last in _anchors(data, length):
        keep = marked(bits, anchor)
        if places is not None:
            keep[keep] = marked(places, _place_hash(doc, first[keep] + low))
        if keep.any():
            yield data[low:][: STRETCH + length - 1], low, anchor[keep], at[keep], first[keep], last[keep]


def _occurrences(length: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                data, offsets = raw(part.column("text"))
                columns: list[list] = [[] for _ in range(4)]
                for doc, a, b in zip(part.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    for stretch, low, anchor, _, first, last in _in_doc(doc, data[a:b], length, table.value):
                        context = span_hashes(stretch, first, last + length)
                        for column, value in zip(columns, (anchor.view(np.int64), context.view(np.int64), np.full(len(first), doc), first + low)):
                            column.append(value)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names=["anchor", "context", "doc", "start"])

    return run


def _written(length: int, table, places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                data, offsets = raw(part.column("text"))
                columns: list[list] = [[] for _ in range(6)]
                texts: list[bytes] = []
                for doc, a, b in zip(part.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    for stretch, low, anchor, at, first, last in _in_doc(doc, data[a:b], length, table.value, places.value):
                        context, whole = span_hashes(stretch, first, last + length), stretch.tobytes()
                        for column, value in zip(columns, (anchor.view(np.int64), context.view(np.int64), at - first, last - first, np.full(len(first), doc), first + low)):
                            column.append(value)
                        texts += [whole[x : y + length] for x, y in zip(first.tolist(), last.tolist())]
                if texts:
                    arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.binary())], names=["anchor", "context", "before", "behind", "doc", "start", "bytes"])

    return run


def _places(table):
    """Of classes whose anchor is in a table: a hash of where the first occurrence is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, doc, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "doc", "start"))
            keep = marked(table.value, anchor.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(_place_hash(doc[keep], start[keep]).view(np.int64))], names=["place"])

    return run


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of an anchor stand together. Spans of first occurrences whose strings occur earlier in another class."""
        held: list[pa.RecordBatch] = []

        def spans(table: pa.Table) -> Iterator[pa.RecordBatch]:
            anchor = table["anchor"].to_numpy()
            before, behind, doc, start = (table[c].to_numpy() for c in ("before", "behind", "doc", "start"))
            texts = table["bytes"].to_pylist()
            data = np.frombuffer(b"".join(texts), np.uint8)
            base = np.cumsum([0, *map(len, texts)])[:-1]
            n = behind + 1
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            value = np.empty(len(row), np.uint64)
            # Hashes in parts, each of bounded bytes.
            edge = np.flatnonzero(np.diff(base // STRETCH, prepend=-1))
            for a, b in zip(edge, [*edge[1:], len(base)]):
                own = slice(int(np.searchsorted(row, a)), int(np.searchsorted(row, b)))
                x = base[row[own]] + nth[own] - base[a]
                stop = base[b] if b < len(base) else len(data)
                value[own] = span_hashes(data[base[a] : stop], x, x + length)
            order = np.lexsort((start[row], doc[row], value, nth - before[row], anchor[row]))
            key = (anchor[row][order], (nth - before[row])[order], value[order])
            repeat = np.concatenate(([False], np.logical_and.reduce([k[1:] == k[:-1] for k in key])))
            hit = np.zeros(len(row), bool)
            hit[order[repeat]] = True
            k = np.flatnonzero(hit)
            if len(k):
                new = np.concatenate(([True], (row[k][1:] != row[k][:-1]) | (nth[k][1:] != nth[k][:-1] + 1)))
                first = k[new]
                last = k[np.concatenate((new[1:], [True]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[row[first]]), pa.array(start[row[first]] + nth[first]), pa.array(start[row[last]] + nth[last] + length)], names=["doc", "low", "high"]
                )

        previous = None
        for batch in batches:
            anchor, context = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "context"))
            if not len(anchor):
                continue
            new = np.concatenate(([previous != (anchor[0], context[0])], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])))
            previous = anchor[-1], context[-1]
            held.append(batch.filter(pa.array(new)))
            table = pa.Table.from_batches(held)
            if not len(table):
                continue
            last = table["anchor"][len(table) - 1].as_py()
            whole = int(np.searchsorted(table["anchor"].to_numpy(), last))
            if whole:
                yield from spans(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if any(len(batch) for batch in held):
            yield from spans(pa.Table.from_batches(held))

    return run


def _ordered(rows: DataFrame) -> DataFrame:
    """Add ``doc``, a number of each row in the order of identities: the identity itself where it is a number of one row only."""
    odd = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("id is null or n > 1")
    if isinstance(rows.schema["id"].dataType, IntegralType) and odd.isEmpty():
        return rows.withColumn("doc", F.col("id").cast("bigint"))
    numbered = number_rows(rows.withColumn("none", F.col("id").isNull()), ["none", "id"])
    return numbered.select("id", "text", F.col("row_number").alias("doc"))


def remove_repeats(df: DataFrame, length: int = 100, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """Per row: identity, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller identity, or earlier
    in the same. Matches are judged on the input and never cross documents; null is empty. Every row is a document: rows of one
    identity stand in any, but fixed, order after each other, and rows without one come last.
    """
    rows = _ordered(df.select(F.col(f"`{identity}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))
    keyed = rows.select(F.col("doc").alias("id"), "text")
    counted = keyed.select("text").mapInArrow(_all_anchors(length), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    shared = table_of(counted.where("n > 1"), "anchor")
    found = keyed.mapInArrow(_occurrences(length, shared), "anchor long, context long, doc long, start long")
    # A context fixes its anchor and the anchor's place in it.
    classes = found.groupBy("anchor", "context").agg(F.min(F.struct("doc", "start")).alias("f"))
    classes = stored(classes.select("anchor", F.col("f.doc").alias("doc"), F.col("f.start").alias("start")))
    # Texts are read once more for the bytes of first occurrences of anchors of several classes, which are few.
    several = table_of(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "anchor")
    places = table_of(classes.mapInArrow(_places(several), "place long"), "place")
    schema = "anchor long, context long, before long, behind long, doc long, start long, bytes binary"
    written = keyed.mapInArrow(_written(length, several, places), schema)
    # Rows of a class stand together, its first occurrence first; others that share a place in the table are left out there.
    order = ["anchor", "context", "doc", "start"]
    firsts = written.repartition("anchor").sortWithinPartitions(*order).mapInArrow(_compare(length), "doc long, low long, high long")
    # What is not the first of its class goes as a whole. Firsts, without an end, are named to the document, which finds the others again.
    named = classes.select("doc", F.col("start").alias("low"), F.lit(None).cast("bigint").alias("high")).unionByName(firsts)
    by_doc = stored(named.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("spans")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                data, offsets = raw(part.column("text"))
                out: list[list] = [[] for _ in range(5)]
                spans = part.column("spans")
                low, high = (spans.values.field(i) for i in (0, 1))
                is_first = high.is_null().to_numpy(zero_copy_only=False)
                low, high = low.to_numpy(zero_copy_only=False), high.fill_null(0).to_numpy(zero_copy_only=False)
                edge, some = spans.offsets.to_numpy(), spans.is_valid().to_numpy(zero_copy_only=False)
                for i, (doc, a, b) in enumerate(zip(part.column("doc").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist())):
                    own = data[a:b]
                    mine = slice(int(edge[i]), int(edge[i + 1]) if some[i] else int(edge[i]))
                    firsts = low[mine][is_first[mine]]
                    depth = np.zeros(len(own) + 1, np.int64)
                    np.add.at(depth, low[mine][~is_first[mine]], 1)
                    np.add.at(depth, high[mine][~is_first[mine]], -1)
                    for _, at, _, _, first, last in _in_doc(doc, own, length, shared.value):
                        later = ~np.isin(first + at, firsts)
                        np.add.at(depth, (first + at)[later], 1)
                        np.add.at(depth, (last + at)[later] + length, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    n_spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                    body = own[~gone].tobytes()
                    for column, value in zip(out, (len(own), len(own) - len(body), n_spans, hashlib.sha256(body).hexdigest(), body)):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("own"), *(pa.array(c, k) for c, k in zip(out, kinds))], names=[identity, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                )

    # Spans come with every text, in all a good part of the texts' size: no side is small enough for every executor.
    joined = rows.select(F.col("id").alias("own"), "doc", "text").join(by_doc.hint("merge"), "doc", "left").select("own", "doc", "text", "spans")
    kind = rows.schema["id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"`{identity}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
