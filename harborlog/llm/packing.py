"""Packing of token sequences by non-negative least squares over the histogram of piece lengths.

Documents are cut into full windows and one rest. All combinations of up to three lengths that fill a window exactly are the
columns of a least squares problem whose right side is the histogram of rests; its solution, rounded down, says how often each
combination is used, and a greedy pass over what is left of the histogram packs the residual. The driver handles histograms
and combinations only, whose number depends on the window. Pieces find their places by their rank among those of a length.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlog.llm.bytewords import slices, tidied
from harborlog.plans import stored

STEPS = 800
#: Pieces that are ranked in one group.
GROUP_ROWS = 50_000


class Plan(NamedTuple):
    """Uses of lengths: the pieces of ``length`` ranked from ``rank`` on go to sequences from ``sequence`` on, ``times`` to each."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    sequences: int


def combinations(window: int) -> np.ndarray:
    """All of one to three lengths that sum to the window, descending, filled up with zeros."""
    a = np.arange(1, window + 1)
    x, y = (m.ravel() for m in np.meshgrid(a, np.arange(window + 1), indexing="ij"))
    z = window - x - y
    keep = (x >= y) & (y >= z) & (z >= 0)
    return np.stack([x[keep], y[keep], z[keep]], 1)


def solve(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients; histogram[n] pieces have n tokens."""
    size = len(histogram)

    def apply(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(combos[:, j], x, size) for j in range(3))
        out[0] = 0
        return out

    target = histogram.astype(float)
    target[0] = 0
    x = np.zeros(len(combos))
    probe = np.ones(len(combos))
    for _ in range(30):
        probe = _spread(apply(probe), combos)
        norm = np.linalg.norm(probe)
        probe /= norm
    y, t = x, 1.0
    for _ in range(STEPS):
        new = np.maximum(0, y - _spread(apply(y) - target, combos) / (norm * 1.02))
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / ahead * (new - x)
        x, t = new, ahead
    return x


def _spread(residual: np.ndarray, combos: np.ndarray) -> np.ndarray:
    return residual[combos].sum(1)


def plan(histogram: np.ndarray, window: int) -> Plan:
    """histogram[n] pieces of n tokens, 0 < n <= window."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    chosen: list[tuple[list[int], int]] = []
    if left[window]:
        chosen.append(([window], int(left[window])))
        left[window] = 0
    if left.any():
        combos = combinations(window)
        combos = combos[(left[combos] > 0).all(1, where=combos > 0)]
        if len(combos):
            times = np.floor(solve(combos, left) + 1e-6).astype(np.int64)
            for i in np.argsort(-times, kind="stable").tolist():
                if not times[i]:
                    break
                lengths = [n for n in combos[i].tolist() if n]
                n = min(int(times[i]), *(int(left[m]) // lengths.count(m) for m in lengths))
                if n:
                    chosen.append((lengths, n))
                    for m in lengths:
                        left[m] -= n
    while left.any():
        # Greedy: the longest piece, then always the longest that fits; as many times as the pieces last.
        lengths, room, rest = [], window, left.copy()
        while room:
            fit = np.flatnonzero(rest[1 : room + 1])
            if not len(fit):
                break
            n = int(fit[-1]) + 1
            lengths.append(n)
            rest[n] -= 1
            room -= n
        n = min(int(left[m]) // lengths.count(m) for m in lengths)
        chosen.append((lengths, n))
        for m in lengths:
            left[m] -= n
    used = np.zeros(window + 1, np.int64)
    rows, sequence = [], 0
    for lengths, n in chosen:
        offset = 0
        for m in sorted(set(lengths), reverse=True):
            times = lengths.count(m)
            rows.append((m, used[m], sequence, times, offset))
            used[m] += n * times
            offset += m * times
        sequence += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return Plan(*columns, sequence)


_encodings: dict[tuple, object] = {}


def encoding(ranks_path: str, pattern: str, special: dict[str, int] | None = None):
    """The byte-level BPE of a file with a base64 piece and its rank in each line; ``special`` strings are tokens of their own."""
    key = ranks_path, pattern, tuple(sorted((special or {}).items()))
    if key not in _encodings:
        _encodings.clear()
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special or {})
    return _encodings[key]


def _cut(ranks_path: str, pattern: str, special: dict[str, int] | None, window: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoding(ranks_path, pattern, special)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                row, start, length, crc, total = [], [], [], [], []
                for k, value in enumerate(part.column("text").to_pylist()):
                    ids = np.array([*known.encode(value or "", allowed_special="all"), end_id], "<u4")
                    for low in range(0, len(ids), window):
                        piece = ids[low : low + window]
                        row.append(k)
                        start.append(low)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return cut


def pack(
    df: DataFrame, ranks_path: str, pattern: str, window: int = 1024, text: str = "text", identity: str = "doc_id", end_id: int = 0,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """Cut every text's tokens (byte-level BPE by the ranks of its pieces, words cut by the pattern), followed by ``end_id``, into pieces and place these in sequences of at most ``window`` tokens.

    Strings in ``special`` are single tokens with the given ids wherever they stand in a text.
    Per piece: identity, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is the end alone.
    Repeated rows are packed as often as they occur. An empty table has no sequences.
    """
    spark = df.sparkSession
    rows = df.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    cut = rows.mapInArrow(tidied(_cut(ranks_path, pattern, special, window, end_id)), f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = stored(cut.withColumn("row", F.monotonically_increasing_id()))
    counts = pieces.groupBy("length").count().collect()  # at most one row per length
    histogram = np.zeros(window + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["count"]
    placed = spark.sparkContext.broadcast(plan(histogram, window))
    groups = int(histogram.sum() // GROUP_ROWS) + 8
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("row")
    ranked = salted.join(bases, ["length", "salt"]).withColumn("rank", F.col("base") + F.row_number().over(within) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = placed.value
        span = np.int64(1) << 48
        key = known.length * span + known.rank
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length * span + rank, "right") - 1
            nth = rank - known.rank[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(known.sequence[at] + nth // known.times[at]), pa.array(known.offset[at] + length * (nth % known.times[at]))],
                names=[identity, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    wanted = ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return wanted.mapInArrow(place, f"`{identity}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
