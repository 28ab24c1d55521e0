"""Shuffled shards from a Feistel permutation of global row numbers.

Rows get gapless numbers in a total order. A Feistel network over two mixed-radix halves permutes 0 to a*b-1 where a*b is the
least such product that covers the rows; the few values beyond the last row are walked along their cycle until they fall inside.
The permuted number, taken modulo and divided by the number of shards, is the shard and the slot, so both can be computed for
any row, and the row for any shard and slot, without the table.
"""

from __future__ import annotations

from math import isqrt
from typing import NamedTuple

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlog.plans import stored

ROUNDS = 6
#: Ranges in which rows are numbered.
RANGES = 64


class Permutation(NamedTuple):
    """Of 0 to n - 1, for n below 2**60."""

    n: int
    seed: int = 0

    @property
    def halves(self) -> tuple[int, int]:
        a = max(1, isqrt(max(self.n - 1, 0)) + 1)
        return a, max(1, -(-self.n // a))

    def key(self, turn: int) -> int:
        return self.seed * ROUNDS + turn

    def _mix(self, x: int, turn: int, size: int) -> int:
        """xxhash64 of the number and then the round's key, as Spark chains it."""
        first = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), 42)
        value = xxhash.xxh64_intdigest(self.key(turn).to_bytes(8, "little", signed=True), first)
        return (value - (1 << 64) * (value >> 63)) % size

    def once(self, x: int) -> int:
        a, b = self.halves
        left, right = x % a, x // a
        for turn in range(0, ROUNDS, 2):
            left = (left + self._mix(right, turn, a)) % a
            right = (right + self._mix(left, turn + 1, b)) % b
        return right * a + left

    def back_once(self, x: int) -> int:
        a, b = self.halves
        left, right = x % a, x // a
        for turn in range(ROUNDS - 2, -1, -2):
            right = (right - self._mix(left, turn + 1, b)) % b
            left = (left - self._mix(right, turn, a)) % a
        return right * a + left

    def __call__(self, x: int) -> int:
        x = self.once(x)
        while x >= self.n:
            x = self.once(x)
        return x

    def inverse(self, x: int) -> int:
        x = self.back_once(x)
        while x >= self.n:
            x = self.back_once(x)
        return x

    def longest_walk(self) -> int:
        """Steps that any row needs beyond the first: the longest run of values beyond the rows on one cycle.

        There are fewer such values than the square root of n, and only they are visited.
        """
        a, b = self.halves
        outside, longest = set(range(self.n, a * b)), 0
        for x in list(outside):
            if self.back_once(x) < self.n:
                steps = 0
                while x >= self.n:
                    x, steps = self.once(x), steps + 1
                longest = max(longest, steps)
        return longest

    def apply(self, df: DataFrame, number: str, name: str) -> DataFrame:
        """Add the permuted number of a column of row numbers. Every round is a projection of its own."""
        a, b = self.halves
        df = df.withColumn(name, F.col(number))
        for walk in range(self.longest_walk() + 1):
            df = df.withColumns({"__left": F.col(name) % a, "__right": F.call_function("div", F.col(name), F.lit(a).cast("bigint"))})
            for turn in range(0, ROUNDS, 2):
                df = df.withColumn("__left", (F.col("__left") + self._mixed("__right", turn, a)) % a)
                df = df.withColumn("__right", (F.col("__right") + self._mixed("__left", turn + 1, b)) % b)
            once = F.col("__right") * a + F.col("__left")
            df = df.withColumn(name, once if not walk else F.when(F.col(name) >= self.n, once).otherwise(F.col(name)))
        return df.drop("__left", "__right")

    def _mixed(self, half: str, turn: int, size: int) -> Column:
        return F.pmod(F.xxhash64(half, F.lit(self.key(turn)).cast("bigint")), F.lit(size).cast("bigint"))


def locate(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number."""
    slot, shard = divmod(Permutation(n, seed)(row), shards)
    return shard, slot


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number at a place."""
    return Permutation(n, seed).inverse(slot * shards + shard)


def number_rows(df: DataFrame, order: list[str], ranges: int = RANGES) -> DataFrame:
    """Add row_number, from 0 without gaps, in the order of the columns (rows that tie are in any order, but fixed).

    The rows are sorted by range; a hot value is split, since ties are ranged by a number of their own. Each range numbers its
    rows, and a table of one row per range carries the counts over. The numbered table is written once.
    """
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*order, "__tie"]
    placed = tied.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    table = stored(
        placed.select(*(F.col(f"`{c}`") for c in df.columns), F.shiftright("__at", 33).cast("int").alias("__range"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)).alias("__place"))
    )
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = table.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).select("__range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__base"))
    # One row per range, whose number is a parameter.
    joined = table.join(F.broadcast(bases), "__range")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("__base") + F.col("__place")).alias("row_number"))


def shard(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add row_number, shard and slot. Shard sizes differ by one at most; an empty table stays empty.

    Null order values come first. Rows that tie in all order columns take the numbers of their group in any order.
    """
    numbered = number_rows(df, order)
    n = df.count()
    permuted = Permutation(n, seed).apply(numbered, "row_number", "__p") if n else numbered.withColumn("__p", F.col("row_number"))
    return permuted.withColumn("shard", (F.col("__p") % shards).cast("int")).withColumn("slot", F.expr(f"__p div {int(shards)}")).drop("__p")
