"""Phrase collocations by best-first branch-and-bound growth.

Phrases grow to the right from their first words. No phrase is more frequent than its prefixes, so a prefix of count a whose
first word has count l bounds the score of everything that starts with it: SCALE * a / (l + a). Per language, the prefixes of
the best bounds are grown first, down to a level of score that is chosen so that the best phrases known so far are above it.
Phrases at or above the level are settled: they, and what is one word longer on either side, are counted exactly, and with that
it is known which of them are dropped. When a language has enough settled phrases that are not dropped, nothing below its level
can be among the first, ties included, and it is done. Else its level falls and the frontier moves on.

Texts become sequences of word hashes once. A round is a pass over these sequences that counts only phrases which the
frontier asks for. It asks by tables of bits, of bounded size, in which other phrases may share a place: they are counted as
well, exactly, and cost work only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlog.llm.bytewords import give_back, mixed, raw, slices, tidied, words
from harborlog.plans import Scratch, stored

SCALE = 2_000_000
LONGEST = 4
#: Bits of one of Spark's bitmaps, and the most bits a table of phrases has: 32 MB.
BITMAP = 1 << 15
MOST_PLACES = 28
#: Words of sequences that are counted together: a task holds about 150 bytes for each.
TOGETHER = 1 << 19

#: Words of a row of a sequence.
ROW_WORDS = 1 << 10

#: Bytes that end a piece, and those that separate words within one.
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SEPARATORS = BREAKS.copy()
SEPARATORS[[0x20, 0x09]] = True

WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one language as rows of word hashes with 0 between pieces; and its words, with their counts there.

    Rows are short. Each starts with the last words of the one before it, ``skip`` of them, as phrases may run across.
    """
    for batch in batches:
        langs = batch.column("lang").unique().to_pylist()
        for lang in langs:
            of_lang = batch.filter(pc.equal(batch.column("lang"), lang)) if len(langs) > 1 else batch
            for part in slices(of_lang, "text", 1 << 21):
                texts = part.column("text")
                found = words(texts, SEPARATORS)
                if not len(found.hash):
                    continue
                data, _ = raw(texts)
                stops = np.zeros(len(data) + 1, np.int32)
                np.cumsum(BREAKS[data], out=stops[1:])
                # Words of different texts, or with a break between them, don't stand together.
                text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
                apart = np.flatnonzero((np.diff(stops[found.start]) > 0) | (np.diff(text) > 0)) + 1
                hashes = np.where(found.hash == 0, np.uint64(1), found.hash).view(np.int64)
                known, first, n = np.unique(hashes, return_index=True, return_counts=True)
                low = [data[a:b].tobytes().lower().decode() for a, b in zip(found.start[first].tolist(), found.end[first].tolist())]
                line = np.insert(hashes, apart, 0)
                starts = range(0, len(line), ROW_WORDS)
                skips = [min(at, LONGEST - 1) for at in starts]
                rows, none = len(skips), [None] * len(known)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (rows + len(known)), pa.string()),
                        pa.array([line[at - skip : at + ROW_WORDS] for at, skip in zip(starts, skips)] + none, pa.list_(pa.int64())),
                        pa.array(skips + none, pa.int32()),
                        pa.array([None] * rows + known.tolist(), pa.int64()),
                        pa.array([None] * rows + low, pa.string()),
                        pa.array([None] * rows + n.tolist(), pa.int64()),
                    ],
                    names=["lang", "hashes", "skip", "w1", "word", "a"],
                )


def _phrase_hash(lang: np.ndarray | np.uint64, ids: list[np.ndarray]) -> np.ndarray:
    total = lang
    for i, part in enumerate(ids):
        total = total + part.view(np.uint64) * _ODD[i]
    return mixed(np.asarray(total))


def lang_seed(lang: str) -> np.uint64:
    """A number of a language, for hashes of its phrases."""
    seed = np.uint64(0xCBF29CE484222325)
    with np.errstate(over="ignore"):
        for byte in lang.encode():
            seed = (seed ^ np.uint64(byte)) * np.uint64(0x100000001B3)
    return seed


class Bits(NamedTuple):
    """Phrases of n words, of any language, by bits."""

    n: int
    places: int
    bits: Broadcast


def bits_of(phrases: DataFrame, n: int, members: int) -> Bits:
    """A table for phrases of n words: 16 places for each up to a fixed size, beyond which it lets more others through."""
    places = min(MOST_PLACES, max(16, int(members * 16).bit_length()))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            seeds = np.array([lang_seed(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy(zero_copy_only=False)]
            hashes = _phrase_hash(seeds, [batch.column(w).to_numpy(zero_copy_only=False) for w in WORDS[:n]])
            yield pa.RecordBatch.from_arrays([pa.array((hashes >> np.uint64(64 - places)).astype(np.int64) + 1)], names=["number"])

    merged = phrases.select("lang", *WORDS[:n]).mapInArrow(numbers, "number long")
    merged = merged.select(F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
    bits = np.zeros((max(1, (1 << places) // BITMAP), BITMAP // 8), np.uint8)
    # One row of 4 KB per bitmap: as large as the table at most.
    for row in merged.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        bits[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return Bits(n, places, phrases.sparkSession.sparkContext.broadcast(bits.reshape(-1)))


def _marked(table: Bits, hashes: np.ndarray) -> np.ndarray:
    bits, place = table.bits.value, (hashes >> np.uint64(64 - table.places)).astype(np.int64)
    return ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)


def _counter(n: int, frequent: Bits | None, starts: Bits | None, ends: Bits | None, exact: Bits | None):
    """Count phrases of n words of which the first n - 1 and the last n - 1 are frequent (if given), and of which the first n - 1 are in
    ``starts`` or the last in ``ends`` (if given), and which are in ``exact`` (if given)."""

    def wanted(seed: np.uint64, at: list[np.ndarray]) -> np.ndarray:
        if exact is not None:
            return _marked(exact, _phrase_hash(seed, at))
        head, tail = _phrase_hash(seed, at[:-1]), _phrase_hash(seed, at[1:])
        keep = np.ones(len(head), bool)
        if frequent is not None:
            keep &= _marked(frequent, head) & _marked(frequent, tail)
        if starts is not None:
            keep &= _marked(starts, head) | _marked(ends, tail)
        return keep

    def counted(lang: str, ids: np.ndarray, new: np.ndarray) -> pa.RecordBatch | None:
        """Phrases of a sequence that end at a word which is new there."""
        seed = lang_seed(lang)
        at = [ids[i : len(ids) - n + 1 + i] for i in range(n)]
        inside = np.logical_and.reduce([x != 0 for x in at]) & new[n - 1 :]
        at = [x[inside] for x in at]
        keep = wanted(seed, at)
        at = [x[keep] for x in at]
        if not len(at[0]):
            return None
        order = np.argsort(_phrase_hash(seed, at), kind="stable")
        at = [x[order] for x in at]
        first = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in at]))))
        a = np.diff(np.append(first, len(order)))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), *(pa.array(x[first]) for x in at), pa.array(a)], names=["lang", *WORDS[:n], "a"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, int]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            wall = np.zeros(1, np.int64)
            for lang, rows in held.items():
                ids = np.concatenate([x for row, _ in rows for x in (row, wall)])
                new, at = np.ones(len(ids), bool), 0
                for row, skip in rows:
                    new[at : at + skip] = False
                    at += len(row) + 1
                made = counted(lang, ids, new) if len(ids) >= n else None
                if made is not None:
                    yield made
            held.clear()

        for batch in batches:
            column = batch.column("hashes")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            for lang, skip, low, high in zip(batch.column("lang").to_pylist(), batch.column("skip").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                held.setdefault(lang, []).append((values[low:high], skip))
                size += high - low
                if size > TOGETHER:
                    yield from flush()
                    size = 0
        yield from flush()

    return count


def _counted(
    sequences: DataFrame, n: int, least: int, scratch: Scratch,
    frequent: Bits | None = None, starts: Bits | None = None, ends: Bits | None = None, exact: Bits | None = None,
) -> DataFrame:
    shape = ", ".join(f"{w} long" for w in WORDS[:n])
    parts = sequences.mapInArrow(tidied(_counter(n, frequent, starts, ends, exact)), f"lang string, {shape}, a long")
    phrases = parts.groupBy("lang", *WORDS[:n]).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return stored(phrases, scratch=scratch)


def ratio(a: Column, total: Column) -> Column:
    """floor(SCALE * a / total), in more than 64 bits."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)")).cast("bigint")


def _scored(phrases: DataFrame, n: int, known: dict[int, DataFrame]) -> DataFrame:
    """Add l, r and score at the lowest-scoring cut. Where the count of a rest isn't known yet (no phrase of ``known``), score is null.

    ``bound`` is what the score can be at most, by the cuts that are known and the count of the phrase for those that aren't.
    """
    out = phrases
    for k in range(1, n):
        for name, low, size in ((f"l{k}", 0, k), (f"r{k}", k, n - k)):
            side = known[size].select("lang", *(F.col(w).alias(WORDS[low + i]) for i, w in enumerate(WORDS[:size])), F.col("a").alias(name))
            out = out.join(side, ["lang", *WORDS[low : low + size]], "left")
    cuts = [
        F.struct(
            ratio(F.col("a"), F.coalesce(f"l{k}", "a") + F.coalesce(f"r{k}", "a")).alias("score"), F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        )
        for k in range(1, n)
    ]
    whole = F.lit(True)
    for k in range(1, n):
        whole = whole & F.col(f"l{k}").isNotNull() & F.col(f"r{k}").isNotNull()
    out = out.withColumn("cut", F.least(*cuts) if n > 2 else cuts[0]).withColumn("bound", F.col("cut.score"))
    score, left, right = (F.when(whole, F.col(f"cut.{c}")).alias(c) for c in ("score", "l", "r"))
    return out.select("lang", *WORDS[:n], "a", "bound", score, left, right)


def _nth_score(scores: DataFrame, n: int) -> DataFrame:
    """Per language the greatest score that n rows reach; -1 where there are fewer. At most a row per score is ordered."""
    counts = scores.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("rows"))
    above = Window.partitionBy("lang").orderBy(F.desc("score"))
    enough = counts.withColumn("rows", F.sum("rows").over(above)).where(F.col("rows") >= n)
    return enough.groupBy("lang").agg(F.max("score").alias("level"))


def _as_phrases(parts: dict[int, DataFrame]) -> DataFrame:
    """Phrases of all lengths in one table; words beyond a phrase's length are null."""
    out = None
    for part in parts.values():
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def collocations(
    df: DataFrame, first: int = 2000, least: int = 30, inside: int = 80, text: str = "text", lang: str = "lang", scratch: Scratch | None = None
) -> DataFrame:
    """The ``first`` phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z. Words are what blanks and tabs separate within pieces, and pieces end at any of ``.,;:!?`` or a line end; a null
    or empty text has no words, and a null language is ``und``. n counts all words of a language, a the places of a phrase, l and r
    those of its two parts at the cut of lowest score (the first such cut), and score is SCALE * a / (l + r), rounded down. Phrases have
    ``least`` places or more. One that lies within a longer one (of at most 4 words and ``least`` places) that has ``inside``
    percent of its places is dropped. The order is score, then a, both descending, then the phrase by its bytes. A table
    without such phrases gives no rows; repeated rows count as often as they occur; other columns play no part.
    """
    scratch = scratch or Scratch(df.sparkSession, "collocations")
    rows = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    both = stored(rows.mapInArrow(tidied(_sequences), "lang string, hashes array<long>, skip int, w1 long, word string, a long"), scratch=scratch)
    sequences = both.where("hashes is not null").select("lang", "hashes", "skip")
    single = both.where("w1 is not null").groupBy("lang", "w1").agg(F.sum("a").alias("a"), F.min("word").alias("word"))
    single = stored(single, scratch=scratch)
    totals = stored(single.groupBy("lang").agg(F.sum("a").alias("n")), scratch=scratch)

    frontier: list[Bits] = []

    def bits(phrases: DataFrame, n: int) -> Bits:
        frontier.append(bits_of(phrases, n, phrases.count()))
        return frontier[-1]

    def let_go() -> None:
        while frontier:
            frontier.pop().bits.destroy()
        give_back()

    known = {1: stored(single.where(F.col("a") >= least).select("lang", "w1", "a"), scratch=scratch)}
    known[2] = _counted(sequences, 2, least, scratch, frequent=bits(known[1], 1))
    let_go()
    scored = {2: stored(_scored(known[2], 2, known), scratch=scratch)}

    open_langs = stored(totals.select("lang"), scratch=scratch)
    results, wanted = [], 2 * first
    while True:
        # The level of this round: what enough phrases known so far reach; everything, where there are too few.
        everything = _as_phrases({n: part.where("score is not null") for n, part in scored.items()})
        level = _nth_score(everything.join(open_langs, "lang", "left_semi"), wanted)
        level = stored(open_langs.join(level, "lang", "left").select("lang", F.coalesce("level", F.lit(-1).cast("bigint")).alias("level")), scratch=scratch)

        # Phrases that may reach the level, and those of the next length that they, or the check of them, ask for.
        for n in range(2, LONGEST):
            of_level = scored[n].join(level, "lang")
            heads = known[1].select("lang", "w1", F.col("a").alias("head"))
            grow = of_level.join(heads, ["lang", "w1"]).where(ratio(F.col("a"), F.col("head") + F.col("a")) >= F.col("level"))
            check = stored(of_level.where(F.col("bound") >= F.col("level")).select("lang", *WORDS[:n]), scratch=scratch)
            starts = stored(grow.select("lang", *WORDS[:n]).unionByName(check).distinct(), scratch=scratch)
            # All frequent pairs are known; of longer phrases only those that were asked for.
            frequent = bits(known[2], 2) if n == 2 else None
            known[n + 1] = _counted(sequences, n + 1, least, scratch, frequent, bits(starts, n), bits(check, n))
            scores = stored(_scored(known[n + 1], n + 1, known), scratch=scratch)
            missing = scores.join(level, "lang").where(F.col("score").isNull() & (F.col("bound") >= F.col("level")))
            rests = stored(missing.select("lang", *(F.col(w).alias(v) for v, w in zip(WORDS, WORDS[1 : n + 1]))).distinct(), scratch=scratch)
            if not rests.isEmpty():
                more = _counted(sequences, n, least, scratch, exact=bits(rests, n))
                known[n] = stored(known[n].unionByName(more).distinct(), scratch=scratch)
                scored[n] = stored(_scored(known[n], n, known), scratch=scratch)
                scores = stored(_scored(known[n + 1], n + 1, known), scratch=scratch)
            scored[n + 1] = scores
            let_go()

        settled = {n: part.where("score is not null").join(level, "lang").where("score >= level").drop("level", "bound") for n, part in scored.items()}
        kept = {}
        for n, part in settled.items():
            if n < LONGEST:
                longer = known[n + 1].select("lang", *WORDS[: n + 1], F.col("a").alias("more"))
                for low in (0, 1):
                    most = longer.groupBy("lang", *(F.col(w).alias(v) for v, w in zip(WORDS, WORDS[low : low + n]))).agg(F.max("more").alias("more"))
                    covered = most.select("lang", *WORDS[:n], F.col("more").alias(f"more{low}"))
                    part = part.join(covered, ["lang", *WORDS[:n]], "left")
                most = F.coalesce(F.greatest("more0", "more1"), F.lit(0)).cast("decimal(20,0)")
                part = part.where(most * 100 < F.col("a").cast("decimal(20,0)") * inside).drop("more0", "more1")
            kept[n] = part
        survivors = stored(_as_phrases(kept), scratch=scratch)
        enough = survivors.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
        done = level.join(enough, "lang", "left").where((F.col("level") < 0) | (F.coalesce("rows", F.lit(0)) >= first)).select("lang")
        done = stored(done, scratch=scratch)
        results.append(survivors.join(done, "lang", "left_semi"))
        open_langs = stored(open_langs.join(done, "lang", "left_anti"), scratch=scratch)
        if open_langs.isEmpty():
            break
        wanted *= 4

    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    # Only what can be among the first, ties included, gets its words.
    found = stored(found, scratch=scratch)
    last = _nth_score(found, first)
    found = found.join(last, "lang", "left").where(F.col("level").isNull() | (F.col("score") >= F.col("level"))).drop("level")
    asked = found.select("lang", F.explode(F.array(*WORDS)).alias("w1")).where("w1 is not null").distinct()
    names = stored(single.join(asked, ["lang", "w1"], "left_semi").select("lang", "w1", "word"), scratch=scratch)
    for i, w in enumerate(WORDS):
        found = found.join(names.select("lang", F.col("w1").alias(w), F.col("word").alias(f"word{i}")), ["lang", w], "left")
    found = found.withColumn("phrase", F.concat_ws(" ", *(f"word{i}" for i in range(LONGEST))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

