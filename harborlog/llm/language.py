"""Language of a text from unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A text is a row of words; a word's probability
is the sum, over all ways to cut it into pieces, of the products of the pieces' probabilities, which a forward pass gives.
Piece probabilities come from expectation maximisation (forward and backward passes) over the words of labelled texts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlog.llm.bytewords import give_back, LOWER, raw, slices, span_hashes, tidied, words

#: Longest piece in bytes that is used, and longest part of a word that is scored in one pass; longer words are cut.
PIECE_BYTES = 12
WORD_BYTES = 48
#: Labelled texts that are learned from, about so many of each language (their choice depends on the text alone).
SAMPLE_TEXTS = 600
ROUNDS = 3
#: Terms that training looks at together: their lattices and sums are all it holds beside the counts, on the driver.
TOGETHER = 2_000
SMOOTH = 0.05
#: Words whose probabilities a worker remembers; beyond, it starts anew.
REMEMBERED = 400_000


class Model(NamedTuple):
    languages: list[str]
    pieces: np.ndarray  # sorted hashes
    chance: np.ndarray  # of a piece in a language, pieces x languages


def vocabulary(path: str) -> np.ndarray:
    """Sorted hashes of the pieces of a vocabulary file with a base64 piece and a rank in each line."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    pieces = [bytes(LOWER[np.frombuffer(p, np.uint8)]) for p in pieces if 0 < len(p) <= PIECE_BYTES]
    pieces = sorted(set(pieces) | {bytes([b]) for b in range(256)})
    ends = np.cumsum([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    return np.unique(span_hashes(data, np.concatenate(([0], ends[:-1])), ends))


def _lattice(terms: list[bytes], pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the terms, and the piece that ends at each place of a term with each length (or -1)."""
    length = np.array([len(t) for t in terms], np.int64)
    width = int(length.max())
    found = np.full((width + 1, PIECE_BYTES + 1, len(terms)), -1, np.int32)
    for low in range(0, len(terms), 20_000):
        part = terms[low : low + 20_000]
        data = np.frombuffer(b"".join(part), np.uint8)
        size = length[low : low + 20_000]
        first = np.cumsum(size) - size
        of = np.repeat(np.arange(len(part)), size)
        place = np.arange(len(data)) - first[of]
        for n in range(1, PIECE_BYTES + 1):
            fits = np.flatnonzero(place + n <= size[of])
            h = span_hashes(data, fits, fits + n)
            at = np.minimum(np.searchsorted(pieces, h), len(pieces) - 1)
            hit = pieces[at] == h
            found[place[fits[hit]] + n, n, low + of[fits[hit]]] = at[hit]
    return length, found


def _forward(found: np.ndarray, chance: np.ndarray) -> np.ndarray:
    places, _, n = found.shape
    out = np.zeros((places, n, chance.shape[1]))
    out[0] = 1
    for place in range(1, places):
        for size in range(1, min(PIECE_BYTES, place) + 1):
            k = np.flatnonzero(found[place, size] >= 0)
            if len(k):
                out[place, k] += out[place - size, k] * chance[found[place, size, k]]
    return out


def word_scores(terms: list[bytes], pieces: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Log probability of each term (up to WORD_BYTES) in each language, over all its segmentations."""
    out = np.empty((len(terms), chance.shape[1]))
    order = np.argsort([len(t) for t in terms], kind="stable")
    for low in range(0, len(order), 5_000):
        some = order[low : low + 5_000]
        length, found = _lattice([terms[i] for i in some.tolist()], pieces)
        out[some] = np.log(np.maximum(_forward(found, chance)[length, np.arange(len(some))], 1e-300))
    return out


def fit(languages: list[str], terms: list[bytes], counts: np.ndarray, pieces: np.ndarray) -> Model:
    """counts: terms x languages. Expectation maximisation from equal chances that favour no segmentation length."""
    chance = np.full((len(pieces), len(languages)), 1.0 / 256)
    # Terms of like lengths together keep the lattices narrow.
    order = sorted(range(len(terms)), key=lambda i: len(terms[i]))
    terms, counts = [terms[i] for i in order], counts[order]
    parts = [slice(low, low + TOGETHER) for low in range(0, len(terms), TOGETHER)]
    for _ in range(ROUNDS):
        seen = np.zeros_like(chance)
        for p in parts:
            length, found = _lattice(terms[p], pieces)
            ahead = _forward(found, chance)
            places, _, n = found.shape
            behind = np.zeros_like(ahead)
            behind[length, np.arange(n)] = 1
            weight = counts[p] / np.maximum(ahead[length, np.arange(n)], 1e-300)
            for place in range(places - 1, 0, -1):
                for size in range(1, min(PIECE_BYTES, place) + 1):
                    k = np.flatnonzero(found[place, size] >= 0)
                    if not len(k):
                        continue
                    piece = found[place, size, k]
                    step = chance[piece] * behind[place, k]
                    behind[place - size, k] += step
                    share = ahead[place - size, k] * step * weight[k]
                    for j in range(len(languages)):
                        seen[:, j] += np.bincount(piece, share[:, j], len(pieces))
        chance = (seen + SMOOTH) / (seen + SMOOTH).sum(0)
    return Model(languages, pieces, chance)


def _terms(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """The words with a blank in front, as the vocabulary has them."""
    buffer = LOWER[data].tobytes()
    return [b" " + buffer[a:b] for a, b in zip(start.tolist(), end.tolist())]


def _cut(w):
    """Words as spans of at most WORD_BYTES - 1 bytes."""
    size = w.end - w.start
    parts = np.maximum(1, -(-size // (WORD_BYTES - 1)))
    if parts.max(initial=1) == 1:
        return w.start, w.end, w.hash, w.first
    of = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = w.start[of] + nth * (WORD_BYTES - 1)
    end = np.minimum(start + WORD_BYTES - 1, w.end[of])
    first = np.concatenate(([0], np.cumsum(parts)))[w.first]
    return start, end, w.hash[of] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), first


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            start, end, key, first = _cut(words(part.column("text")))
            data, _ = raw(part.column("text"))
            code, names = np.unique(part.column("lang").to_pylist(), return_inverse=True)[::-1]
            for j, name in enumerate(names):
                own = np.repeat(code == j, np.diff(first))
                _, at, n = np.unique(key[own], return_index=True, return_counts=True)
                if len(at):
                    yield pa.record_batch({
                        "lang": pa.array([name] * len(at), pa.string()),
                        "word": pa.array(_terms(data, start[own][at], end[own][at]), pa.binary()),
                        "n": pa.array(n, pa.int64()),
                    })


def train(labelled: DataFrame, vocabulary_path: str, text: str = "text", lang: str = "lang") -> Model:
    """Learn from the labelled rows: about SAMPLE_TEXTS different texts of each language, whole.

    Rows without text or language are left out; without any rows the model knows no language.
    """
    pieces = vocabulary(vocabulary_path)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    rows = rows.withColumn("mark", F.xxhash64("text"))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")).collect()}
    if not totals:
        return Model([], pieces, np.zeros((len(pieces), 0)))
    part = F.lit(0)
    for name, n in totals.items():
        part = F.when(F.col("lang") == name, F.lit(int(min(1.0, SAMPLE_TEXTS / max(n, 1)) * (1 << 20)))).otherwise(part)
    chosen = rows.where(F.pmod("mark", F.lit(1 << 20)) < part).dropDuplicates(["lang", "mark"]).select("lang", "text")
    counted = chosen.mapInArrow(tidied(_count_words), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    got = counted.toArrow().to_pandas()
    languages = sorted(totals)
    got = got[got["lang"].isin(languages)]
    terms, at = np.unique(got["word"].to_numpy(object), return_inverse=True) if len(got) else (np.array([], object), [])
    if not len(terms):
        return Model([], pieces, np.zeros((len(pieces), 0)))
    counts = np.zeros((len(terms), len(languages)))
    np.add.at(counts, (at, [languages.index(x) for x in got["lang"]]), got["n"].to_numpy(float))
    model = fit(languages, terms.tolist(), counts, pieces)
    give_back()
    return model


class _Memory:
    """Scores of words met before, by hash; forgets everything when full, which changes no result."""

    def __init__(self, n: int):
        self.key, self.value = np.zeros(0, np.uint64), np.zeros((0, n))

    def look(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return self.key[at] == key, at

    def add(self, key: np.ndarray, value: np.ndarray) -> None:
        if len(self.key) + len(key) > REMEMBERED:
            self.key, self.value = self.key[:0], self.value[:0]
        keys = np.concatenate((self.key, key))
        order = np.argsort(keys, kind="stable")
        self.key, self.value = keys[order], np.concatenate((self.value, value))[order]


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = LOWER[data]
    ascii_letter = np.concatenate(([0], np.cumsum((plain >= 97) & (plain <= 122), dtype=np.int64)))
    out = np.diff(ascii_letter[offsets]) > 0
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score (the language's share of the text's probability, 0 to 1).

    A null text, or one without letters, is ``und`` with score 0, and so is every text if no language was learned. Equal
    scores go to the language that sorts first. Other columns stay; they may have any name but those two.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    memory: list[_Memory] = []

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, pieces, chance = shared.value
        memory[:] = [_Memory(len(languages))]
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(text)
                data, offsets = raw(column)
                known = _has_letter(data, offsets) if languages else np.zeros(len(column), bool)
                total = np.zeros((len(column), max(1, len(languages))))
                if known.any():
                    start, end, key, first = _cut(words(column))
                    unique, at, back = np.unique(key, return_index=True, return_inverse=True)
                    hit, place = memory[0].look(unique)
                    value = np.zeros((len(unique), len(languages)))
                    value[hit] = memory[0].value[place[hit]]
                    new = np.flatnonzero(~hit)
                    for low in range(0, len(new), 5_000):
                        some = new[low : low + 5_000]
                        value[some] = word_scores(_terms(data, start[at[some]], end[at[some]]), pieces, chance)
                    if len(new):
                        memory[0].add(unique[new], value[new])
                    for j in range(len(languages)):
                        run = np.concatenate(([0.0], np.cumsum(value[back, j])))
                        total[:, j] = run[first[1:]] - run[first[:-1]]
                best = total.argmax(1)
                with np.errstate(over="ignore", under="ignore"):
                    share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                names = pa.array([languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, names, pa.array(np.where(known, share, 0.0), pa.float64())],
                    names=[*part.schema.names, "lang_pred", "score"],
                )
        memory.clear()

    schema = df.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return df.mapInArrow(tidied(score), schema)
