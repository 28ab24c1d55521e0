"""Byte-level BPE by prefix dynamic programming, and back.

The encoding of every prefix of a piece of text ends with one certain token. A token t that ends at byte i is that token if the
prefix before t ends with a token that t may follow: one which merging t's bytes to it would leave alone. Two tokens follow each
other exactly where merging the bytes of both gives back the two, and then a whole sequence of such neighbours is the encoding
of its bytes. So one number per byte, the prefix's last token, is all there is to store. More bytes only add numbers, and after
an edit the numbers are the old ones again as soon as they agree over the length of the longest token.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from harborlog.llm.bytewords import slices, tidied

#: Characters beyond its end that the pattern may look at before it settles a piece.
LOOKAHEAD = 8
#: Characters that are split into pieces at once, and how many pieces a worker remembers beyond a segment, twice (pairs of tokens: eight times).
SEGMENT = 1 << 20
REMEMBERED = 1 << 17
#: Bytes of a piece up to which tokens are looked up one by one; an automaton finds those in longer pieces.
SHORT = 48
#: A rank beyond all ranks.
NEVER = 1 << 31


class Decoder:
    """The bytes of all tokens in a row, by id."""

    def __init__(self, token: dict[int, bytes]) -> None:
        size = np.zeros(max(token, default=-1) + 2, np.int64)
        for rank, data in token.items():
            size[rank] = len(data)
        self.size, self.start = size[:-1], np.cumsum(size) - size
        self.data = np.frombuffer(b"".join(token[rank] for rank in sorted(token)), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and where each id's begin, the last one's end included."""
        ids = ids.astype(np.int64)
        # No token is empty, so an id without bytes isn't one.
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise KeyError("an id is not in the vocabulary")
        ends = np.concatenate(([0], np.cumsum(self.size[ids])))
        place = np.repeat(self.start[ids] - ends[:-1], self.size[ids])
        place += np.arange(len(place))
        return self.data[place], ends


class Vocabulary:
    """Tokens by rank, and which of them may follow each other."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.pattern = regex.compile(pattern)
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        #: By its last three bytes, how long a token may be, from the longest on.
        self._lengths: dict[bytes, tuple[int, ...]] = {}
        for token in sorted(self.rank, key=len):
            if len(token) > 2 and len(token) not in self._lengths.get(token[-3:], (2, 1))[:1]:
                self._lengths[token[-3:]] = (len(token), *self._lengths.get(token[-3:], (2, 1)))

    @cached_property
    def decoder(self) -> Decoder:
        return Decoder(self.bytes)

    @cached_property
    def _ends(self) -> ahocorasick.Automaton:
        """Finds all tokens in a long piece."""
        automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            automaton.add_word(token.decode("latin-1"), (len(token), rank))
        automaton.make_automaton()
        return automaton

    def merged(self, data: bytes, down_to: int = 1) -> list[int]:
        """Merge the leftmost pair of least rank until none, or only so many parts, are left; for the bytes of a token or two."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            least, at = min((self.rank.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if least == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[part] for part in parts]

    def _halves_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a byte, and for what merging never makes."""
        if token not in self._halves:
            data = self.bytes[token]
            parts = self.merged(data, 2) if len(data) > 1 else []
            self._halves[token] = tuple(parts) if len(parts) == 2 else None
        return self._halves[token]

    def _check(self, left: int, right: int) -> bool:
        """Whether ``right`` may come after ``left`` (-1: the start of a piece).

        Merges are undone from the last to the first on both sides of the border. The tokens may stand side by side if the
        parts that touched there were never to be merged before the merge that is undone next; of two merges of equal
        rank the left one comes first.
        """
        if len(self._pairs) >= REMEMBERED * 8:
            self._pairs.clear()
        if not self._made(right):
            fits = False
        elif left < 0:
            fits = True
        else:
            fits = self._apart(left, right)
        self._pairs[(left << 32) + right] = fits
        return fits

    def _made(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self._halves_of(token) is not None

    def _apart(self, left: int, right: int) -> bool:
        rank, text, until = self.rank, self.bytes, NEVER
        while True:
            if rank.get(text[left] + text[right], NEVER) < until:
                return False
            of_left, of_right = self._halves_of(left), self._halves_of(right)
            if of_left is not None and (of_right is None or left > right):
                until, left = left, of_left[1]
            elif of_right is not None:
                until, right = right + 1, of_right[0]
            else:
                return True

    def extend(self, data: bytes, low: int, last: array | list[int], stop: Callable[[int], bool] | None = None) -> int:
        """Add the last token of each prefix longer than ``low`` to those in ``last``, until ``stop`` says so; how many there were."""
        first, pairs, check, before = max(0, low - self.longest), self._pairs, self._check, len(last)
        end = low
        for at, (n, token) in self._ends.iter(data[first:].decode("latin-1")):
            at += first + 1
            if at <= end or n > at:
                continue
            left = last[at - n]
            fits = pairs.get((left << 32) + token)
            if fits if fits is not None else check(left, token):
                last.append(token)
                end = at
                if stop is not None and stop(end):
                    break
        return len(last) - before

    def back(self, last: array | list[int], at: int) -> list[int]:
        """The encoding of the first ``at`` bytes, from its end to its start and turned round."""
        out, text = [], self.bytes
        while at:
            token = last[at]
            out.append(token)
            at -= len(text[token])
        out.reverse()
        return out

    def piece(self, data: bytes) -> tuple[int, ...]:
        """A piece that is a token is that token; else its encoding."""
        known = self.rank.get(data)
        if known is not None:
            return (known,)
        last = [-1]
        self.extend(data, 0, last)
        return tuple(self.back(last, len(data)))

    def split(self, text: str) -> Iterator[list[str]]:
        """All pieces of a text in order, segment by segment, so a long text is never split whole."""
        low, size = 0, SEGMENT
        while low < len(text):
            high = min(low + size, len(text))
            pieces = self.pattern.findall(text, low, high)
            if high < len(text):
                # Pieces near the end of the segment may change with what follows.
                end = high
                while pieces and end > high - LOOKAHEAD:
                    end -= len(pieces.pop())
                if not pieces:
                    size *= 2
                    continue
                low, size = end, SEGMENT
            else:
                low = high
            yield pieces

    def remember(self, pieces: set[str]) -> None:
        """Encode all pieces that aren't known, in bytewise order: what a piece shares with the one before it is done already."""
        if len(self._pieces) > REMEMBERED:
            # What turns up again is taken over, so pieces of every segment stay.
            self._older, self._pieces = self._pieces, {}
        known, older, missing = self._pieces, self._older.get, []
        for piece in pieces:
            if piece not in known:
                ids = older(piece)
                if ids is not None:
                    known[piece] = ids
                    continue
                data = piece.encode()
                whole = self.rank.get(data)
                if whole is None:
                    missing.append((data, piece))
                else:
                    known[piece] = whole.to_bytes(4, "little")
        missing.sort()
        rank, lengths, fits, check, last, former = self.rank.get, self._lengths.get, self._pairs.get, self._check, [-1], b""
        for data, piece in missing:
            end, most = 0, min(len(data), len(former))
            while end < most and data[end] == former[end]:
                end += 1
            del last[end + 1 :]
            former = data
            if len(data) > SHORT:
                self.extend(data, end, last)
            else:
                while end < len(data):
                    end += 1
                    for n in lengths(data[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                        low = end - n
                        if low < 0:
                            continue
                        token = rank(data[low:end])
                        if token is not None:
                            fit = fits((last[low] << 32) + token)
                            if fit or (fit is None and check(last[low], token)):
                                last.append(token)
                                break
            known[piece] = array("i", self.back(last, len(data))).tobytes()

    def ids_of(self, pieces: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self._pieces.__getitem__, pieces)), "<i4")

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for pieces in self.split(text):
            self.remember(set(pieces))
            parts.append(self.ids_of(pieces))
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Encode texts of a segment's size together, longer ones each on its own."""
        if sum(map(len, texts)) > 2 * SEGMENT:
            return [self.encode(text) for text in texts]
        split = [list(chain.from_iterable(self.split(text))) for text in texts]
        self.remember(set().union(*split))
        return [self.ids_of(pieces) for pieces in split]

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        return self.decoder.decode(np.asarray(ids, np.int64))[0].tobytes()


class Prefixes:
    """The last token of every prefix of a growing or changing piece of bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", array("i", [-1])
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: what is stored stays, and each new byte adds a number."""
        low = len(self.data)
        self.data += more
        self.vocabulary.extend(self.data, low, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes from start to stop; how many numbers had to be worked out anew."""
        old, agreed, last = self.last[stop + 1 :], 0, self.last
        self.data = self.data[:start] + new + self.data[stop:]
        del last[start + 1 :]
        since = start + len(new)

        def as_before(end: int) -> bool:
            nonlocal agreed
            if end > since:
                agreed = agreed + 1 if old[end - since - 1] == last[end] else 0
            return agreed >= self.vocabulary.longest

        done = self.vocabulary.extend(self.data, start, last, as_before)
        last.extend(old[len(last) - 1 - since :] if len(last) - 1 >= since else [])
        return done

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the first ``length`` bytes, by default all."""
        return self.vocabulary.back(self.last, len(self.data) if length is None else length)


class Document:
    """A text and its encoding under edits: only pieces that an edit can reach are split and encoded again."""

    def __init__(self, vocabulary: Vocabulary, text: str = "") -> None:
        self.vocabulary, self.text, self.starts, self.parts = vocabulary, "", [], []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> int:
        """Put ``new`` in place of the characters from start to stop; how many pieces were encoded."""
        shift = len(new) - (stop - start)
        later = {at + shift: i for i, at in enumerate(self.starts) if at >= stop}
        keep = 0
        while keep < len(self.starts) and (self.starts[keep + 1] if keep + 1 < len(self.starts) else len(self.text)) <= start - LOOKAHEAD:
            keep += 1
        at = self.starts[keep] if keep < len(self.starts) else (len(self.text) if keep else 0)
        at = min(at, start)
        self.text = self.text[:start] + new + self.text[stop:]
        starts, parts, done = self.starts[:keep], self.parts[:keep], 0
        while at < len(self.text):
            # From a place where a piece began before, in text that is the same from there on, all is as it was.
            if at in later and at >= start + len(new):
                starts += [old + shift for old in self.starts[later[at] :]]
                parts += self.parts[later[at] :]
                break
            found = self.vocabulary.pattern.match(self.text, at)
            starts.append(at)
            parts.append(self.vocabulary.piece(found.group().encode()))
            at, done = found.end(), done + 1
        self.starts, self.parts = starts, parts
        return done

    def ids(self) -> list[int]:
        return [token for part in self.parts for token in part]


_vocabularies: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(ranks_path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a file with a base64 token and its rank in each line; one at a time is kept in a worker."""
    if (ranks_path, pattern) not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[ranks_path, pattern] = Vocabulary(ranks_path, pattern)
    return _vocabularies[ranks_path, pattern]


def _free(df: DataFrame) -> str:
    """A column name that ``df`` doesn't have."""
    name = "_input"
    while name in df.columns:
        name += "_"
    return name


def _added(df: DataFrame, keep: list[str] | None, name: str, kind: DataType) -> tuple[list[str], StructType]:
    kept = [c for c in (df.columns if keep is None else keep) if c != name]
    return kept, StructType([*(df.schema[c] for c in kept), StructField(name, kind)])


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", name: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add the token ids of a text, as array<int>, to the columns ``keep`` (all, if not given).

    The text is cut into pieces by the pattern, and each piece is encoded on its own, without special tokens. A null or empty
    text has no ids. Long texts are split and encoded whole, segment by segment. A column called ``name`` is replaced; an empty table
    stays empty; repeated rows come back as often.
    """
    kept, shape = _added(df, keep, name, ArrayType(IntegerType()))
    given = _free(df)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch, given, 2 * SEGMENT):
                ids = known.encode_all([value or "" for value in part.column(part.num_columns - 1).to_pylist()])
                ends = np.cumsum([0, *map(len, ids)])
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], names=[*kept, name])

    return df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias(given)).mapInArrow(tidied(each), shape)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", name: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Add the bytes of token ids, as binary, to the columns ``keep`` (all, if not given).

    Null is decoded as no ids, and so is a null id. An id that the vocabulary doesn't have fails the query: bytes that are not
    known can't be made up.
    """
    kept, shape = _added(df, keep, name, BinaryType())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(ranks_path, pattern).decoder
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(size) // SEGMENT
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if high == low:
                    continue
                flat = column.slice(low, high - low).flatten()
                there = flat.is_valid().to_numpy(zero_copy_only=False)
                data, ends = known.decode(flat.drop_null().to_numpy(zero_copy_only=False))
                upto = np.concatenate(([0], np.cumsum(there)))[np.concatenate(([0], np.cumsum(size[low:high])))]
                offsets = pa.py_buffer(ends[upto].astype(np.int64))
                made = pa.Array.from_buffers(pa.large_binary(), high - low, [None, offsets, pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*(c.slice(low, high - low) for c in batch.columns[:-1]), made.cast(pa.binary())], names=[*kept, name])

    return df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{ids}`").alias(_free(df))).mapInArrow(tidied(each), shape)
