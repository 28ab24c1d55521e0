"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

BLANKS = " \t\n\x0b\x0c\r"


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None) -> set:
    found = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def components(texts: dict, percent: int = 80) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}
    up = {i: i for i in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def without_lines(texts: list, min_docs: int) -> list:
    def key(line):
        return low(line.strip(BLANKS))

    often = Counter(k for t in texts for k in {key(line) for line in (t or "").split("\n")})
    out = []
    for t in texts:
        split = (t or "").split("\n")
        kept = [line for line in split if not (key(line) and often[key(line)] >= min_docs)]
        out.append((len(split), len(split) - len(kept), "\n".join(kept)))
    return out


def leaks(texts: dict, items: dict, percent: int = 80) -> set:
    out = set()
    for j, item in items.items():
        q = shingles(item)
        for i, t in texts.items():
            shared = len(q & shingles(t))
            if q and 100 * shared >= percent * len(q):
                out.add((i, j, len(q), shared))
    return out


def without_repeats(texts: dict, length: int) -> dict:
    seen, out = set(), {}
    for i in sorted(texts):
        body = (texts[i] or "").encode()
        gone = [False] * len(body)
        for p in range(len(body) - length + 1):
            part = body[p : p + length]
            if part in seen:
                gone[p : p + length] = [True] * length
            seen.add(part)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
