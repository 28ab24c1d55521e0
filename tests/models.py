"""Per-record restatements of the rules, for comparison with the table operators."""


def accept(offsets, strict, position=None):
    """Places of the accepted offsets, given in order of arrival."""
    kept, expected = [], position
    for at, offset in enumerate(offsets):
        if expected is None:
            expected = offset
        if offset == expected or (not strict and offset > expected):
            kept.append(at)
            expected = offset + 1
    return kept


def rotate(batches, flush_size, interval_ms, start_ms=0):
    """Chunk of each record; ``batches`` are (clock, number of records)."""
    chunks, chunk, since, last = [], 0, 0, start_ms
    for now, n in batches:
        for _ in range(n):
            chunks.append(chunk)
            since += 1
            if since >= flush_size or (interval_ms > 0 and now - last >= interval_ms):
                chunk, since, last = chunk + 1, 0, now
    return chunks


def replay(entries, existing, sources):
    """(source, target) renames a recovery carries out, in order."""
    existing, sources = set(existing), set(sources)
    pending, done = [], []
    for key, value in entries:
        if key == "BEGIN":
            pending = []
        elif key == "END":
            for source, target in pending:
                if target not in existing and source in sources:
                    done.append((source, target))
                    existing.add(target)
                    sources.discard(source)
        else:
            pending.append((key, value))
    return done
