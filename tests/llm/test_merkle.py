"""The Merkle manifest against a plain version, over several blocks, and in odd cases."""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from harborlog.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, total long"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and left and right siblings of every node, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 8 * 8 : place // 8 * 8 + 8]
            paths[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
            at[i] = place // 8
        level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def plain(rows) -> dict:
    """(doc_id, leaf) to sorted (subroot, root, proof text) of each row."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], leaf((row[0], row[3], row[2], row[4], row[1]))))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        leaves = sorted(groups[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = leaves, *climb([x[1] for x in leaves])
    if not langs:
        return {}
    root, above = climb([trees[lang][1] for lang in langs])
    out: dict = {}
    for lang, over in zip(langs, above):
        leaves, subroot, paths = trees[lang]
        for (doc, node), path in zip(leaves, paths):
            text = "".join(a + b for a, b in path + over)
            out.setdefault((doc, node), []).append((subroot, root, text))
    return {key: sorted(value) for key, value in out.items()}


def found(frame) -> dict:
    out: dict = {}
    for row in frame.collect():
        out.setdefault((row.doc_id, row.leaf), []).append((row.subroot, row.root, "".join(s.left + s.right for s in row.proof)))
        node = row.leaf
        for step in row.proof:
            node = h(step.left, node, step.right)
        assert node == row.root
    return {key: sorted(value) for key, value in out.items()}


def rows_of(n: int, langs) -> list[tuple]:
    return [(i, f"Text {i % 7} É", langs[i % len(langs)], "s" if i % 3 else None, i % 5 or None, "l", "t", 3) for i in range(n)]


ODD = [
    (None, None, None, None, None, None, None, None),
    (None, "", "", "", 0, "x", "y", 1),
    (3, "same", "de", "s", 4, "", "", 0),
    (3, "same", "de", "s", 4, "", "", 0),
    (3, "other", "de", "s", 4, "", "", 0),
    (4, "x" * 300_000, "é", "s", 4, "", "", 0),
    (-5, "A", "=", "s", 4, "", "", 0),
]


@pytest.mark.parametrize("rows", [rows_of(1, ["en"]), rows_of(9, ["en"]), rows_of(65, ["en", None]), ODD], ids=["one", "nine", "two", "odd"])
def test_same_as_plain(spark, rows):
    assert found(merkle.manifest(spark.createDataFrame(rows, SCHEMA), FIELDS)) == plain(rows)


def test_blocks_across_rounds(spark):
    """A hot group of 8,000 leaves, some of them repeated, is two blocks and two rounds; ten small groups end in the first."""
    rows = rows_of(9000, ["en"] * 8 + ["de"])
    rows += [(row[0], row[1], lang, *row[3:]) for lang in "abcdefghij" for row in rows[:9]] + rows[:5] * 3
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(merkle.manifest(frame, FIELDS, keep=["doc_id"])) == plain(rows)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty, FIELDS).collect() == []
    frame = merkle.manifest(spark.createDataFrame(ODD, SCHEMA), FIELDS)
    assert sorted(frame.columns) == sorted([*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "subroot", "root", "proof"])
    assert frame.where("total = 3").count() == 0 and frame.where("tree = 'y'").count() == 1


def test_query_finds_tampering(spark, sf_dir):
    """The registered query, whole: a row is verified unless its id is of the tampered ones and its text changes with that."""
    rows = queries.QUERIES["op13_merkle_manifest"](spark, sf_dir).collect()
    texts = {row.doc_id: row for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = plain([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in texts.values()])
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id].text
        changes = text is not None and any("A" <= c <= "Z" for c in text) and crc32(str(row.doc_id).encode()) % 3 == 0
        assert row.verified == (not changes) and (row.folded_root == row.root) == row.verified
        ((subroot, root, proof),) = want[row.doc_id, row.leaf]
        assert (row.subroot, row.root, row.proof_sha256) == (subroot, root, h(proof))


def test_folding_is_native(spark):
    proof = F.array(F.struct(F.lit("a").alias("left"), F.lit("b").alias("right")))
    assert spark.range(1).select(merkle.folded(F.lit("x"), proof).alias("r")).first().r == h("axb")
