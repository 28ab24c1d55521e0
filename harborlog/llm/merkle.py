"""A Merkle manifest of a dataset: digests of all rows, a tree per group, one root, and a proof for every row.

Time-forward processing: every node has a label, its level and place, so that labels ascend from children to parents. A node's
digest is a message to its parent's label; a node is worked out when its label is the least in the queue, when all its messages
are there. The queue is external: messages between blocks of ``HEIGHT`` levels are a table, which Spark sorts by label, and a
small heap carries those within a block. The reversed sweep takes labels in descending order; there a message holds what a
proof has from that node on up to the root, and parents deliver it to their children down to the leaves.

A block has at most ``FAN_OUT ** HEIGHT`` nodes at its foot, whatever the size of a group, so a hot group is many blocks. A
sweep takes one round of Spark per ``HEIGHT`` levels: four for 10^11 rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from harborlog.plans import Scratch, stored

FAN_OUT = 8
HEIGHT = 4
#: Rows of one range when leaves are numbered.
RANGE_ROWS = 250_000

Label = tuple[int, int]
PROOF = "array<struct<left:string,right:string>>"


def digest(*inputs: Column) -> Column:
    """sha256 of the inputs after each other, as lower-case hex."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value so that fields can't run into each other: its length in bytes, a colon, its text; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*(field(value) for value in values))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to: at each level the digest of what stands left, the node, and what stands right."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def forward(feet: list[str]) -> list[list[str]]:
    """Digests of a block level by level, up to ``HEIGHT`` levels over its foot. A node is done when its label leaves the queue."""
    levels: list[list[str]] = [feet, *([] for _ in range(HEIGHT))]
    queue = [((1, i // FAN_OUT), i, node) for i, node in enumerate(feet)]
    heapq.heapify(queue)
    while queue:
        label, inputs = queue[0][0], []
        while queue and queue[0][0] == label:
            inputs.append(heapq.heappop(queue)[2])
        node, (level, place) = _hash("".join(inputs)), label
        levels[level].append(node)
        if level < HEIGHT:
            heapq.heappush(queue, ((level + 1, place // FAN_OUT), place, node))
    return levels


def backward(levels: list[list[str]], top: int, suffix: tuple | None) -> list[tuple | None]:
    """What every node at the foot needs for its proof; ``suffix`` is what the block's top node at level ``top`` needs.

    A suffix is (left, right, suffix of the parent): siblings are shared, not copied, on the way down.
    """
    queue: list[tuple[Label, tuple | None]] = [((-top, 0), suffix)]
    feet: list[tuple | None] = [None] * len(levels[0])
    while queue:
        (level, place), known = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            feet[place] = known
            continue
        run = levels[level - 1][place * FAN_OUT : (place + 1) * FAN_OUT]
        for i in range(len(run)):
            child = ("".join(run[:i]), "".join(run[i + 1 :]), known)
            heapq.heappush(queue, ((1 - level, -(place * FAN_OUT + i)), child))
    return feet


def _steps(suffix: tuple | None) -> list[dict[str, str]]:
    out = []
    while suffix is not None:
        left, right, suffix = suffix
        out.append({"left": left, "right": right})
    return out


def _chain(steps: list[dict[str, str]]) -> tuple | None:
    suffix = None
    for step in reversed(steps):
        suffix = (step["left"], step["right"], suffix)
    return suffix


def _height(total: int) -> int:
    """Levels that a block of a tree with so many nodes at its foot builds."""
    height = 0
    while total > 1 and height < HEIGHT:
        total, height = -(-total // FAN_OUT), height + 1
    return height


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of (tree, block), a table for each block."""
    held, owner = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist()))
        low = 0
        for i, key in enumerate(keys):
            if key != owner:
                if i > low:
                    held.append(batch.slice(low, i - low))
                if held:
                    yield pa.Table.from_batches(held)
                held, owner, low = [], key, i
        held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)


def _ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        total, feet = block.column("total")[0].as_py(), block.column("digest").to_pylist()
        height = _height(total)
        node = forward(feet)[height][0] if height else feet[0]
        yield pa.RecordBatch.from_pylist(
            [{"tree": block.column("tree")[0].as_py(), "place": block.column("block")[0].as_py(), "digest": node, "total": -(-total // FAN_OUT**height)}],
            pa.schema([("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("total", pa.int64())]),
        )


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks whose first row is the message from above; their feet with what they need."""
    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    for block in _blocks(batches):
        message, nodes = block.slice(0, 1), block.slice(1)
        feet = nodes.column("digest").to_pylist()
        height = _height(nodes.column("total")[0].as_py())
        proofs = backward(forward(feet), height, _chain(message.column("proof")[0].as_py()))
        subroot, root = (message.column(c)[0].as_py() for c in ("subroot", "root"))
        # A proof is a few kilobytes, so a block leaves in parts.
        for low in range(0, len(feet), 512):
            part = nodes.slice(low, 512).combine_chunks()
            n = part.num_rows
            made = [pa.array([_steps(proof) for proof in proofs[low : low + n]], pa.list_(step)), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).chunk(0) for c in ("tree", "place", "digest", "kept")), *made],
                names=["tree", "place", "digest", "kept", "proof", "subroot", "root"],
            )


def _number(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """Add ``place`` in the tree and its ``total`` to stored rows of (tree, identity, digest, row, kept).

    Rows are dealt by ranges of (tree, identity, digest, row), so neither a hot tree nor repeated rows meet in one task, and each
    range numbers its rows. A table with a row per tree and range carries the counts over.
    """
    ranges = max(leaves.sparkSession.sparkContext.defaultParallelism, leaves.count() // RANGE_ROWS + 1)
    keys = ["tree", "identity", "digest", "row"]
    placed = leaves.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt = stored(placed.withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), scratch=scratch)
    earlier = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    counts = dealt.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    base = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    bases = stored(counts.select("tree", "range", base.alias("base"), F.sum("n").over(whole).alias("total")), scratch=scratch)
    place = F.col("base") + F.col("at")
    return dealt.join(bases, ["tree", "range"]).select("tree", place.alias("place"), "digest", "total", "kept")


def _queue(messages: DataFrame, rows: int) -> DataFrame:
    """Messages in order of the label that they go to."""
    parts = max(messages.sparkSession.sparkContext.defaultParallelism, rows // FAN_OUT ** (HEIGHT + 1) + 1)
    return messages.repartitionByRange(parts, "tree", "block").sortWithinPartitions("tree", "block", "place")


def _proofs(leaves: DataFrame, above: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """Digest, kept columns, proof, subroot and root of every leaf.

    ``above`` takes the root of each tree, (tree, subroot), and tells (tree, proof, subroot, root): what stands over the trees.
    """
    spot = F.expr(f"place div {FAN_OUT**HEIGHT}")
    kept = leaves.schema["kept"].dataType
    level = stored(leaves.withColumn("block", spot), scratch=scratch)
    rounds, sizes = [level], []
    while True:
        ahead = level.where("total > 1").select("tree", "block", "place", "digest", "total")
        sizes.append(ahead.count())
        if not sizes[-1]:
            break
        made = _queue(ahead, sizes[-1]).mapInArrow(_ascend, "tree string, place long, digest string, total long")
        level = stored(made.withColumn("kept", F.lit(None).cast(kept)).withColumn("block", spot), scratch=scratch)
        rounds.append(level)

    ends = [level.where("total = 1").select("tree", F.col("digest").alias("subroot")) for level in rounds]
    suffixes = stored(above(reduce(DataFrame.unionByName, ends)), scratch=scratch)
    columns = ["tree", "place", "digest", "kept", "proof", "subroot", "root"]

    def lone(n: int) -> DataFrame:
        """Nodes that are the whole rest of their tree."""
        return rounds[n].where("total = 1").join(suffixes, "tree").select(columns)

    found = lone(len(rounds) - 1)
    shape = StructType(
        [*(found.schema[c] for c in ("tree", "place", "digest")), StructField("kept", kept), *(found.schema[c] for c in ("proof", "subroot", "root"))]
    )
    for n in reversed(range(len(rounds) - 1)):
        feet = rounds[n].where("total > 1").select(
            "tree", "block", "place", "digest", "total", "kept", *(F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("proof", "subroot", "root"))
        )
        sent = found.select(
            "tree", F.col("place").alias("block"), F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("string").alias("digest"),
            F.lit(None).cast("bigint").alias("total"), F.lit(None).cast(kept).alias("kept"), "proof", "subroot", "root",
        )
        found = _queue(feet.unionByName(sent), sizes[n]).mapInArrow(_descend, shape).unionByName(lone(n))
        if n:
            found = stored(found, scratch=scratch)
    return found


def manifest(
    df: DataFrame, fields: list[str], tree: str = "lang", identity: str = "doc_id", keep: list[str] | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Columns ``keep`` of every row (all, if not given) with its ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``leaf`` is the digest of the fields. Rows of equal ``tree`` ascend by ``identity`` (null first; rows of equal identity by
    their leaf, and equal rows in any order, which changes nothing but which of them has which proof); every 8 of them
    become a node while more than one remains, and what remains is ``subroot``. Subroots, in bytewise order of ``tree`` with
    null first, become ``root`` likewise. ``proof`` has for each level the siblings to the left and to the right, as text, from
    the leaf to the root; ``folded`` leads from a leaf back to the root. Columns of these four names are replaced, other
    columns stay as they are. An empty table has no rows and no root. A null tree is a group of its own.
    """
    scratch = scratch or Scratch(df.sparkSession, "merkle")
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("leaf", "subroot", "root", "proof")]
    # '-' sorts before '=', so null comes first and the rest in order of its bytes.
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{tree}`").cast("string")), F.lit("-"))
    leaves = stored(
        df.select(
            key.alias("tree"), F.col(f"`{identity}`").alias("identity"), leaf_of(*(F.col(f"`{c}`") for c in fields)).alias("digest"),
            F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"),
        ),
        scratch=scratch,
    )
    empty = F.array().cast(PROOF)

    def over_all(roots: DataFrame) -> DataFrame:
        trees = stored(
            roots.select(
                F.lit("").alias("tree"), F.col("tree").alias("identity"), F.col("subroot").alias("digest"),
                F.monotonically_increasing_id().alias("row"), F.struct("tree").alias("kept"),
            ),
            scratch=scratch,
        )
        top = _proofs(_number(trees, scratch), lambda root: root.select("tree", empty.alias("proof"), "subroot", F.col("subroot").alias("root")), scratch)
        return top.select(F.col("kept.tree").alias("tree"), "proof", F.col("digest").alias("subroot"), "root")

    out = _proofs(_number(leaves, scratch), over_all, scratch)
    return out.select(*(F.col(f"kept.`{c}`") for c in keep), F.col("digest").alias("leaf"), "subroot", "root", "proof")
