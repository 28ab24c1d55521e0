"""Exact top-k by inner product, with bounds from distances to pivots.

For a query q, a candidate x and a pivot p, |q - x| is at least |d(q, p) - d(x, p)|, and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2. So
the greatest difference over many pivots bounds the score from above. Candidates are evaluated in descending order of that bound
until it falls below the k-th score found. Queries and candidates meet in blocks of bounded size; the best k of each block are
merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlog.plans import stored

PIVOTS = 32
#: Vectors among which pivots are chosen.
PIVOT_SAMPLE = 2048
QUERY_BLOCK = 1024
BLOCK = 8192
#: Candidates with the best bounds that are evaluated first; then four times as many, and so on.
STEP = 512


def quantised(df: DataFrame, vector: str, identity: str, scale: int) -> DataFrame:
    """Identity and floor(scale * x) of each component; without null vectors and those that hold null or non-finite components."""
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    parts = F.col(vector).cast("array<double>")
    whole = df.select(F.col(identity).alias("id"), parts.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", bad))
    return whole.select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those chosen."""
    chosen, far = [0], ((vectors - vectors[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(vectors)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
    return vectors[chosen]


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows; zeros where one is shorter than ``width``."""
    out = np.zeros((len(column), width))
    for row, vector in zip(out, column):
        row[: len(vector)] = vector
    return out


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def best(query_ids, queries, to_query, ids, vectors, to_vector, k) -> list[tuple[int, int, int]]:
    """The best k of a block for each query of a block, exactly; ties to the smaller id.

    Candidates are taken by their bounds, best first, in growing steps. After each, those whose bound is below the k-th score are out
    of the question, and it stops when none is left.
    """
    out = []
    norm = (vectors**2).sum(1)
    far = np.ascontiguousarray(to_vector.T, np.float32)
    # Distances are rounded, so a gap gets some room.
    room = np.float32(1e-6 * (1 + float(to_vector.max(initial=0)) + float(to_query.max(initial=0))))
    gap, step = np.empty(len(vectors), np.float32), np.empty(len(vectors), np.float32)
    for i, q in enumerate(queries):
        gap[:] = room
        for pivot, distance in zip(far, to_query[i].astype(np.float32)):
            np.subtract(pivot, distance, out=step)
            np.abs(step, out=step)
            np.maximum(gap, step, out=gap)
        bound = (q @ q + norm - (gap - room).astype(np.float64) ** 2) / 2 + 1e-3
        open_rows = np.flatnonzero(ids != query_ids[i])
        kept_score, kept_id, size = np.zeros(0), np.zeros(0, np.int64), STEP
        while len(open_rows):
            part, rest = open_rows, open_rows[:0]
            if len(open_rows) > size:
                order = np.argpartition(-bound[open_rows], size)
                part, rest = open_rows[order[:size]], open_rows[order[size:]]
            score, at = np.concatenate((kept_score, vectors[part] @ q)), np.concatenate((kept_id, ids[part]))
            if len(score) > 8 * k:
                # All that reach the k-th score, ties included.
                reach = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                score, at = score[reach], at[reach]
            top = np.lexsort((at, -score))[:k]
            kept_score, kept_id = score[top], at[top]
            open_rows = rest if len(kept_score) < k else rest[bound[rest] >= kept_score[-1]]
            size *= 4
        out += [(int(query_ids[i]), int(x), int(s)) for x, s in zip(kept_id, kept_score)]
    return out


def top_k(df: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", identity: str = "vec_id", scale: int = 64) -> DataFrame:
    """Per query its k highest integer inner products: query_id, rank from 1, vec_id, score.

    Components become floor(scale * x). Rows with the query's own identity are no candidates. Ties go to the smaller identity.
    Null vectors, vectors with null or non-finite components, and null identities take no part. Repeated rows are repeated
    candidates; a repeated query is one query. A vector that is shorter than others has zeros in the places it lacks.
    """
    spark = df.sparkSession
    all_rows = stored(quantised(df, vector, identity, scale).where("id is not null"))
    asked = stored(quantised(queries, vector, identity, scale).where("id is not null").dropDuplicates(["id"]))
    sample = all_rows.limit(PIVOT_SAMPLE).toArrow()  # which vectors are pivots changes no result
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = all_rows.unionByName(asked).agg(F.max(F.size("v"))).first()[0]
    shared = spark.sparkContext.broadcast(choose_pivots(_matrix(sample["v"].to_pylist(), width), PIVOTS))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _distances(_matrix(batch.column("v").to_pylist(), width), shared.value) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(far), pa.list_(pa.float64()))], names=["id", "v", "far"])

    def blocked(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
        table = stored(rows.mapInArrow(measure, "id long, v array<bigint>, far array<double>").withColumn("row", F.monotonically_increasing_id()))
        blocks = table.count() // size + 1
        return table.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).drop("row"), blocks

    candidates, n_candidates = blocked(all_rows.select("id", "v"), BLOCK)
    wanted, n_queries = blocked(asked.select("id", "v"), QUERY_BLOCK)
    candidates = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))).withColumnRenamed("block", "c")
    wanted = wanted.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1)))).withColumnRenamed("block", "q")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = best(
            left["id"].to_numpy(), _matrix(left["v"], width), np.stack(left["far"]),
            right["id"].to_numpy(), _matrix(right["v"], width), np.stack(right["far"]), k,
        ) if len(left) and len(right) else []
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = wanted.groupBy("q", "c").cogroup(candidates.groupBy("q", "c")).applyInPandas(meet, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
