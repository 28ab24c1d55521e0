"""Removal of lines that many documents share, with an index of sorted runs of line hashes.

The index has levels of runs. A run is a table sorted by line hash with the number of documents of each. A new batch
merge-anti-joins the runs of lines already known to be frequent and adds the counts of the others as a run of its own. When a
level is full its runs are merged into one of the next level, and lines that reach the threshold move to the frequent runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.plans import Scratch, intermediate, new_folder, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["__h1", "__h2"]
DOC = ["__d1", "__d2"]


def lowered(column: Column) -> Column:
    """A-Z in lower case, all else as it is; plain ASCII takes the faster way."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def split_lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _digest(*columns: Column) -> list[Column]:
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


class LineRuns:
    """Levelled runs in a folder. A count is exact for lines below ``min_docs``; frequent lines are only known as such."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int, fanout: int = 4):
        self.spark, self.path, self.min_docs, self.fanout = spark, path, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.frequent: list[str] = []
        self._made = 0

    SCHEMA = "__h1 long, __h2 long, __docs long"

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], self.SCHEMA)

    def _write(self, run: DataFrame) -> str:
        self._made += 1
        path = f"{self.path}/run-{self._made}"
        run.sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def add(self, batch: DataFrame) -> None:
        """batch: line hashes and their numbers of documents."""
        fresh = batch.hint("merge").join(self._read(self.frequent), KEY, "left_anti") if self.frequent else batch
        self.levels[0].append(self._write(fresh))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """Merge all runs of a level into one of the next."""
        merged = self._read(self.levels[level]).groupBy(*KEY).agg(F.sum("__docs").alias("__docs"))
        path = self._write(merged)
        whole = self._read([path])
        self.frequent.append(self._write(whole.where(F.col("__docs") >= self.min_docs)))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level] = []
        self.levels[level + 1].append(self._write(whole.where(F.col("__docs") < self.min_docs)))

    def frequent_lines(self) -> DataFrame:
        """All lines of at least ``min_docs`` documents so far, each once."""
        rest = [run for level in self.levels for run in level]
        counted = self._read(rest).groupBy(*KEY).agg(F.sum("__docs").alias("__docs")).where(F.col("__docs") >= self.min_docs)
        return counted.unionByName(self._read(self.frequent)).select(*KEY)


def _dropped_lines(lines: DataFrame, batches: int, min_docs: int) -> DataFrame:
    """Per document the places of its frequent lines. The index and the lines' hashes are needed for that only."""
    spark = lines.sparkSession
    lines = stored(lines.withColumn("__batch", F.pmod("__row", F.lit(batches)).cast("int")))
    runs = LineRuns(spark, intermediate(spark, "runs"), min_docs)
    for n in range(batches):
        batch = lines.where(F.col("__batch") == n).select("__row", *KEY).distinct()
        runs.add(batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("__docs")))
    frequent = stored(runs.frequent_lines())
    return lines.join(frequent, KEY).select(*DOC, "__at").groupBy(*DOC).agg(F.collect_set("__at").alias("__gone"))


def drop_frequent_lines(
    df: DataFrame, text: str = "text", identity: str = "doc_id", min_docs: int = 10, min_length: int = 1, batches: int = 6
) -> DataFrame:
    """Add n_lines, n_dropped and kept_text: the text without lines that ``min_docs`` rows or more have.

    A line counts by its key: blanks stripped at both ends, A-Z in lower case. Keys shorter than ``min_length`` code points
    never go. Null and empty texts are one empty line. A row is a document, so a repeated row counts as another one. A text
    that loses every line becomes empty.
    """
    spark = df.sparkSession
    own = _digest(F.col(identity), F.coalesce(F.col(text), F.lit("")))
    key = F.btrim(lowered(F.col("__line")), F.lit(BLANKS))
    lines = (
        df.select(F.monotonically_increasing_id().alias("__row"), F.col(text), *(c.alias(n) for c, n in zip(own, DOC)))
        .select("__row", *DOC, F.posexplode(split_lines(text)).alias("__at", "__line"))
        .withColumn("__key", key)
        .where(F.char_length("__key") >= min_length)
        .select("__row", *DOC, "__at", *(c.alias(n) for c, n in zip(_digest(F.col("__key")), KEY)))
    )
    with Scratch(spark, "lines"):
        dropped = stored(_dropped_lines(lines, batches, min_docs), new_folder(spark, "dropped"))
    marked = df.select("*", *(c.alias(n) for c, n in zip(own, DOC))).join(dropped, DOC, "left")
    all_lines = split_lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("__gone"))
    return marked.select(
        *(F.col(f"`{c}`") for c in df.columns),
        F.size(all_lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("__gone").isNull(), F.coalesce(F.col(text), F.lit("")))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n"))
        .alias("kept_text"),
    )
