"""The manifest: which files have been published. Each micro-batch adds a part, and parts are merged into runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.sinks import paths
from harborlog.sources.listing import committed_files, list_files

MANIFEST_SCHEMA = (
    "topic string, kafka_partition int, encoded_partition string, start_offset bigint, end_offset bigint, "
    "n_records bigint, committed_file string, path string, stream_id string, batch_id bigint"
)


def read_manifest(spark: SparkSession, manifest_root: str) -> DataFrame:
    """All published files: the parts of batches, and the runs that earlier parts were merged into. Empty if nothing is published.

    Parts are laid out as ``stream_id=<s>/batch_id=<n>``, so a filter on either prunes directories; filters on topic and
    partition are pushed to the Parquet scan, and runs are clustered by them. Names starting with an underscore are parts being
    written, or no parts.
    """
    parts, runs = manifest_folders(manifest_root)
    try:
        if not runs:
            return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_root)
        merged = spark.read.schema(MANIFEST_SCHEMA).parquet(*runs)
        if not parts:
            return merged
        return merged.unionByName(spark.read.schema(MANIFEST_SCHEMA).option("basePath", manifest_root).parquet(*parts))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise


def rebuild_manifest(spark: SparkSession, topics_root: str, stream_id: str = "rebuilt") -> DataFrame:
    """Derive the manifest from the names of the published files; record counts are unknown."""
    files = committed_files(list_files(spark, topics_root, "*+*+*+*"))
    # <topics root>/<topic>/<encoded partition>/<name>; the token itself may contain slashes.
    root = topics_root.rstrip("/").rsplit("/", 1)[-1]
    below_root = F.substring_index("path", f"/{root}/", -1)
    # Files that were written in place lie in a folder of their attempt.
    encoded = F.regexp_extract(below_root, r"^[^/]+/(.*?)(?:/o-[0-9a-f]{32})?/[^/]+$", 1)
    return files.select(
        "topic",
        "kafka_partition",
        encoded.alias("encoded_partition"),
        "start_offset",
        "end_offset",
        F.lit(None).cast("bigint").alias("n_records"),
        F.col("file_name").alias("committed_file"),
        "path",
        F.lit(stream_id).alias("stream_id"),
        F.lit(-1).cast("bigint").alias("batch_id"),
    )


# Compaction ---------------------------------------------------------------------------------------------------

#: Runs of a manifest lie beside its parts; plain readers skip the folder.
RUNS = "_runs"
DONE = "_COMMITTED"
#: Parts, or runs of a level, that are merged into a run of the next level.
FAN_IN = 8
#: Newest parts that stay as they are: a replay needs them, and the positions that lie in them.
NEWEST = 2
RUN_ROWS = 1_000_000
CLUSTERED = ["topic", "kafka_partition", "start_offset"]


@dataclass(frozen=True, order=True)
class Run:
    """The manifest parts of a stream's batches ``first`` to ``last``, merged and clustered by topic."""

    first: int
    last: int
    level: int
    path: str

    def covers(self, batch_id: int) -> bool:
        return self.first <= batch_id <= self.last


def runs_of(manifest_root: str, stream_id: str) -> list[Run]:
    """Committed runs of a stream, in order, without those that lie in a larger one."""
    return _outermost(_all_runs(manifest_root, stream_id))


def _all_runs(manifest_root: str, stream_id: str) -> list[Run]:
    folder, found = f"{manifest_root}/{RUNS}/stream_id={stream_id}", []
    for name in paths.subdirectories(folder):
        level, first, last = (int(part) for part in name.split("-"))
        if paths.exists(f"{folder}/{name}/{DONE}"):
            found.append(Run(first, last, level, f"{folder}/{name}"))
    return sorted(found)


def _outermost(runs: list[Run]) -> list[Run]:
    return [run for run in runs if not any(run != other and other.first <= run.first and run.last <= other.last for other in runs)]


def _parts(manifest_root: str, stream_id: str) -> list[int]:
    names = paths.subdirectories(f"{manifest_root}/stream_id={stream_id}")
    return sorted(int(name.removeprefix("batch_id=")) for name in names)


def is_covered(manifest_root: str, stream_id: str, batch_id: int) -> bool:
    """Whether a batch's part has gone into a run."""
    return any(run.covers(batch_id) for run in _all_runs(manifest_root, stream_id))


def compact_manifest(spark: SparkSession, manifest_root: str, stream_id: str, fan_in: int = FAN_IN) -> bool:
    """Merge parts of a stream into runs, and runs into larger ones, where ``fan_in`` of a kind have come together.

    A row is rewritten once per level, so n batches cost n times their logarithm, and a reader visits fewer than ``fan_in``
    folders per level. A run counts from the moment its mark is put; until then its parts do. What is in a run is deleted by
    the next compaction but one, not before, so that readers which listed it can finish. May be called at any time by the
    one writer of a stream, and again after any failure. Whether anything was merged.
    """
    runs = _all_runs(manifest_root, stream_id)
    outer = _outermost(runs)
    parts = _parts(manifest_root, stream_id)
    superseded = [run.path for run in runs if run not in outer]
    superseded += [f"{manifest_root}/stream_id={stream_id}/batch_id={n}" for n in parts if any(run.covers(n) for run in outer)]
    open_parts = [n for n in parts if not any(run.covers(n) for run in outer)][:-NEWEST]
    merged = False
    if len(open_parts) >= fan_in:
        sources = [f"{manifest_root}/stream_id={stream_id}/batch_id={n}" for n in open_parts]
        rows = spark.read.schema(MANIFEST_SCHEMA).option("basePath", manifest_root).parquet(*sources)
        _write_run(rows, manifest_root, stream_id, 1, open_parts[0], open_parts[-1])
        merged = True
    level = 1
    while True:
        alike = [run for run in runs_of(manifest_root, stream_id) if run.level == level]
        if not alike and not any(run.level > level for run in runs_of(manifest_root, stream_id)):
            break
        if len(alike) >= fan_in:
            rows = spark.read.schema(MANIFEST_SCHEMA).parquet(*(run.path for run in alike))
            _write_run(rows, manifest_root, stream_id, level + 1, alike[0].first, alike[-1].last)
            merged = True
        level += 1
    if merged:
        for path in superseded:
            paths.delete_directory(path)
    return merged


def _write_run(rows: DataFrame, manifest_root: str, stream_id: str, level: int, first: int, last: int) -> None:
    path = f"{manifest_root}/{RUNS}/stream_id={stream_id}/{level}-{first}-{last}"
    files = rows.count() // RUN_ROWS + 1
    clustered = rows.repartitionByRange(files, *CLUSTERED).sortWithinPartitions(*CLUSTERED)
    clustered.write.mode("overwrite").parquet(path)
    paths.put_if_absent(f"{path}/{DONE}", b"")


def manifest_folders(manifest_root: str) -> tuple[list[str], list[str]]:
    """What a reader visits: folders of parts, and of runs."""
    parts, runs = [], []
    for stream_id in streams_of(manifest_root):
        # Parts first: one that goes into a run meanwhile is then seen in its folder, which stays until the next compaction.
        numbers = _parts(manifest_root, stream_id)
        outer = runs_of(manifest_root, stream_id)
        runs += [run.path for run in outer]
        parts += [f"{manifest_root}/stream_id={stream_id}/batch_id={n}" for n in numbers if not any(run.covers(n) for run in outer)]
    return parts, runs


def streams_of(manifest_root: str) -> list[str]:
    """Ids of the ingests that have published something."""
    names = {*paths.subdirectories(manifest_root), *paths.subdirectories(f"{manifest_root}/{RUNS}")}
    return sorted(name.removeprefix("stream_id=") for name in names if name.startswith("stream_id="))


def last_batch(manifest_root: str, stream_id: str) -> int | None:
    """The newest committed batch of a stream."""
    for number in reversed(_parts(manifest_root, stream_id)):
        if any(name.startswith("part-") for name in paths.file_names(f"{manifest_root}/stream_id={stream_id}/batch_id={number}")):
            return number
    return max((run.last for run in runs_of(manifest_root, stream_id)), default=None)


def folders_between(manifest_root: str, stream_id: str, first: int, last: int) -> list[str]:
    """Parts of batches ``first`` to ``last``, and runs that hold some of them beside others."""
    # Parts first, as above.
    numbers = _parts(manifest_root, stream_id)
    runs = [run for run in runs_of(manifest_root, stream_id) if run.first <= last and first <= run.last]
    parts = [n for n in numbers if first <= n <= last and not any(run.covers(n) for run in runs)]
    return [run.path for run in runs] + [f"{manifest_root}/stream_id={stream_id}/batch_id={n}" for n in parts]
