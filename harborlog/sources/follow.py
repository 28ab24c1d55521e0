"""Follow what is published: a streaming source over the manifest.

The position of a stream is the last batch read of each ingest. A micro-batch lists no data files: the manifest's parts and runs
of the batches in between tell what to read, and a task reads files one after another, however small they are.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from harborlog.sinks import paths
from harborlog.sources.manifest import folders_between, last_batch, streams_of

FORMAT = "published_files"
PROVENANCE = "topic string, kafka_partition int, start_offset bigint, end_offset bigint, committed_file string"
#: Rows that a task hands over at a time.
ROWS = 1 << 14
#: Rows of the files that a task reads; opening a file counts as some rows more.
TASK_ROWS = 1 << 17
OPENING = 1 << 10


def follow_committed(
    spark: SparkSession, manifest_root: str, schema: str, topic: str | None = None, batches_per_trigger: int | None = None, progress: str | None = None
) -> DataFrame:
    """Stream the rows of published Parquet files plus ``topic, kafka_partition, start_offset, end_offset, committed_file``.

    Each published file is read once, however often the stream is restarted or the manifest compacted meanwhile. Columns of
    ``schema`` that a file lacks are null. ``batches_per_trigger`` bounds a micro-batch to so many batches of each ingest. Spark
    doesn't tell a source where a restarted query stands, so the bound holds over restarts only with ``progress``, a folder of
    this stream's own beside its checkpoint. ``availableNow`` reads up to the bound and ends.
    """
    # Spark runs the source in processes that don't see added Python files.
    for name in ("harborlog.sources.follow", "harborlog.sources.manifest", "harborlog.sinks.paths"):
        cloudpickle.register_pickle_by_value(sys.modules[name])
    spark.dataSource.register(PublishedFiles)
    options = {"manifest_root": manifest_root, "topic": topic, "batches_per_trigger": batches_per_trigger, "progress": progress}
    given = {name: str(value) for name, value in options.items() if value is not None}
    provenance = StructType.fromDDL(PROVENANCE)
    return spark.readStream.format(FORMAT).schema(StructType([*StructType.fromDDL(schema).fields, *provenance.fields])).options(**given).load()


class PublishedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> _Reader:
        return _Reader({name.lower(): value for name, value in self.options.items()}, schema)


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.root, self.topic, self.progress = options["manifest_root"], options.get("topic"), options.get("progress")
        self.most = int(options["batches_per_trigger"]) if "batches_per_trigger" in options else None
        self.schema = to_arrow_schema(schema)
        self.reached: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        latest = {stream: last for stream in streams_of(self.root) if (last := last_batch(self.root, stream)) is not None}
        before = self._reached()
        if self.most is None or before is None:
            return latest
        # An ingest whose manifest is gone for now doesn't go back.
        return before | {s: max(before.get(s, -1), min(last, before.get(s, -1) + self.most)) for s, last in latest.items()}

    def _reached(self) -> dict[str, int] | None:
        """Where the newest micro-batch ends."""
        if self.reached is None and self.progress is not None:
            known = sorted(paths.file_names(self.progress))
            self.reached = json.loads(paths.read(f"{self.progress}/{known[-1]}")) if known else {}
        return self.reached

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._remember(end)
        files = []
        for stream, last in end.items():
            first = start.get(stream, -1) + 1
            for folder in folders_between(self.root, stream, first, last) if first <= last else []:
                for name in paths.file_names(folder):
                    if name.startswith("part-"):
                        files += _listed(f"{folder}/{name}", first, last, self.topic)
        # Spark wants one partition at least.
        return [InputPartition(task) for task in _tasks(files)] or [InputPartition([])]

    def _remember(self, end: dict) -> None:
        # Spark has logged this end before it asks, so the next micro-batch starts here, after a restart as well.
        self.reached = end
        if self.progress is not None:
            known = sorted(paths.file_names(self.progress))
            if not known or json.loads(paths.read(f"{self.progress}/{known[-1]}")) != end:
                paths.put_if_absent(f"{self.progress}/{len(known):010d}.json", json.dumps(end).encode())

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for file in partition.value:
            yield from self._rows(*file)

    def _rows(self, path: str, *known) -> Iterator[pa.RecordBatch]:
        filesystem, name = paths.resolve(path)
        provenance = dict(zip(("topic", "kafka_partition", "start_offset", "end_offset", "committed_file"), known))
        with filesystem.open_input_file(name) as source:
            file = pq.ParquetFile(source)
            have = set(file.schema_arrow.names)
            wanted = [field.name for field in self.schema if field.name in have and field.name not in provenance]
            for batch in file.iter_batches(ROWS, columns=wanted):
                columns = []
                for field in self.schema:
                    if field.name in provenance:
                        columns.append(pa.repeat(pa.scalar(provenance[field.name], field.type), batch.num_rows))
                    elif field.name in have:
                        columns.append(batch.column(field.name).cast(field.type))
                    else:
                        columns.append(pa.nulls(batch.num_rows, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _tasks(files: list[tuple[int, tuple]]) -> Iterator[list[tuple]]:
    """Files, given with their numbers of rows, by the task that reads them."""
    task, held = [], 0
    for n, file in files:
        if task and held + n + OPENING > TASK_ROWS:
            yield task
            task, held = [], 0
        task.append(file)
        held += n + OPENING
    if task:
        yield task


def _listed(path: str, first: int, last: int, topic: str | None) -> list[tuple[int, tuple]]:
    """Files that a manifest file lists for some batches; a part has no column for its batch, a run has."""
    filesystem, name = paths.resolve(path)
    with filesystem.open_input_file(name) as source:
        file = pq.ParquetFile(source)
        columns = ["path", "topic", "kafka_partition", "start_offset", "end_offset", "committed_file"]
        in_run = "batch_id" in file.schema_arrow.names
        rows = file.read([*columns, "n_records"] + ["batch_id"] * in_run).to_pylist()
    return [
        (row["n_records"] or 0, tuple(row[column] for column in columns))
        for row in rows
        if (topic is None or row["topic"] == topic) and (not in_run or first <= row["batch_id"] <= last)
    ]
