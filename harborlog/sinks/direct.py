"""Publishing without renames, as a Python data source: ``df.write.format("committed_files")``.

Tasks write each planned file once, where it stays, in a folder of its own attempt. What a task has written is its commit message;
the driver turns the messages into one manifest file and puts it if there is none yet. That put commits the batch: readers
trust the manifest, so objects of attempts that failed, and of a batch that was committed before, are never seen. A job that is
aborted deletes what its tasks wrote; what a lost executor leaves is found by ``stray_files``.
"""

from __future__ import annotations

import io
import json
import sys
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from harborlog.functions.naming import committed_name, relative_directory
from harborlog.operators.files import FILE_KEY
from harborlog.sinks import paths
from harborlog.sinks.claims import Claims
from harborlog.sinks.publish import Part
from harborlog.sources.envelope import TOPIC_PARTITION
from harborlog.sources.listing import list_files

FORMAT = "committed_files"
#: The folder of an attempt; its parent is the directory of the file.
ATTEMPT = "o-"
#: Bytes of a row group and of a page of published files.
ROW_GROUP = 256 << 20
PAGE = 64 << 10
#: What tells files apart and how they are called; not written to them.
ROUTING = [f"__{name}" for name in (*TOPIC_PARTITION, "encoded_partition", "start_offset", "end_offset", "committed_file", "directory")]


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: topic, partition, encoded partition, first and last offset, count, name, path."""

    files: list[tuple]


class CommittedFiles(DataSource):
    """Writes rows that come file by file, in order, with the columns of ``ROUTING``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options))


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        lowered = {name.lower(): value for name, value in options.items()}
        self.root, self.part = lowered["topics_root"], lowered["part"]
        self.claims = json.loads(lowered["claims"]) if "claims" in lowered else None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        token, files, writer = uuid.uuid4().hex, [], _File(self.root)
        try:
            for batch in iterator:
                names = batch.column("__committed_file").to_pylist()
                folders = batch.column("__directory").to_pylist()
                low = 0
                for i in range(1, len(names) + 1):
                    if i == len(names) or (names[i], folders[i]) != (names[low], folders[low]):
                        rows = batch.slice(low, i - low)
                        if writer.key != (names[low], folders[low]):
                            files += writer.close()
                            writer = _File(self.root, token, rows)
                        writer.add(rows)
                        low = i
            files += writer.close()
        except BaseException:
            writer.discard()
            _delete(files)
            raise
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        files = sorted(row for message in messages if message is not None for row in message.files)
        names = ["topic", "kafka_partition", "encoded_partition", "start_offset", "end_offset", "n_records", "committed_file", "path"]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = [pa.array([row[i] for row in files], kind) for i, kind in enumerate(kinds)]
        out = io.BytesIO()
        pq.write_table(pa.table(columns, names), out)
        if self.claims is not None:
            Claims(self.claims["root"], self.claims["owner"]).check(map(tuple, self.claims["claimed"]))
        if not paths.put_if_absent(f"{self.part}/part-0.parquet", out.getvalue()):
            # The batch was committed by another attempt; these files are nobody's.
            _delete(files)

    def abort(self, messages: list[Written | None]) -> None:
        for message in messages:
            if message is not None:
                _delete(message.files)


class _File:
    """One planned file while it is written."""

    def __init__(self, root: str, token: str = "", rows: pa.RecordBatch | None = None) -> None:
        self.key, self.n, self.out = None, 0, None
        if rows is None:
            return
        self.known = {name.removeprefix("__"): rows.column(name)[0].as_py() for name in ROUTING}
        self.key = (self.known["committed_file"], self.known["directory"])
        self.path = f"{root}/{self.known['directory']}/{ATTEMPT}{token}/{self.known['committed_file']}"
        self.held: list[pa.RecordBatch] = []
        self.bytes = 0

    def row(self) -> tuple:
        known = self.known
        return (*(known[name] for name in ["topic", "kafka_partition", "encoded_partition", "start_offset", "end_offset"]), self.n, known["committed_file"], self.path)

    def add(self, rows: pa.RecordBatch) -> None:
        content = rows.select([name for name in rows.schema.names if name not in ROUTING])
        self.n += rows.num_rows
        self.held.append(content)
        self.bytes += content.nbytes
        if self.bytes >= ROW_GROUP:
            self._flush()

    def _flush(self) -> None:
        if self.out is None:
            filesystem, name = paths.resolve(self.path)
            filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
            self.out = pq.ParquetWriter(name, self.held[0].schema, filesystem=filesystem, compression="snappy", data_page_size=PAGE)
        self.out.write_table(pa.Table.from_batches(self.held), row_group_size=1 << 30)
        self.held, self.bytes = [], 0

    def close(self) -> list[tuple]:
        if self.key is None:
            return []
        if self.held:
            self._flush()
        self.out.close()
        return [self.row()]

    def discard(self) -> None:
        if self.key is not None and self.out is not None:
            self.out.close()
            _delete([self.row()])


def _delete(files: list[tuple]) -> None:
    for row in files:
        paths.delete_file(row[-1])
        paths.delete_if_empty(row[-1].rsplit("/", 1)[0])


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    # Spark pickles the source by name in processes that don't see added Python files.
    for name in ("harborlog.sinks.direct", "harborlog.sinks.claims", "harborlog.sinks.paths"):
        cloudpickle.register_pickle_by_value(sys.modules[name])
    spark.dataSource.register(CommittedFiles)


def write_committed(
    rows: DataFrame, topics_root: str, part: Part, extension: str = ".parquet", pad_width: int = 10, claims: Claims | None = None, claimed: Iterable[tuple[str, int]] = ()
) -> None:
    """Write routed and chunked records as committed files of ``part``, and commit it, in one job.

    ``rows`` carry ``topic, kafka_partition, kafka_offset, encoded_partition, chunk``; a ``payload`` becomes the columns of the files,
    else key and value do. One shuffle by file brings a file's rows together; what the file is called is known from the same
    partitioning, so there is no pass to plan files. With ``claims`` the job fails, and leaves nothing, if any of those on
    ``claimed`` topic-partitions are lost when it commits.
    """
    spark = rows.sparkSession
    register(spark)
    content = ["payload.*"] if "payload" in rows.columns else ["key", "value"]
    file = Window.partitionBy(*FILE_KEY)
    ends = rows.withColumns({"start_offset": F.min("kafka_offset").over(file), "end_offset": F.max("kafka_offset").over(file)})
    name = committed_name(F.col("topic"), F.col("kafka_partition"), F.col("start_offset"), F.col("end_offset"), extension, pad_width)
    named = ends.withColumn("committed_file", name).withColumn("directory", relative_directory(F.col("topic"), F.col("encoded_partition")))
    ordered = named.sortWithinPartitions(*FILE_KEY, "kafka_offset")
    routing = (F.col(name.removeprefix("__")).alias(name) for name in ROUTING)
    written = ordered.select(*routing, *content).write.format(FORMAT).mode("append")
    if claims is not None:
        written = written.option("claims", json.dumps({"root": claims.root, "owner": claims.owner, "claimed": list(claimed)}))
    written.options(topics_root=topics_root, part=part.path).save()


def stray_files(spark: SparkSession, topics_root: str, manifest: DataFrame, older_than: str = "1 day") -> DataFrame:
    """Files of direct attempts that no manifest lists, such as those of lost executors; old enough to be nobody's work."""
    listed = list_files(spark, topics_root, "*+*+*+*").where(F.col("path").contains(f"/{ATTEMPT}"))
    old = listed.where(F.col("modification_time") < F.current_timestamp() - F.expr(f"interval {older_than}"))

    def below(path):
        return F.substring_index(path, f"/{topics_root.rstrip('/').rsplit('/', 1)[-1]}/", -1)

    return old.join(manifest.select(below(F.col("path")).alias("_below")), below(F.col("path")) == F.col("_below"), "left_anti")
