"""Give staged files their published names.

Readers trust the manifest, not the listing. A batch is staged, renamed file by file, and then recorded by one rename
of a directory. All renames run in tasks, and every step may be repeated: a target that exists is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from harborlog.sinks import paths


def publish(files: DataFrame, staged: DataFrame) -> DataFrame:
    """Rename the staged file of each row to ``path``, in tasks, when the result is written.

    ``files`` has ``file_id`` and ``path``; its columns come back, except ``file_id``. Fails if a file was not staged,
    was staged in several pieces, or cannot be renamed. Nothing is listed on the driver.
    """
    width = files.sparkSession.sparkContext.defaultParallelism
    columns = [column for column in files.columns if column != "file_id"]
    pairs = files.join(staged, "file_id", "left").repartition(width, "file_id")

    def rename(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[str] = set()
        for frame in frames:
            for source, target in zip(frame["staged_path"].tolist(), frame["path"].tolist()):
                if target in done:
                    raise RuntimeError(f"several staged files for {target}")
                done.add(target)
                _rename(source, target)
            yield frame[columns]

    return pairs.mapInPandas(rename, files.select(*columns).schema)


def _rename(source: str | None, target: str) -> None:
    if paths.exists(target):
        return
    pieces = paths.files_at(source) if source is not None else []
    if len(pieces) > 1:
        raise RuntimeError(f"several staged files for {target}")
    if not pieces:
        # Another attempt of this task may have been faster.
        if paths.exists(target):
            return
        raise RuntimeError(f"nothing staged for {target}")
    try:
        paths.move(pieces[0], target)
    except FileNotFoundError:
        if not paths.exists(target):
            raise


@dataclass(frozen=True)
class Part:
    """What one batch adds to a table of batches, and what else it commits with it. All of it shows up by one rename, or nothing.

    Tables of their own that go with the part lie in folders starting with an underscore, which readers of the table skip.
    """

    root: str
    stream_id: str
    batch_id: int
    #: Written where it stays; the file that makes it a part comes last and commits it.
    in_place: bool = False

    @property
    def written(self) -> str:
        return self.path if self.in_place else f"{self.root}/_writing/{self.stream_id}-{self.batch_id}"

    @property
    def path(self) -> str:
        return f"{self.root}/stream_id={self.stream_id}/batch_id={self.batch_id}"

    def write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.written)

    def attach(self, name: str, rows: DataFrame) -> None:
        """Commit another table with the part. Call it after ``write``, or before what commits a part that is written in place."""
        rows.write.mode("overwrite").parquet(f"{self.written}/_{name}")

    def attached(self, name: str) -> str | None:
        """Where a committed part has such a table, if it has one."""
        return f"{self.path}/_{name}" if paths.exists(f"{self.path}/_{name}") and self.committed() else None

    def committed(self) -> bool:
        return any(name.startswith("part-") for name in paths.file_names(self.path))

    def commit(self) -> None:
        """Replace what an earlier attempt of the same batch committed."""
        paths.delete_directory(self.path)
        paths.move(self.written, self.path)
