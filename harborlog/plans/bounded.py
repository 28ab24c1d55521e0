"""Small join sides whose size is known before the join is planned, and folders of tables that have an owner."""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from harborlog.plans.workspace import delete_folder, new_folder


class Scratch:
    """A folder of intermediate tables below the shared folder, deleted when its owner is done with it.

    Within ``with``, tables that are stored without a path of their own go there. Whatever is read from the tables must have
    been written elsewhere by the end.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.folder, self._n = spark, new_folder(spark, label), 0

    def path(self, label: str) -> str:
        self._n += 1
        return f"{self.folder}/{label}-{self._n}"

    def delete(self) -> None:
        delete_folder(self.spark, self.folder)

    def __enter__(self) -> Scratch:
        self._outer = _current.set(self)
        return self

    def __exit__(self, *failure) -> None:
        _current.reset(self._outer)
        self.delete()


_current: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def intermediate(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table: in the scratch folder at hand, else in the shared folder."""
    scratch = _current.get()
    return new_folder(spark, label) if scratch is None else scratch.path(label)


def stored(side: DataFrame, path: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Write ``side`` to the shared folder and read it back.

    It is computed once, it survives lost executors, and Spark sees how large it is: up to
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and the large side stays where it is; beyond, the join is a
    shuffle join whose hot keys adaptive execution splits. No broadcast is forced. With a ``scratch`` the table goes when its
    owner is done; without, the caller's ``path`` or the shared folder keeps it.
    """
    spark = side.sparkSession
    path = path or (scratch.path("side") if scratch is not None else intermediate(spark, "side"))
    side.write.parquet(path)
    return spark.read.schema(side.schema).parquet(path)


def bounded(side: DataFrame) -> DataFrame:
    """The rows of ``side`` as a local relation: for tables with a row per topic-partition, which nothing makes grow.

    They are computed once, and plans that only project or filter them start no job.
    """
    return side.sparkSession.createDataFrame(side.toArrow(), side.schema)
