"""The commit log: which renames a topic-partition promised, and which of them are due on recovery.

A log row is ``topic, kafka_partition, seq, key, value``. ``key`` is BEGIN, END, or the path of a temporary file whose
published path is ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlog.plans import SLICE_WIDTH, running_total, stored
from harborlog.sources.envelope import TOPIC_PARTITION

# The markers around a group of pairs.
BEGIN = "BEGIN"
END = "END"


def commit_log(plan: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """Write the log of a file plan as a table: per chunk BEGIN, one pair per file, END.

    Takes ``topic, kafka_partition, chunk, temp_file, committed_file, ended``; ``ended`` false leaves END out.
    """
    pairs = plan.select(
        *TOPIC_PARTITION, "chunk", F.lit(1).alias("step"),
        F.col("temp_file").alias("key"), F.col("committed_file").alias("value"),
    )
    chunks = plan.groupBy(*TOPIC_PARTITION, "chunk").agg(
        F.bool_and("ended").alias("ended"), F.count(F.lit(1)).alias("n")
    )
    markers = chunks.select(
        *TOPIC_PARTITION, "chunk", F.inline(
            F.filter(
                F.array(
                    F.struct(F.lit(0).alias("step"), F.lit(BEGIN).alias("key"), F.lit("").alias("value")),
                    F.struct(
                        F.when(F.col("ended"), 2).alias("step"), F.lit(END).alias("key"), F.lit("").alias("value")
                    ),
                ),
                lambda entry: entry["step"].isNotNull(),
            )
        ),
    )
    # A chunk is a bounded group, so order its entries there; earlier chunks shift them by their entry counts.
    in_chunk = Window.partitionBy(*TOPIC_PARTITION, "chunk").orderBy("step", "value", "key")
    entries = chunks.select(
        *TOPIC_PARTITION, "chunk", (F.col("n") + 1 + F.col("ended").cast("int")).alias("entries")
    )
    shifts = running_total(entries, TOPIC_PARTITION, "chunk", F.col("entries"), "upto", width)
    numbered = pairs.unionByName(markers).withColumn("_place", F.row_number().over(in_chunk))
    return numbered.join(shifts, [*TOPIC_PARTITION, "chunk"]).select(
        *TOPIC_PARTITION,
        (F.col("upto") - F.col("entries") + F.col("_place") - 1).cast("bigint").alias("seq"),
        "key",
        "value",
    )


def publish_pending(plan: DataFrame, existing: DataFrame, on: str = "committed_file") -> DataFrame:
    """Planned files whose target is not there yet."""
    return plan.join(existing.select(on), on, "left_anti").select(*plan.columns)


def replay(
    log: DataFrame,
    existing: DataFrame | None = None,
    sources: DataFrame | None = None,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Renames to carry out: ``topic, kafka_partition, seq, temp_file, committed_file``.

    Pairs count from one BEGIN to the next and are due if an END follows them there. A pair is left out if its
    target is among ``existing.committed_file`` or its source is not among ``sources.temp_file``. A target is written
    by the earliest pair that can, and a source that has been renamed is gone for later pairs.
    """
    begins = F.when(F.col("key") == BEGIN, 1).otherwise(0)
    grouped = running_total(log, TOPIC_PARTITION, "seq", begins, "group", width)
    last_end = (
        grouped.where(F.col("key") == END)
        .groupBy(*TOPIC_PARTITION, "group")
        .agg(F.max("seq").alias("last_end"))
    )
    due = (
        grouped.where(~F.col("key").isin(BEGIN, END))
        .join(last_end, [*TOPIC_PARTITION, "group"])
        .where(F.col("seq") < F.col("last_end"))
        .select(
            *TOPIC_PARTITION, "seq", F.col("key").alias("temp_file"), F.col("value").alias("committed_file")
        )
    )
    if sources is not None:
        due = due.join(sources.select("temp_file").distinct(), "temp_file", "left_semi")
    if existing is not None:
        due = publish_pending(due, existing)
    return _in_order(due.select(*TOPIC_PARTITION, "seq", "temp_file", "committed_file"))


def _in_order(due: DataFrame) -> DataFrame:
    """The pairs that get both their source and their target when pairs are carried out in order of ``seq``.

    A pair whose source and target no other pair names is carried out as it is. Of the others, one that comes first for its
    source and for its target is carried out, and then all others of that source or target fall away; what is left goes
    through the same again. Logs name a source or target twice only after failures, so as a rule there are no others.
    """
    due = stored(due)
    several = [
        due.groupBy(*TOPIC_PARTITION, name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*TOPIC_PARTITION, name)
        for name in ("temp_file", "committed_file")
    ]
    shared = due.join(several[0], [*TOPIC_PARTITION, "temp_file"], "left_semi").unionByName(
        due.join(several[1], [*TOPIC_PARTITION, "committed_file"], "left_semi")
    )
    left = stored(shared.select(due.columns).distinct())
    if left.isEmpty():
        return due
    done = due.join(left.select(*TOPIC_PARTITION, "seq"), [*TOPIC_PARTITION, "seq"], "left_anti").select(due.columns)
    while True:
        firsts = left
        for name in ("temp_file", "committed_file"):
            first = left.groupBy(*TOPIC_PARTITION, name).agg(F.min("seq").alias("seq"))
            firsts = firsts.join(first, [*TOPIC_PARTITION, name, "seq"], "left_semi")
        firsts = stored(firsts.select(due.columns))
        done = done.unionByName(firsts)
        for name in ("temp_file", "committed_file"):
            left = left.join(firsts.select(*TOPIC_PARTITION, name), [*TOPIC_PARTITION, name], "left_anti")
        left = stored(left.select(due.columns))
        if left.isEmpty():
            return done
