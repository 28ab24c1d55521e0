"""Running values over a long ordered log without one task per log.

``sum() over (partition by key order by position)`` sends a whole key to one task. Here a key is cut into slices
of at most ``width`` positions. Every slice is summarised on its own (with map-side partial aggregation), a window
over the small summary table gives the value carried into each slice, and the window over rows is then confined to
one slice. The position must be unique within a key, which bounds a slice by ``width`` rows however hot the key is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_WIDTH = 1 << 16
SLICE = "_slice"
CARRY = "_carry"


def with_slice(df: DataFrame, position: str, width: int = SLICE_WIDTH) -> DataFrame:
    """Number the slice of each row. Slices ascend with ``position``."""
    return df.withColumn(SLICE, F.expr(f"`{position}` div {int(width)}"))


def with_carry(
    sliced: DataFrame,
    keys: Sequence[str],
    summary: Column,
    combine: Callable[[str], Column],
) -> DataFrame:
    """Add what all earlier slices of the key amount to; null in the first slice."""
    earlier = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        sliced.groupBy(*keys, SLICE)
        .agg(summary.alias("_summary"))
        .select(*keys, SLICE, combine("_summary").over(earlier).alias(CARRY))
    )
    return sliced.join(carried, [*keys, SLICE])


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    name: str = "rank",
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """``row_number() over (partition by keys order by position)`` as a BIGINT."""
    within = Window.partitionBy(*keys, SLICE).orderBy(position)
    carried = with_carry(with_slice(df, position, width), keys, F.count(F.lit(1)), F.sum)
    rank = F.coalesce(CARRY, F.lit(0)) + F.row_number().over(within)
    return carried.withColumn(name, rank.cast("bigint")).drop(SLICE, CARRY)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    name: str,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Sum of ``value`` from the start of the key up to and including each row."""
    within = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sliced = with_slice(df, position, width).withColumn("_value", value)
    carried = with_carry(sliced, keys, F.sum("_value"), F.sum)
    total = F.coalesce(CARRY, F.lit(0)) + F.coalesce(F.sum("_value").over(within), F.lit(0))
    return carried.withColumn(name, total.cast("bigint")).drop(SLICE, CARRY, "_value")


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    name: str,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Greatest ``value`` of the key strictly before each row; null at the start."""
    within = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = with_carry(with_slice(df, position, width), keys, F.max(value), F.max)
    # greatest() skips nulls, so a first slice and a first row need no special case.
    return carried.withColumn(name, F.greatest(CARRY, F.max(value).over(within))).drop(SLICE, CARRY)
