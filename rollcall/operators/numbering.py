"""Dense global numbers, ordered look-back and places among bounds, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import cut

# monotonically_increasing_id keeps the row number of a partition in its low 33 bits.
_ROW_BITS = 33


def _ranged(df: DataFrame, order_by: list[str], parts: int | None) -> DataFrame:
    """Range-partitioned, sorted and stored, with ``_part`` and ``_row`` (from 0) per row.

    The result is checkpointed: counts and numbers are then read from the same rows, so
    resampled range bounds or a lost executor cannot shift them against each other. Without ``parts``
    adaptive execution joins small ranges: few rows in many stored parts would be as many tasks
    in every later shuffle, each with a block for every partition.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(parts, *order_by) if parts else df.repartitionByRange(*order_by)
    sorted_parts = ranged.sortWithinPartitions(*order_by)
    stored = cut(sorted_parts.withColumn("_place", place))
    return stored.withColumns(
        {
            "_part": F.shiftright("_place", _ROW_BITS),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_place")


def number_rows(
    df: DataFrame, order_by: list[str], name: str = "seq", start: int = 1, parts: int | None = None
) -> DataFrame:
    """Add ``name``: start, start+1, ... in the order of ``order_by``.

    Equal to ``row_number()`` over one global window when ``order_by`` is unique, but each
    task sorts one range only. The offsets hold one row per range, so the window over them
    and their broadcast are bounded by the number of partitions.
    """
    ranged = _ranged(df, order_by, parts)
    sizes = ranged.groupBy("_part").agg((F.max("_row") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_row") + F.lit(start)).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )


def last_at_or_before(
    probes: DataFrame, marks: DataFrame, on: str, value: str, parts: int | None = None
) -> DataFrame:
    """For each distinct probe the ``value`` of the greatest mark not above it, or null.

    Both sides are laid out in one range-partitioned order; each task looks back inside its
    range and takes what earlier ranges ended with from a table of one row per range.
    ``value`` has to grow with ``on``.
    """
    kind = marks.schema[value].dataType
    rows = marks.select(on, value).unionByName(
        probes.select(on).distinct().withColumn(value, F.lit(None).cast(kind))
    )
    # a mark sorts before the probe that equals it
    ranged = _ranged(rows.withColumn("_probe", F.col(value).isNull()), [on, "_probe"], parts)
    ends = ranged.groupBy("_part").agg(F.max(value).alias("_end"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_part", F.max("_end").over(before).alias("_carry"))
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_seen", F.last(value, ignorenulls=True).over(inside))
        .join(F.broadcast(carried), "_part")
        .filter("_probe")
        .select(on, F.coalesce("_seen", "_carry").alias(value))
    )


#: Bounds that a plan may carry as one array of longs.
MOST_BOUNDS = 1 << 17


def place_in(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are not above ``value``; null for null.

    A binary search over one constant array, in the stage that reads the rows: no join and no shuffle.
    """
    if len(bounds) > MOST_BOUNDS:
        raise ValueError(f"{len(bounds)} bounds are more than {MOST_BOUNDS}")
    if not bounds:
        return F.when(value.isNotNull(), 0).cast("bigint")
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")  # folded into a constant
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        ahead = at + step
        return F.when((ahead <= len(bounds)) & (F.get(array, ahead - 1) <= value), ahead).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), further)
    return F.when(value.isNotNull(), found).cast("bigint")
