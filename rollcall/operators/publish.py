"""Wide publishing: registry id on every source row, batches that never split an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.casts import to_number_or_zero
from rollcall.functions.text import key_text
from rollcall.operators.lookup import attach
from rollcall.operators.normalize import blank_nulls, drop_columns, is_base, keep_columns
from rollcall.operators.numbering import number_rows
from rollcall.schema import (
    INSTANCE,
    INSTRUMENT,
    KEY,
    KEYS_PER_BATCH,
    PULL_STAMP,
    RECORD,
    REGISTRY_LINK,
    ROW,
    SOURCE_LINK,
)
from rollcall.session import cut

BATCH = "batch_id"
PLACE = "place"
#: Place of a row in its batch, whether it is the first or the last one, and whether the batch is a large one.
FRAME = [PLACE, "opens", "closes", "large"]
#: Rows of a file of the payload; a batch of more of them is laid out in several.
ROWS_PER_FILE = 250_000


def add_links(mapping: DataFrame, source: DataFrame) -> DataFrame:
    """Survey link of each mapped record, taken from base rows; none gives null.

    Of several base rows the one of the lowest instance counts, as in ``collapse``; then the first link in text order.
    Rows of records that are not mapped are left out before links are aggregated, which takes a sort of its rows.
    """
    number = to_number_or_zero(F.col(INSTANCE).cast("string"))
    base = source.filter(is_base()).select(key_text(F.col(RECORD)).alias(RECORD), number.alias("_number"), SOURCE_LINK)
    links = (
        attach(base, mapping.select(RECORD).distinct(), [RECORD], "inner")
        .groupBy(RECORD)
        .agg(F.min_by(SOURCE_LINK, F.struct("_number", SOURCE_LINK)).alias(REGISTRY_LINK))
    )
    return attach(mapping, links, [RECORD])


def plan_batches(mapping: DataFrame, keys_per_batch: int = KEYS_PER_BATCH) -> DataFrame:
    """Batch number of every registry id: ids in order, so many ids per batch.

    Runs on the narrow mapping, before the wide rows are touched. An id has one number,
    so all its rows share a batch.
    """
    numbered = number_rows(mapping.select(KEY).distinct(), [KEY], "_seq")
    batch = F.ceil(F.col("_seq") / F.lit(keys_per_batch)).cast("bigint")
    return mapping.join(numbered.select(KEY, batch.alias(BATCH)), KEY)


def _number() -> Column:
    return to_number_or_zero(F.col(INSTANCE).cast("string"))


def plan_frames(source: DataFrame, planned: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """A planned mapping with first and last place of each batch and its number of rows; ``source`` is landed (``ROW``).

    Only the four fields that make up a place are read and joined, so the framing of a batch is known before its wide rows
    move. Of a batch nothing but one aggregate row is kept.
    """
    rows = source.select(key_text(F.col(RECORD)).alias(RECORD), F.col(INSTRUMENT).alias("_kind"), _number().alias("_number"), ROW)
    place = F.struct(F.col(KEY).alias("key"), F.col("_kind").alias("instrument"), F.col("_number").alias("instance"), F.col(ROW).alias("row"))
    placed = attach(rows, planned.select(RECORD, KEY, BATCH), [RECORD], "inner").select(BATCH, place.alias("_place"))
    ends = placed.groupBy(BATCH).agg(
        F.min("_place").alias("_first"), F.max("_place").alias("_last"), (F.count("*") > rows_per_file).alias("large")
    )
    return planned.join(ends, BATCH)


def publish_rows(
    source: DataFrame, mapping: DataFrame, ignored: list[str], allowed: list[str], stamp: str
) -> DataFrame:
    """Source rows with registry id, link and run stamp, reduced to the registry's fields.

    ``mapping`` carries record id, registry id and link, the batch number if planned, and the framing if that is planned
    too; then the rows carry ``FRAME``. A record on several ids is published once per id. Repeat rows keep neither record id,
    link nor stamp. One pass over the wide rows: the only shuffle is the join to the mapping.
    """
    framed = "_first" in mapping.columns
    sent = {RECORD, KEY, REGISTRY_LINK, PULL_STAMP, BATCH, *FRAME, "_first", "_last"}
    wide = drop_columns(source, ignored)
    wide = drop_columns(wide, [c for c in wide.columns if c in sent - {RECORD}])
    rows = wide.withColumn("_record", key_text(F.col(RECORD))).join(
        mapping.withColumnRenamed(RECORD, "_record"), "_record"
    )
    on_base = lambda c: F.when(is_base(), c).otherwise("")
    own = {
        RECORD: on_base(F.col(RECORD)),
        REGISTRY_LINK: on_base(F.col(REGISTRY_LINK)),
        PULL_STAMP: on_base(F.lit(stamp)),
    }
    if framed:
        place = F.struct(F.col(KEY).alias("key"), F.col(INSTRUMENT).alias("instrument"), _number().alias("instance"), F.col(ROW).alias("row"))
        own |= {PLACE: place, "opens": place == F.col("_first"), "closes": place == F.col("_last")}
    return keep_columns(blank_nulls(rows.withColumns(own).drop("_record")), [*allowed, BATCH, *FRAME])


def superseded(source: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of source records that are nobody's current record; they are not published."""
    return (
        source.withColumn("_record", key_text(F.col(RECORD)))
        .join(mapping.select(F.col(RECORD).alias("_record")), "_record", "left_anti")
        .drop("_record")
        .withColumn("reason", F.lit("superseded"))
    )


def held_rows(source: DataFrame, mapping: DataFrame, unread: DataFrame) -> DataFrame:
    """Every source row that is not published, once, with the reason: ``blank_id``, ``bad_age`` or ``superseded``.

    ``unread`` is ``source_quarantine`` of the source; a record of unreadable age is held with all its rows, repeats included.
    """
    bad = unread.filter("reason = 'bad_age'").select(F.col(RECORD).alias("_record"), F.lit(True).alias("_bad"))
    left = source.withColumn("_record", key_text(F.col(RECORD))).join(
        mapping.select(F.col(RECORD).alias("_record")), "_record", "left_anti"
    )
    reason = F.when(F.col("_record") == "", "blank_id").when(F.col("_bad"), "bad_age").otherwise("superseded")
    return attach(left, bad, ["_record"]).withColumn("reason", reason).drop("_record", "_bad")


def _row_order() -> list[Column]:
    """Base row of an id first, then its repeats by instrument and instance."""
    return [
        F.col(KEY),
        F.col(INSTRUMENT),
        to_number_or_zero(F.col(INSTANCE).cast("string")),
    ]


def payload_lines(rows: DataFrame) -> DataFrame:
    """One JSON object per row with its batch and place; a batch of any size stays distributed."""
    fields = [c for c in rows.columns if c not in {BATCH, *FRAME}]
    key, instrument, instance = _row_order()
    return rows.select(
        BATCH,
        key.alias(KEY),
        instrument.alias("instrument"),
        instance.alias("instance"),
        F.to_json(F.struct(*fields)).alias("line"),
        *[c for c in FRAME if c in rows.columns],
    )


def receipts(lines: DataFrame) -> DataFrame:
    """Per batch: rows, ids, bytes, first and last id."""
    return lines.groupBy(BATCH).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(KEY).alias("n_keys"),
        F.sum(F.octet_length("line").cast("bigint")).alias("n_bytes"),
        F.min(KEY).alias("first_key"),
        F.max(KEY).alias("last_key"),
    )


def framed_lines(lines: DataFrame) -> DataFrame:
    """Lines of framed rows with their framing: those of a batch, in the order of ``place``, are one JSON array of any size.

    ``[`` stands before the first line, ``,`` before the others, ``]`` after the last. Which ones these are was planned on the
    narrow rows (``plan_frames``), so this is a projection.
    """
    framed = F.concat(F.when(F.col("opens"), "[").otherwise(","), F.col("line"), F.when(F.col("closes"), "]").otherwise(""))
    return lines.select(BATCH, KEY, "instrument", "instance", PLACE, framed.alias("framed"))


def in_files(rows: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Framed rows laid out for writing: batches in order, some to a file, and a large batch over several.

    The partition of a row is computed from its dense batch number, so nothing is sampled. The rows of a large batch are spread
    over files of their own kind by place; ``place`` gives their order.
    """
    n_rows, n_large, n_batches = rows.agg(F.count("*"), F.count_if("large"), F.coalesce(F.max(BATCH), F.lit(1))).first()
    parts = max(1, min(n_batches, -(-(n_rows - n_large) // rows_per_file)))
    spread = -(-n_large // rows_per_file)
    slot = F.floor((F.col(BATCH) - 1) * parts / n_batches)
    if spread:
        slot = F.when(F.col("large"), parts + F.pmod(F.xxhash64(BATCH, PLACE), F.lit(spread))).otherwise(slot)
    return rows.repartitionById(parts + spread, slot.cast("int")).sortWithinPartitions(BATCH, PLACE)


def in_batch_order(lines: DataFrame, parts: int | None = None) -> DataFrame:
    """Lines laid out for writing: batches contiguous, a huge id split over several files."""
    order = [BATCH, KEY, "instrument", "instance"]
    ranged = lines.repartitionByRange(parts, *order) if parts else lines.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)
