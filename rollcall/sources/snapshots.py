"""Readers for exported snapshots, tables and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.casts import to_key
from rollcall.functions.text import blank_missing, key_text
from rollcall.operators.lookup import attach
from rollcall.operators.normalize import blank_nulls
from rollcall.operators.numbering import MOST_BOUNDS, last_at_or_before, number_rows, place_in
from rollcall.schema import IDS_PER_RANGE, INTAKE_FIELDS, KEY, RECORD, ROW, all_strings
from rollcall.session import cut


#: Raw text of what could not be read; null on rows that could.
CORRUPT = "_corrupt_record"


def read_export(
    spark: SparkSession, path: str, fields: list[str] | None = None, lines: bool = False
) -> DataFrame:
    """Flat export: JSON arrays of string objects, one or more files; null becomes blank.

    Give ``fields`` (for instance the names of the dictionary) to skip the pass that finds
    them. An array file is read by one task, so large exports should come as several files
    or as JSON ``lines``, which split. A cut-off file or line ends the job; ``read_export_parts`` sets it aside instead.
    """
    reader = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if fields:
        reader = reader.schema(all_strings(fields))
    else:
        reader = reader.option("primitivesAsString", True)
    return blank_nulls(reader.json(path))


def _parted(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(readable rows, quarantine): what could not be read keeps its file and its raw text, and gives no row of blanks."""
    bad = F.col(CORRUPT).isNotNull()
    good = blank_nulls(rows.filter(~bad).select(*fields))
    held = rows.filter(bad).select("file", F.col(CORRUPT).alias("raw"), F.lit("unreadable").alias("reason"))
    return good, held


def read_export_parts(spark: SparkSession, path: str, fields: list[str], lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """As ``read_export``, with a quarantine (file, raw, reason) of cut-off files or lines. The parsed rows are stored once for both."""
    schema = all_strings([*fields, CORRUPT])
    reader = spark.read.schema(schema).option("multiLine", not lines).option("columnNameOfCorruptRecord", CORRUPT)
    return _parted(cut(reader.json(path).withColumn("file", F.input_file_name())), fields)


def read_intake_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Upload file in the fixed column order, one row a line, with a quarantine of lines of too few or too many cells. Files split."""
    schema = all_strings([*INTAKE_FIELDS, CORRUPT])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.option("enforceSchema", False).csv(path)
    return _parted(cut(rows.withColumn("file", F.input_file_name())), INTAKE_FIELDS)


def parse_export(lines: DataFrame, fields: list[str], text: str = "line") -> DataFrame:
    """Rows of JSON text (one object each) as fields beside the other columns, with the raw text of what is no object in ``CORRUPT``."""
    return _parsed(lines, fields, text, F.from_json(text, all_strings([*fields, CORRUPT]), {"columnNameOfCorruptRecord": CORRUPT}))


def parse_upload(lines: DataFrame, fields: list[str] = INTAKE_FIELDS, text: str = "line") -> DataFrame:
    """Rows of comma-separated text as fields beside the other columns; a line of too few or too many cells is set aside whole."""
    options = {"columnNameOfCorruptRecord": CORRUPT, "escape": '"'}
    schema = ", ".join(f"`{n}` string" for n in [*fields, CORRUPT])
    return _parsed(lines, fields, text, F.from_csv(text, schema, options))


def _parsed(lines: DataFrame, fields: list[str], text: str, value: Column) -> DataFrame:
    """A cut-off row has blanks in no field, but nulls, so that it cannot pass for a row of blanks."""
    others = [c for c in lines.columns if c != text]
    rows = lines.withColumn("_row", value)
    bad = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_row").isNull()
    cells = [F.when(~bad, blank_missing(F.col(f"_row.`{n}`"))).alias(n) for n in fields]
    return rows.select(*others, *cells, F.when(bad, F.coalesce(text, F.lit(""))).alias(CORRUPT))


def land(snapshot: DataFrame, path: str, key: str | None = None, group_bytes: int = 8 << 20) -> DataFrame:
    """The snapshot stored once as Parquet and read back, with ``ROW``, a number of each row that no later read changes.

    Without ``key`` the rows are written as they are parsed, without a shuffle. With it they are sorted by key in ranges: files
    have narrow statistics, page indexes and a Bloom filter on the key, so a read of one key opens few row
    groups. A key with very many rows is spread over ranges, as the row number is part of the order.
    """
    writer = snapshot.drop(ROW).withColumn(ROW, F.monotonically_increasing_id())
    if key is not None:
        writer = cut(writer).repartitionByRange(key, ROW).sortWithinPartitions(key, ROW)
    out = writer.write.mode("overwrite").option("parquet.block.size", group_bytes)
    if key is not None:
        out = out.option(f"parquet.bloom.filter.enabled#{key}", "true")
    out.parquet(path)
    return snapshot.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot stored as parquet; column selection and filters reach the files."""
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, predicates: list[str] | None = None, **options: str
) -> DataFrame:
    """Database table in one scan, or in one task per predicate."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def fields_of(snapshot: DataFrame, names: list[str]) -> DataFrame:
    """Narrow export."""
    return snapshot.select(*names)


def where(snapshot: DataFrame, condition: str) -> DataFrame:
    """Filtered export; the condition is Spark SQL and is pushed to the files."""
    return snapshot.filter(condition)


def one_record(snapshot: DataFrame, record_id: str) -> DataFrame:
    return snapshot.filter(F.col(RECORD) == str(record_id))


def read_intake(spark: SparkSession, path: str) -> DataFrame:
    """Upload file: header, text columns, blanks for missing. Dates stay text until judged.

    Columns are found by their header, in whatever order the file has them; further ones follow.
    """
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    others = [c for c in rows.columns if c not in INTAKE_FIELDS]
    return blank_nulls(rows.select(*[F.col(f"`{n}`").cast("string") for n in [*INTAKE_FIELDS, *others]]))


def read_ids(spark: SparkSession, path: str, key: str = KEY) -> DataFrame:
    """Distinct integer keys of a CSV file."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(to_key(F.col(key).cast("string")).alias(key)).filter(F.col(key).isNotNull()).distinct()


def read_dictionary(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Dictionary with ``seq``, the place of a field in its file.

    A dictionary is one array file whose order matters, so it is read as it stands.
    """
    if kind == "csv":
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    else:
        rows = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    renamed = rows.withColumnRenamed("field_annotation", "annotation")
    return blank_nulls(renamed).withColumn("seq", F.monotonically_increasing_id())


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    """JSON object of name and flag as rows (field_name, flag)."""
    text = spark.read.option("wholetext", True).text(path)
    flags = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return text.select(F.explode(flags).alias("field_name", "flag"))


# --- range-partitioned extracts ----------------------------------------------------------


def range_boundaries(registry: DataFrame, ids_per_range: int = IDS_PER_RANGE, tasks: int | None = None) -> DataFrame:
    """Ranges [lo, hi) that hold so many known record ids each; the last one is open.

    With ``tasks``, the number of read tasks wanted, the ids are dealt into so many ranges at most.

    ``range_no`` counts from 0. The upper end of a range is its successor's lower end,
    joined by number, so no window runs over all ranges.
    """
    ids = registry.select(to_key(key_text(F.col(RECORD))).alias("lo")).filter("lo IS NOT NULL").distinct()
    if tasks:
        ids = cut(ids)
        ids_per_range = max(1, -(-ids.count() // tasks))
    marks = (
        number_rows(ids, ["lo"], "_n", start=0)
        .filter(F.col("_n") % ids_per_range == 0)
        .select((F.col("_n") / ids_per_range).cast("bigint").alias("range_no"), "lo")
    )
    successor = marks.select((F.col("range_no") - 1).alias("range_no"), F.col("lo").alias("hi"))
    return marks.join(successor, "range_no", "left")


#: Range of ids below the first known one, and of those that are no integer (blank ones included).
BELOW, UNREADABLE = -1, -2


def range_of_records(source: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(record id, range_no) of every source row, repeats included.

    Up to ``MOST_BOUNDS`` lower ends are searched in the stage that reads the source, which is not shuffled. More of them
    are laid out in one order with the distinct ids (an ordered look-back) and attached to the rows.
    """
    rows = source.select(RECORD, to_key(key_text(F.col(RECORD))).alias("lo"))
    number = F.when(F.col("lo").isNull(), UNREADABLE).otherwise(F.coalesce("range_no", F.lit(BELOW))).cast("bigint")
    # range numbers are dense in the order of the lower ends
    ends = [r.lo for r in boundaries.select("lo").limit(MOST_BOUNDS + 1).collect()]
    if len(ends) <= MOST_BOUNDS:
        labelled = rows.withColumn("range_no", place_in(F.col("lo"), sorted(ends)) - 1)
        return labelled.select(RECORD, number.alias("range_no"))
    ids = rows.select("lo").filter("lo IS NOT NULL")
    found = last_at_or_before(ids, boundaries.select("lo", "range_no"), "lo", "range_no")
    return attach(rows, found, ["lo"]).select(RECORD, number.alias("range_no"))


def range_predicates(boundaries: DataFrame, column: str = RECORD, unreadable: str | None = None) -> list[str]:
    """Predicates of a JDBC read, one per read task, that together cover every row once.

    One per range, one for ids below the first and one for missing ids; ``unreadable`` adds what the database calls an id
    that is no integer, for columns of text, and keeps such ids out of the ranges. The list is as long as the caller asked for with ``tasks``.
    """
    rows = sorted((r.lo, r.hi) for r in boundaries.select("lo", "hi").collect())
    rest = f"{column} IS NULL" + (f" OR {unreadable}" if unreadable else "")
    if not rows:
        return [rest, f"NOT ({rest})"]
    own = f"NOT ({unreadable}) AND " if unreadable else ""
    out = [rest, f"{own}{column} < {rows[0][0]}"]
    return out + [f"{own}{column} >= {lo}" + ("" if hi is None else f" AND {column} < {hi}") for lo, hi in rows]


def read_ranges(
    spark: SparkSession, url: str, table: str, boundaries: DataFrame, column: str = RECORD, unreadable: str | None = None, **options: str
) -> DataFrame:
    """Source table read range by range and united; ``unreadable`` as in ``range_predicates``. ``jobs.sync_database`` starts with it."""
    return read_jdbc(spark, url, table, range_predicates(boundaries, column, unreadable), **options)
