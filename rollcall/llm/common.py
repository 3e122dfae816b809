"""Tables, lineage cuts and Arrow text buffers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rollcall.operators.audit import counted

#: Text handed to numpy at once, in bytes; one longer text is still taken whole.
SLICE_BYTES = 1 << 20
#: Narrow rows that one task reads from a stored frame.
ROWS = 100_000

#: What a worker holds from one task to the next, by the kind of work it is for, with the function that lets go of it.
HELD: dict[str, Callable[[], None]] = {}
Batches = Iterator[pa.RecordBatch]


def let_go(kind: str = "") -> None:
    """Drops what is held for work of another kind than ``kind`` and gives back what Arrow and the C library keep free."""
    for other in [k for k in HELD if k != kind]:
        HELD.pop(other)()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run: Callable[[Batches], Batches], kind: str = "") -> Callable[[Batches], Batches]:
    """``run``, a function over a task's batches, in a worker that lives on between tasks: its memory is given back before and after."""

    def task(batches: Batches) -> Batches:
        let_go(kind)
        yield from run(batches)
        let_go(kind)

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def new_path(spark: SparkSession, kind: str) -> str:
    """A folder of its own in the shared one."""
    return f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder and forget its lineage."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut`` of ``df``, and its number of rows, observed while it is stored."""
    seen, observed = counted(df)
    return cut(seen), observed.get["n_rows"]


def parts_of(rows: int) -> int:
    """Partitions that so many narrow rows need."""
    return max(1, -(-rows // ROWS))


def snug(df: DataFrame) -> DataFrame:
    """``cut`` of a narrow frame, read in no more partitions than its rows need: each task of a shuffle writes files, however few its rows."""
    found, n = stored(df)
    return found.coalesce(parts_of(n))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(taken: list[str], stem: str) -> str:
    """``stem``, lengthened until no column of ``taken`` has that name in any letter case."""
    names = {c.lower() for c in taken}
    while stem.lower() in names:
        stem += "_"
    return stem


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the places where its texts begin and end; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``most`` bytes each, one row at least."""
    _, at = utf8(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi
