"""Helpers shared by the operators: row keys, materialised tables, Arrow text access."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles at once; one longer text is handled alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, which is one process, may lack it."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='causeway-')}"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/causeway/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes materialised tables that no result still reads."""
    for df in tables:
        if path := getattr(df, "written_at", None):
            context = df.sparkSession.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
            df.written_at = None


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with more underscores if a column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def place_of(df: DataFrame, name: str) -> int:
    """Where the column is that Spark means by ``name``: the one of that name, or of that name in another case."""
    return df.columns.index(name) if name in df.columns else [c.lower() for c in df.columns].index(name.lower())


def release(spark: SparkSession) -> None:
    """Lets the driver forget finished steps, upon which Spark deletes their shuffle files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_row_key(df: DataFrame, name: str = "rid") -> DataFrame:
    """A key per row: repeated ids stay separate rows. The same scan gets the same keys each time."""
    return df.withColumn(name, F.monotonically_increasing_id())


@contextmanager
def batches_of(spark, rows: int):
    """Smaller Arrow batches while an action on wide rows runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its int64 offsets; a null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first : int(offsets[-1]) if len(offsets) else 0], offsets - first


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges whose texts have about ``most`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES):
    """(first row, bytes, offsets) of the chunks of a string column."""
    data, offsets = text_bytes(column)
    for i, j in chunks(offsets, most):
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
    pa.default_memory_pool().release_unused()  # workers live on between tasks; what earlier batches took goes back


def codepoints(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """A chunk as one str, its code points, and the offsets of its texts counted in code points."""
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    text = data.tobytes().decode("utf-8")
    return text, np.frombuffer(text.encode("utf-32-le"), np.uint32), lead[offsets]
