"""Shared storage of the session, and texts on their way through joins."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from cohortlens.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the session names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to a new folder of the shared storage and read again. For steps of a loop: the frame read back
    knows nothing of the plan that made it, while a checkpoint keeps that plan's constraints, which pile up."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, frames: list[DataFrame]) -> None:
    """Delete the folders of ``stored`` frames that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Ends the life of a query's shuffle files with the query, not with the driver's next garbage collection.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it every query frees its shuffle files when it ends. For eager steps whose results are stored: a frame that
    runs a second time would have to shuffle again."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of a few rows, for work that holds Python copies of their texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Parquet's vectored reads ask for whole column chunks at once, and the JVM keeps a direct buffer of that size for every
#: thread that read one, beside the heap. Texts make column chunks large; streams read them through small buffers.
_VECTORED = "parquet.hadoop.vectored.io.enabled"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Set the session's Arrow batches and Parquet reads to a size that suits rows with texts: a batch is held by the JVM
    and by the Python worker at once, and what a read holds must not follow the size of a column chunk."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set(_VECTORED, "false")


def _compress_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for part in in_parts(batches):
        z = pa.array([None if t is None else pack.compress(t.encode()) for t in part.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([z if c == "text" else part.column(c) for c in part.schema.names], names=part.schema.names)


def compressed(docs: DataFrame) -> DataFrame:
    """The rows with their texts compressed, as they travel through joins on doc_id."""
    fields = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(_compress_task, ", ".join(fields))


def open_text(z: bytes | None) -> bytes:
    """The UTF-8 bytes of a compressed text; none for null."""
    return b"" if z is None else zstandard.ZstdDecompressor().decompress(z)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the texts as plain bytes again, a bounded number of rows at a time."""
    for part in in_parts(batches):
        text = pa.array([open_text(z) for z in part.column("text").to_pylist()], pa.large_binary())
        yield pa.RecordBatch.from_arrays([text if c == "text" else part.column(c) for c in part.schema.names], names=part.schema.names)


def of_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of (doc_id, text) whose doc_id is among ``ids`` (doc_id), texts compressed. Always a sort-merge join,
    so that the plan, and what it moves, is the same at every size."""
    return compressed(texts).join(ids.hint("merge"), "doc_id", "left_semi")
