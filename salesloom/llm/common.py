"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators.lineage import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other letter alone."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet into the shared checkpoint folder and read them back.

    Cuts the lineage like a checkpoint, but keeps columns and statistics. The folder
    belongs to the session's checkpoint folder and goes with it; ``discard`` removes
    it earlier.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    for frames in _RECORDS:
        frames.append(back)
    return back


# Bytes that an Arrow batch on its way to a Python task holds at most, but for one row that is longer.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """What is run inside sends rows to Python in batches of about ``most`` bytes.

    Spark's 10,000 rows of whole texts make batches of tens of MB, which each task holds in
    the executor and in its worker at once. Frames must be run inside, say by ``stored``.
    """
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


_RECORDS: list[list[DataFrame]] = []


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """What ``stored`` writes inside, so that it can be discarded together."""
    frames: list[DataFrame] = []
    _RECORDS.append(frames)
    try:
        yield frames
    finally:
        _RECORDS.remove(frames)


def discard(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote, once nothing will read it again."""
    for df in frames:
        path = getattr(df, "stored_at", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text and at most ``rows`` rows, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most + np.arange(len(sizes)) // rows
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for begin, end in zip(cuts, np.append(cuts, batch.num_rows)[1:], strict=True):
        yield batch.slice(int(begin), int(end - begin))
