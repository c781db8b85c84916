"""Results written to shared storage: results that are read several times are computed once
and survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PREFIX = "materialized-"
# Texts of replies take about half the room that Spark's own choice would give them.
CODEC = "zstd"
# Rows of a key table that every executor can hold: some tens of megabytes.
BROADCAST_ROWS = 1_000_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="salesloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def materialized(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: written as Parquet into the session's checkpoint
    folder and read back, so columns are still pruned and sizes known. The folder keeps
    it until ``forget_materialized``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{_PREFIX}{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_materialized(spark: SparkSession) -> int:
    """Delete what ``materialized`` wrote in this session, once no result needs it any more;
    returns how many tables that were."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    stored = [status.getPath() for status in files.listStatus(folder) if status.getPath().getName().startswith(_PREFIX)]
    for path in stored:
        files.delete(path, True)
    return len(stored)


def broadcast_if_small(stored: DataFrame, limit: int | None = None) -> DataFrame:
    """A materialized key table, with a broadcast hint when its counted rows are few.

    Spark's own size estimate of such a table is the one of its input, which is
    often far too large; without the hint the table it is joined to would be
    shuffled. Beyond the limit the join is left to Spark.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    return F.broadcast(stored) if stored.count() <= limit else stored
