"""CSV export and whole rows kept as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; every field quoted, quotes doubled, null as empty text."""
    text = df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    (
        text.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def with_raw_json(df: DataFrame, name: str = "raw_json") -> DataFrame:
    """Adds the whole row as JSON text."""
    return df.withColumn(name, F.to_json(F.struct(*df.columns)))
