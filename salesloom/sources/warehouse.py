"""Warehouse tables as Parquet folders: parts for the tables that grow, one folder each for the
others and for reports. A catalog says which folders are current."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.cleanse import as_date
from salesloom.operators.lineage import CODEC, broadcast_if_small, materialized
from salesloom.operators.upsert import changed_partitions, distinct_values, newest_per_key, require_unique
from salesloom.sources.catalog import Catalog

MONTH = "month"
# Partition of rows whose order day is not known.
NO_MONTH = "none"
SPAN = "span"
# Order ids of one part of an index.
SPAN_IDS = 1 << 22
BATCH = "batch"
# Single batches of an appended table are joined into one part when there are so many.
BATCHES = 64
# Tables that grow with sales, in months.
GROWING = {
    "orders": schemas.ORDERS,
    "order_amounts": schemas.ORDER_AMOUNTS,
    "order_items": schemas.ORDER_ITEMS,
    "f_sales": schemas.F_SALES,
    "stg_orders": schemas.STG_ORDERS,
    "stg_order_items": schemas.STG_ORDER_ITEMS,
    "state_days": schemas.STATE_DAYS,
    "state_channels": schemas.STATE_CHANNELS,
    "state_products": schemas.STATE_PRODUCTS,
    "state_sales": schemas.STATE_SALES,
    "state_names": schemas.STATE_NAMES,
}
# Where an order lies in a table: indexes by order id, in spans of ids.
INDEXES = {"orders": "order_months", "stg_orders": "stg_order_months", "f_sales": "fact_months"}
# Kept by order id, in spans too.
SPANNED = {**dict.fromkeys(INDEXES.values(), schemas.ORDER_MONTHS), "rejected_details": schemas.REJECTED_DETAILS}
# Tables that only get more rows, by the batch that brought them.
APPENDED = {
    "rejected_pages": schemas.REJECTED_PAGES,
    "load_batches": schemas.LOAD_BATCHES,
    "product_keys": schemas.PRODUCT_KEYS,
    "product_names": schemas.PRODUCT_NAMES,
}
PARTS = {
    **dict.fromkeys(GROWING, MONTH), **dict.fromkeys(APPENDED, BATCH),
    **dict.fromkeys(SPANNED, SPAN),
}
# Smaller tables, written as a whole.
CATALOGUE = {
    "products": schemas.PRODUCTS,
    "stg_products": schemas.STG_PRODUCTS,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_date": schemas.DIM_DATE,
}
# Entries of the catalog under such names are notes, not folders.
_NOTES = "_"
# The one part of a table that is written as a whole.
_WHOLE = "whole"


def month_text(day: Column) -> Column:
    """Partition value of a day; rows without a day share one partition."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


def span_text(order_id: Column) -> Column:
    """Part of an index that holds an order id."""
    return F.floor(order_id / SPAN_IDS).cast("string")


class Warehouse:
    """Tables under one root folder on storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = Catalog(spark, self.path("_catalog"))
        self._pending: dict | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- tables in parts --------------------------------------------------

    def growing_schema(self, name: str) -> str:
        return f"{(GROWING | SPANNED | APPENDED)[name]}, {PARTS[name]} string"

    def load(self, name: str, since=None) -> DataFrame:
        """Current rows of a table, read with its declared schema.

        The folders are looked up once, so a frame goes on showing the rows of that moment.
        ``since`` (a day) reads only the months from then on. Lines are stored in
        the month of their order, so a report over the last days can prune both
        tables: ``load("orders", day)`` and ``load("order_items", day)``.
        """
        if name in PARTS:
            table = self._parts(name)
            return table if since is None else table.where(F.col(MONTH) >= month_text(as_date(since)))
        folder = self._entries().get((name, _WHOLE))
        if name in CATALOGUE and folder is None:
            return self.spark.createDataFrame([], CATALOGUE[name])
        if folder is None:
            raise ValueError(f"there is no table {name}")
        return self.spark.read.parquet(self.path(folder))

    def _entries(self) -> dict:
        return self.catalog.current()[1] if self._pending is None else self._pending

    def _parts(self, name: str) -> DataFrame:
        folders = sorted(self.folders(name).values())
        schema = self.growing_schema(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(f"{schema}, v string").option("basePath", self.path(name))
        return reader.parquet(*[f"{self.root}/{folder}" for folder in folders]).drop("v")

    def recent(self, as_of=None, days: int = 90) -> tuple[DataFrame, DataFrame]:
        """Orders and lines of the months that hold the last ``days`` days."""
        since = F.date_sub(as_date(as_of), days)
        return self.load("orders", since), self.load("order_items", since)

    @contextmanager
    def together(self) -> Iterator[None]:
        """Changes of tables in parts made inside become visible at once, at the end, or
        not at all. Inside, ``load`` shows them already."""
        if self._pending is not None:
            yield
            return
        number, before = self.catalog.current()
        self._pending = dict(before)
        try:
            yield
            if self._pending != before:
                self.catalog.switch(number + 1, self._pending)
        finally:
            self._pending = None

    def _write_parts(self, name: str, rows: DataFrame, parts: Sequence[str]) -> None:
        """Make ``rows`` the whole content of these parts (and of those they hold besides).

        New folders are written; which are current changes with the catalog. The rebalance
        hint lets adaptive execution gather small parts into one file and split large ones.
        """
        column, written = PARTS[name], Observation()
        stamp = uuid.uuid4().hex
        (
            rows.select(*[F.col(field.name).cast(field.dataType) for field in self._parts(name).schema])
            .hint("rebalance", column)
            .observe(written, F.collect_set(column).alias("parts"))
            .withColumn("v", F.lit(stamp))
            .write.mode("append")
            .option("compression", CODEC)
            .partitionBy(column, "v")
            .parquet(self.path(name))
        )
        with self.together():
            for part in parts:
                self._pending.pop((name, part), None)
            for part in written.get["parts"]:
                self._pending[name, part] = f"{name}/{column}={part}/v={stamp}"

    def replace(
        self,
        name: str,
        replaced: DataFrame,
        rows: DataFrame,
        keys: Sequence[str],
        within: Sequence[str] | None = None,
        ready: bool = False,
    ) -> list[str]:
        """Rows of ``replaced`` keys go, ``rows`` (with their part) come.

        ``within`` names the parts that can hold a replaced row; for a table with an index
        they are looked up there. Both frames are read several times and are materialized
        for that, unless they are ``ready``: stored, or few steps from what is stored, as only
        keys and parts are read more than once. Returns the parts rewritten.
        """
        replaced, rows = replaced.select(*keys).distinct(), rows.select(*self._parts(name).columns)
        if not ready:
            replaced, rows = materialized(replaced), materialized(rows)
        with self.together():
            if within is None and name in INDEXES:
                within = distinct_values(self.homes(name, replaced).select(MONTH))
            result, parts = changed_partitions(self.load(name), replaced, rows, keys, PARTS[name], within)
            if parts:
                self._write_parts(name, result, parts)
            if name in INDEXES:
                self._index(name, replaced, rows)
        return parts

    def homes(self, name: str, ids: DataFrame) -> DataFrame:
        """order_id, month: where the table holds each of the (materialized) order ids it knows.

        Only the spans of these ids are read, and the few ids go to the index's rows.
        """
        spans = distinct_values(ids.select(span_text(F.col("order_id")).alias(SPAN)))
        index = self.load(INDEXES[name]).where(F.col(SPAN).isin(spans)).select("order_id", MONTH)
        return index.join(broadcast_if_small(ids.select("order_id")), "order_id", "left_semi")

    def _index(self, name: str, replaced: DataFrame, rows: DataFrame) -> None:
        entries = rows.select("order_id", MONTH).distinct().withColumn(SPAN, span_text(F.col("order_id")))
        known = replaced.select("order_id").unionByName(rows.select("order_id")).distinct()
        spans = distinct_values(known.select(span_text(F.col("order_id")).alias(SPAN)))
        self.replace(INDEXES[name], known, entries, ["order_id"], spans, ready=True)

    def upsert(self, name: str, changes: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> list[str]:
        """Insert or update by key; the newest change wins."""
        latest = newest_per_key(changes, keys, newest)
        return self.replace(name, latest, latest, keys)

    def overwrite_months(self, name: str, rows: DataFrame, months: Sequence[str], moved: bool = True) -> None:
        """Make ``rows`` the whole content of these months. ``moved`` says that orders may lie
        elsewhere than before, so the index is told."""
        with self.together():
            if moved and name in INDEXES:
                rows = materialized(rows)
                self._index(name, rows.select("order_id"), rows)
            self._write_parts(name, rows, months)

    # --- batches ------------------------------------------------------------

    def append(self, name: str, rows: DataFrame, batch: str) -> None:
        """Add the rows of a batch. The same batch again replaces what it added; once there
        are many single batches, they become one part."""
        with self.together():
            self._write_parts(name, rows.withColumn(BATCH, F.lit(batch)), [batch])
            single = sorted(part for table, part in self._pending if table == name and not part.startswith("to-"))
            if len(single) >= BATCHES:
                joined = self.load(name).where(F.col(BATCH).isin(single)).withColumn(BATCH, F.lit(f"to-{single[-1]}-{uuid.uuid4().hex}"))
                self._write_parts(name, joined, single)

    def last_batch(self, stream: str) -> int:
        """Number of the last batch of a stream that is in the tables; -1 before the first."""
        return int(self.notes("streams").get(stream, -1))

    def folders(self, name: str) -> dict[str, str]:
        """Current folder of each part of a table."""
        return {part: folder for (table, part), folder in self._entries().items() if table == name}

    def notes(self, topic: str) -> dict[str, str]:
        """Notes that were put into the catalog with the changes they tell of."""
        return self.folders(_NOTES + topic)

    def note(self, topic: str, key: str, text: str | None) -> None:
        with self.together():
            if text is None:
                self._pending.pop((_NOTES + topic, key), None)
            else:
                self._pending[_NOTES + topic, key] = text

    def drop_unused(self, keep: int = 2) -> list[str]:
        """Delete the folders that none of the newest ``keep`` lists of the catalog names, once
        no reader needs them and no change is under way. Returns them."""
        tables, named = self.catalog.drop(keep)
        unused = []
        for name in sorted(tables | set(PARTS) | set(CATALOGUE)):
            fs, pattern = self._hadoop(self.path(f"{name}/{PARTS[name]}=*/v=*" if name in PARTS else f"{name}/v=*"))
            for status in fs.globStatus(pattern) or ():
                folder = status.getPath().toString().split(f"{self.root}/", 1)[1]
                if folder not in named:
                    unused.append(folder)
                    fs.delete(status.getPath(), True)
        return sorted(unused)

    # --- whole tables and reports -----------------------------------------

    def materialize(
        self, name: str, df: DataFrame, unique: Sequence[str] | None = None, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write a table anew as a whole, and let readers move to it with the catalog.

        ``unique`` names a key; rows that share one are an error, and the old table stays.
        Returns the new table, and points the temporary view ``name`` at it.
        """
        folder = f"{name}/v={uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(self.path(folder))
        current = self.spark.read.parquet(self.path(folder))
        if unique:
            require_unique(current, unique, name)
        with self.together():
            self._pending[name, _WHOLE] = folder
        current.createOrReplaceTempView(name)
        return current

    def refresh(
        self,
        reports: dict[str, Callable[[], DataFrame]],
        only: Sequence[str] | None = None,
        keys: dict[str, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Materialize every report, check its key, and count its rows. All reports change
        together: one with a repeated key leaves them all as they were."""
        counts = None
        with self.together():
            for name in only or list(reports):
                current = self.materialize(name, reports[name](), (keys or {}).get(name))
                row = current.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
                counts = row if counts is None else counts.unionByName(row)
        return counts

    def _hadoop(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """Scan of a database table in ``partitions`` key ranges read in parallel."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper)
        .options(numPartitions=partitions, **options)
        .load()
    )


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns (name to type) that a table lacks, as nulls."""
    return df.withColumns(
        {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    )
