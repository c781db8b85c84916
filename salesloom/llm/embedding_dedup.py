"""Near duplicates among embeddings, by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned into the basis of their principal components,
which keeps every cosine and moves their length into the leading coordinates. The basis
comes from the scatter matrix of all vectors; it only steers the pruning, so results are
exact. Copies of one vector are first merged into their smallest id. Vectors of a label
are range-partitioned by the first coordinate and cut by the second into tiles of at most
``TILE`` rows. A pair of tiles is compared unless the boxes of their leading coordinates
are too far apart for the threshold.

Within a pair of tiles the products of the leading coordinates are added up first; the
rest is at most the product of both suffix lengths, and a pair of vectors is dropped as
soon as that bound leaves the cosine below the threshold. A task returns, for a pair of
tiles, each vector's number of links and one link towards the smallest vector it is
connected with there: never the list of links.

Defined cases: vectors that are null, zero or hold null or non-finite components, and
those with a null label or id, link with nothing; vectors of different lengths are not
compared; each row counts as a vector, so rows that repeat an id link as copies do; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import partitions, stored
from salesloom.llm.components import components

THRESHOLD = 0.98
TILE = 512
BOX = 8
STEP = 16
SALTS = 16
SLACK = 1e-9


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest component first, so squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            yield int(dim), batch.filter(pa.array(dims == dim))


def bases(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal components by vector length; length squared rows each come to the driver."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for dim, part in by_length(batches):
            x = unit_rows(matrix(part, dim))
            sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, total in sums.items():
            place = np.arange(dim * dim)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim * dim, dim, "i4")), pa.array(place), pa.array(total.ravel())], ["dim", "place", "v"])

    summed = vectors.select("dim", "embedding").mapInArrow(scatter, "dim int, place long, v double").groupBy("dim", "place").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for row in summed.collect():
        out.setdefault(row.dim, np.zeros(row.dim * row.dim))[row.place] = row.v
    for dim, total in out.items():
        out[dim] = np.linalg.eigh(total.reshape(dim, dim))[1][:, ::-1]
    return out


def tiles(vectors: DataFrame, turned: dict[int, np.ndarray], size: int) -> DataFrame:
    """tile, label, dim, lo, hi, ids, copies and vectors of each tile."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(turned)
    fields = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_id long, label {fields['label']}, dim int, copies long, embedding {fields['embedding']}, y0 double, y1 double"

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in by_length(batches):
            y = unit_rows(matrix(part, dim)) @ shared.value[dim][:, :2]
            y = np.pad(y, ((0, 0), (0, max(0, 2 - dim))))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("vec_id", "label", "dim", "copies", "embedding")], pa.array(y[:, 0]), pa.array(y[:, 1])],
                ["vec_id", "label", "dim", "copies", "embedding", "y0", "y1"],
            )

    placed = vectors.select("vec_id", "label", "dim", "copies", "embedding").mapInArrow(turn, schema)
    dealt = stored(placed).repartitionByRange(partitions(spark), "label", "dim", "y0", "vec_id").sortWithinPartitions("label", "dim", "y1")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def emit() -> pa.RecordBatch:
            nonlocal made
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            dim = rows.column("dim")[0].as_py()
            x = matrix(rows, dim)
            y = unit_rows(x) @ shared.value[dim][:, :BOX]
            made += 1
            columns = [
                pa.array([slot << 32 | made], pa.int64()), rows.column("label")[:1], rows.column("dim")[:1],
                pa.array([y.min(axis=0)], pa.list_(pa.float64())), pa.array([y.max(axis=0)], pa.list_(pa.float64())),
                *[pa.array([a.tobytes()], pa.binary()) for a in (rows.column("vec_id").to_numpy(), rows.column("copies").to_numpy(), x)],
            ]
            return pa.RecordBatch.from_arrays(columns, ["tile", "label", "dim", "lo", "hi", "ids", "copies", "x"])

        key, count = None, 0
        for batch in batches:
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            begin = 0
            for row, own in enumerate(zip(labels, dims, strict=True)):
                if own != key or count == size:
                    if row > begin:
                        held.append(batch.slice(begin, row - begin))
                    if held:
                        yield emit()
                    key, count, begin = own, 0, row
                count += 1
            if batch.num_rows > begin:
                held.append(batch.slice(begin))
        if held:
            yield emit()

    return dealt.select("vec_id", "label", "dim", "copies", "embedding").mapInArrow(
        cut, f"tile long, label {fields['label']}, dim int, lo array<double>, hi array<double>, ids binary, copies binary, x binary"
    )


def linked_pairs(x: np.ndarray, y: np.ndarray, basis: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of linked rows of both tiles; i < j within one tile."""
    ux, uy = unit_rows(x), unit_rows(y)
    a, b = ux @ basis, uy @ basis
    dim = basis.shape[0]
    at = min(STEP, dim)
    rest = lambda m, k: np.sqrt((m[:, k:] ** 2).sum(axis=1))
    product = a[:, :at] @ b[:, :at].T
    alive = product + np.outer(rest(a, at), rest(b, at)) >= threshold - SLACK
    i, j = np.nonzero(np.triu(alive, 1) if same else alive)
    sums = product[i, j]
    while at < dim and len(i):
        end = min(at + STEP, dim)
        sums = sums + np.einsum("ij,ij->i", a[i, at:end], b[j, at:end])
        kept = sums + rest(a, end)[i] * rest(b, end)[j] >= threshold - SLACK
        i, j, sums, at = i[kept], j[kept], sums[kept], end
    linked = np.einsum("ij,ij->i", ux[i], uy[j]) >= threshold
    return i[linked], j[linked]


def smallest_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is connected with."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        new = least.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def tile_links(cut: DataFrame, turned: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """vec_id, n, root: links of a vector within a pair of tiles, and whom they lead to."""
    spark = cut.sparkSession
    shared = spark.sparkContext.broadcast(turned)
    reach = 2 - 2 * threshold + SLACK
    meta = cut.select("tile", "label", "dim", "lo", "hi")
    a = meta.withColumn("salt", F.pmod(F.xxhash64("tile"), F.lit(SALTS)).cast("int")).alias("a")
    b = meta.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)]))).alias("b")
    gaps = F.zip_with(
        F.zip_with("a.lo", "b.hi", lambda p, q: p - q), F.zip_with("b.lo", "a.hi", lambda p, q: p - q), lambda p, q: F.greatest(p, q, F.lit(0.0))
    )
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= reach
    same_group = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.salt") == F.col("b.salt"))
    pairs = a.join(b, same_group & (F.col("a.tile") <= F.col("b.tile")) & near).select(F.col("a.tile").alias("l"), F.col("b.tile").alias("r"))
    left = cut.select(F.col("tile").alias("l"), "dim", *[F.col(c).alias(f"l_{c}") for c in ("ids", "copies", "x")])
    right = cut.select(F.col("tile").alias("r"), *[F.col(c).alias(f"r_{c}") for c in ("ids", "copies", "x")])
    met = stored(pairs).join(left, "l").join(right, "r")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim = batch.column("dim")[row].as_py()
                read = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)  # noqa: B023, E731
                same = batch.column("l")[row].as_py() == batch.column("r")[row].as_py()
                x, y = read("l_x", "f8").reshape(-1, dim), read("r_x", "f8").reshape(-1, dim)
                i, j = linked_pairs(x, y, shared.value[dim], threshold, same)
                if not len(i):
                    continue
                ids = np.concatenate([read("l_ids", "i8"), read("r_ids", "i8")])
                copies = np.concatenate([read("l_copies", "i8"), read("r_copies", "i8")])
                j = j if same else j + len(x)
                n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                order = np.argsort(ids, kind="stable")
                rank = np.empty(len(ids), np.int64)
                rank[order] = np.arange(len(ids))
                root = ids[order][smallest_reached(len(ids), rank[i], rank[j])[rank]]
                has = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[has]), pa.array(n[has].astype(np.int64)), pa.array(root[has])], ["vec_id", "n", "root"])

    return met.mapInArrow(compare, "vec_id long, n long, root long")


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``."""
    read = vectors.select("vec_id", "label", "embedding")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    valid = read.where(usable).withColumn("vec_id", F.col("vec_id").cast("long"))
    distinct = stored(valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")))
    distinct = distinct.withColumn("dim", F.size("embedding"))
    turned = bases(distinct)
    cut = stored(tiles(distinct, turned, tile))
    links = stored(tile_links(cut, turned, threshold))
    reached = components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("vec_id").agg(F.sum("n").alias("n"))
    # Every copy has its smallest copy's links, and one to each other copy.
    heads = distinct.where("copies > 1").select("label", "embedding", F.col("vec_id").alias("head"), "copies")
    members = valid.join(heads, ["label", "embedding"], "left").select("vec_id", F.coalesce("head", "vec_id").alias("head"), F.coalesce("copies", F.lit(1)).alias("copies"))
    counted = members.join(counts.withColumnRenamed("vec_id", "of"), F.col("head") == F.col("of"), "left")
    counted = counted.join(reached, F.col("head") == F.col("node"), "left").select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "head").alias("component_id")
    )
    others = read.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = counted.unionByName(others)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
