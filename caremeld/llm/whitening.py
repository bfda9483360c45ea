"""Whitening of embeddings by principal components.

Entries become integers (``scaled``), so that counts, sums and distances are exact. Three passes read the vectors, none of them
shuffles them: one sums the dimensions, one the centred products (a matrix as wide as the vectors, whatever their
number), one projects. The components come from ``feast``. The projected rows, ``components`` numbers each, are written
once; their covariance, taken over all of them, says how far they are from white.

Vectors that are null or hold null or non-finite entries are left out, and so are those with an entry beyond ``LARGEST`` and
those whose length is not the commonest (of equally common ones the longest). Null ids are kept; repeated rows count each;
equal eigenvalues have any orthonormal vectors of their space. Components whose eigenvalue is zero but for rounding can't be
whitened and are left out, so one row, equal rows or an empty table give an empty result. Other columns are left
out. A task holds square matrices of the vectors' length, and so does the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm import feast
from caremeld.llm.shared import col, stored

#: Larger entries count as not finite: sums over a batch of scaled ones stay in 64 bits.
LARGEST = float(1 << 36)
SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def scaled(embedding: Column) -> Column:
    """Entries as whole numbers of 1/1024, moved by 100,000."""
    return F.transform(embedding.cast("array<double>"), lambda c: F.floor(c * 1024).cast("long") + 100_000)


def usable(vectors: DataFrame, id: str, embedding: str) -> DataFrame:
    """(vec_id, x) of the rows that can be used."""
    chosen = vectors.select(col(id).cast("long").alias("vec_id"), col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    return chosen.where(F.col("v").isNotNull() & finite).select("vec_id", scaled(F.col("v")).alias("x"))


def matrix_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def dimension_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, object)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                sums += matrix_of(batch, width).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))],
            names=["i", "n", "s"],
        )

    parts = rows.select("x").mapInArrow(add, "i int, n long, s decimal(38,0)")
    found = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    return found[0].n, [int(r.s) for r in found]


class Centre:
    """Subtracts the exact mean: the whole part as integers, the fraction of it after that."""

    def __init__(self, n: int, sums: list[int]):
        self.whole = np.array([s // n for s in sums], np.int64)
        self.fraction = np.array([s % n / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.fraction


def covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    width, centre = len(sums), Centre(n, sums)
    upper = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                centred = centre(matrix_of(batch, width))
                total += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], names=["i", "j", "total"]
        )

    parts = rows.select("x").mapInArrow(add, "i int, j int, total double")
    out = np.zeros((width, width))
    for i, j, total in parts.groupBy("i", "j").agg(F.sum("total")).collect():
        out[i, j] = out[j, i] = total / n
    return out


def projected(rows: DataFrame, n: int, sums: list[int], directions: np.ndarray) -> DataFrame:
    """(vec_id, deviation, w): the exact squared distance of n * x to the sums, and the whitened coordinates."""
    width, centre = len(sums), Centre(n, sums)
    exact = np.array(sums, object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch, width)
            w = np.ascontiguousarray(centre(x) @ directions)
            apart = n * x.astype(object) - exact
            squares = (apart * apart).sum(axis=1) if len(x) else []
            offsets = pa.array(np.arange(0, w.size + 1, directions.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    # beyond what a decimal holds there is no exact value to give
                    pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(offsets, pa.array(w.ravel())),
                ],
                names=["vec_id", "deviation", "w"],
            )

    return rows.mapInArrow(project, "vec_id long, deviation decimal(38,0), w array<double>")


def whitened(
    vectors: DataFrame, components: int = 8, id: str = "vec_id", embedding: str = "embedding", contour: feast.Contour = feast.Contour()
) -> DataFrame:
    """``SCHEMA``, a row for every usable vector and component.

    ``deviation`` is null where it has more than 38 digits.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id, embedding)
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    if common is None or not common.length:
        return spark.createDataFrame([], SCHEMA)
    rows = rows.where(F.size("x") == common.length)
    n, sums = dimension_sums(rows, common.length)
    spread = covariance(rows, n, sums)
    values, directions = feast.largest(spread, components, contour)
    k = len(values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    out = stored(projected(rows, n, sums, directions / np.sqrt(values)), "whitened")
    w = [F.get("w", F.lit(i)) for i in range(k)]
    products = out.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i + 1)]).first()
    error = max(abs(products[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i + 1))
    share = F.array(*[F.lit(float(v)) for v in values / np.trace(spread)])
    return out.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("i")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
