"""Whitening of embeddings: blockwise QR of the centred rows, then a bidiagonal solver of R.

Each task reduces its centred rows, block by block, to one triangle; triangles are merged in a
tree over the cluster until one is left, as large as the dimension squared. Its singular values
and right vectors (``bidiagonal``) are those of the centred rows, which are never multiplied with
each other, so small variances keep their accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm import bidiagonal
from fleetgauge.llm.common import ship_package, stage

#: Scaled entries are whole numbers up to this; beyond it one counts as not finite.
MOST = 1 << 31


@dataclass(frozen=True)
class WhiteningSettings:
    scale: int = 1024
    offset: int = 100_000
    components: int = 8
    #: Rows that are reduced at once.
    block: int = 4096
    #: Triangles that a task merges.
    fan: int = 16
    #: Least singular value of a component, as a share of the largest.
    least: float = 1e-11


@dataclass(frozen=True)
class Whitening:
    """``n`` rows with sums ``sums``; unit ``directions`` as columns, variances and their total."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total: float
    settings: WhiteningSettings


def usable(rows: DataFrame, settings: WhiteningSettings = WhiteningSettings()) -> DataFrame:
    """``vec_id, embedding`` of rows with a vector of finite entries of the most common length.

    Of lengths equally common the longest counts. Empty vectors are left out.
    """
    finite = F.forall("embedding", lambda c: F.coalesce(
        F.abs(c.cast("double") * settings.scale) <= MOST - settings.offset, F.lit(False))
        & ~F.isnan(c))
    sized = rows.select("vec_id", "embedding").filter(
        F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    common = sized.groupBy(F.size("embedding").alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).first()
    return sized.filter(F.size("embedding") == (common.d if common else 0))


def _scaled(batch: pa.RecordBatch, settings: WhiteningSettings) -> np.ndarray:
    """Entries as whole numbers, a row per vector."""
    column = batch.column("embedding")
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(settings.scale * entries).astype(np.int64) + settings.offset).reshape(
        len(column), -1)


def _sums(vectors: DataFrame, settings: WhiteningSettings) -> tuple[int, tuple[int, ...]]:
    """Number of vectors, and the sum of each dimension."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _scaled(batch, settings)
                n, sums = n + len(x), x.sum(axis=0) + (0 if sums is None else sums)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "sums": [sums]})

    parts = stage(vectors.mapInArrow(of, "n long, sums array<long>"), "sums")
    n = parts.agg(F.sum("n")).first()[0] or 0
    sums = parts.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    return n, tuple(r.s for r in sorted(sums))


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``, rounded once: whole parts cancel exactly."""
    return (x - sums // n).astype(float) - (sums % n) / n


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square."""
    d = rows.shape[1]
    if len(rows) < d:
        rows = np.vstack([rows, np.zeros((d - len(rows), d))])
    return np.linalg.qr(rows, mode="r")


def triangle(vectors: DataFrame, n: int, sums: tuple[int, ...],
             settings: WhiteningSettings = WhiteningSettings()) -> np.ndarray:
    """R of the centred rows: one triangle per task, merged by ``fan`` at a time."""
    total, d = np.array(sums, np.int64), len(sums)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, r = [], 0, np.zeros((0, d))
        for batch in batches:
            if batch.num_rows:
                held.append(_centred(_scaled(batch, settings), n, total))
                rows += batch.num_rows
            if rows >= settings.block:
                r, held, rows = _triangle(np.vstack([r, *held])), [], 0
        if held or len(r):
            r = _triangle(np.vstack([r, *held]))
            yield pa.RecordBatch.from_pydict({"r": [r.ravel()]})

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([r.reshape(d, d) for r in parts.sort_values("id")["r"]])
        return pd.DataFrame({"id": parts["part"].iloc[:1], "r": [_triangle(stacked).ravel()]})

    made = stage(vectors.mapInArrow(reduce_rows, "r array<double>")
                 .select(F.spark_partition_id().cast("long").alias("id"), "r"), "triangles")
    left = made.count()
    while left > 1:
        left = -(-left // settings.fan)
        made = stage(made.withColumn("part", F.pmod("id", F.lit(left))).groupBy("part")
                     .applyInPandas(merge, "id long, r array<double>"), "triangles")
        left = made.count()
    return np.array(made.first().r).reshape(d, d)


def fit_whitening(vectors: DataFrame,
                  settings: WhiteningSettings = WhiteningSettings()) -> Whitening | None:
    """The whitening of all ``vectors``; None if there is none.

    Only one triangle and the sums come to the driver. Components whose singular value is below
    ``least`` of the largest have no variance to speak of and are left out. Of the two signs that
    is taken for which a direction's largest entry is positive.
    """
    n, sums = _sums(vectors, settings)
    if not n:
        return None
    r = triangle(vectors, n, sums, settings)
    a, b, v = bidiagonal.bidiagonal(r)
    values, inner = bidiagonal.right_vectors(a, b, min(settings.components, len(a)))
    kept = values > 0
    if kept.any():
        kept &= np.sqrt(values) >= settings.least * np.sqrt(values.max())
    directions = (v @ inner)[:, kept]
    largest = np.argmax(np.abs(directions), axis=0)
    directions = directions * np.sign(directions[largest, np.arange(directions.shape[1])])
    return Whitening(n, sums, directions, values[kept] / n, float((r * r).sum() / n), settings)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of ``(n * x - sums) ** 2`` of each row, exactly; None if 64 bits do not hold it."""
    whole, rest = x - sums // n, sums % n
    about = ((float(n) * whole - rest) ** 2).sum(axis=1)
    if about.max(initial=0.0) < 2.0 ** 62:
        return ((n * whole - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True))
             for row in whole.tolist()]
    return [value if value < 1 << 63 else None for value in exact]


def apply_whitening(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` of each vector: its components in order, as an array."""
    total, n, settings = np.array(model.sums, np.int64), model.n, model.settings
    onto = model.directions / np.sqrt(model.variances)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _scaled(batch, settings)
            projected = _centred(x, n, total) @ onto
            width = onto.shape[1]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(_deviation(x, n, total), pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * width, pa.int32()),
                    pa.array(projected.ravel()))], ["vec_id", "deviation", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(of, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, width: int) -> float:
    """Largest entry of the covariance of ``whitened`` less the identity. The rows are centred."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((width + 1, width))
        for batch in batches:
            w = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            found += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"parts": [found.ravel()]})

    rows = whitened.select("whitened").mapInArrow(of, "parts array<double>").select(
        F.posexplode("parts")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    parts = np.array([r.s for r in sorted(rows)]).reshape(width + 1, width) / n
    covariance = parts[:-1] - np.outer(parts[-1], parts[-1])
    return float(np.abs(covariance - np.eye(width)).max())


COLUMNS = ("vec_id {}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def whiten(rows: DataFrame, settings: WhiteningSettings = WhiteningSettings()) -> DataFrame:
    """Per usable row and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.

    Rows without a vector, or with an entry that is null or not finite, are left out, see
    ``usable``; repeated rows count as often as they occur, null ids stay. Components are numbered
    from 1 by falling variance; there are at most as many as dimensions with variance, so a table
    of one row, or of equal rows, has no result row. ``deviation`` is null beyond 64 bits. Other
    columns are not read.
    """
    spark = rows.sparkSession
    ship_package(spark)
    vectors = usable(rows, settings)
    model = fit_whitening(vectors, settings)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.variances):
        return spark.createDataFrame([], COLUMNS.format(kind))
    whitened = stage(apply_whitening(vectors, model), "whitened")
    error = identity_error(whitened, model.n, len(model.variances))
    shares = F.array(*[F.lit(float(v / model.total)) for v in model.variances])
    return whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
