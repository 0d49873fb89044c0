"""Whitened embeddings by a covariance of distinct vectors, weighted by how often each occurs.

Entries become whole numbers x = floor(scale * c), so that many rows share one vector; any offset
added to x would shift its mean alike, and no result depends on one. Equal vectors are grouped
first; the number of rows of each (or one, ``weigh_copies=False``) is its weight in the fit. The
covariance is a sum of weighted, centred products of matrices, one per batch of distinct vectors:
sums of whole numbers give the exact mean, deviations from it are multiplied. Its eigenvectors
come from one small matrix on the driver, each distinct vector is whitened once and joined back
to its rows.

A vector travels as its key: the whole numbers in the least number of bytes that holds them all,
zeros at the end left out. Keys are equal just if vectors are.

A vector that a large part of the rows share is joined through several copies of its one row.
There are at most ``_HOT`` such vectors, found by their counts.

Rows whose vector is null or holds a null or a number that is not finite are dropped. A vector
shorter than the longest counts as if zeros followed; one without entries is all zeros. An entry
beyond +-2^62 in whole numbers counts as that. A null id stays null; repeated rows are each
kept. A component without variance has null as its whitened value, as nothing can be divided by
its root. A deviation that no long holds is null. An empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable

_WIDTHS = (1, 2, 4, 8)
_MOST = 2**62
_HOT = 1000
_ROWS = 8192


def _key(whole: np.ndarray) -> bytes:
    held = whole[: np.flatnonzero(whole)[-1] + 1] if whole.any() else whole[:0]
    low, high = (int(held.min()), int(held.max())) if len(held) else (0, 0)
    width = next(w for w in _WIDTHS if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return bytes([width]) + held.astype(f"<i{width}").tobytes()


def _vectors(keys: list[bytes], size: int) -> np.ndarray:
    """The whole numbers, one row per key."""
    rows = np.zeros((len(keys), size), np.int64)
    for row, key in zip(rows, keys, strict=True):
        held = np.frombuffer(key, f"<i{key[0]}", offset=1)
        row[: len(held)] = held
    return rows


def _exact(weights: np.ndarray, rows: np.ndarray) -> list[int]:
    """Weighted sums of the columns, in Python's numbers where 64 bits could overflow."""
    high = int(np.abs(rows).max(initial=0))
    if high * max(1, int(weights.sum())) < 2**63:
        return (weights @ rows).tolist()
    return (weights.astype(object) @ rows.astype(object)).tolist()


def keyed(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, key, size) of each row whose vector is whole and finite."""
    finite = F.forall(
        F.col("vector"),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))),
    )
    vectors = rows.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    ).where(F.col("vector").isNotNull() & finite)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            entries = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
            whole = np.clip(entries, -_MOST, _MOST).astype(np.int64)
            sizes = column.value_lengths()
            ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
            keys = [_key(whole[start:end]) for start, end in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), sizes], names=["id", "key", "size"]
            )

    return vectors.mapInArrow(encode, "id long, key binary, size int")


@dataclass
class Fit:
    """What every distinct vector is whitened with."""

    n: int
    sums: list[int]
    variances: np.ndarray  # falling; zero where there is none
    axes: np.ndarray  # dimensions x components
    total_variance: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """x - S/n: whole parts are subtracted exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (rows - whole).astype(float) - part

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        """NaN for a component without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            found = self.centred(rows) @ self.axes / np.sqrt(self.variances)
        found[:, self.variances <= 0] = np.nan
        return found

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n x - S)^2, exact."""
        high = max([abs(s) for s in self.sums], default=0) + self.n * int(np.abs(rows).max(initial=0))
        if high * high * max(1, rows.shape[1]) < 2**63:
            return ((self.n * rows - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        found = []
        for row in rows.tolist():
            exact = sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums, strict=True))
            found.append(exact if exact < 2**63 else None)
        return found


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            keys = part.column("key").to_pylist()
            yield keys, _vectors(keys, size), part.column("weight").to_numpy()


def _sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """The weights' sum and the exact weighted sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * size, 0
        for _, rows, weights in _batches(batches, size):
            total = [a + b for a, b in zip(total, _exact(weights, rows), strict=True)]
            n += int(weights.sum())
        if n:
            at = pa.array(range(-1, size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [at, pa.array([str(value) for value in (n, *total)])], names=["at", "value"]
            )

    parts = distinct.mapInArrow(add, "at int, value string")
    found = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    by_place = {row["at"]: int(row["value"]) for row in found.collect()}
    return by_place.get(-1, 0), [by_place.get(at, 0) for at in range(size)]


def _covariance(distinct: DataFrame, size: int, of: int, n: int, centred) -> np.ndarray:
    """Sum of weighted products of the ``of`` columns that ``centred`` makes, over ``n``.

    Each task sends its matrix row by row, and Spark brings equal rows of all tasks together.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((of, of)), False
        for _, rows, weights in _batches(batches, size):
            values = centred(rows)
            total += (values * weights[:, None]).T @ values
            seen = True
        if seen:
            at = pa.array(np.arange(of, dtype=np.int32))
            ends = pa.array(np.arange(of + 1, dtype=np.int32) * of)
            rows_ = pa.ListArray.from_arrays(ends, pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([at, rows_], names=["at", "row"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.stack(parts["row"].to_list()).sum(axis=0)
        return pd.DataFrame({"at": parts["at"].iloc[:1], "row": [total]})

    schema = "at int, row array<double>"
    added = distinct.mapInArrow(multiply, schema).groupBy("at").applyInPandas(add, schema)
    matrix = np.zeros((of, of))
    for row in added.collect():
        matrix[row["at"]] = row["row"]
    return (matrix + matrix.T) / (2 * n)


def fit(distinct: DataFrame, size: int, components: int) -> Fit | None:
    """From rows (key, weight); the covariance of ``size`` dimensions fits on the driver."""
    n, sums = _sums(distinct, size)
    if not n:
        return None
    found = Fit(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    covariance = _covariance(distinct, size, size, n, found.centred)
    variances, axes = np.linalg.eigh(covariance)
    found.total_variance = float(np.trace(covariance))
    # What rounding leaves of a variance that is none.
    variances[variances <= found.total_variance * size * np.finfo(float).eps] = 0
    best = np.argsort(-variances, kind="stable")[:components]
    found.variances, found.axes = variances[best], axes[:, best]
    return found


def whiten(
    docs: DataFrame,
    *,
    components: int = 32,
    scale: int = 64,
    weigh_copies: bool = True,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per remaining row of ``docs`` and component: (id, component, n, deviation,
    whitened, explained, identity_error)."""
    schema = (
        "id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    spark = docs.sparkSession
    rows = keyed(docs, id_column, vector_column, scale)
    counted = durable(rows.groupBy("key").agg(F.count("*").alias("rows"), F.max("size").alias("size")))
    total, size = (value or 0 for value in counted.agg(F.sum("rows"), F.max("size")).first())
    distinct = counted.select("key", (F.col("rows") if weigh_copies else F.lit(1).cast("long")).alias("weight"))
    model = fit(distinct, size, components) if size else None
    if model is None:
        return spark.createDataFrame([], schema)
    found = len(model.variances)

    def centred_whitened(vectors: np.ndarray) -> np.ndarray:
        return np.nan_to_num(model.whitened(vectors))

    of_whitened = _covariance(distinct, size, found, model.n, centred_whitened)
    identity = np.diag((model.variances > 0).astype(float))
    error = float(np.abs(of_whitened - identity).max(initial=0.0))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, vectors, rows_ in _batches(batches, size):
            values = model.whitened(vectors)
            flat = pa.array(values.ravel(), from_pandas=True)
            ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array(rows_),
                    pa.array(model.deviations(vectors), pa.int64()),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                names=["key", "rows", "deviation", "whitened"],
            )

    whitened = counted.select("key", F.col("rows").alias("weight")).mapInArrow(
        apply, "key binary, rows long, deviation long, whitened array<double>"
    )

    # A vector of more rows than this is hot; fewer than _HOT vectors can be.
    per_copy = -(-total // _HOT)
    copies = F.greatest(F.lit(1), F.ceil(F.col("rows") / per_copy).cast("int"))
    hot = counted.where(F.col("rows") > per_copy).select("key", copies.alias("copies"))
    deal = F.pmod(F.monotonically_increasing_id(), F.coalesce("copies", F.lit(1))).cast("int")
    dealt = rows.join(F.broadcast(hot), "key", "left").select("id", "key", deal.alias("copy"))
    once = whitened.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    each = dealt.join(once, ["key", "copy"]).select(
        "id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    share = model.variances / model.total_variance if model.total_variance else np.zeros(found)
    return each.select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit(share.tolist()), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
