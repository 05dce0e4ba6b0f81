"""Embedding whitening over distinct quantised vectors.

Each entry ``c`` becomes the integer ``floor(64 * c) + 1000000``.  Rows with the same
integer vector ``x`` form a group that is counted by an aggregate (combined inside
tasks, so a vector that a third of all rows share is one row after them); groups are
told apart by a 128-bit digest.  The fit reads each distinct vector once, with
weight one or its count: exact integer sums, then centred blocks multiplied with
their weights inside tasks.  The blocks' products (dimension squared numbers a task)
are added by row of the matrix.  Its eigenvectors are found on the driver, which
holds just that matrix.  Each distinct vector is whitened once and joined back to
its rows by the digest; vectors with more than a thousandth of all rows (a thousand
vectors at most) are broadcast, so their rows do not meet in one task.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry
are dropped, as are rows whose vector's length is not the most frequent one (ties:
the longer); entries beyond +-2**52 / 64 count as that bound; repeated rows and null ids
give their rows; a deviation beyond a long is null; directions without variance (all
of them where there is one distinct vector) have no component; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
_BOUND = float(1 << 52)
_LONG = 1 << 63
#: A vector with more copies than this, and than a thousandth of all rows, is broadcast.
HOT_COPIES = 1_000
#: Dimensions whose matrix the driver may hold (128 MB).
MAX_DIMENSIONS = 4_096
SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def quantised(embeddings: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", with_x: bool = True) -> DataFrame:
    """(vec_id, key, x) of every row with a usable vector; ``key`` is x's digest."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite))

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            lengths = v.value_lengths().to_numpy()
            x = np.clip(np.floor(v.flatten().to_numpy() * SCALE), -_BOUND, _BOUND).astype("<i8") + SHIFT
            ends = np.cumsum(lengths)
            keys = [hashlib.blake2b(x[e - n:e], digest_size=16).digest() for e, n in zip(ends.tolist(), lengths.tolist())]
            columns = {"vec_id": batch.column("vec_id"), "key": pa.array(keys, pa.binary())}
            if with_x:
                columns["x"] = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(x))
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(quantise, "vec_id bigint, key binary" + (", x array<bigint>" if with_x else ""))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(key, x, copies): each distinct vector of the most frequent length once."""
    groups = common.stored(rows.groupBy("key", "x").agg(F.count("*").alias("copies")), "distinct-vectors")
    lengths = groups.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("d"))
    most = lengths.first()
    return groups.where(F.size("x") == (most.d if most else 0))


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy()


def _sums(vectors: DataFrame) -> tuple[int, list]:
    """Sum of the weights and weighted sums by dimension of (v, weight) rows:
    exact for whole numbers."""
    whole = dict(vectors.dtypes)["v"] == "array<bigint>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0
        for batch in batches:
            v, w = _matrix(batch.column("v")), _weights(batch)
            if not len(v):
                continue
            if whole and int(np.abs(v).max()) * int(w.sum()) >= _LONG:
                v, w = v.astype(object), w.astype(object)
            part = (w @ v).astype(object) if whole else w @ v
            total = part if total is None else total + part
            weight += int(w.sum())
        if total is not None:
            values = [Decimal(weight), *map(Decimal, total.tolist())] if whole else [float(weight), *total.tolist()]
            yield pa.RecordBatch.from_pydict({"pos": pa.array(range(len(values)), pa.int32()), "total": pa.array(
                values, pa.decimal128(38, 0) if whole else pa.float64())})

    kind = "decimal(38,0)" if whole else "double"
    sums = vectors.mapInArrow(add, f"pos int, total {kind}").groupBy("pos").agg(F.sum("total").alias("total"))
    found = {r.pos: r.total for r in sums.collect()}  # a row per dimension
    change = int if whole else float
    return int(found.get(0, 0)), [change(found[p]) for p in range(1, len(found))]


def _covariance(vectors: DataFrame, centred, n: int) -> np.ndarray:
    """Weighted products of the centred rows over ``n``; ``centred`` centres a block."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if len(batch):
                block = centred(_matrix(batch.column("v")))
                total = total + block.T @ (block * _weights(batch)[:, None])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(total)), pa.int32()), "row": pa.array(
                list(total), pa.list_(pa.float64()))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), _matrix(batch.column("row"))):
                totals[i] = totals[i] + row if i in totals else row.copy()
        yield pa.RecordBatch.from_pydict({"i": pa.array(list(totals), pa.int32()), "row": pa.array(
            list(totals.values()), pa.list_(pa.float64()))})

    schema = "i int, row array<double>"
    rows = vectors.mapInArrow(multiply, schema).repartition("i").mapInArrow(add, schema).collect()  # a row per dimension
    found = np.array([r.row for r in sorted(rows, key=lambda r: r.i)]) / n
    return (found + found.T) / 2


@dataclass(frozen=True)
class Whitening:
    """A fit: sum of weights, sums by dimension, axes as columns, their variances."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact (whole numbers of any size where a long is too small)."""
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums)) >= _LONG:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n).astype(float)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of the squared offsets, exact; None beyond a long."""
        off = self.offsets(x)
        if off.dtype != object and int(np.abs(off).max(initial=0)) ** 2 * off.shape[1] >= _LONG:
            off = off.astype(object)
        return [s if s < _LONG else None for s in (off * off).sum(axis=1).tolist()]


def _weight(weights: str) -> Column:
    if weights not in ("one", "copies"):
        raise ValueError(f"weights: one or copies, not {weights}")
    return F.lit(1).cast("long").alias("weight") if weights == "one" else F.col("copies").alias("weight")


def fit(distinct: DataFrame, *, components: int = COMPONENTS, weights: str = "one") -> Whitening | None:
    """Fit on the distinct vectors; None without any."""
    listed = distinct.select(F.col("x").alias("v"), _weight(weights))
    n, sums = _sums(listed)
    if not n:
        return None
    if len(sums) > MAX_DIMENSIONS:
        raise ValueError(f"{len(sums)} dimensions; the driver solves at most {MAX_DIMENSIONS}")
    blank = Whitening(n, sums, np.empty(0), np.empty(0), np.empty(0))
    values, vectors = np.linalg.eigh(_covariance(listed, blank.centred, n))
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values[:components] > values[0] * len(values) * np.finfo(float).eps).sum()) if values[0] > 0 else 0
    axes = vectors[:, :kept]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(kept)]) if kept else axes  # one sign for all runs
    return Whitening(n, sums, axes, values[:kept], values[:kept] / values.sum() if kept else values[:0])


def whitened_vectors(distinct: DataFrame, model: Whitening) -> DataFrame:
    """(key, copies, deviation, white): each distinct vector whitened once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column("x"))
                yield pa.RecordBatch.from_pydict({
                    "key": batch.column("key"), "copies": batch.column("copies"),
                    "deviation": pa.array(model.deviations(x), pa.int64()),
                    "white": pa.array(list(model.apply(x)), pa.list_(pa.float64()))})

    return distinct.select("key", "copies", "x").mapInArrow(run, "key binary, copies bigint, deviation bigint, white array<double>")


def identity_error(white: DataFrame, *, weights: str = "one") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    listed = white.select(F.col("white").alias("v"), _weight(weights))
    n, sums = _sums(listed)
    mean = np.array(sums) / n
    found = _covariance(listed, lambda v: v - mean, n)
    return float(np.abs(found - np.eye(len(found))).max())


def _join_back(rows: DataFrame, white: DataFrame) -> DataFrame:
    """Rows with their group's columns.  Frequent vectors are broadcast: at most a
    thousand have more than a thousandth of all rows each."""
    total = white.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    frequent = F.col("copies") > max(HOT_COPIES, total // 1_000)
    hot = F.broadcast(white.where(frequent))
    rest = rows.join(F.broadcast(white.where(frequent).select("key")), "key", "left_anti")
    return rows.join(hot, "key").unionByName(rest.join(white.where(~frequent), "key"))


def whiten(embeddings: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           weights: str = "one") -> DataFrame:
    """One row per usable row of ``embeddings`` and component (see ``SCHEMA``)."""
    distinct = distinct_vectors(quantised(embeddings, id_col=id_col, vec_col=vec_col))
    model = fit(distinct, components=components, weights=weights)
    if model is None or not len(model.variances):
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    white = common.stored(whitened_vectors(distinct, model), "whitened-vectors")
    error = identity_error(white, weights=weights)
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    joined = _join_back(quantised(embeddings, id_col=id_col, vec_col=vec_col, with_x=False), white)
    out = joined.select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      "whitened", F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))
