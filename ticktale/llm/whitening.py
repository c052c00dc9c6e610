"""Embedding whitening from a covariance weighted by multiplicity.

Entries become integers, ``x = floor(SCALE * c) + OFFSET``. Rows with the same
x vector are one group: the covariance is fitted on the distinct vectors, each
weighted by its count (``weights="count"``) or by one (``weights="one"``), as
matrix products of the centred vectors that the tasks add up. Each distinct
vector is projected and scaled once and joined back to its rows.

The driver gets sums per dimension, the dimension x dimension covariance and
the component x component check matrix, never a vector. A vector that holds
more than 1/``HOT`` of all rows joins by a broadcast table, which thus has
fewer than ``HOT`` rows whatever the input; the other groups are small and
join by shuffle.

Defined results: rows whose vector is null, empty or holds a null, NaN or
infinite entry are left out; of vectors of unequal length only those of the
most frequent length (the longer one in a tie) are used; repeated rows and null
ids are rows like any other; entries beyond +-2**53 count as that bound; a
``deviation`` beyond 64 bits is null; a component whose eigenvalue is zero to
double precision has a null ``whitened``; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktale.llm.common import stored

SCALE, OFFSET = 64.0, 1_000_000
LIMIT = 2.0 ** 53
HOT = 1024
BATCH = 4096                # vectors of one matrix product
WIDTHS = (1, 2, 4, 8)


# ---------------------------------------------------------------- x vectors as bytes
def encode_rows(y: np.ndarray) -> list[bytes]:
    """One byte string per row of integers: the width of the entries, then the
    entries. Equal rows and only they have equal strings."""
    top = np.abs(y).max(axis=1)
    width = np.select([top < 1 << 7, top < 1 << 15, top < 1 << 31], WIDTHS[:3], WIDTHS[3])
    out: list[bytes] = [b""] * len(y)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        body = np.ascontiguousarray(y[at].astype(f"<i{w}"))
        for i, row in zip(at, body):
            out[i] = bytes([w]) + row.tobytes()
    return out


def decode_rows(keys: list[bytes], dims: int) -> np.ndarray:
    out = np.empty((len(keys), dims), np.int64)
    for i, k in enumerate(keys):
        out[i] = np.frombuffer(k, f"<i{k[0]}", offset=1)
    return out


def _encode(batches):
    """(carried, vector) to (carried, dims, key) for the rows that can be used."""
    for b in batches:
        lists = b.column(1)
        values = lists.flatten()            # without the entries of null rows
        flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False)     # null entries become NaN
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        ends = np.cumsum(sizes)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
        ok = (sizes > 0) & (bad[ends] == bad[ends - sizes])
        for dims in np.unique(sizes[ok]):
            rows = np.flatnonzero(ok & (sizes == dims))
            c = flat[(ends[rows] - dims)[:, None] + np.arange(dims)]
            y = np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dims, np.int32)),
                 pa.array(encode_rows(y), pa.binary())], names=["carried", "dims", "key"])


def _batches_of(batches, dims: int):
    """(record batch, x) in pieces of at most ``BATCH`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            part = b.slice(at, BATCH)
            yield part, decode_rows(part.column("key").to_pylist(), dims) + OFFSET


# ---------------------------------------------------------------- sums and products
def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S without rounding: 64-bit integers where they suffice, Python's
    otherwise."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squared_lengths(dev: np.ndarray) -> list[int | None]:
    """Sum of squares per row, None beyond 64 bits."""
    top = int(abs(dev).max()) if dev.size else 0
    if top * top * dev.shape[1] >= 1 << 63:
        dev = dev.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (dev * dev).sum(axis=1)]


def _sum_rows(dims: int):
    """Weighted sums of a task's x vectors, as decimals."""
    def run(batches):
        total = [0] * dims
        for b, x in _batches_of(batches, dims):
            w = b.column("weight").to_numpy()
            if int(np.abs(x).max()) * int(w.sum()) < 1 << 62:
                part = (w[:, None] * x).sum(axis=0)
            else:
                part = (w[:, None].astype(object) * x).sum(axis=0)
            total = [t + int(p) for t, p in zip(total, part)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(map(str, total), pa.string())],
                                         names=["dim", "total"])
    return run


def sums_of(distinct: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Sum of the weights, and of weight times x per dimension, exact."""
    n = distinct.agg(F.sum("weight")).first()[0]
    rows = (distinct.select("key", "weight").mapInArrow(_sum_rows(dims), "dim int, total string")
            .groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    by_dim = {r["dim"]: int(r["total"]) for r in rows}
    return n, [by_dim[i] for i in range(dims)]


def _product_rows(centred, size: int):
    """Weighted product of a task's centred vectors, one row per dimension."""
    def run(batches):
        total = np.zeros((size, size))
        for w, z in centred(batches):
            total += (z * w[:, None]).T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([TaskContext.get().partitionId()] * size, pa.int32()),
             pa.array(list(total), pa.list_(pa.float64()))], names=["dim", "part", "products"])
    return run


def _add_products(t: pa.Table) -> pa.Table:
    rows = sorted(zip(t.column("part").to_pylist(), t.column("products").to_pylist()))
    total = np.sum([p for _, p in rows], axis=0)
    return pa.table({"dim": t.column("dim").slice(0, 1), "products": pa.array([total], pa.list_(pa.float64()))})


def covariance(rows: DataFrame, centred, size: int, n: int) -> np.ndarray:
    """``centred(batches)`` yields (weights, centred vectors); divisor ``n``.
    A group of the sum holds one row per task."""
    parts = rows.mapInArrow(_product_rows(centred, size), "dim int, part int, products array<double>")
    got = {r["dim"]: r["products"] for r in
           parts.groupBy("dim").applyInArrow(_add_products, "dim int, products array<double>").collect()}
    return np.array([got[i] for i in range(size)]) / n


def eigenvectors(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, list]:
    """The first eigenvalues (0 where they are zero to double precision) and
    vectors (columns), falling, and each one's share of the trace."""
    e, v = np.linalg.eigh((cov + cov.T) / 2)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    trace = float(np.trace(cov))
    e = np.where(e > len(cov) * np.finfo(float).eps * max(e[0], 0.0), e, 0.0)
    return e, v, [x / trace if trace > 0 else None for x in e.tolist()]


# ---------------------------------------------------------------- operator
def whiten(df: DataFrame, vector_col: str = "embedding", carry: tuple[str, ...] = ("vec_id",),
           components: int = 32, weights: str = "count") -> DataFrame:
    """``carry`` columns, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``: a row for each usable
    row and component."""
    if weights not in ("count", "one"):
        raise ValueError(weights)
    carried = F.struct(*[F.col(c) for c in carry]).alias("carried")
    source = df.select(carried, F.col(vector_col).alias("vector"))
    kind = source.schema["carried"].dataType
    rows = stored(source.mapInArrow(_encode, f"carried {kind.simpleString()}, dims int, key binary"), "whiten-rows")
    common = rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return _answer(rows.select("carried", F.lit(None).cast("long").alias("deviation"),
                                   F.array().cast("array<double>").alias("values")), carry, 0, [], None)
    dims = common["dims"]
    rows = rows.where(F.col("dims") == dims).select("carried", "key")
    distinct = rows.groupBy("key").agg(F.count("*").alias("copies"))
    distinct = stored(distinct.withColumn("weight", F.col("copies") if weights == "count" else F.lit(1).cast("long")),
                      "whiten-distinct")
    n, sums = sums_of(distinct, dims)

    def centred(batches):
        for b, x in _batches_of(batches, dims):
            yield b.column("weight").to_numpy(), exact_deviations(x, n, sums).astype(np.float64) / n
    values, vectors, explained = eigenvectors(covariance(distinct.select("key", "weight"), centred, dims, n), components)
    scale = np.where(values > 0, 1.0 / np.sqrt(np.where(values > 0, values, 1.0)), np.nan)
    k = len(values)

    def project(batches):
        for b, x in _batches_of(batches, dims):
            dev = exact_deviations(x, n, sums)
            white = (dev.astype(np.float64) / n) @ vectors * scale
            flat = pa.array(white.ravel(), pa.float64(), from_pandas=True)          # NaN becomes null
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(squared_lengths(dev), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * k, pa.int32()), flat)],
                names=["key", "copies", "weight", "deviation", "values"])
    white = stored(distinct.select("key", "copies", "weight").mapInArrow(
        project, "key binary, copies long, weight long, deviation long, values array<double>"), "whiten-values")

    live = int((values > 0).sum())
    error = None
    if live:
        means = [r["m"] for r in white.select("weight", F.posexplode("values").alias("i", "v")).groupBy("i").agg(
            (F.sum(F.col("v") * F.col("weight")) / n).alias("m")).orderBy("i").collect()][:live]

        def centred_values(batches):
            for b in batches:
                v = b.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[:, :live]
                yield b.column("weight").to_numpy(), v - np.array(means)
        check = covariance(white.select("weight", "values"), centred_values, live, n)
        error = float(np.abs(check - np.eye(live)).max())

    value_of = white.select("key", "deviation", "values")
    hot = F.broadcast(value_of.join(white.where(F.col("copies") * HOT > rows.count()).select("key"), "key", "left_semi"))
    both = rows.join(hot, "key").unionByName(
        rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(value_of, "key"))
    return _answer(both, carry, n, explained, error)


def _answer(rows: DataFrame, carry, n: int, explained: list, error: float | None) -> DataFrame:
    shares = F.array(*[F.lit(x).cast("double") for x in explained] or [F.lit(None).cast("double")])
    each = rows.select("carried", "deviation", F.posexplode("values").alias("i", "whitened"))
    return each.select(*[F.col("carried").getField(c).alias(c) for c in carry],
                       (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("i")).alias("explained"),
                       F.lit(error).cast("double").alias("identity_error"))
