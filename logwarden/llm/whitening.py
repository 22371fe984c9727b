"""Embedding whitening over distinct vectors with their multiplicities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import stored

#: Entries become whole numbers: floor(STEP * c) + SHIFT.
STEP, SHIFT = 64, 1_000_000
#: Entries of this size or more have no exact place among 64-bit numbers; their vectors count as not finite.
TOO_LARGE = float(1 << 46)
#: A vector is common if it makes up at least this share of the rows, so that at most 1,000 different ones are.
COMMON_SHARE = 1_000
#: Components whose share of the largest variance is below this are rounding and have no rows.
LEAST_SHARE = 1e-12

RESULT = "{id}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def quantized(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows whose vector has entries, all of them finite; x holds whole numbers."""
    # NaN is larger than any number; an entry that does not fit is null
    number = lambda c: F.when(F.abs(c) < TOO_LARGE, F.floor(c * STEP).cast("long") + SHIFT)
    slim = rows.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col).cast("array<double>"), number).alias("x"))
    return slim.where(F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull()))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _total(parts: DataFrame, kind: str) -> list[tuple[int, object]]:
    """Sums of (at, value) by place, as many as the model has numbers, whatever the input."""
    return [(r["at"], r["value"]) for r in parts.groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()]


def _dense(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape[0] * shape[1])
    for at, value in _total(parts, "double"):
        out[at] = value
    return out.reshape(shape)


class Centre:
    """n vectors with sums S by dimension: S / n as a whole number and the rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.d = n, len(sums)
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=object)
        self.part = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once or twice."""
        return (x - self.whole) - self.part

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - S) ** 2, exact."""
        near = x - self.whole
        largest = int(np.abs(near).max(initial=0)) + 1
        if (self.n * largest) ** 2 * self.d < 1 << 62:
            return ((near * self.n - self.rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        return ((near.astype(object) * self.n - self.rest) ** 2).sum(axis=1).tolist()


def _second_moments(table: DataFrame, column: str, d: int, of) -> np.ndarray:
    """Weighted sum of outer products of the rows ``of(vectors)``, one matrix product a batch and one matrix a task."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = of(_matrix(batch.column(0), d))
                weights = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                product = (rows * weights[:, None]).T @ rows
                total = product if total is None else total + product
        if total is not None:
            flat = total.reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], ["at", "value"])

    return _dense(table.select(column, "weight").mapInArrow(partial, "at long, value double"), (d, d))


def whiten(rows: DataFrame, components: int = 32, weights: str = "counts", id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors become whole numbers x.  Equal ones are grouped; the fit takes each as often as it occurs (``weights``
    "counts") or once ("one"), which makes n vectors with sums S.  Components are eigenvectors of their covariance by
    falling variance; ``whitened`` is x - S / n along the component over its standard deviation, ``explained`` the
    component's share of all variance, ``deviation`` the exact sum of (n * x - S) ** 2, and ``identity_error`` the largest
    difference between the covariance of the whitened vectors and the identity.

    Every distinct vector is whitened once and joined back to its rows; those that make up a thousandth of the rows or
    more, at most 1,000, go to the rows by broadcast, so that a vector that fills a third of the table meets nowhere.
    The driver holds matrices of the vectors' length only.

    Rows whose vector is null, empty, or has null, non-finite or huge entries (2^46 and more) are left out, and so are
    vectors of another length than most rows have (of two such lengths the larger).  Components without variance have
    no rows; equal variances are told apart arbitrarily.  Null and repeated ids are kept like any other, an empty table
    gives an empty one, and other columns are not read.  Fits while this is called; a lost executor costs its tasks only.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be counts or one")
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    x = quantized(rows, id_col, vec_col)
    distinct = stored(x.groupBy("x").agg(F.count("*").alias("count")), "white-distinct")
    sizes = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("count").alias("rows"), F.count("*").alias("vectors"))
    most = sizes.orderBy(F.desc("rows"), F.desc("d")).first()
    empty = spark.createDataFrame([], RESULT.format(id=f"`{id_col}` {kind}"))
    if most is None:
        return empty
    d, n_rows = most["d"], most["rows"]
    n = n_rows if weights == "counts" else most["vectors"]
    distinct = distinct.where(F.size("x") == d).withColumn("weight", F.col("count") if weights == "counts" else F.lit(1).cast("long"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            product = _matrix(batch.column(0), d) * batch.column(1).to_numpy(zero_copy_only=False)[:, None]
            total = [a + int(b) for a, b in zip(total, product.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int64()), pa.array(map(str, total), pa.string())], ["at", "value"])

    centre = Centre(n, [int(v) for _, v in sorted(_total(distinct.select("x", "weight").mapInArrow(sums, "at long, value string"), "decimal(38,0)"))])
    covariance = _second_moments(distinct, "x", d, centre.centred) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > LEAST_SHARE * max(values.max(), 0)]
    if not len(order):
        return empty
    variances, axes = values[order], vectors[:, order]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
    scaled = axes / np.sqrt(variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = _matrix(batch.column(0), d)
            z = centre.centred(numbers) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.reshape(-1)))
            exact = pa.array(map(str, centre.deviation(numbers)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), exact, lists], ["x", "count", "weight", "deviation", "z"])

    white = distinct.select("x", "count", "weight").mapInArrow(project, "x array<long>, count long, weight long, deviation string, z array<double>")
    white = stored(white.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")), "white-vectors")
    # centred vectors stay centred along the components
    identity = _second_moments(white, "z", len(order), lambda z: z) / n
    error = float(np.abs(identity - np.eye(len(order))).max())

    found = white.select("x", "deviation", "z")
    common = F.broadcast(white.where(F.col("count") * COMMON_SHARE >= n_rows).select("x", "deviation", "z"))
    here = x.where(F.size("x") == d)
    joined = here.join(common, "x").unionByName(here.join(common.select("x"), "x", "left_anti").join(found, "x"))
    shares = F.array(*[F.lit(float(v / np.trace(covariance))) for v in variances])
    return joined.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
