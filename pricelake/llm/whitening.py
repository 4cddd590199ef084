"""Whitening of embeddings by the eigenvectors of their covariance.

Three passes over the vectors, none with more than a matrix leaving a task: exact sums, the centred covariance, and the
covariance of what whitening gives, as its check. Partial matrices are merged row by row, a bounded number at a time. The
driver gets one matrix of the vectors' width, decomposes it in single precision and corrects that in higher (`eigen`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.eigen import components
from pricelake.llm.tables import by_batch, table
from pricelake.session import cut

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000    # an entry c becomes floor(64 c) + 1,000,000
LARGEST = 1 << 62               # scaled entries end here on both sides
HALF = 31                       # entries are summed as high and low halves, which cannot overflow
FAN_IN = 256                    # partial matrices that one task merges


def usable(column: pa.Array) -> np.ndarray:
    """The length of each vector, or -1 where it is null or has a null or non-finite entry."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    bad = ~pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
    sums = np.concatenate([[0], np.cumsum(bad)])
    ends = np.cumsum(lengths)
    broken = sums[ends] > sums[ends - lengths]
    return np.where(broken | pc.is_null(column).to_numpy(zero_copy_only=False), -1, lengths)


def scaled(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The given rows, all of one length, as integers."""
    chosen = column.take(pa.array(np.flatnonzero(rows)))
    values = chosen.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values * SCALE), -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT
    return whole.reshape(len(chosen), -1)


@dataclass(frozen=True)
class Sums:
    """How many vectors are fitted, their width, and the exact sum of every dimension."""

    n: int
    width: int
    sums: list[int]

    @property
    def centre(self) -> np.ndarray:
        """The integers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times the centre, less the sums: exact, and no larger than half of n."""
        return np.array([self.n * int(m) - s for m, s in zip(self.centre, self.sums, strict=True)], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the means, as doubles; the integers are subtracted first, so nothing is lost."""
        return (x - self.centre).astype(np.float64) + self.rest / self.n


@dataclass(frozen=True)
class Whitening:
    """A fit: its sums, eigenvalues and unit eigenvectors of the leading components, their shares, and the check."""

    sums: Sums
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projections of unit variance; 0 for a component without variance."""
        some = self.values > 0
        return (self.sums.centred(x) @ self.vectors) * np.where(some, 1 / np.sqrt(np.where(some, self.values, 1)), 0)


def sums_of(vectors: DataFrame, column: str) -> Sums | None:
    """Sums of the vectors of the commonest length, the longer one at a tie; None if no vector can be used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            lengths = usable(batch.column(0))
            for width in np.unique(lengths[lengths >= 0]).tolist():
                x = scaled(batch.column(0), lengths == width)
                own = found.setdefault(width, [0, np.zeros(width, np.int64), np.zeros(width, np.int64)])
                own[0] += int((lengths == width).sum())
                own[1] += (x >> HALF).sum(0, dtype=np.int64) if width else 0
                own[2] += (x & ((1 << HALF) - 1)).sum(0, dtype=np.int64) if width else 0
        for width, (n, high, low) in found.items():
            # place -1 counts the vectors
            yield pa.RecordBatch.from_pydict({
                "width": pa.array(np.full(width + 1, width, np.int32)), "place": pa.array(np.arange(-1, width, dtype=np.int32)),
                "high": pa.array(np.append(0, high)), "low": pa.array(np.append(n, low))})

    partial = vectors.select(column).mapInArrow(run, "width int, place int, high long, low long")
    wide = "decimal(38,0)"
    totals = cut(partial.groupBy("width", "place").agg(F.sum(F.col("high").cast(wide)).alias("high"),
                                                       F.sum(F.col("low").cast(wide)).alias("low")), "vector-sums")
    most = totals.filter("place = -1").orderBy(F.col("low").desc(), F.col("width").desc()).first()
    if most is None or most.width == 0:
        return None
    rows = totals.filter((F.col("width") == most.width) & (F.col("place") >= 0)).orderBy("place").collect()
    return Sums(int(most.low), most.width, [(int(r.high) << HALF) + int(r.low) for r in rows])


def _added(rows: pa.Table) -> pa.Table:
    values = rows["values"].combine_chunks()
    total = values.flatten().to_numpy().reshape(len(values), -1).sum(0)
    return pa.table({"part": rows["part"][:1], "i": rows["i"][:1], "values": pa.array([total], pa.list_(pa.float64()))})


def gram(vectors: DataFrame, column: str, width: int, size: int, made: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of this width of u u', u being what `made` makes of a vector: a matrix of `size` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((size, size)), False
        for batch in batches:
            chosen = usable(batch.column(0)) == width
            if chosen.any():
                u, some = made(scaled(batch.column(0), chosen)), True
                total += u.T @ u
        if some:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(size, TaskContext.get().partitionId(), np.int64)),
                "i": pa.array(np.arange(size, dtype=np.int32)),
                "values": pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), size).cast(pa.list_(pa.float64()))})

    schema = "part long, i int, values array<double>"
    partial = cut(vectors.select(column).mapInArrow(run, schema), "partial-matrices")
    while (most := partial.filter("i = 0").count()) > FAN_IN:
        groups = -(-most // FAN_IN)
        merged = partial.withColumn("part", F.pmod("part", F.lit(groups))).groupBy("i", "part").applyInArrow(_added, schema)
        partial = cut(merged, "partial-matrices")
    rows = partial.groupBy("i").applyInArrow(_added, schema).toArrow().sort_by("i")
    return rows["values"].combine_chunks().flatten().to_numpy().reshape(size, size)


def fit(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """Learn the whitening of all usable vectors; see `whitened` for what is left out. None if there is none."""
    sums = sums_of(vectors, column)
    if sums is None:
        return None
    covariance = gram(vectors, column, sums.width, sums.width, sums.centred) / sums.n
    values, axes = components((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    values, axes = values[:most], axes[:, :most]
    values = np.where(values > values[0] * sums.width * np.finfo(np.float64).eps, values, 0)
    found = Whitening(sums, values, axes, values / trace if trace > 0 else np.zeros(len(values)))
    k = len(values)
    moments = gram(vectors, column, sums.width, k + 1,
                   lambda x: np.hstack([np.ones((len(x), 1)), found.whiten(x)])) / sums.n
    spread = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    some = values > 0
    error = np.abs(spread - np.eye(k))[np.ix_(some, some)].max(initial=0)
    return Whitening(sums, values, axes, found.explained, float(error))


def _deviations(sums: Sums, x: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact; null beyond 38 digits."""
    low = x - sums.centre
    reach = sums.n * (int(np.abs(low).max(initial=0)) + 1)
    if reach * reach * sums.width < 1 << 63:
        return pa.array(((low * sums.n + sums.rest) ** 2).sum(1)).cast(pa.decimal128(38, 0))
    exact = (((row * sums.n + sums.rest.astype(object)) ** 2).sum() for row in low.astype(object))
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], pa.decimal128(38, 0))


def whitened(vectors: DataFrame, fitted: Whitening | None, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """For each usable vector: `key`, deviation (decimal, exact) and whitened, an array with a double for each component.

    Left out are null vectors, vectors with a null or non-finite entry, and those of another length than the fitted one, which
    is the commonest. Scaled entries end at 2^62. Components without variance whiten to 0. Repeated rows count each,
    equal eigenvalues get some basis of their space, and an empty table gives no rows. Only the two named columns are read.
    """
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"_key {kind}, deviation decimal(38,0), whitened array<double>"

    def work(batch: pa.RecordBatch) -> dict | None:
        chosen = usable(batch.column(1)) == fitted.sums.width
        if not chosen.any():
            return None
        x = scaled(batch.column(1), chosen)
        made = fitted.whiten(x)
        places = np.arange(0, made.size + 1, made.shape[1], dtype=np.int32)
        return {"_key": batch.column(0).filter(pa.array(chosen)), "deviation": _deviations(fitted.sums, x),
                "whitened": pa.ListArray.from_arrays(pa.array(places), pa.array(made.ravel()))}

    narrow = vectors.select(F.col(key).alias("_key"), F.col(column).alias("_vector"))
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("_key", key)
    return by_batch(narrow, schema, work).withColumnRenamed("_key", key)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding and each of its leading components, whitened over all of them."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = fit(vectors)
    rows = whitened(vectors, fitted).select(
        "vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("_at", "whitened"))
    share = F.array(*map(F.lit, fitted.explained.tolist())) if fitted else F.array().cast("array<double>")
    return rows.select("vec_id", (F.col("_at") + 1).alias("component"), F.lit(fitted.sums.n if fitted else 0).cast("long").alias("n"),
                       "deviation", "whitened", F.get(share, F.col("_at")).alias("explained"),
                       F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))
