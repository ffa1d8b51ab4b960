"""Whitening of embeddings on the covariance of distinct vectors.

Vectors become integer vectors. Equal ones are grouped before anything is computed; the covariance
takes each group with weight one or with its number of copies, centred before it is multiplied. Each
distinct vector is whitened once and joined back to the rows that hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visittrail.llm.common import prepare, stored

#: An entry c becomes floor(SCALE * c) + SHIFT; scaled entries beyond 2^52 count as 2^52.
SCALE, SHIFT, FARTHEST = 64, 1_000_000, float(1 << 52)

SCHEMA = """vec_id {}, dims int, component int, n long, deviation long, whitened double,
    explained double, identity_error double"""


def integer_vector(vector: Column) -> Column:
    """The entries as integers, or null unless all are present and finite."""
    whole = vector.cast("array<double>")
    finite = F.forall(whole, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def scaled(c: Column) -> Column:
        near = F.greatest(F.least(c * F.lit(float(SCALE)), F.lit(FARTHEST)), F.lit(-FARTHEST))
        return F.floor(near) + F.lit(SHIFT)

    return F.when(finite, F.transform(whole, scaled))


class Space:
    """What is fitted on the distinct vectors of one length."""

    def __init__(self, weight: int, sums: list[int]):
        self.n, self.sums = weight, sums
        # S / n as whole part and rest, so that x - S / n is exact before it becomes a double.
        self.whole = np.array([s // weight for s in sums], dtype=np.int64)
        self.rest = [s % weight for s in sums]
        self.part = np.array([r / weight for r in self.rest])

    def fit(self, covariance: np.ndarray, components: int) -> None:
        """Axes by falling eigenvalue; those of no variance beyond rounding are left out."""
        values, axes = np.linalg.eigh(covariance)
        values, axes = values[::-1], axes[:, ::-1]
        least = max(values[0], 0) * len(values) * np.finfo(float).eps
        kept = min(components, int((values > least).sum()))
        axes = axes[:, :kept]
        signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(kept)])
        self.axes = axes * signs / np.sqrt(values[:kept])
        self.explained = (values[:kept] / np.trace(covariance)).tolist()

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each vector, exact; null where a long cannot hold it."""
        off = x - self.whole
        farthest = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if farthest ** 2 * max(x.shape[1], 1) < 2 ** 63:
            near = off * self.n - np.array(self.rest, dtype=np.int64)
            return (near * near).sum(axis=1).tolist()
        far = off.astype(object) * self.n - np.array(self.rest, dtype=object)
        return [s if s < 2 ** 63 else None for s in (far * far).sum(axis=1).tolist()]


def whitened(vectors: DataFrame, components: int = 16, weights: str = "one",
             vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, dims, component, n, deviation, whitened, explained, identity_error) by row and axis.

    Rows whose vector is null or has null or non-finite entries are left out; any other row counts,
    also with a null or repeated vec_id. weights: "one" fits on each distinct integer vector once,
    "count" with its number of copies; n is the sum of weights. Vectors of different lengths share
    no covariance: each length (`dims`) is a space of its own, fitted and numbered by itself.
    Axes without variance give no rows (so one distinct vector, or empty ones, give none).
    deviation is null where a long cannot hold it. Other columns are left out; an empty table
    gives no rows.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be 'one' or 'count', not {weights!r}")
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), integer_vector(F.col(vector)).alias("x")
    ).filter("size(x) > 0")
    kind = dict(rows.dtypes)["vec_id"]
    weight = F.lit(1).cast("long") if weights == "one" else F.count(F.lit(1))
    fit = stored(rows.groupBy("x").agg(weight.alias("weight")), "distinct-vectors")

    spaces = _spaces(fit)
    if not spaces:
        return spark.createDataFrame([], SCHEMA.format(kind))
    sent = spark.sparkContext.broadcast(spaces)
    covariances = _covariances(fit, "x", lambda dims, x: sent.value[dims].centred(x))
    for dims, space in spaces.items():
        space.fit(covariances[dims] / space.n, components)
    sent = spark.sparkContext.broadcast(spaces)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, x, w, own in _spaces_of(batch, "x"):
                space = sent.value[dims]
                values = space.centred(x) @ space.axes
                ends = np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]
                yield pa.record_batch({
                    "x": batch.column("x").take(pa.array(own)), "weight": pa.array(w),
                    "dims": pa.array([dims] * len(x), pa.int32()),
                    "deviation": pa.array(space.deviations(x), pa.int64()),
                    "w": pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))})

    fields = "x array<bigint>, weight long, dims int, deviation long, w array<double>"
    each = stored(fit.mapInArrow(project, fields), "whitened-vectors")

    models = []
    for dims, error in _identity_errors(each, spaces).items():
        space = spaces[dims]
        models += [(dims, i, space.n, e, error) for i, e in enumerate(space.explained)]
    model = spark.createDataFrame(
        models, "dims int, i int, n long, explained double, identity_error double")
    back = rows.join(each.drop("weight"), "x").select(
        "vec_id", "dims", "deviation", F.posexplode("w").alias("i", "whitened"))
    return back.join(model, ["dims", "i"]).select(
        "vec_id", "dims", (F.col("i") + 1).alias("component"), "n", "deviation", "whitened",
        "explained", "identity_error")


def _spaces_of(batch: pa.RecordBatch, column: str):
    """(dims, matrix, weights, row numbers) for each space in a batch."""
    lists, weight = batch.column(column), batch.column("weight").to_numpy()
    own_dims = "dims" in batch.schema.names
    spaces = batch.column("dims") if own_dims else lists.value_lengths()
    spaces = spaces.to_numpy(zero_copy_only=False)
    for dims in np.unique(spaces):
        own = np.flatnonzero(spaces == dims)
        some = lists if len(own) == len(spaces) else lists.take(pa.array(own))
        flat = some.flatten().to_numpy(zero_copy_only=False)
        yield int(dims), flat.reshape(len(own), flat.size // len(own)), weight[own], own


def _exact_sum(x: np.ndarray, w: np.ndarray) -> list[int]:
    most = int(np.abs(x).max(initial=0)) * int(w.max(initial=1)) * len(x)
    if most < 2 ** 62:
        return (w @ x).tolist()
    return (w.astype(object) @ x.astype(object)).tolist()


def _spaces(fit: DataFrame) -> dict[int, Space]:
    """Weight and sums by length of vector, exact: whole numbers are added up as decimals."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for dims, x, w, _ in _spaces_of(batch, "x"):
                new = [*_exact_sum(x, w), sum(w.tolist())]
                sums[dims] = [a + b for a, b in zip(sums.get(dims, [0] * len(new)), new,
                                                    strict=True)]
        for dims, own in sums.items():
            yield pa.record_batch({
                "dims": pa.array([dims] * len(own), pa.int32()),
                "i": pa.array(range(len(own)), pa.int32()),
                "s": pa.array([str(v) for v in own])})

    parts = fit.mapInArrow(add, "dims int, i int, s string")
    total = parts.groupBy("dims", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found: dict[int, list[int]] = {}
    for row in total.orderBy("dims", "i").collect():
        found.setdefault(row["dims"], []).append(int(row["s"]))
    return {dims: Space(own[-1], own[:-1]) for dims, own in found.items()}


def _covariances(frame: DataFrame, column: str,
                 centred: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Sum of w (x - mean)(x - mean)^T by length: a matrix product a batch, one result a task."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, x, w, _ in _spaces_of(batch, column):
                off = centred(dims, x)
                sums[dims] = sums.get(dims, 0) + (off * w[:, None]).T @ off
        for dims, own in sums.items():
            i, j = np.triu_indices(len(own))
            yield pa.record_batch({
                "dims": pa.array(np.full(len(i), dims), pa.int32()),
                "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                "v": pa.array(own[i, j])})

    some = frame.select(column, "weight", *(["dims"] if "dims" in frame.columns else []))
    parts = some.mapInArrow(multiply, "dims int, i int, j int, v double")
    total = parts.groupBy("dims", "i", "j").agg(F.sum("v").alias("v")).toArrow()
    dims, i, j, v = (total.column(c).to_numpy() for c in ("dims", "i", "j", "v"))
    found = {}
    for one in np.unique(dims).tolist():
        own = dims == one
        size = int(i[own].max()) + 1
        matrix = np.zeros((size, size))
        matrix[i[own], j[own]] = matrix[j[own], i[own]] = v[own]
        found[one] = matrix
    return found


def _identity_errors(each: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """How far the covariance of the whitened vectors is from the identity, by length."""
    axes = each.select("dims", "weight", F.posexplode("w").alias("i", "v"))
    sums = axes.groupBy("dims", "i").agg(F.sum(F.col("v") * F.col("weight")).alias("s"))
    means = {dims: np.zeros(space.axes.shape[1]) for dims, space in spaces.items()}
    for row in sums.collect():
        means[row["dims"]][row["i"]] = row["s"] / spaces[row["dims"]].n
    found = _covariances(each, "w", lambda dims, w: w - means[dims])
    return {dims: float(np.abs(c / spaces[dims].n - np.eye(len(c))).max())
            for dims, c in found.items()}
