"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of nearness. So that the nearest are those of
the largest inner product, vectors first get one more coordinate that makes all of them equally long,
and queries get a zero there. Each shard of the vectors keeps
an inverted file: for each pivot the vectors that have it among their nearest, with its place. For
a query, the lists of its own nearest pivots are added up to the footrule distance of the two
orders (a pivot that only one of them has counts as the place after the last), the nearest by
footrule are ranked anew by inner product, and the shards' answers are merged.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visittrail.llm.common import prepare, stored

#: Pivots, taken from the vectors with the smallest hashes; and how many of them stand for a vector.
PIVOTS, NEAREST = 256, 64
#: Distinct vectors of a shard, about. Of a shard this share, and so many more, are ranked anew.
SHARD_ROWS, RERANK_SHARE, RERANK_LEAST = 8_192, 0.1, 512
#: Queries that one task searches a shard for, about.
QUERY_ROWS = 16_384


def valid(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(id, v): vectors in double precision, without null, empty, zero or non-finite ones."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"),
                          F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite
                       & F.exists("v", lambda x: x != 0))


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the coordinate that gives each the length of the longest one."""
    short = longest ** 2 - np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(short, 0))])


def as_queries(vectors: np.ndarray) -> np.ndarray:
    """The vectors with a zero in that coordinate: their products with lengthened ones stay."""
    return np.column_stack([vectors, np.zeros(len(vectors))])


def orders(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each vector (by direction), nearest first, ties to the earlier pivot."""
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    close = (vectors / np.where(size > 0, size, 1)) @ pivots.T
    return np.argsort(-close, axis=1, kind="stable")[:, :nearest]


class InvertedFile:
    """The posting lists of one shard."""

    def __init__(self, order: np.ndarray, pivots: int):
        self.rows, self.nearest = order.shape
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.ids = (by_pivot // self.nearest).astype(np.int32)
        self.places = (by_pivot % self.nearest).astype(np.int32)
        self.starts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """The footrule distance of each row's order to the query's."""
        k = self.nearest
        both = np.zeros(self.rows, dtype=np.int32)
        for place, pivot in enumerate(query):
            own = slice(self.starts[pivot], self.starts[pivot + 1])
            both[self.ids[own]] += k - np.maximum(self.places[own], place)
        # |p - q| where both have the pivot, k - p or k - q where one has: what is shared lessens it.
        return k * (k + 1) - 2 * both


def search_shard(ids: np.ndarray, vectors: np.ndarray, file: InvertedFile, query: np.ndarray,
                 order: np.ndarray, top: int, share: float, least: int):
    """Row numbers and inner products of the best rows of a shard, ties to smaller ids."""
    distance = file.footrule(order)
    most = min(len(ids), int(share * len(ids)) + least)
    if most < len(ids):
        limit = np.partition(distance, most - 1)[most - 1]
        some = np.flatnonzero(distance <= limit)  # ties at the limit are all ranked
    else:
        some = np.arange(len(ids))
    scores = np.einsum("ij,j->i", vectors[some], query)
    best = np.lexsort((ids[some], -scores))[:top]
    return some[best], scores[best]


def nearest_neighbours(vectors: DataFrame, is_query, top: int = 20, vector: str = "embedding",
                       vec_id: str = "vec_id", pivots: int = PIVOTS, nearest: int = NEAREST,
                       shard_rows: int = SHARD_ROWS, share: float = RERANK_SHARE,
                       least: int = RERANK_LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` rows with the largest inner products, as found.

    is_query: a column of vec_id that tells queries. A query's own row is left out, ties go to
    smaller ids. Rows whose id is null or whose vector is null, empty, zero or has null or
    non-finite parts take no part. Vectors of different lengths have no inner product: each length
    is searched by itself. Equal vectors are searched for once and as one: of them only the
    smallest top + 1 ids can be among the answers, and each query of a group has the group's
    answers without itself. A repeated id counts once for each different vector.
    """
    spark = prepare(vectors.sparkSession)
    rows = stored(valid(vectors, vector, vec_id), "vectors").withColumn("q", is_query(F.col("id")))
    lengths = rows.select(F.size("v").alias("n")).distinct().orderBy("n").collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, (
        _nearest_of_one_length(rows.filter(F.size("v") == r["n"]), top, pivots, nearest,
                               shard_rows, share, least) for r in lengths))


def _nearest_of_one_length(rows: DataFrame, top: int, pivots: int, nearest: int, shard_rows: int,
                           share: float, least: int) -> DataFrame:
    spark = rows.sparkSession
    place = Window.partitionBy("v").orderBy("id")
    first = rows.select("v", "id").distinct().withColumn("at", F.row_number().over(place))
    groups = first.filter(F.col("at") <= top + 1).groupBy("v").agg(
        F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.filter("q").select("v", F.lit(True).alias("q")).distinct()
    groups = groups.join(asked, "v", "left").select(
        F.col("ids")[0].alias("group"), "v", "ids", F.coalesce("q", F.lit(False)).alias("q"))
    groups = stored(groups, "vector-groups")

    size = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    longest = groups.agg(F.sqrt(F.max(size)).alias("n")).first()["n"]
    chosen = groups.orderBy(F.xxhash64("group"), "group").limit(pivots).select("v").collect()
    pivot = lengthened(np.array([r["v"] for r in chosen]), longest)
    pivot = pivot / np.linalg.norm(pivot, axis=1, keepdims=True)
    nearest = min(nearest, max(len(pivot) // 2, 1))
    sent = spark.sparkContext.broadcast((pivot, longest))
    with_order = groups.withColumn("o", _order_of(sent, nearest, False)("v")).withColumn(
        "asked", F.when(F.col("q"), _order_of(sent, nearest, True)(F.when(F.col("q"), F.col("v")))))
    with_order = stored(with_order, "permutations")

    shards = with_order.count() // shard_rows + 1
    slices = with_order.filter("q").count() // QUERY_ROWS + 1
    shard = F.pmod(F.xxhash64("group"), F.lit(shards)).cast("int")
    data = with_order.select(
        shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1).cast("int")))
        .alias("slice"), "group", "v", "o", F.lit(False).alias("is_query"))
    asks = with_order.filter("q").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1).cast("int"))).alias("shard"),
        F.pmod(F.xxhash64("group", F.lit(1)), F.lit(slices)).cast("int").alias("slice"),
        "group", "v", F.col("asked").alias("o"), F.lit(True).alias("is_query"))
    n_pivots = len(pivot)

    def search(table: pa.Table) -> pa.Table:
        return _searched(table, n_pivots, top, share, least)

    found = data.unionByName(asks).groupBy("shard", "slice").applyInArrow(
        search, "ask long, found long, score double")
    found = found.join(groups.select(F.col("group").alias("of"), "ids"),
                       F.col("found") == F.col("of"))
    each = found.select("ask", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    answers = each.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= top + 1)
    answers = answers.groupBy("ask").agg(F.array_sort(F.collect_list(
        F.struct("at", "vec_id", "score"))).alias("answers"))

    members = rows.filter("q").select("id", "v").distinct().join(
        groups.filter("q").select("v", "group"), "v")
    own = members.join(answers, F.col("group") == F.col("ask"))
    others = F.slice(F.filter("answers", lambda x: x["vec_id"] != F.col("id")), 1, top)
    return own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("i", "x")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"),
        F.col("x.score").alias("score"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.chunk(0)
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _order_of(sent, nearest: int, is_query: bool):
    @F.arrow_udf("array<int>")
    def order(values: pa.Array) -> pa.Array:
        there = values.is_valid()
        some = values.filter(there)
        if not len(some):
            return pa.nulls(len(values), pa.list_(pa.int32()))
        pivots, longest = sent.value
        matrix = _matrix(some)
        matrix = as_queries(matrix) if is_query else lengthened(matrix, longest)
        found = orders(matrix, pivots, nearest).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            np.arange(0, found.size + 1, nearest, dtype=np.int32), pa.array(found.ravel()))
        place = np.cumsum(there.to_numpy(zero_copy_only=False)) - 1
        return lists.take(pa.array(place, mask=~there.to_numpy(zero_copy_only=False)))

    return order


def _searched(table: pa.Table, pivots: int, top: int, share: float, least: int) -> pa.Table:
    ask = table.column("is_query").to_numpy()
    ids = table.column("group").to_numpy()
    vectors, order = _matrix(table.column("v")), _matrix(table.column("o"))
    own, rows = np.flatnonzero(~ask), []
    if len(own):
        own = own[np.argsort(ids[own], kind="stable")]
        file, some = InvertedFile(order[own], pivots), vectors[own]
        for i in np.flatnonzero(ask):
            at, scores = search_shard(
                ids[own], some, file, vectors[i], order[i], top + 1, share, least)
            rows.append((np.full(len(at), ids[i]), ids[own][at], scores))
    if not rows:
        rows = [(np.array([], np.int64),) * 2 + (np.array([], float),)]
    ask_ids, found, scores = (np.concatenate(x) for x in zip(*rows, strict=True))
    return pa.table({"ask": ask_ids.astype(np.int64), "found": found.astype(np.int64),
                     "score": scores.astype(float)})
