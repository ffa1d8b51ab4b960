"""Near duplicates by 64-bit SimHash and a generalised pigeonhole search.

Two fingerprints that differ in at most D bits, cut into M parts whose limits t_i add up to
D - M + 1, differ in at most t_i bits of some part i (a limit of -1 stands for a part that need not
be looked at). Correlated bits share a part, each row's limits are chosen by dynamic programming
over the candidates that they are estimated to bring, each row is posted under its parts and looks
at every value within its limits, and each pair found that way is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from visittrail.llm.common import free_name, prepare, stored, utf8, with_row_number
from visittrail.llm.components import connected_components

BITS = 64
#: Bits of a part that its histogram is kept by; a histogram has at most 2 ** this entries.
HISTOGRAM_BITS = 16
#: A posted value with more rows than this is dealt out over several tasks.
BLOCK_ROWS = 4096

_shingle_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint_of(text: bytes, shingle: int) -> int:
    """The SimHash of one text, unsigned; zero if it has no words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(_shingle_hash, parts), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(shingle: int = 3):
    """A column function: text to fingerprint, as a signed long of the same bits."""
    @arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        found = [fingerprint_of(t, shingle) for t in utf8(texts)]
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return simhash


# --- the plan of the search: parts of the 64 bits, and a histogram of each -------------------


def bit_parts(together: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits dealt into equal parts, each filled with the bits most correlated with its own.

    together[i, j] counts the fingerprints in which both bits are set.
    """
    share = together / max(rows, 1)
    one = np.diag(share)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    close = np.abs(share - np.outer(one, one)) / np.outer(spread, spread)
    np.fill_diagonal(close, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        room = len(left) // (parts - k)
        rest = sorted(left)
        seed = max(rest, key=lambda b: close[b, rest].sum())
        part = [seed]
        left.discard(seed)
        while len(part) < room:
            nearest = max(sorted(left), key=lambda b: close[b, part].mean())
            part.append(nearest)
            left.discard(nearest)
        out.append(sorted(part))
    return out


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, rows = np.zeros((BITS, BITS)), 0
    for batch in batches:
        bits = _bits(_unsigned(batch.column(0))).astype(np.float32)
        counts += bits.T @ bits
        rows += len(bits)
    yield pa.RecordBatch.from_pydict({"counts": [counts.ravel().tolist()], "rows": [rows]})


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _bits(values: np.ndarray) -> np.ndarray:
    rows = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little")


def project(bits: np.ndarray, part: list[int]) -> np.ndarray:
    """The part's bits as a number."""
    return bits[:, part].astype(np.int64) @ (1 << np.arange(len(part), dtype=np.int64))


def _histogram(batches: Iterator[pa.RecordBatch], parts: list[list[int]]):
    sums = [np.zeros(1 << min(len(p), HISTOGRAM_BITS), dtype=np.int64) for p in parts]
    for batch in batches:
        bits = _bits(_unsigned(batch.column(0)))
        for counts, part in zip(sums, parts, strict=True):
            counts += np.bincount(project(bits, part[:HISTOGRAM_BITS]), minlength=len(counts))
    for i, counts in enumerate(sums):
        values = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": np.full(len(values), i, dtype=np.int32),
            "value": values.astype(np.int64), "n": counts[values],
        })


def within(counts: np.ndarray, width: int, most: int) -> np.ndarray:
    """expected[r, v]: rows estimated to agree with v in all but r bits of a part, r up to most.

    Bits beyond the histogram count as fair coins.
    """
    seen = min(width, HISTOGRAM_BITS)
    at = np.arange(len(counts))
    exact = [counts.astype(float)]
    for r in range(1, most + 1):
        total = np.zeros(len(counts))
        for flipped in combinations(range(seen), r):
            total += counts[at ^ sum(1 << b for b in flipped)]
        exact.append(total)
    rest = width - seen
    tail = [_choose(rest, r) / 2.0 ** rest for r in range(most + 1)]
    by_distance = [sum(exact[s] * tail[r - s] for s in range(r + 1)) for r in range(most + 1)]
    return np.cumsum(by_distance, axis=0)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out if k <= n else 0


def allocate(costs: np.ndarray, distance: int) -> np.ndarray:
    """limits[row, part], adding up to distance - parts + 1, at the least total cost.

    costs[part, limit + 1, row]; limit runs from -1 to distance.
    """
    parts, choices, rows = costs.shape
    total = distance + 1  # of limit + 1 over all parts
    best = np.full((parts + 1, total + 1, rows), np.inf)
    pick = np.zeros((parts + 1, total + 1, rows), dtype=np.int8)
    best[0, 0] = 0
    for i in range(parts):
        for given in range(total + 1):
            for c in range(min(given, choices - 1) + 1):
                cost = best[i, given - c] + costs[i, c]
                better = cost < best[i + 1, given]
                best[i + 1, given][better] = cost[better]
                pick[i + 1, given][better] = c
    limits = np.empty((rows, parts), dtype=np.int8)
    given, row = np.full(rows, total), np.arange(rows)
    for i in range(parts, 0, -1):
        c = pick[i, given, row]
        limits[:, i - 1] = c - 1
        given = given - c
    return limits


# --- probing and verifying ------------------------------------------------------------------


def _flips(width: int, limit: int) -> np.ndarray:
    """Every change of at most limit bits of a part; no change comes first."""
    return np.array([
        sum(1 << b for b in flipped)
        for r in range(limit + 1) for flipped in combinations(range(width), r)
    ], dtype=np.int64)


def _postings(batches, parts: list[list[int]], histograms, distance: int):
    """(part, value, kind, fp): each row posted under each part, and each value it looks at."""
    counts = histograms.value
    most = min(distance, 2) if len(parts) > 1 else distance
    near = [within(c, len(p), most) for c, p in zip(counts, parts, strict=True)]
    flips = [[_flips(len(p), t) for t in range(most + 1)] for p in parts]
    # A value looked at costs about as much as a candidate verified.
    for batch in batches:
        values = _unsigned(batch.column(0))
        bits = _bits(values)
        at = [project(bits, p) for p in parts]
        costs = np.zeros((len(parts), most + 2, len(values)))
        for i, part in enumerate(parts):
            seen = at[i] & ((1 << min(len(part), HISTOGRAM_BITS)) - 1)
            for t in range(most + 1):
                costs[i, t + 1] = near[i][t][seen] + len(flips[i][t])
        limits = allocate(costs, distance)
        for i in range(len(parts)):
            kinds = np.where(limits[:, i] >= 0, 3, 1)
            yield _posting_rows(i, at[i], values, kinds)
            for t in range(1, most + 1):
                own = limits[:, i] == t
                if own.any():
                    for flip in flips[i][t][1:]:
                        yield _posting_rows(i, at[i][own] ^ flip, values[own], 2)


def _posting_rows(part: int, at: np.ndarray, values: np.ndarray, kind) -> pa.RecordBatch:
    """kind: 1 for a value posted, 2 for one looked at, 3 for both."""
    return pa.RecordBatch.from_pydict({
        "part": np.full(len(at), part, dtype=np.int8), "value": at,
        "kind": np.full(len(at), kind, dtype=np.int8), "fp": values.view(np.int64),
    })


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def forest(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each value the index of the smallest value that links a-b connect it with."""
    parent = np.arange(len(values))
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        low, high = np.minimum(ra[open_], rb[open_]), np.maximum(ra[open_], rb[open_])
        np.minimum.at(parent, high, low)
        parent = _roots(parent)


def _close_in(values: np.ndarray, looks: np.ndarray, posts: np.ndarray, distance: int):
    """Links within one group of rows that share a value, one for each row that is not alone."""
    size = len(values)
    parent = np.arange(size)
    rows = np.flatnonzero(looks)
    cols = np.flatnonzero(posts)
    step = max(1, (1 << 20) // max(len(cols), 1))
    for at in range(0, len(rows), step):
        some = rows[at:at + step]
        close = np.bitwise_count(values[some][:, None] ^ values[cols][None, :]) <= distance
        i, j = np.nonzero(close)
        a, b = parent[some[i]], parent[cols[j]]
        keep = a != b
        if keep.any():
            joined = forest(values, a[keep], b[keep])
            parent = joined[parent]
    linked = np.flatnonzero(parent != np.arange(size))
    return values[linked], values[parent[linked]]


def _verified(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group that a batch cuts is kept for the next one."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        group = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                          for i in range(3)])
        fp = _unsigned(batch.column(3))
        kind = batch.column(4).to_numpy(zero_copy_only=False)
        if rest is not None:
            group = np.concatenate([rest[0], group], axis=1)
            fp, kind = np.concatenate([rest[1], fp]), np.concatenate([rest[2], kind])
        if not len(fp):
            continue
        starts = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])
        cut = starts[-1]
        rest = [group[:, cut:], fp[cut:], kind[cut:]]
        yield from _groups(starts[:-1], cut, fp, kind, distance)
    if rest is not None and len(rest[1]):
        yield from _groups(np.array([0]), len(rest[1]), rest[1], rest[2], distance)


def _groups(starts: np.ndarray, end: int, fp: np.ndarray, kind: np.ndarray, distance: int):
    sizes = np.diff(np.r_[starts, end])
    small = (sizes > 1) & (sizes <= 8)
    a, b = [], []
    for step in range(1, 8):  # rows of small groups against those some places on, all at once
        first, length = starts[small & (sizes > step)], sizes[small & (sizes > step)] - step
        if not len(first):
            break
        at = np.repeat(first - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())
        to = at + step
        ok = (((kind[at] & 2) > 0) & ((kind[to] & 1) > 0)) | (
            ((kind[at] & 1) > 0) & ((kind[to] & 2) > 0))
        ok &= np.bitwise_count(fp[at] ^ fp[to]) <= distance
        ok &= fp[at] != fp[to]
        a.append(fp[at][ok])
        b.append(fp[to][ok])
    for k in np.flatnonzero(sizes > 8):
        own = slice(starts[k], starts[k] + sizes[k])
        values, inverse = np.unique(fp[own], return_inverse=True)
        kinds = np.zeros(len(values), dtype=np.int64)
        np.bitwise_or.at(kinds, inverse, kind[own].astype(np.int64))
        x, y = _close_in(values, (kinds & 2) > 0, (kinds & 1) > 0, distance)
        a.append(x)
        b.append(y)
    if a and sum(map(len, a)):
        yield pa.RecordBatch.from_pydict({
            "a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})


def fingerprint_links(fps: DataFrame, distance: int = 3, parts: int = 3) -> DataFrame:
    """(a, b): links that connect what pairs at most `distance` bits apart connect.

    fps: distinct fingerprints in a column fp, stored. Of a group that shares a posted value only
    links that connect it are returned, never all its pairs. A value with more than BLOCK_ROWS
    rows is split into blocks, and each two blocks meet in a task of their own.
    """
    spark = fps.sparkSession
    gram = fps.select("fp").mapInArrow(_together, "counts array<double>, rows long")
    sums = gram.select(F.posexplode("counts"), "rows").groupBy("pos").agg(
        F.sum("col").alias("n"), F.sum("rows").alias("rows")).orderBy("pos").collect()
    together = np.array([r["n"] for r in sums] or [0.0] * BITS ** 2).reshape(BITS, BITS)
    dealt = bit_parts(together, sums[0]["rows"] if sums else 0, parts)

    counts = [np.zeros(1 << min(len(p), HISTOGRAM_BITS), dtype=np.int64) for p in dealt]
    tables = fps.select("fp").mapInArrow(
        lambda rows: _histogram(rows, dealt), "part int, value long, n long")
    for r in tables.groupBy("part", "value").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["part"]][r["value"]] = r["n"]
    histograms = spark.sparkContext.broadcast(counts)

    rows = fps.select("fp").mapInArrow(
        lambda batches: _postings(batches, dealt, histograms, distance),
        "part byte, value long, kind byte, fp long",
    )
    sizes = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(sizes.filter(F.col("n") > BLOCK_ROWS).select(
        F.col("part").alias("p"), F.col("value").alias("v"),
        F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "simhash-hot")
    placed = rows.join(hot, (F.col("part") == F.col("p")) & (F.col("value") == F.col("v")), "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda x: (F.least(own, x) * blocks + F.greatest(own, x)).cast("int"))
    dealt_rows = placed.select(
        "part", "value", F.explode(F.when(blocks == 1, F.array(F.lit(0))).otherwise(cells))
        .alias("cell"), "fp", "kind",
    )
    grouped = dealt_rows.repartition("part", "value", "cell").sortWithinPartitions(
        "part", "value", "cell")
    return grouped.mapInArrow(
        lambda batches: _verified(batches, distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id in its group.

    Words are split at ASCII white space after A-Z are lower-cased. Texts that are null or have no
    words get fingerprint zero and are linked like any other. Rows without an id belong to a
    group but never name it (null if none of the group has an id). Repeated rows stay.
    """
    prepare(docs.sparkSession)
    prints = stored(docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint(shingle)(F.col(text)).alias("fp")), "simhash")
    return prints.join(group_names(prints, distance), "fp").select("doc_id", "fp", "component_id")


def group_names(prints: DataFrame, distance: int = 3, name: str = "doc_id") -> DataFrame:
    """(fp, component_id): the smallest `name` of all rows whose fingerprints are connected."""
    nodes = stored(prints.groupBy("fp").agg(F.min(name).alias("least")), "simhash-nodes")
    of = connected_components(fingerprint_links(nodes, distance)).withColumnRenamed("node", "fp")
    named = nodes.join(of, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(least, "component").select("fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                distance: int = 3) -> DataFrame:
    """The rows of docs less near copies: of each group the row with the smallest id stays.

    Of rows with one id, and of rows without an id (which come last), the first one read stays.
    All columns stay as they are.
    """
    prepare(docs.sparkSession)
    row, fp = free_name(docs, "row"), free_name(docs, "fp")
    numbered = stored(with_row_number(docs.withColumn(fp, fingerprint(shingle)(F.col(text))), row),
                      "simhash-rows")
    prints = numbered.select(
        F.col(fp).alias("fp"), F.struct(
            F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"),
            F.col(row).alias("row")).alias("name"))
    kept = group_names(prints, distance, "name").select(
        F.col("component_id.row").alias("kept_row")).distinct()
    return numbered.join(kept, F.col(row) == F.col("kept_row"), "left_semi").select(*docs.columns)
