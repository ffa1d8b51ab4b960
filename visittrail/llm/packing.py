"""Packing documents into few sequences by linear grouping and few-size configurations.

Lengths above a share of the sequence are sorted and cut into groups of equal count; each group is
rounded up to its longest member, so that few sizes are left. The cutting-stock problem over these
sizes is solved by column generation: each configuration is a multiset of sizes that fits. Actual
documents then take the places of the rounded sizes, and all others fill the room that is left, the
longest first, each where it leaves the least room.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visittrail.llm.bestfit import Bins
from visittrail.llm.common import prepare, stored
from visittrail.llm.tokens import tokenized

#: Pieces that one task packs, about; pieces are dealt to groups by hash.
GROUP_ROWS = 50_000
#: Lengths above this share of a sequence are grouped, into so many sizes.
LARGE_SHARE, SIZES = 1 / 3, 20


def linear_groups(lengths: np.ndarray, sizes: int) -> list[np.ndarray]:
    """Indices of the lengths, longest first, in at most `sizes` groups of equal count."""
    order = np.argsort(-lengths, kind="stable")
    return [g for g in np.array_split(order, min(sizes, max(len(order), 1))) if len(g)]


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, most_rounds: int = 400):
    """(uses, patterns): how often each pattern is used, not rounded; sizes are distinct.

    The simplex method over patterns: the best new pattern comes from an unbounded knapsack on the
    present prices, until none has a value above one.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    uses = counts / np.diag(basis)
    for _ in range(most_rounds):
        prices = np.linalg.solve(basis.T, np.ones(m))
        pattern, worth = _knapsack(sizes, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, pattern)
        ratio = np.full(m, np.inf)
        up = change > 1e-9
        ratio[up] = uses[up] / change[up]
        leaves = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaves]):
            break
        step = ratio[leaves]
        uses = uses - step * change
        uses[leaves] = step
        basis[:, leaves] = pattern
    return np.maximum(uses, 0), basis.T.round().astype(int)


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The multiset of sizes within the capacity that is worth most."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    good = np.flatnonzero(prices > 1e-12)
    for i in good:
        # Few of a large size fit, so take one more of it as often as that can happen.
        for _ in range(capacity // sizes[i]):
            other = best[:-sizes[i]] + prices[i]
            better = other > best[sizes[i]:] + 1e-12
            if not better.any():
                break
            best[sizes[i]:][better] = other[better]
            last[sizes[i]:][better] = i
    pattern = np.zeros(len(sizes))
    at = capacity
    while last[at] >= 0:
        pattern[last[at]] += 1
        at -= sizes[last[at]]
    return pattern, float(pattern @ prices)


def pack(lengths: np.ndarray, capacity: int, large_share: float = LARGE_SHARE,
         sizes: int = SIZES) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length."""
    lengths = np.asarray(lengths, dtype=np.int64)
    where, offset = np.full(len(lengths), -1), np.zeros(len(lengths), np.int64)
    bins = Bins(capacity)
    full = np.flatnonzero(lengths == capacity)
    for i in full:
        where[i] = bins.new()
    large = np.flatnonzero((lengths > large_share * capacity) & (lengths < capacity))
    if len(large):
        _pack_large(lengths, large, capacity, sizes, bins, where, offset)
    rest = np.flatnonzero(where < 0)
    for i in rest[np.argsort(-lengths[rest], kind="stable")]:
        where[i], offset[i] = bins.best_fit(int(lengths[i]))
    return where, offset


def _pack_large(lengths, large, capacity, sizes, bins, where, offset) -> None:
    queues: dict[int, list[int]] = {}
    for group in linear_groups(lengths[large], sizes):
        members = large[group]
        # Groups that round up to one size become one; the longest members come out first.
        queues.setdefault(int(lengths[members].max()), []).extend(members.tolist())
    rounded = np.array(sorted(queues, reverse=True))
    waiting = [queues[s][::-1] for s in rounded]
    counts = np.array([len(q) for q in waiting], dtype=float)
    uses, patterns = configurations(rounded, counts, capacity)
    # Whole uses only: what the fractions leave over is placed best fit with the small ones.
    for n, pattern in zip(np.floor(uses + 1e-6).astype(int), patterns, strict=True):
        for _ in range(n):
            own = [waiting[k].pop() for k in np.flatnonzero(pattern)
                   for _ in range(min(pattern[k], len(waiting[k])))]
            if not own:
                break
            bin_, at = bins.new(), 0
            for i in own:
                where[i], offset[i] = bin_, at
                at += int(lengths[i])
            bins.offer(bin_, capacity - at)


def packed(docs: DataFrame, path: str, length: int = 4096, end_id: int = 1, text: str = "text",
           doc_id: str = "doc_id", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): each piece and its place.

    Null texts are empty documents (just end_id); only documents longer than `length` are cut;
    rows are never merged, whatever their doc_id. Pieces are dealt by hash to groups of about
    group_rows, each packed in one task; a group leaves a few unfilled sequences at most. An empty
    table gives no row.
    """
    prepare(docs.sparkSession)
    pieces = stored(tokenized(docs, path, length, end_id, text, doc_id), "pieces")
    groups = pieces.count() // group_rows + 1
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        where, offset = pack(rows["length"].to_numpy(), length)
        rows["sequence_id"] = (rows["group"].to_numpy().astype(np.int64) << 32) + where
        rows["offset"] = offset
        return rows.drop(columns="group")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " \
        "sequence_id long, offset long"
    types = dict(pieces.dtypes)
    schema = schema.replace("doc_id long", f"doc_id {types['doc_id']}")
    return dealt.groupBy("group").applyInPandas(place, schema)
