"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are streamed through it,
and the length of the longest run that ends at each word is kept: at least `window` means that the
last `window` words are a window of an item. Stretches of a document whose neighbouring word pairs
are not all known pairs of the items cannot hold a window and are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visittrail.llm.common import WORD_BYTES, free_name, plain_words, prepare, stored, utf8

WINDOW = 10
#: Bytes of item text that one automaton holds; more items go to further automata, one after another.
BLOCK_BYTES = 8 << 20


class SuffixAutomaton:
    """Every run of words of every item, and the items in which its windows lie."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Items with a window that ends in a state, by state; and items shorter than a window.
        self.windows: dict[int, set[str | None]] = {}
        self.short: dict[int, dict[int, set[str | None]]] = {}
        self.pairs: set[tuple[int, int]] = set()
        coded = [
            (item, [self.words.setdefault(w, len(self.words) + 1) for w in words])
            for item, words in items if words
        ]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
            self.pairs.update(zip(codes, codes[1:], strict=False))
        self.shortest = min([window, *(len(codes) for _, codes in coded)])
        for item, codes in coded:
            for i, (state, length) in enumerate(self.stream(codes)):
                if length >= window:
                    self.windows.setdefault(self.at_length(state, window), set()).add(item)
                if i == len(codes) - 1 < window - 1:
                    state = self.at_length(state, len(codes))
                    self.short.setdefault(state, {}).setdefault(len(codes), set()).add(item)
        base = len(self.words) + 1
        self.pair_codes = np.array(sorted(a * base + b for a, b in self.pairs), dtype=np.int64)

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, known, c)
        state = self._state(self.length[last] + 1, {}, 0)
        while last != -1 and c not in self.next[last]:
            self.next[last][c] = state
            last = self.link[last]
        if last != -1:
            to = self.next[last][c]
            exact = self.length[to] == self.length[last] + 1
            self.link[state] = to if exact else self._clone(last, to, c)
        return state

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, last: int, to: int, c: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while last != -1 and self.next[last].get(c) == to:
            self.next[last][c] = copy
            last = self.link[last]
        return copy

    def stream(self, codes) -> Iterator[tuple[int, int]]:
        """For each word the state and length of the longest run that ends there."""
        state = length = 0
        step, link, longest = self.next, self.link, self.length
        for c in codes:
            to = step[state].get(c)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = step[state].get(c)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            yield state, length

    def at_length(self, state: int, length: int) -> int:
        """The state of the last `length` words of a run in `state`."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str | None]]:
        """Which words lie in a window, and the items of these windows."""
        hit, found = np.zeros(len(words), dtype=bool), set()
        get = self.words.get
        codes = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        for start, end in self._stretches(codes):
            runs = self.stream(codes[start:end].tolist())
            for i, (state, length) in enumerate(runs, start + 1):
                if length >= self.window:
                    hit[i - self.window:i] = True
                    found |= self.windows[self.at_length(state, self.window)]
                if self.short and length:
                    self._short_hits(state, length, i, hit, found)
        return hit, found

    def _short_hits(self, state, length, end, hit, found) -> None:
        while state:
            for n, items in self.short.get(state, {}).items():
                if n <= length:
                    hit[end - n:end] = True
                    found |= items
            state = self.link[state]
            length = self.length[state]

    def _stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of known neighbours that are long enough for the shortest window."""
        if self.shortest <= 1:
            known = codes > 0
            extra = 0
        else:
            keys = codes[:-1] * (len(self.words) + 1) + codes[1:]
            at = np.searchsorted(self.pair_codes, keys)
            at[at == len(self.pair_codes)] = 0
            known = (self.pair_codes[at] == keys) if len(self.pair_codes) else keys < 0
            extra = 1
        edges = np.diff(np.r_[0, known.astype(np.int8), 0])
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            if b - a + extra >= self.shortest:
                yield a, b + extra


def automata(benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
             window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[SuffixAutomaton]:
    """One automaton for each `block_bytes` of item texts, built when asked for.

    Benchmarks are small; what the driver holds is bounded by the block, not by the table. A single
    item longer than a block makes a block of its own.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    block, size = [], 0
    for row in items.toLocalIterator():
        words = plain_words((row["text"] or "").encode())
        if block and size + len(row["text"] or "") > block_bytes:
            yield SuffixAutomaton(block, window)
            block, size = [], 0
        block.append((row["item"], words))
        size += len(row["text"] or "")
    yield SuffixAutomaton(block, window)


HITS = "struct<n_words: bigint, runs: array<struct<start: int, end: int>>, items: array<string>>"


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return [{"start": int(a), "end": int(b)} for a, b in
            zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)]


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "hits",
              keep: list[str] | None = None, **options) -> DataFrame:
    """The columns to keep (all, if None), and `name`: (n_words, runs of hit words, items found).

    Each automaton is sent to the executors once; further ones add to what the earlier ones found.
    """
    spark = prepare(docs.sparkSession)
    columns = [c for c in docs.columns if keep is None or c in keep]
    carried = docs.select(*dict.fromkeys([*columns, text]))
    carried = carried.withColumn(name, F.lit(None).cast(HITS))
    for i, automaton in enumerate(automata(benchmark, **options)):
        if i:
            carried = stored(carried, "decontaminate")
        sent = spark.sparkContext.broadcast(automaton)
        carried = carried.withColumn(name, _hits_of(sent)(F.col(text), F.col(name)))
    return carried.select(*columns, name)


def _hits_of(sent):
    @F.arrow_udf(HITS)
    def hits(texts: pa.Array, before: pa.Array) -> pa.Array:
        automaton = sent.value
        counts, runs, items = [], [], []
        for t, earlier in zip(utf8(texts), before.to_pylist(), strict=True):
            words = plain_words(t)
            hit, found = automaton.hits(words)
            if earlier and earlier["n_words"] is not None:
                for r in earlier["runs"]:
                    hit[r["start"]:r["end"]] = True
                found |= set(earlier["items"])
            counts.append(len(words))
            runs.append(_runs(hit))
            items.append(sorted(found, key=lambda x: (x is not None, x or "")))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(runs, _RUNS),
             pa.array(items, pa.list_(pa.string()))], ["n_words", "runs", "items"])

    return hits


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  doc_id: str = "doc_id", **options) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or wordless text has no words and no hits. Items that are null or wordless have no
    window; an item without an id is counted but not named in the digest; items that share an id
    count once. Repeated documents each give a row.
    """
    found = find_hits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                      benchmark, keep=["doc_id"], **options)
    n_hit = F.aggregate("hits.runs", F.lit(0).cast("long"),
                        lambda n, r: n + (r["end"] - r["start"]).cast("long"))
    # The items come sorted, an item without an id first.
    return found.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  most_covered: float = 0.5, **options) -> DataFrame:
    """docs without what they share with the items.

    Runs of hit words are cut out of the text, from the first letter of the first word to the end
    of the last. A document of which more than `most_covered` of the words are hit goes. Texts
    without a hit stay as they are (null too). Columns and their order stay.
    """
    name = free_name(docs, "hits")
    found = find_hits(docs, benchmark, text=text, name=name, **options)
    n_hit = F.aggregate(F.col(name)["runs"], F.lit(0),
                        lambda n, r: n + r["end"] - r["start"])
    kept = found.filter(n_hit <= most_covered * F.col(name)["n_words"])
    cut = F.when(n_hit > 0, _cut(F.col(text), F.col(name)["runs"])).otherwise(F.col(text))
    return kept.withColumn(text, cut).select(*docs.columns)


def _cut(text, runs):
    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([
            cut_words(t, [(r["start"], r["end"]) for r in own or ()]).decode()
            for t, own in zip(utf8(texts), found.to_pylist(), strict=True)
        ], pa.string())

    return cut(text, runs)


def cut_words(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without the words of the runs and what stands between them."""
    if not runs:
        return text
    spaces = np.frombuffer(text.translate(WORD_BYTES), dtype=np.uint8) == 0x20
    edges = np.diff(np.r_[1, spaces.astype(np.int8), 1])
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:starts[a]])
        at = ends[b - 1]
    return b"".join([*out, text[at:]])

