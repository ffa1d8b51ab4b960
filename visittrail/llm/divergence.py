"""How far the sources of a language differ in their terms.

Each task counts the terms of its own texts and hands on fixed-width digests with their counts, dealt
to buckets by digest; no string is shuffled. A bucket adds them up and keeps the digests that enough
documents have. Only then are strings looked for: a bitmap of the kept digests goes to a second
pass over the texts, and the smallest and the largest string of a digest tell whether it stands for
several terms. If some do, their terms are counted once more by their strings. All later joins are on
(digest, number of the term under it); text comes back for the rows that are returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visittrail.llm.common import prepare, stored, utf8

#: Added to each count; and the whole that shares are parts of.
PRIOR, UNIT = 5, 1_000_000_000
#: Distinct (group, term) entries that a task holds before it hands them on.
HELD_TERMS = 600_000
#: Text bytes whose digests one bucket adds up, and the fewest buckets. Beyond SALT_BYTES of text the
#: counts of a bucket are added up in so many parts first, as a frequent term has one in each task.
BUCKET_BYTES, LEAST_BUCKETS, SALT_BYTES = 8 << 20, 64, 100 << 30
#: Bits of the bitmap for each kept digest, and the most it may have (32 MiB).
BITS_A_TERM, MOST_BITS = 16, 1 << 28
#: (group, term) cells that one task compares between sources, and sources that it compares, about.
CELLS, SOURCES = 100_000, 512

#: A-Z become a-z, what is neither a letter nor beyond ASCII becomes a space.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

#: Counts of one bucket: what places in `at` stand for, and little-endian arrays of places (unsigned
#: 32-bit), digests (64-bit) and counts (64-bit). A group without a source counts a language's rows.
BLOCKS = """bucket int, salt int, groups array<struct<lang: string, source: string>>,
    at binary, digests binary, counts binary"""
GROUP, KEY = ["lang", "source"], ["lang", "digest", "k"]


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def share(count: Column | str, total: Column | str) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / total), exact; null where the total is not above 0."""
    count = F.col(count) if isinstance(count, str) else count
    total = F.col(total) if isinstance(total, str) else total
    raised = (count + PRIOR).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    parts = F.call_function("div", raised, total.cast("decimal(19,0)"))
    return F.when(total > 0, parts + 1)


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, text: str = "text",
               lang: str = "lang", source: str = "source", digest_bits: int = 64,
               held_terms: int = HELD_TERMS, salt_bytes: int = SALT_BYTES, cells: int = CELLS,
               sources: int = SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank), for each source of each language.

    Part `pair`: item is another source of the language, value the sum over all kept terms of the
    difference of the two sources' shares. Part `term`: item is a kept term that has a larger
    share in the source than in the language, value the difference; only the `top` largest. Values
    rank in falling order, equal ones by item. A language keeps the terms that at least
    `least_docs` of its rows hold; a share is that of `share` with total N + PRIOR * V, of N
    occurrences of V kept terms. Null text, lang and source are empty strings. Rows count whatever
    their ids, repeated ones each time. A language that keeps no term has pairs of value 0; one
    with one source has no pairs. Other columns are not read; an empty table gives no rows.

    digest_bits: how much of a term's digest is used; fewer bits only make more collisions. The
    other numbers only say how much a task holds at once (see the constants).
    """
    prepare(docs.sparkSession)
    named = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(text).cast("string").alias("text"))
    kept, counts = _kept_terms(named, least_docs, digest_bits, held_terms, salt_bytes)

    groups = stored(_groups(named, kept, counts, cells, sources), "groups")
    shares = counts.join(groups, GROUP).withColumn("p", share("n", "total"))
    return _pairs(shares, groups, sources).unionByName(_own_terms(shares, counts, kept, top))


def _groups(named: DataFrame, kept: DataFrame, counts: DataFrame, cells: int,
            sources: int) -> DataFrame:
    """Each source of each language: its number, its total and the language's, how work is dealt.

    One row a group, so that all that is known of a language reaches its terms by the key of the
    source, and no join has to bring a whole language together.
    """
    own = counts.groupBy(GROUP).agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("cells"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    found = named.select(GROUP).distinct().join(own, GROUP, "left").join(vocabulary, "lang", "left")
    found = found.fillna(0, ["own", "cells", "v"])
    whole = Window.partitionBy("lang")
    added = PRIOR * F.col("v")
    return found.select(
        *GROUP, (F.row_number().over(whole.orderBy("source")) - 1).alias("number"),
        (F.col("own") + added).alias("total"),
        (F.sum("own").over(whole) + added).alias("lang_total"),
        F.ceil((F.sum("cells").over(whole) + 1) / cells).alias("buckets"),
        F.ceil(F.count(F.lit(1)).over(whole) / sources).alias("blocks"))


def _digests(names: list[bytes], bits: int) -> np.ndarray:
    half, mask = 1 << 63, (1 << bits) - 1
    return np.fromiter(((xxhash.xxh3_64_intdigest(t) & mask) - half for t in names),
                       dtype=np.int64, count=len(names))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, list[bytes]]]:
    for batch in batches:
        yield from zip(
            batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
            map(terms, utf8(batch.column("text"))), strict=True)


def _held(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict[tuple, Counter]]:
    """Counts of terms by (language, source) and of rows by (language, None), so many at a time."""
    held: dict[tuple, Counter] = {}
    size = 0
    for lang, source, words in _texts(batches):
        if not words:
            continue
        count = held.setdefault((lang, source), Counter())
        rows = held.setdefault((lang, None), Counter())
        size -= len(count) + len(rows)
        count.update(words)
        rows.update(set(words))
        size += len(count) + len(rows)
        if size > most:
            yield held
            held, size = {}, 0
    if held:
        yield held


def _counting(digest_bits: int, held_terms: int, buckets: int, salts: int):
    """For mapInArrow: BLOCKS of the terms of a task's texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % salts
        for held in _held(batches, held_terms):
            sizes = [len(c) for c in held.values()]
            digests = np.concatenate([_digests(list(c), digest_bits) for c in held.values()])
            counts = np.concatenate([
                np.fromiter(c.values(), dtype=np.int64, count=len(c)) for c in held.values()])
            at = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            yield _blocks(list(held), at, digests, counts, buckets, salt)

    return count


def _blocks(groups: list[tuple], at: np.ndarray, digests: np.ndarray, counts: np.ndarray,
            buckets: int, salt: int) -> pa.RecordBatch:
    """BLOCKS of one set of counts, a row for each bucket that has any."""
    bucket = (digests >> 20) % buckets
    order = np.lexsort((at, bucket))
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else order
    ends = np.r_[starts, len(bucket)]
    names = pa.array([{"lang": a, "source": b} for a, b in groups],
                     pa.struct([("lang", pa.string()), ("source", pa.string())]))
    every = pa.ListArray.from_arrays(
        pa.array(np.arange(len(starts) + 1, dtype=np.int32) * len(groups)),
        pa.concat_arrays([names] * len(starts)) if len(starts) else names[:0])

    def cut(values: np.ndarray) -> pa.Array:
        offsets = (ends * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values[order]))])

    return pa.record_batch({
        "bucket": pa.array(bucket[starts], pa.int32()),
        "salt": pa.array(np.full(len(starts), salt), pa.int32()), "groups": every,
        "at": cut(at), "digests": cut(digests), "counts": cut(counts)})


def _summed(table: pa.Table) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """(groups, place, digest, count) of all BLOCKS of one bucket, each (place, digest) once."""
    known: dict[tuple, int] = {}
    places, digests, counts = [], [], []
    columns = (table.column(c).to_pylist() for c in ("groups", "at", "digests", "counts"))
    for groups, at, own, n in zip(*columns, strict=True):
        number = np.array([known.setdefault((g["lang"], g["source"]), len(known))
                           for g in groups], dtype=np.uint32)
        places.append(number[np.frombuffer(at, dtype=np.uint32)])
        digests.append(np.frombuffer(own, dtype=np.int64))
        counts.append(np.frombuffer(n, dtype=np.int64))
    place, digest = np.concatenate(places), np.concatenate(digests)
    order = np.lexsort((digest, place))
    place, digest = place[order], digest[order]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (digest[1:] != digest[:-1])])
    return (list(known), place[first], digest[first],
            np.add.reduceat(np.concatenate(counts)[order], first))


def _frequent(table: pa.Table, least: int) -> pa.Table:
    """(lang, source, digest, n) of one bucket: digests that enough rows of a language have."""
    groups, place, digest, n = _summed(table)
    spans = np.searchsorted(place, np.arange(len(groups) + 1))
    kept = {}
    for i, (lang, source) in enumerate(groups):
        if source is None:
            own = slice(spans[i], spans[i + 1])
            kept[lang] = digest[own][n[own] >= least]
    rows = []
    for i, (lang, source) in enumerate(groups):
        own = slice(spans[i], spans[i + 1])
        some = np.isin(digest[own], kept[lang], assume_unique=True)
        rows.append(pa.table({
            "lang": pa.array([lang] * int(some.sum()), pa.string()),
            "source": pa.array([source] * int(some.sum()), pa.string()),
            "digest": pa.array(digest[own][some]), "n": pa.array(n[own][some])}))
    return pa.concat_tables(rows)


def _frequent_digests(named: DataFrame, least: int, digest_bits: int, held_terms: int,
                      salt_bytes: int) -> DataFrame:
    """(lang, source, digest, n) of frequent digests; without a source, n counts rows."""
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, salts = max(LEAST_BUCKETS, size // BUCKET_BYTES), size // salt_bytes + 1
    blocks = named.mapInArrow(_counting(digest_bits, held_terms, buckets, salts), BLOCKS)
    if salts > 1:
        def merged(table: pa.Table) -> pa.Table:
            bucket = table.column("bucket")[0].as_py()
            one = _blocks(*_summed(table), 1, 0)
            at = one.schema.get_field_index("bucket")
            return pa.Table.from_batches([one.set_column(at, "bucket", pa.array([bucket], pa.int32()))])

        blocks = blocks.groupBy("bucket", "salt").applyInArrow(merged, BLOCKS)
    return stored(blocks.groupBy("bucket").applyInArrow(
        lambda table: _frequent(table, least), "lang string, source string, digest long, n long"),
        "frequent-digests")


def _named_digests(named: DataFrame, bitmap, digest_bits: int, held_terms: int) -> DataFrame:
    """(lang, digest, term), for digests in the bitmap, once or more by task."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, set[bytes]] = {}
        size = 0
        for batch in batches:
            fresh: dict[str, set[bytes]] = {}
            for lang, _, words in _texts([batch]):
                fresh.setdefault(lang, set()).update(words)
            for lang, words in fresh.items():
                own = seen.setdefault(lang, set())
                new = list(words - own)
                own.update(new)
                size += len(new)
                digests = _digests(new, digest_bits)
                likely = _in_bitmap(bitmap.value, digests)
                yield pa.record_batch({
                    "lang": pa.array([lang] * int(likely.sum()), pa.string()),
                    "digest": pa.array(digests[likely]),
                    "term": pa.array([t for t, x in zip(new, likely, strict=True) if x],
                                     pa.binary()).cast(pa.string())})
            if size > held_terms:
                seen, size = {}, 0

    return named.mapInArrow(name, "lang string, digest long, term string")


def _by_string(named: DataFrame, bitmap, digest_bits: int, held_terms: int) -> DataFrame:
    """(lang, source, digest, term, n) of terms in the bitmap; without a source, n counts rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches, held_terms):
            for (lang, source), counts in held.items():
                names = list(counts)
                digests = _digests(names, digest_bits)
                likely = np.flatnonzero(_in_bitmap(bitmap.value, digests))
                some = [names[i] for i in likely]
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(some), pa.string()),
                    "source": pa.array([source] * len(some), pa.string()),
                    "digest": pa.array(digests[likely]),
                    "term": pa.array(some, pa.binary()).cast(pa.string()),
                    "n": pa.array([counts[t] for t in some], pa.int64())})

    return named.mapInArrow(count, "lang string, source string, digest long, term string, n long")


def _kept_terms(named: DataFrame, least: int, digest_bits: int, held_terms: int,
                salt_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(lang, digest, k, term) and (lang, source, digest, k, n) of the terms that are kept.

    k is 0 for a digest that stands for one term and counts from 1 where it stands for several.
    """
    found = _frequent_digests(named, least, digest_bits, held_terms, salt_bytes)
    seen = found.filter(F.col("source").isNull()).select("lang", "digest")
    names = _named_digests(named, _bitmap(seen), digest_bits, held_terms)
    names = names.groupBy("lang", "digest").agg(
        F.min("term").alias("term"), F.max("term").alias("last")).join(seen, ["lang", "digest"])
    names = stored(names, "digest-names")
    kept = names.filter(F.col("term") == F.col("last")).select(
        "lang", "digest", F.lit(0).alias("k"), "term")
    several = names.filter(F.col("term") != F.col("last")).select("lang", "digest")
    columns = ["lang", "source", "digest", "k", "n"]
    counts = found.filter(F.col("source").isNotNull()).join(
        kept.select(KEY), ["lang", "digest"]).select(columns)
    if several.isEmpty():
        return kept, stored(counts, "kept-counts")

    split = _by_string(named, _bitmap(several), digest_bits, held_terms).join(
        several, ["lang", "digest"], "left_semi").groupBy(
        "lang", "source", "digest", "term").agg(F.sum("n").alias("n"))
    split = stored(split, "split-counts")
    place = Window.partitionBy("lang", "digest").orderBy("term")
    enough = split.filter(F.col("source").isNull() & (F.col("n") >= least)).select(
        "lang", "digest", F.row_number().over(place).alias("k"), "term")
    by_term = split.filter(F.col("source").isNotNull()).join(
        enough, ["lang", "digest", "term"]).select(columns)
    return (stored(kept.unionByName(enough), "kept-terms"),
            stored(counts.unionByName(by_term), "kept-counts"))


def _bitmap(seen: DataFrame):
    """A bounded bitmap with the places of all given digests, sent to the executors."""
    bits = 1 << 16
    while bits < min(BITS_A_TERM * seen.count(), MOST_BITS):
        bits *= 2
    place = F.pmod(F.col("digest"), F.lit(bits)) + 1
    blocks = seen.select(place.alias("place")).groupBy(
        F.bitmap_bucket_number("place").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")).collect()
    whole = np.zeros((bits >> 15, 4096), dtype=np.uint8)
    for row in blocks:
        whole[row["block"] - 1] = np.frombuffer(row["bitmap"], dtype=np.uint8)
    return seen.sparkSession.sparkContext.broadcast(whole.ravel())


def _in_bitmap(bitmap: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """True for all digests the bitmap was made of, and for few others."""
    place = digests % (len(bitmap) << 3)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _own_terms(shares: DataFrame, counts: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """The terms a source has more of than its language; strings are joined to the last ones only."""
    whole = counts.groupBy(KEY).agg(F.sum("n").alias("whole"))
    above = shares.join(whole, KEY).withColumn("q", share("whole", "lang_total"))
    above = above.filter(F.col("p") > F.col("q")).select(
        "source", *KEY, (F.col("p") - F.col("q")).alias("value"))
    largest = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    tied = above.withColumn("at", F.rank().over(largest)).filter(F.col("at") <= top)
    ranked = tied.join(kept, KEY).withColumn(
        "rank", F.row_number().over(largest.orderBy(F.desc("value"), "term")))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(shares: DataFrame, groups: DataFrame, most_sources: int) -> DataFrame:
    """Sums of differences for all pairs of sources of a language.

    A language's terms are dealt to buckets; a task lays one bucket out as a matrix of terms by
    sources, filled with the share of a term that a source lacks, and adds up differences. More
    than `most_sources` sources are compared by as many tasks, each for its own share of the first
    ones.
    """
    base = F.coalesce(share(F.lit(0), F.col("total")), F.lit(0))
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    empty = groups.select(
        "lang", "number", F.lit(None).cast("long").alias("digest"),
        F.lit(None).cast("int").alias("k"), base.alias("p"), "blocks",
        F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    filled = shares.select(
        "lang", "number", "digest", "k", "p", "blocks",
        F.pmod(F.xxhash64("digest", "k"), "buckets").alias("bucket"))
    dealt = empty.unionByName(filled).select(
        "lang", "bucket", "number", "digest", "k", "p", blocks)
    parts = dealt.groupBy("lang", "bucket", "block").applyInArrow(
        lambda table: _compared(table, most_sources), "lang string, a int, b int, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("one"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("one"), F.col("a").alias("other")))).alias("x"))
    names = groups.select("lang", "source", "number")
    of = both.select("lang", "value", "x.one", "x.other")
    of = of.join(names.select("lang", "source", F.col("number").alias("one")), ["lang", "one"])
    of = of.join(names.select("lang", F.col("source").alias("item"),
                              F.col("number").alias("other")), ["lang", "other"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return of.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                     F.row_number().over(order).alias("rank"))


def _compared(table: pa.Table, most_sources: int) -> pa.Table:
    """One bucket of one language: sums of differences for pairs a < b, a in the block."""
    lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
    number, p = table.column("number").to_numpy(), table.column("p").to_numpy()
    digest, k = table.column("digest"), table.column("k")
    is_base = digest.is_null().to_numpy()
    base = np.zeros(int(number.max()) + 1, dtype=np.int64)
    base[number[is_base]] = p[is_base]
    own = ~is_base
    key = np.stack([digest.fill_null(0).to_numpy()[own],
                    k.fill_null(0).to_numpy()[own].astype(np.int64)])
    n_terms, term = 0, np.zeros(0, dtype=np.int64)
    if key.size:
        distinct, term = np.unique(key, axis=1, return_inverse=True)
        n_terms, term = distinct.shape[1], term.ravel()
    order = np.argsort(term, kind="stable")
    term, number, p = term[order], number[own][order], p[own][order]
    firsts = range(block * most_sources, min((block + 1) * most_sources, len(base)))
    sums = np.zeros((len(firsts), len(base)), dtype=np.int64)
    rows = max(1, (1 << 20) // len(base))
    for at in range(0, n_terms, rows):
        some = slice(*np.searchsorted(term, [at, at + rows]))
        matrix = np.tile(base, (min(rows, n_terms - at), 1))
        matrix[term[some] - at, number[some]] = p[some]
        for i, a in enumerate(firsts):
            sums[i] += np.abs(matrix - matrix[:, a:a + 1]).sum(axis=0)
    i, b = np.nonzero(np.arange(len(base))[None, :] > np.array(firsts)[:, None])
    return pa.table({
        "lang": pa.array([lang] * len(i), pa.string()),
        "a": pa.array(i + firsts.start, pa.int32()), "b": pa.array(b, pa.int32()),
        "value": pa.array(sums[i, b], pa.int64())})
