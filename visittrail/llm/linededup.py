"""Boilerplate lines by how much of a site's pages hold them, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visittrail.llm.common import free_name, prepare, stored

#: A line that more than this share of a host's pages hold is boilerplate, from so many pages on.
RATIO, LEAST_PAGES = 0.1, 5
#: Lists of boilerplate lines go to every task up to this size; larger ones are copied so many times
#: and meet the pages by host and copy.
SENT_BYTES, COPIES = 8 << 20, 32


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g"))


def _is_blank(line: Column) -> Column:
    return F.trim(line) == ""


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): the keys of each host's boilerplate lines.

    A page is a distinct text of a host: copies of one page count once, so that a page copied often
    is no boilerplate. A page counts once for a line, however often the line is in it. Blank
    lines are never boilerplate. Null texts are no pages; a null host is a host like others. On
    average a host's pages have at least `ratio` times as many lines as its list has, so a list
    is bounded by the lines of 1 / ratio average pages. Both counts are summed up in each task
    before rows move, first by page and then by line, so a frequent line or host stays spread.
    """
    page = F.struct(F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), F.col(text)).alias("g"))
    pages = docs.filter(F.col(text).isNotNull()).select(
        F.col(host).alias("host"), page.alias("page"), _lines(F.col(text)).alias("all"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"))
    lines = pages.select("host", "page", F.explode("all").alias("line"))
    lines = lines.filter(~_is_blank(F.col("line"))).select(
        "host", _key(F.col("line")).alias("line"), "page").distinct()
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") >= least_pages)
    found = frequent.join(
        totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
    return found.filter(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(
        F.collect_list("line").alias("lines"))


def line_dedup(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
               least_pages: int = LEAST_PAGES, dropped: str | None = None,
               sent_bytes: int = SENT_BYTES) -> DataFrame:
    """docs without boilerplate lines; a column `dropped` counts them, if it is named.

    Lines end at a line feed. Null and empty texts stay, a text of boilerplate only becomes empty;
    no row goes, and columns stay in place; one that is named like `dropped` is replaced. The lists
    are stored and measured before pages meet them, so that texts only move where lists are large,
    and then no host's texts go to one task.
    """
    prepare(docs.sparkSession)
    of, bad, count, copy, other = (
        free_name(docs, n) for n in ("host_of", "bad_lines", "dropped_lines", "copy", "copy_of"))
    lists = stored(boilerplate(docs, text, host, ratio, least_pages).select(
        F.col("host").alias(of), F.col("lines").alias(bad)), "boilerplate")
    size = lists.agg(F.sum(F.size(bad) * 16 + F.coalesce(F.octet_length(of), F.lit(0)) + 32))
    same = F.col(host).eqNullSafe(F.col(of))
    if (size.first()[0] or 0) <= sent_bytes:
        joined = docs.join(F.broadcast(lists), same, "left")
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
        joined = docs.withColumn(
            copy, F.pmod(F.monotonically_increasing_id(), F.lit(COPIES)).cast("int")).join(
            lists.withColumn(other, every), same & (F.col(copy) == F.col(other)), "left")
    kept = F.filter(_lines(F.col(text)), lambda x: ~F.array_contains(F.col(bad), _key(x)))
    # A text with none of a host's lines is returned as it is.
    n = F.when(F.col(bad).isNull() | F.col(text).isNull(), 0).otherwise(
        F.size(_lines(F.col(text))) - F.size(kept))
    cleaned = F.when(F.col(bad).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    columns = [c for c in docs.columns if c.lower() != (dropped or "").lower()]
    out = joined.withColumn(count, n.cast("long")) if dropped else joined
    out = out.withColumn(text, cleaned)
    return out.select(*columns, *([F.col(count).alias(dropped)] if dropped else []))
