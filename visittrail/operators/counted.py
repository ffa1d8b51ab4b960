"""Relations that hold each distinct row once, with the number of its copies.

Joins multiply the numbers and not the rows, so copies on both sides of a key cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "n"
#: Rows that a number is spread out to at a time.
CHUNK = 4096


def counted(rows: DataFrame) -> DataFrame:
    """Each distinct row with how often it occurs."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COUNT))


def once(rows: DataFrame) -> DataFrame:
    """Rows that are distinct already, each counted once."""
    return rows.withColumn(COUNT, F.lit(1).cast("long"))


def summed(rows: DataFrame) -> DataFrame:
    """Rows that have become equal, for example by leaving out columns, put together again."""
    others = [c for c in rows.columns if c != COUNT]
    return rows.groupBy(*others).agg(F.sum(COUNT).alias(COUNT))


def joined(left: DataFrame, right: DataFrame, on: Column | list[str], how: str = "left") -> DataFrame:
    """Both counted; an unmatched row of a left join keeps its own number."""
    times = right.withColumnRenamed(COUNT, "_times")
    both = left.join(times, on, how)
    return both.withColumn(COUNT, F.col(COUNT) * F.coalesce("_times", F.lit(1))).drop("_times")


def expanded(rows: DataFrame) -> DataFrame:
    """Every copy as a row of its own, made where the counted row lies."""
    n = F.col(COUNT)
    chunks = rows.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / CHUNK))))
    size = F.least(F.lit(CHUNK), n - F.col("_chunk") * CHUNK).cast("int")
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).drop(
        "_chunk", "_copy", COUNT)
