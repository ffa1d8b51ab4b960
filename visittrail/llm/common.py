"""What the operators of this subpackage share: session, shared folder, stored tables, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches end at this size, so that long texts cannot fill a Python worker.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: A-Z become a-z; bytes that are no part of a word become spaces.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


#: What the operator that a worker ran last keeps between its tasks.
_KEPT: dict = {}


def kept(name: Hashable, build: Callable):
    """What build() gives, kept between the tasks of a worker; what others kept there goes first."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = build()
    return _KEPT[name]


def prepare(spark: SparkSession) -> SparkSession:
    """The settings of this subpackage, and a folder for what jobs hand to one another."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="visittrail-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows as a written table in the shared folder: computed once, read many times."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it (case is ignored)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_row_number(frame: DataFrame, name: str) -> DataFrame:
    """Adds a number that differs for each row; to be stored before it is used twice."""
    return frame.withColumn(name, F.monotonically_increasing_id())


def utf8(texts: pa.Array) -> list[bytes]:
    """Each text's bytes; null counts as empty."""
    return texts.cast(pa.binary()).fill_null(b"").to_pylist()


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of letters, digits and whatever is not ASCII."""
    return text.translate(WORD_BYTES).split()
