"""Token-id matrices on disk, packed best fit decreasing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from visittrail.llm.bestfit import Bins
from visittrail.llm.common import new_folder, prepare, stored
from visittrail.llm.files import new_file, open_folder
from visittrail.llm.tokens import tokenized

#: Text bytes that one task packs, about: pieces are dealt to so many groups by hash.
GROUP_BYTES = 4 << 20

SCHEMA = """sequence_id long, file string, row int, used int, n_segments int,
    doc_ids array<{}>, pieces array<int>, cu_seqlens array<int>, position_resets array<int>,
    ids_crc32 long"""


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; longest first, ties in the order given."""
    bins = Bins(capacity)
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        where[i], offset[i] = bins.best_fit(int(lengths[i]))
    return where, offset


def write_packed(docs: DataFrame, path: str, folder: str | None = None, length: int = 4096,
                 end_id: int = 1, pad_id: int = 0, text: str = "text",
                 doc_id: str = "doc_id", kind: str = "<u2") -> DataFrame:
    """Writes packed matrices of token ids; one row per sequence says where it is and what it holds.

    A file is a matrix of `length` ids a row, of type `kind`, padded with pad_id. cu_seqlens holds
    0 and each segment's end; position_resets where positions start again from 0. Documents
    longer than `length` are cut without loss; null texts are empty documents (just end_id).
    Pieces are dealt to groups of about GROUP_BYTES of text, each packed in one task. The rows are
    stored, so files of lost attempts are never named. An empty table gives no row and no file.
    Document ids are of any type. A vocabulary with ids beyond `kind` is an error.
    """
    spark = prepare(docs.sparkSession)
    last = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
    if max(last, end_id, pad_id) > np.iinfo(kind).max:
        raise ValueError(f"ids up to {last} do not fit into {kind}")
    folder = folder or new_folder(spark, "packed")
    size = docs.agg(F.sum(F.octet_length(text) + 8)).first()[0] or 0
    groups = size // GROUP_BYTES + 1
    pieces = tokenized(docs, path, length, end_id, text, doc_id, with_ids=True)
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        return _written(table, folder, length, pad_id, kind)

    schema = SCHEMA.format(dict(dealt.dtypes)["doc_id"])
    return stored(dealt.groupBy("group").applyInArrow(pack, schema), "packed-rows")


def _written(table: pa.Table, folder: str, length: int, pad_id: int, kind: str) -> pa.Table:
    group = table.column("group")[0].as_py()
    lengths = table.column("length").to_numpy()
    where, offset = best_fit_decreasing(lengths, length)
    order = np.lexsort((offset, where))
    doc_ids, pieces = table.column("doc_id").to_pylist(), table.column("piece").to_pylist()
    ids = table.column("ids")
    name, create = new_file(folder, ".bin")
    rows = {n.split()[0]: [] for n in SCHEMA.replace("\n", " ").split(", ")}
    with create() as out:
        cuts = np.flatnonzero(np.diff(where[order])) + 1
        for row, own in enumerate(np.split(order, cuts)):
            line = np.full(length, pad_id, dtype=kind)
            for i in own:
                line[offset[i]:offset[i] + lengths[i]] = np.frombuffer(ids[i].as_py(), "<u4")
            out.write(line.tobytes())
            ends = (offset[own] + lengths[own]).tolist()
            values = {
                "sequence_id": (group << 32) + row, "file": f"{folder}/{name}", "row": row,
                "used": ends[-1], "n_segments": len(own), "doc_ids": [doc_ids[i] for i in own],
                "pieces": [pieces[i] for i in own], "cu_seqlens": [0, *ends],
                "position_resets": offset[own].tolist(), "ids_crc32": _crc(line[:ends[-1]]),
            }
            for k, v in values.items():
                rows[k].append(v)
    kinds = {"sequence_id": pa.int64(), "file": pa.string(), "row": pa.int32(),
             "used": pa.int32(), "n_segments": pa.int32(), "doc_ids": pa.list_(table.schema.field("doc_id").type),
             "pieces": pa.list_(pa.int32()), "cu_seqlens": pa.list_(pa.int32()),
             "position_resets": pa.list_(pa.int32()), "ids_crc32": pa.int64()}
    return pa.table({k: pa.array(v, kinds[k]) for k, v in rows.items()})


def _crc(ids: np.ndarray) -> int:
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())


def read_rows(file: str, length: int, kind: str = "<u2") -> np.ndarray:
    """A written matrix."""
    system, path = open_folder(file)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=kind).reshape(-1, length)
