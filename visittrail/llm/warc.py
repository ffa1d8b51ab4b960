"""WARC archives and a two-level capture index over them.

Records are compressed one by one, so each can be read from its place alone. The index holds a line
per capture, sorted by reversed-host URL key and dealt into shards by range; a shard is a file of
compressed blocks of lines, followed by its sparse directory (first key, place and size of each
block). A lookup finds the shard by its range and the blocks by binary search in the directory,
reads these blocks only, and then the records by their places.
"""

from __future__ import annotations

import bisect
import datetime
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visittrail.llm.common import new_folder, prepare, stored
from visittrail.llm.files import new_file, open_folder
from visittrail.llm.urls import url_key

#: Payloads from this size on are stored once.
LEAST_SHARED = 100
#: Lines of an index block; bytes after which a task begins another archive.
BLOCK_LINES, ARCHIVE_BYTES = 300, 1 << 30
#: Captures of one shard, at most, about; there are at least as many shards as shuffle partitions.
SHARD_LINES = 1_000_000
#: Places that lie this close in an archive are read at once, up to this size.
NEAR, MOST_AT_ONCE = 1 << 16, 8 << 20
#: Bytes of archives that one task reads, about; there are at least as many tasks as cores.
READ_BYTES = 64 << 20

CAPTURES = "url_key string, page_id {id}, archive string, offset long, size long, " \
    "record_type string"


@dataclass(frozen=True)
class Archive:
    """Where archives and index lie: captures and shards are stored tables."""

    folder: str
    captures: DataFrame
    shards: DataFrame


# --- writing --------------------------------------------------------------------------------


def record(kind: str, page: str | None, url: str, payload: bytes, digest: str, size: int,
           refers_to: str | None, date: str) -> bytes:
    """One WARC record, compressed by itself. A revisit holds no payload, but its size and digest."""
    body = payload if kind == "response" else b""
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date,
        "WARC-Target-URI": _one_line(url), "WARC-Page-ID": page,
        "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Payload-Length": str(size),
        "Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(body)),
    }
    if refers_to is not None:
        head["WARC-Refers-To-Page-ID"] = refers_to
        head["WARC-Profile"] = \
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    whole = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"
    press = zlib.compressobj(3, zlib.DEFLATED, 31)
    return press.compress(whole) + press.flush()


def _one_line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of an uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[:int(headers["Content-Length"])]


def _write_records(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    out, name, at = None, "", 0
    try:
        for batch in batches:
            rows = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            offsets, sizes, names = [], [], []
            for i in range(batch.num_rows):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, create = new_file(folder, ".warc.gz")
                    out, at = create(), 0
                page, refers = rows["page_id"][i], rows["refers_to"][i]
                data = record(
                    rows["record_type"][i], None if page is None else str(page),
                    rows["url"][i] or "", rows["payload"][i], rows["digest"][i],
                    len(rows["payload"][i]), None if refers is None else str(refers), date)
                out.write(data)
                names.append(name)
                offsets.append(at)
                sizes.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("url_key"), batch.column("page_id"), pa.array(names, pa.string()),
                 pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()),
                 batch.column("record_type")],
                ["url_key", "page_id", "archive", "offset", "size", "record_type"])
    finally:
        if out is not None:
            out.close()


def write_archive(pages: DataFrame, folder: str | None = None, page_id: str = "page_id",
                  url: str = "url", html: str = "html",
                  least_shared: int = LEAST_SHARED) -> Archive:
    """Writes a record per row, and the index.

    Rows with equal payloads of at least `least_shared` bytes: the one with the smallest page_id
    is a response, the others revisits of it. Null html is an empty payload, a null url an empty
    one. Rows repeated with one page_id are each a record: responses alike, if it is the smallest. A row
    without a page_id revisits an equal payload that has one. Only payloads that occur more than
    once meet in a join, by digest and without a limit on how often they occur.
    """
    spark = prepare(pages.sparkSession)
    folder = folder or new_folder(spark, "warc")
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least_shared
    shared = rows.filter(large).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = shared.filter((F.col("n") > 1) & F.col("first").isNotNull())
    shared = stored(shared.select(F.col("digest").alias("of"), "first"), "warc-shared")
    met = rows.join(shared, (F.col("digest") == F.col("of")) & large, "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = met.select(
        F.coalesce(url_key(F.col("url")), F.lit(")")).alias("url_key"), "page_id", "url",
        "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"))
    schema = CAPTURES.format(id=dict(rows.dtypes)["page_id"])
    captures = stored(
        typed.mapInArrow(lambda batches: _write_records(batches, folder), schema), "captures")
    return Archive(folder, captures, write_index(captures, folder))


def write_index(captures: DataFrame, folder: str, shard_lines: int = SHARD_LINES) -> DataFrame:
    """Writes the shards; (shard, first_key, last_key, lines) of each.

    Captures are dealt by ranges of key and page, so captures of one host or URL may fill any
    number of shards.
    """
    n = max(captures.count() // shard_lines + 1,
            int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = captures.repartitionByRange(n, "url_key", "page_id", "archive", "offset")
    ordered = dealt.sortWithinPartitions("url_key", "page_id", "archive", "offset")
    shards = ordered.mapInArrow(
        lambda batches: _write_shard(batches, folder),
        "shard string, first_key string, last_key string, lines long")
    return stored(shards, "warc-shards")


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    out, name, at, lines = None, "", 0, 0
    directory, block, first, last = [], [], None, None

    def flush() -> int:
        data = zlib.compress("\n".join(block).encode(), 6)
        directory.append([json.loads(block[0])[0], at, len(data)])
        out.write(data)
        block.clear()
        return at + len(data)

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns, strict=True):
            if out is None:
                name, create = new_file(folder, ".idx")
                out, first = create(), row[0]
            block.append(json.dumps(row, separators=(",", ":")))
            last, lines = row[0], lines + 1
            if len(block) == BLOCK_LINES:
                at = flush()
    if out is None:
        return
    if block:
        at = flush()
    data = zlib.compress(json.dumps([directory, last]).encode(), 6)
    out.write(data)
    out.write(struct.pack(">QQ", at, len(data)))
    out.close()
    yield pa.RecordBatch.from_pydict({
        "shard": [name], "first_key": [first], "last_key": [last], "lines": [lines]})


# --- reading --------------------------------------------------------------------------------


class Shard:
    """An index file: its directory is read at once, blocks when they are asked for."""

    def __init__(self, folder: str, name: str):
        system, path = open_folder(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        end = self.file.size() - 16
        at, size = struct.unpack(">QQ", self.file.read_at(16, end))
        self.directory, _ = json.loads(zlib.decompress(self.file.read_at(size, at)))
        self.firsts = [d[0] for d in self.directory]
        self._number, self._lines = -1, []

    def lines(self, number: int) -> list[list]:
        if number != self._number:
            _, at, size = self.directory[number]
            data = zlib.decompress(self.file.read_at(size, at))
            self._number, self._lines = number, [json.loads(x) for x in data.split(b"\n")]
        return self._lines

    def find(self, key: str) -> Iterator[list]:
        """The captures of a key. The block before the first that begins with it may hold some."""
        number = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while number < len(self.firsts) and self.firsts[number] <= key:
            lines = self.lines(number)
            at = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1
            number += 1


def lookup(archive: Archive, keys: DataFrame, key: str = "url_key") -> DataFrame:
    """The captures of each distinct key, as (url_key, page_id, archive, offset, size, record_type).

    Each shard is searched by the task that gets the keys in its range, in order. The list of
    shard ranges, which every task gets, has one entry per SHARD_LINES captures or shuffle partition.
    """
    spark = prepare(keys.sparkSession)
    ranges = [(r["first_key"], r["last_key"], r["shard"]) for r in
              archive.shards.orderBy("first_key", "last_key").toLocalIterator()]
    sent = spark.sparkContext.broadcast(ranges)
    folder = archive.folder

    @F.arrow_udf("array<string>")
    def shards_of(values: pa.Array) -> pa.Array:
        lasts, firsts = [r[1] for r in sent.value], [r[0] for r in sent.value]
        return pa.array([
            [sent.value[i][2] for i in
             range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k))]
            for k in values.to_pylist()], pa.list_(pa.string()))

    wanted = keys.select(F.col(key).alias("key")).filter("key is not null").distinct()
    dealt = wanted.select("key", F.explode(shards_of("key")).alias("shard"))
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "key")
    names = archive.captures.schema.names
    arrow = {f.name: f.dataType for f in archive.captures.schema.fields}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in batches:
            found = []
            pairs = zip(batch.column("key").to_pylist(), batch.column("shard").to_pylist(),
                        strict=True)
            for k, s in pairs:
                if s != name:
                    name, shard = s, Shard(folder, s)
                found.extend(shard.find(k))
                if len(found) >= 10_000:
                    yield _captures(found, names, arrow)
                    found = []
            yield _captures(found, names, arrow)

    return ordered.mapInArrow(search, archive.captures.schema)


def _captures(rows: list[list], names: list[str], types) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, to_arrow_type(types[n])) for c, n in zip(columns, names, strict=True)],
        names)


def _runs(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Places of one archive, in order, put together to ranges that are read at once."""
    own: list[int] = []
    start = end = 0
    for i, (at, size) in enumerate(places):
        if own and (at > end + NEAR or at + size - start > MOST_AT_ONCE):
            yield start, end, own
            own = []
        if not own:
            start = at
        own.append(i)
        end = max(end if len(own) > 1 else 0, at + size)
    if own:
        yield start, end, own


def read_records(archive: Archive, captures: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, digest, length, payload) as the archives have them.

    payload: the record's own (empty for revisits), digest and length: as its headers say. Records
    are read by range, those of an archive in the order of their places.
    """
    folder, spark = archive.folder, captures.sparkSession
    id_type = dict(captures.dtypes)["page_id"]
    # Places are small whatever they point at, so the tasks follow the archives' bytes.
    whole = archive.captures.agg(F.sum("size")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, whole // READ_BYTES + 1)
    ordered = captures.select("archive", "offset", "size").repartitionByRange(
        tasks, "archive", "offset").sortWithinPartitions("archive", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        system, path = open_folder(folder)
        for batch in batches:
            archives = batch.column("archive").to_pylist()
            places = list(zip(batch.column("offset").to_pylist(),
                              batch.column("size").to_pylist(), strict=True))
            at = 0
            while at < len(archives):
                end = at
                while end < len(archives) and archives[end] == archives[at]:
                    end += 1
                if archives[at] != name:
                    name = archives[at]
                    file = system.open_input_file(f"{path}/{name}")
                for start, stop, own in _runs(places[at:end]):
                    data = memoryview(file.read_at(stop - start, start))
                    yield _parsed([data[o - start:o - start + s] for o, s in
                                   (places[at + i] for i in own)])
                at = end

    return ordered.mapInArrow(
        read, "page_id string, url string, record_type string, refers_to string, digest string, "
        "length long, payload binary").withColumns({
            "page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def _parsed(members: list[memoryview]) -> pa.RecordBatch:
    out = {k: [] for k in ("page_id", "url", "record_type", "refers_to", "digest", "length",
                           "payload")}
    for data in members:
        head, body = parse(zlib.decompress(data, 31))
        out["page_id"].append(head.get("WARC-Page-ID"))
        out["url"].append(head["WARC-Target-URI"])
        out["record_type"].append(head["WARC-Type"])
        out["refers_to"].append(head.get("WARC-Refers-To-Page-ID"))
        out["digest"].append(head["WARC-Payload-Digest"].removeprefix("sha256:"))
        out["length"].append(int(head["WARC-Payload-Length"]))
        out["payload"].append(body)
    kinds = {"length": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()], list(out))


def digests(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of full payloads.

    A response's size and digest are those of the payload read back. A revisit has none of its
    own: it meets the response it refers to, and has that one's. Where that response is not
    among the records, as after a lookup of some keys, they are what the revisit's header says.
    """
    own = records.select(
        "page_id", "record_type", "refers_to", "digest", "length",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"))
    own = stored(own, "warc-read")
    first = own.filter("record_type = 'response'").groupBy(
        F.col("page_id").alias("of"), F.col("payload_digest").alias("first_digest")).agg(
        F.max("payload_bytes").alias("first_bytes"))
    met = own.filter("record_type = 'revisit'").join(
        first, (F.col("refers_to") == F.col("of")) & (F.col("digest") == F.col("first_digest")),
        "left")
    columns = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    revisits = met.withColumns({
        "payload_bytes": F.coalesce("first_bytes", "length"),
        "payload_digest": F.coalesce("first_digest", "digest")})
    return own.filter("record_type = 'response'").select(*columns).unionByName(
        revisits.select(*columns))
