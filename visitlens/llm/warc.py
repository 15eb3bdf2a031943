"""WARC archives: a deterministic sharded writer and a reader that checks.

Writing: digests of all payloads decide which record of equal payloads is the
response; records are dealt to shards by ranges of (page_id, payload hash) whose
bounds depend on the rows alone, and sorted within. A task writes its shard as
gzip members, one a record, and starts a new file when the compressed size
reaches a limit. A file gets its final name, which depends on shard and number
only, when it is whole; the manifest, written last and renamed, names the files
that count. A task that is lost and run again writes the same bytes under the
same names.

Reading: only files of the manifest; lengths and digests are checked.

Archive files are reached by Arrow's file systems, so the folder may be local
to a shared mount or any store that Arrow opens (file, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import stage
from visitlens.session import checkpoint_dir

#: payloads of at least so many bytes are kept once
REVISIT_BYTES = 0
#: compressed size at which a file ends; payload bytes of a shard, about; shards at least
ROLL_BYTES, SHARD_BYTES, MIN_SHARDS = 256 << 20, 1 << 30, 64
#: rows a shard of the sample that sets the bounds, about (up to twice)
SAMPLE_PER_SHARD = 16
LEVEL = 6
#: the table has no capture times; records carry this one
DATE = "2024-01-01T00:00:00Z"
#: page ids of null rank last
NO_ID = (1 << 63) - 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 20
MANIFEST_SCHEMA = "file string, shard int, seq int, records long, bytes long, sha256 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, sha1: str, nth: int) -> str:
    """A record's id, from its page id, payload digest and, for rows equal in
    both, its number."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}:{sha1}:{nth}'.encode()).digest()[:16], version=4)}>"


def header_text(url: str) -> str:
    """A url as it can stand in a header: what is not printable ASCII, and
    spaces, percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def member(record: bytes) -> bytes:
    """One gzip member without time or name."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def record_bytes(kind: str, rid: str, block: bytes, fields: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", DATE), *fields,
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, nth: int) -> bytes:
    """A page's response record, or its revisit record, which has no payload."""
    sha1 = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", header_text(url))] if url else []
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1}"),
               ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if not revisit:
        return record_bytes("response", record_id(page_id, sha1, nth), http + payload, fields)
    fields += [("WARC-Refers-To", record_id(first, sha1, 0)), ("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(first))]
    return record_bytes("revisit", record_id(page_id, sha1, nth), http, fields)


class RollingFiles:
    """The files of one shard at a time. A file is written under a temporary
    name and renamed when it is whole."""

    def __init__(self, folder: str, roll_bytes: int):
        self.fs, self.folder = arrow_fs.FileSystem.from_uri(folder)
        self.roll, self.out, self.shard, self.seq, self.done = roll_bytes, None, None, 0, []

    def _open(self) -> None:
        self.name = f"shard-{self.shard:06d}-{self.seq:05d}.warc.gz"
        self.temp = f"{self.folder}/data/{self.name}.tmp-{uuid.uuid4().hex}"
        self.out, self.bytes, self.records, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        info = f"software: visitlens\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {self.shard}\r\n".encode()
        self._put(record_bytes("warcinfo", record_id(None, self.name, 0), info,
                               [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]))

    def _put(self, record: bytes) -> None:
        data = member(record)
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def write(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.seq = shard, 0
        if self.out is None:
            self._open()
        self._put(record)
        self.records += 1
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.temp, f"{self.folder}/data/{self.name}")
        self.done.append((self.name, self.shard, self.seq, self.records, self.bytes, self.sha.hexdigest()))
        self.out, self.seq = None, self.seq + 1


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def _keys() -> list[Column]:
    """Page id as it ranks, and the payload's digest, length and a second hash:
    equal payloads are told by all three."""
    return [F.col("page_id"), F.coalesce("page_id", F.lit(NO_ID)).alias("rank_id"), F.sha1("payload").alias("sha1"),
            F.octet_length("payload").cast("long").alias("size"), F.xxhash64("payload").alias("tie")]


def revisits(ids: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(rank_id, sha1, size, tie, first): one row for each page id and payload
    that revisits the response of page ``first``. ``ids`` has those columns of all
    rows; payloads are not shuffled."""
    ids = ids.where(F.col("size") >= least)
    of = ["sha1", "size", "tie"]
    # once per page id and payload: rows that repeat both are one here
    distinct = ids.groupBy("rank_id", *of).agg(F.count(F.lit(1)).alias("rows"))
    first = (distinct.groupBy(*of).agg(F.min("rank_id").alias("first"), F.count(F.lit(1)).alias("held"))
             .where((F.col("held") > 1) & (F.col("first") < NO_ID)).drop("held"))
    return distinct.join(first, of).where(F.col("rank_id") != F.col("first")).select("rank_id", *of, "first")


def shard_bounds(keyed: DataFrame, shard_bytes: int = SHARD_BYTES, least: int = MIN_SHARDS) -> list[tuple[int, int]]:
    """Upper bounds (rank_id, tie) of all shards but the last, which hold about
    the same payload bytes each. Taken from a sample that a hash of the row picks,
    at most about 2 * SAMPLE_PER_SHARD rows a shard, so they are the same in
    every run."""
    rows, size = keyed.agg(F.count(F.lit(1)), F.sum(F.col("size") + 512)).first()
    if not rows:
        return []
    shards = max(least, -(-size // shard_bytes))
    one_in = max(1, rows // (SAMPLE_PER_SHARD * shards))
    picked = keyed.where(F.pmod(F.xxhash64("rank_id", "tie", F.lit("bounds")), F.lit(one_in)) == 0)
    sample = sorted(tuple(r) for r in picked.select("rank_id", "tie", "size").collect())
    if not sample:
        return []
    upto = np.cumsum([s + 512 for _, _, s in sample])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)
    return sorted({sample[i][:2] for i in at})


def shard_of(bounds: list[tuple[int, int]]):
    """Column function: the number of bounds below (rank_id, tie)."""
    ids, ties = np.array([b[0] for b in bounds], np.int64), [b[1] for b in bounds]

    @F.pandas_udf("int")
    def shard(rank_id: pd.Series, tie: pd.Series) -> pd.Series:
        low, high = np.searchsorted(ids, rank_id, "left"), np.searchsorted(ids, rank_id, "right")
        out = low.astype(np.int32)
        for i in np.flatnonzero(high > low):  # the page id of a bound: its tie decides
            out[i] = bisect_right(ties, tie.iat[i] - 1, low[i], high[i])
        return pd.Series(out)

    return shard


def write_warc(pages: DataFrame, folder: str, least: int = REVISIT_BYTES, roll_bytes: int = ROLL_BYTES,
               shard_bytes: int = SHARD_BYTES, min_shards: int = MIN_SHARDS) -> str:
    """Write one record per row of ``pages`` (page_id, url, html) under
    ``folder`` and commit; returns the folder.

    The payload is the html in UTF-8, null being empty. Of records with equal
    payloads of at least ``least`` bytes, those of the least page id are
    responses and the others revisit it; a row without a page id ranks last, and
    payloads that only such rows have are all responses. Rows equal in page id and
    payload get record ids of their own. A record of a null or empty url has no
    target. An empty table gives a manifest without files."""
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", _payload().alias("payload"))
    keyed = rows.select(*_keys(), "url", "payload")
    ids = stage(keyed.drop("url", "payload"), "warc-ids")
    marks = stage(revisits(ids, least), "warc-revisits")
    bounds = shard_bounds(ids, shard_bytes, min_shards)
    shards = len(bounds) + 1
    cols = ["rank_id", "tie", "size", "sha1", "first", "page_id", "url", "payload"]
    # a mark reaches its record by sorting: the shard holds both, the mark first
    both = (marks.withColumn("page_id", F.lit(None).cast("long")).withColumn("url", F.lit(None).cast("string"))
            .withColumn("payload", F.lit(None).cast("binary")).select(*cols)
            .unionByName(keyed.withColumn("first", F.lit(None).cast("long")).select(*cols)))
    dealt = (both.withColumn("shard", shard_of(bounds)("rank_id", "tie")).repartitionById(shards, "shard")
             .sortWithinPartitions("shard", "rank_id", "tie", "size", "sha1", F.asc_nulls_last("first"), "url")
             .select("shard", *cols))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = RollingFiles(folder, roll_bytes)
        mark, last, nth = None, None, 0
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["rank_id"], r["tie"], r["size"], r["sha1"])
                if r["payload"] is None:
                    mark = (key, r["first"])
                    continue
                nth, last = (nth + 1, key) if key == last else (0, key)
                revisit = mark is not None and mark[0] == key
                files.write(r["shard"], page_record(r["page_id"], r["url"], r["payload"], mark[1] if revisit else None, revisit, nth))
        files.close()
        columns = list(zip(*files.done)) or [[]] * 6
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["file", "shard", "seq", "records", "bytes", "sha256"])

    store, base = arrow_fs.FileSystem.from_uri(folder)
    store.create_dir(f"{base}/data", recursive=True)
    written = stage(dealt.mapInArrow(write, MANIFEST_SCHEMA), "warc-files")
    commit(written, folder)
    return folder


def commit(written: DataFrame, folder: str) -> None:
    """Write the manifest (a line per file) under a temporary name, rename it,
    and remove what attempts that did not count left behind."""
    store, base = arrow_fs.FileSystem.from_uri(folder)
    temp, names = f"{base}/manifest.tmp-{uuid.uuid4().hex}", set()
    with store.open_output_stream(temp) as out:
        for r in written.orderBy("shard", "seq").toLocalIterator():
            names.add(r["file"])
            out.write((json.dumps(r.asDict(), sort_keys=True) + "\n").encode())
    store.move(temp, f"{base}/manifest.jsonl")
    for found in store.get_file_info(arrow_fs.FileSelector(f"{base}/data")):
        if found.base_name not in names:
            store.delete_file(found.path)


def members(stream, what: str) -> Iterator[bytes]:
    """The gzip members of a stream, one by one."""
    held = b""
    while True:
        z, out = zlib.decompressobj(31), []
        if not held:
            held = stream.read(READ)
            if not held:
                return
        while not z.eof:
            if not held:
                held = stream.read(READ)
                if not held:
                    raise ValueError(f"{what} ends inside a record")
            out.append(z.decompress(held))
            held = z.unused_data if z.eof else b""
        yield b"".join(out)


def parse_record(record: bytes, what: str) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, its length and block digest checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"{what}: no WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest != block + b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"{what}: block of {fields['WARC-Record-ID']} is damaged")
    return fields, block


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The page records of the files that the manifest names: ``page_id``,
    ``url`` (as in the header), ``record_type``, ``record_id``, ``refers_to``
    (page id), ``refers_to_record``, ``payload_bytes``, ``payload_digest`` and,
    with ``payloads``, ``payload`` (null for a revisit). A file or record that
    does not agree with the manifest or its digests is an error."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/manifest.jsonl")
    files = max(1, manifest.count())
    names = ["page_id", "url", "record_type", "record_id", "refers_to", "refers_to_record", "payload_bytes", "payload_digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    schema = ("page_id long, url string, record_type string, record_id string, refers_to long, refers_to_record string, "
              "payload_bytes long, payload_digest string")
    if payloads:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], f"{schema}, payload binary"

    def page_row(fields: dict[str, str], block: bytes, what: str) -> tuple:
        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
        payload, revisit = block.partition(b"\r\n\r\n")[2], fields["WARC-Type"] == "revisit"
        if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
            raise ValueError(f"{what}: payload of {fields['WARC-Record-ID']} is damaged")
        number = [int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page")]
        row = (number[0], fields.get("WARC-Target-URI"), fields["WARC-Type"], fields["WARC-Record-ID"], number[1],
               fields.get("WARC-Refers-To"), size, digest)
        return (*row, None if revisit else payload) if payloads else row

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for f in batch.to_pylist():
                path, held, size, n = f"{base}/data/{f['file']}", [], 0, 0
                if store.get_file_info(path).size != f["bytes"]:
                    raise ValueError(f"{path}: not the size in the manifest")
                with store.open_input_stream(path, compression=None) as stream:
                    for record in members(stream, path):
                        fields, block = parse_record(record, path)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        held.append(page_row(fields, block, path))
                        n, size = n + 1, size + len(block) + 256
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                            held, size = [], 0
                if n != f["records"]:
                    raise ValueError(f"{path}: {n} records, {f['records']} in the manifest")
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    return manifest.repartition(files).mapInArrow(read, schema)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the cluster's shared folder, read them
    back: per page ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type`` and ``refers_to``."""
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/visitlens-llm/warc-{uuid.uuid4().hex}"
    write_warc(pages.select("page_id", "url", "html"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def report_sql() -> str:
    """``archive_report`` in DuckDB SQL."""
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first OR first IS NULL THEN NULL ELSE first END AS refers_to
FROM d"""
