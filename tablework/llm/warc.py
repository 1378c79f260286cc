"""WARC archives: a deterministic sharded writer with revisit records, and a reader."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.plans import running_total, stage
from tablework.plans.staging import scratch_dir

#: Smaller payloads are stored each time. Files end after so many compressed bytes.
REVISIT_BYTES, ROLL_BYTES = 1000, 256 << 20
#: Payload of a shard, if there are more shards than shuffle partitions.
SHARD_BYTES = 1 << 30
#: No table has a time of capture; equal input has to give equal files.
DATE = "1970-01-01T00:00:00Z"

_MANIFEST = "file string, shard long, sequence long, records long, bytes long, sha1 string, first_id long, last_id long"
_RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member of its own. Digests and lengths are made anew."""
    digest = hashlib.sha1(block).hexdigest()
    own = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in own if v is not None) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _name(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _fields(page_id: int | None, url: str | None, digest: str, size: int) -> list[tuple[str, str | None]]:
    return [
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
    ]


def _response(page_id: int | None, url: str | None, digest: str, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    fields = [*_fields(page_id, url, digest, len(payload)), ("Content-Type", "application/http; msgtype=response")]
    return _record("response", fields, http.encode() + payload)


def _revisit(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int) -> bytes:
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    fields = [*_fields(page_id, url, digest, size), ("WARC-Profile", profile), ("WARC-Refers-To", _name(refers_to))]
    return _record("revisit", [*fields, ("Content-Type", "application/http; msgtype=response")], b"HTTP/1.1 200 OK\r\n\r\n")


def _packed(bounds: np.ndarray):
    """Adds the shard, and makes the record that a row has as a response."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column("page_id")
                shard = np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).max).to_numpy(), side="right") - 1
                members = [
                    _response(r["page_id"], r["url"], r["digest"], r["body"]) if r["body"] is not None else None
                    for r in part.to_pylist()
                ]
                columns = {n: part.column(n) for n in part.schema.names if n != "body"}
                columns |= {"shard": pa.array(np.maximum(shard, 0)), "member": pa.array(members, pa.binary())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


class _Writer:
    """The open file of a task. It is written under a temporary name and moved when full."""

    def __init__(self, folder: str, roll_bytes: int):
        self.fs, self.path = _open(folder)
        self.roll_bytes, self.file, self.shard, self.sequence = roll_bytes, None, None, 0

    def add(self, shard: int, page_id: int | None, member: bytes) -> Iterator[dict]:
        if self.file and (shard != self.shard or self.bytes + len(member) > self.roll_bytes):
            self.sequence += 1
            yield self.close()
        if shard != self.shard:
            self.shard, self.sequence = shard, 0
        if not self.file:
            self.name = f"part-{shard:06d}-{self.sequence:05d}.warc.gz"
            self.temporary = f"{self.path}/_temporary/{uuid.uuid4().hex}-{self.name}"
            self.fs.create_dir(f"{self.path}/_temporary")
            self.file, self.hash = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha1()
            self.bytes = self.records = 0
            self.first, self.last = page_id, page_id
            info = f"software: tablework\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n"
            fields = [("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._put(_record("warcinfo", fields, info.encode()))
        self._put(member)
        self.records += 1
        self.last = page_id

    def _put(self, member: bytes) -> None:
        self.file.write(member)
        self.hash.update(member)
        self.bytes += len(member)

    def close(self) -> dict:
        self.file.close()
        self.fs.move(self.temporary, f"{self.path}/{self.name}")
        self.file = None
        return {
            "file": self.name, "shard": self.shard, "sequence": int(self.name.split("-")[2].split(".")[0]), "records": self.records,
            "bytes": self.bytes, "sha1": self.hash.hexdigest(), "first_id": self.first, "last_id": self.last,
        }


def _written(folder: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done, again = _Writer(folder, roll_bytes), [], None
        for batch in batches:
            names = ("shard", "page_id", "url", "digest", "size", "refers_to", "kind")
            rows = zip(*[batch.column(n).to_pylist() for n in names], batch.column("member"))
            for shard, page_id, url, digest, size, refers_to, kind, member in rows:
                if kind == 0:
                    # the rows of this id and digest that follow are revisits
                    again = (page_id, digest, refers_to)
                elif again and again[:2] == (page_id, digest):
                    done += writer.add(shard, page_id, _revisit(page_id, url, digest, size, again[2]))
                else:
                    done += writer.add(shard, page_id, member.as_py())
        if writer.file:
            done.append(writer.close())
        schema = pa.schema(
            [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.strip().split(" ") for x in _MANIFEST.split(","))]
        )
        yield pa.RecordBatch.from_pylist(done, schema=schema)

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    shards: int | None = None,
    roll_bytes: int = ROLL_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
    payload: str = "html",
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, ``payload``) and returns the manifest.

    Records are in the order of page_id (null last), then payload digest. Each shard is a range
    of page_id with about the same payload, written by one task, in files that end before
    ``roll_bytes`` compressed bytes; every record is a gzip member. Of equal payloads of
    at least ``revisit_bytes`` bytes that with the largest page_id is a response record and
    the others are revisits of it; rows that repeat its id are responses too. Null payloads
    are empty; a null url has no header. Other columns are not read. The same table and
    number of shards give the same files.

    Files get their names when complete, by a move; the manifest, written last as a table,
    says which files count, so a lost task or job leaves nothing that is read. Records are
    compressed before the one shuffle of payloads; what is equal is found on digests alone.
    ``shards`` defaults to the shuffle partitions, or more if these would exceed a gigabyte.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.sha1(body).alias("digest"),
        F.octet_length(body).cast("long").alias("size"), F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind"), body.alias("body"),
    )
    meta = stage(rows.select("page_id", "digest", "size"), "digests")
    total = meta.agg(F.coalesce(F.sum(F.col("size") + 500), F.lit(0)).alias("n")).first()["n"]
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    kept = (
        meta.filter(F.col("size") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    revisits = meta.join(kept.hint("merge"), "digest").filter("page_id < refers_to or page_id is null and refers_to is not null")
    revisits = revisits.distinct().select(
        "page_id", F.lit(None).cast("string").alias("url"), "digest", "size", "refers_to", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("body")
    )
    weighed = meta.filter("page_id is not null").select("page_id", F.lit(0).alias("all"), (F.col("size") + 500).alias("weight"))
    placed = running_total(weighed, "all", [F.col("page_id")], "weight", "sum").select(
        "page_id", ((F.col("sum") - F.col("weight")) * shards / F.lit(max(total, 1))).cast("long").alias("shard")
    )
    # a number per shard
    bounds = np.array([r["least"] for r in placed.groupBy("shard").agg(F.min("page_id").alias("least")).orderBy("least").collect()], dtype=np.int64)
    columns = "page_id long, url string, digest string, size long, refers_to long, kind int, shard long, member binary"
    ready = rows.unionByName(revisits).mapInArrow(_packed(bounds), columns)
    order = [F.col("shard"), F.col("page_id").asc_nulls_last(), F.col("digest"), F.col("kind"), F.col("url")]
    written = ready.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(*order).mapInArrow(_written(folder, roll_bytes), _MANIFEST)
    filesystem, path = _open(folder)
    filesystem.create_dir(path)
    written.write.parquet(f"{folder}/_manifest")
    if filesystem.get_file_info(f"{path}/_temporary").type == fs.FileType.Directory:
        filesystem.delete_dir(f"{path}/_temporary")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/_manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a decompressed archive; digests are checked."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while line := stream.readline().strip():
            key, _, value = line.decode().partition(": ")
            head[key] = value
        block = stream.read(int(head["Content-Length"]))
        if head["WARC-Block-Digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}" or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        yield head, block


def _id(name: str | None) -> int | None:
    number = (name or "").strip("<>").rpartition(":")[2]
    return int(number) if number.lstrip("-").isdigit() else None


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The page records of the files in the manifest: page_id, url (as encoded in its header),
    record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits, and
    if ``payloads`` is false). Files are read as streams; every digest is checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _open(folder)
        schema = pa.schema(
            [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (x.strip().split(" ") for x in _RECORDS.split(","))]
        )
        for batch in batches:
            for name in batch.column("file").to_pylist():
                found, held = [], 0
                with filesystem.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, block in records(stream):
                        if head["WARC-Type"] == "warcinfo":
                            continue
                        response, digest = head["WARC-Type"] == "response", head["WARC-Payload-Digest"].removeprefix("sha1:")
                        size, payload = int(head["X-Payload-Length"]), block.partition(b"\r\n\r\n")[2]
                        if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"damaged payload of {head['WARC-Record-ID']}")
                        found.append(
                            {
                                "page_id": _id(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"], "payload_bytes": size,
                                "payload_digest": digest, "refers_to": _id(head.get("WARC-Refers-To")), "payload": payload if response and payloads else None,
                            }
                        )
                        held += len(block)
                        if held > 4 << 20 or len(found) >= 2000:
                            yield pa.RecordBatch.from_pylist(found, schema=schema)
                            found, held = [], 0
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    files = read_manifest(spark, folder).select("file")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(spread, "file").mapInArrow(run, _RECORDS)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder where all executors can write."""
    return f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
