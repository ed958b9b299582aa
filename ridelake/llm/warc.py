"""Deterministic sharded WARC writer and reader.

Pages are cut into ranges of page_id of near equal bytes; the cuts come from an
exact histogram (fixed number of cells, heavy cells refined; rows of one id, or of none, that
would pass a shard are divided by digest), not from a sample, so the same pages and shard count give the same files, byte for byte.
A task writes its range in order of page_id, one gzip member per record, and
starts a new file before one would pass ``roll_bytes`` compressed. Files are
written under temporary names and renamed when complete; the manifest (a Parquet
table, committed by Spark) lists what counts. A task that is run again after a
lost executor writes the same bytes under the same names.

Equal payloads: digests are aggregated map-side (one row per digest and task)
and only repeated digests are joined back, on narrow rows (AQE splits a hot one),
as marks that travel to the writer beside the pages; payloads are shuffled once.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import read, written

CELL_BITS = 12
ROLL_BYTES = 256 << 20
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INFO = b"software: ridelake\r\nformat: WARC File Format 1.1\r\n"
DATE = "1970-01-01T00:00:00Z"     # pages carry no capture time
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _order(col: Column) -> Column:
    """Signed ids as unsigned bits of the same order."""
    return col.bitwiseXOR(F.lit(-(1 << 63)))


def with_shard(rows: DataFrame, sizes: DataFrame, id_col: str, n_shards: int, tie: Column | None = None) -> DataFrame:
    """``rows`` with ``shard``: ranges of ``id_col`` (null first) of near equal bytes, given
    ``sizes`` (id, size). An id larger than a shard (or null) is divided by ``tie``, a number from 0 to
    below 1 per row, and not at all without it. The histogram has at most
    2^CELL_BITS cells per level, and only cells larger than a shard are refined."""
    spark = rows.sparkSession
    key = _order(F.col("id"))
    lo, hi, known, unknown = sizes.agg(F.min("id"), F.max("id"), F.sum(F.when(F.col("id").isNotNull(), F.col("size"))),
                                       F.sum(F.when(F.col("id").isNull(), F.col("size")))).first()
    unknown = (unknown or 0) if tie is not None else 0
    target = max(1, -(-((known or 0) + unknown) // n_shards))

    def divided(before: Column, size: Column) -> Column:
        return F.least(F.floor((before + tie * size) / target), F.lit(n_shards - 1)).cast("int")
    null_shard = divided(F.lit(0), F.lit(unknown)) if unknown > target else F.lit(0)
    if lo is None:
        return rows.withColumn("shard", null_shard)
    top = 1 << 63
    shift = max(0, ((lo ^ top) & (2 * top - 1) ^ (hi ^ top) & (2 * top - 1)).bit_length() - CELL_BITS)
    cells: dict[tuple[int, int], int] = {}
    heavy: list[int] | None = None
    upper = 64
    while True:
        cell = F.shiftrightunsigned(key, shift)
        part = sizes.where("id is not null")
        if heavy is not None:
            part = part.where(F.shiftrightunsigned(key, upper).isin(heavy))
        found = {r[0]: r[1] for r in part.groupBy(cell.alias("c")).agg(F.sum("size")).collect()}
        cells.update({(shift, c): n for c, n in found.items()})
        heavy = [c for c, n in found.items() if n > target]
        if not heavy or shift == 0:
            break
        for c in heavy:
            del cells[(shift, c)]
        upper, shift = shift, max(0, shift - CELL_BITS)
    before, levels = unknown, {}
    for (s, c), n in sorted(cells.items(), key=lambda x: (x[0][1] % (1 << (64 - x[0][0]))) << x[0][0]):
        own = before if tie is not None and s == 0 and n > target else None
        levels.setdefault(s, []).append((c, min(n_shards - 1, (before + n // 2) // target), own, n))
        before += n
    out, names = rows, []
    for k, (s, found) in enumerate(sorted(levels.items())):
        table = spark.createDataFrame(found, f"_cell{k} long, _shard{k} int, _before{k} long, _size{k} long")
        out = out.join(F.broadcast(table), F.shiftrightunsigned(_order(F.col(id_col)), s) == F.col(f"_cell{k}"), "left").drop(f"_cell{k}")
        if any(x[2] is not None for x in found):
            at = F.when(F.col(f"_before{k}").isNotNull(), divided(F.col(f"_before{k}"), F.col(f"_size{k}"))).otherwise(F.col(f"_shard{k}"))
            out = out.withColumn(f"_shard{k}", at)
        out = out.drop(f"_before{k}", f"_size{k}")
        names.append(f"_shard{k}")
    return out.withColumn("shard", F.coalesce(*names, null_shard)).drop(*names)


def one_task_each(rows: DataFrame, n_shards: int) -> DataFrame:
    """``rows`` repartitioned so that every shard has a task of its own: shards go by a
    number whose hash falls on the shard, instead of by their own number's hash,
    which would put several into one task and leave others without."""
    spark = rows.sparkSession
    falls = F.pmod(F.hash("id"), F.lit(n_shards))
    numbers = spark.range(32 * n_shards).groupBy(falls.alias("shard")).agg(F.min("id").alias("task"))
    # one row per shard
    return (rows.join(F.broadcast(numbers), "shard", "left").withColumn("task", F.coalesce("task", F.col("shard").cast("long")))
            .repartition(n_shards, "task"))


def _local(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style URI."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    # Hadoop's names of the s3 scheme
    return pafs.FileSystem.from_uri("s3://" + path.split("://", 1)[1] if path.startswith(("s3a://", "s3n://")) else path)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id}/{digest}/{copy}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, wbits=31)     # a gzip member without a time stamp
    return packer.compress(f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None, copy: int) -> bytes:
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest, copy)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    headers += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest, 0))]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    return _record(headers, http if revisit else http + payload)


class _File:
    """One archive file under a temporary name; ``close`` renames it and returns its manifest row."""

    def __init__(self, root: str, shard: int, number: int):
        self.fs, base = _local(root)
        self.shard, self.number, self.name = shard, number, f"part-{shard:06d}-{number:05d}.warc.gz"
        self.temp, self.final = f"{base}/.{self.name}.{uuid.uuid4().hex}.tmp", f"{base}/{self.name}"
        self.fs.create_dir(base, recursive=True)
        self.out, self.bytes, self.records, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        self.add(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_IDS, self.name)}>"), ("WARC-Date", DATE),
                          ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], INFO))

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.fs.move(self.temp, self.final)
        return self.shard, self.number, self.name, self.bytes, self.records, self.sha.hexdigest()


MANIFEST = "shard int, number int, name string, bytes long, records long, sha256 string"


def write_warc(pages: DataFrame, path: str, n_shards: int | None = None, roll_bytes: int = ROLL_BYTES,
               id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write one record per row of ``pages`` under ``path``.

    Of rows with equal payloads the one with the smallest page_id is a response, the
    others are revisits of it (a null page_id is never the smallest unless all are null;
    of repeated rows with that page_id the first is the response). Null payload: empty;
    null url: no target header. An empty table writes an empty manifest."""
    spark = pages.sparkSession
    n_shards = n_shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    # payloads are read twice: once for this narrow table, once to be written
    narrow = written(rows.select("id", F.sha1("payload").alias("digest"), (F.octet_length("payload") + 512).cast("long").alias("size")), "warc-narrow")
    repeated = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marks = narrow.join(repeated, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "digest", "first").distinct()
    everything = rows.select("id", F.sha1("payload").alias("digest"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first"), "url", "payload")
    everything = marks.select("id", "digest", F.lit(0).alias("kind"), "first", F.lit(None).cast("string").alias("url"),
                              F.lit(None).cast("binary").alias("payload")).unionByName(everything)
    # the digest's first 32 bits divide an id that is larger than a shard
    tie = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") / float(1 << 32)
    placed = one_task_each(with_shard(everything, narrow, "id", n_shards, tie), n_shards)
    placed = placed.sortWithinPartitions("shard", "id", "digest", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: _File | None = None
        last, copy, mark = None, 0, None
        done = []
        for batch in batches:
            for x in batch.to_pylist():
                here = (x["id"], x["digest"])
                if here != last:
                    last, copy, mark = here, 0, None
                if x["kind"] == 0:
                    mark = (x["first"],)
                    continue
                revisit = mark is not None or copy > 0
                data = page_record(x["id"], x["url"], x["payload"], revisit, mark[0] if mark else x["id"], copy)
                copy += 1
                if file is not None and (file.shard != x["shard"] or file.bytes + len(data) > roll_bytes):
                    done.append(file.close())
                    file = _File(path, x["shard"], file.number + 1 if file.shard == x["shard"] else 0)
                file = file or _File(path, x["shard"], 0)
                file.add(data)
        if file is not None:
            done.append(file.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (
                pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))], ["shard", "number", "name", "bytes", "records", "sha256"])

    placed.mapInArrow(run, MANIFEST).write.parquet(f"{path}/_manifest")


def _members(stream, sha) -> Iterator[bytes]:
    """The gzip members of an archive, one at a time."""
    unpack, held = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        sha.update(data)
        while data:
            held.append(unpack.decompress(data))
            data = b""
            if unpack.eof:
                yield b"".join(held)
                data, held, unpack = unpack.unused_data, [], zlib.decompressobj(31)
    if any(held):
        raise ValueError("archive ends inside a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest differs in {headers['WARC-Record-ID']}")
    return headers, block


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per page record of the files in the manifest (others don't count): page_id,
    url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, the payload
    (null for revisits). Digests are recomputed; a file that differs from its manifest row fails."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    files = max(1, manifest.count())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _local(path)
        rows, held = [], 0
        for batch in batches:
            for f in batch.to_pylist():
                sha = hashlib.sha256()
                with fs.open_input_stream(f"{base}/{f['name']}", compression=None) as stream:
                    for record in _members(stream, sha):
                        headers, block = parse(record)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                        revisit = headers["WARC-Type"] == "revisit"
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not revisit and (length != len(body) or digest != base32_sha1(body)):
                            raise ValueError(f"payload differs in {headers['WARC-Record-ID']}")
                        number = [int(v) if (v := headers.get(h)) is not None else None for h in ("X-Page-ID", "X-Refers-To-Page-ID")]
                        row = (number[0], headers.get("WARC-Target-URI"), length, digest, headers["WARC-Type"], number[1])
                        rows.append(row + ((None if revisit else body,) if payload else ()))
                        held += len(body) if payload else 0
                        if len(rows) >= 4096 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if sha.hexdigest() != f["sha256"]:
                    raise ValueError(f"{f['name']} differs from the manifest")
        if rows:
            yield batch_of(rows)

    return manifest.select("name", "sha256").repartition(files).mapInArrow(run, RECORDS + (", payload binary" if payload else ""))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payload=False).drop("url")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
