"""WARC archives of pages: sharded by range, rolled by compressed size, committed through a manifest.

Shards are ranges of (page_id, payload hash) with bounds from a sample by content hash, and every
record is a gzip member without a time stamp: the same pages give the same files, byte by byte.
A task writes files under temporary names and reports them; the report is a Spark table, so of
several attempts of a task one counts. Files of that report get their names, then the manifest is
written. Readers know a file by the manifest only. Paths are those of ``pyarrow.fs``: local, hdfs, s3, gs.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, map_rows, written

SHARD_BYTES = 1 << 25  # payload of a shard, about; more where that would be over MAX_SHARDS
MAX_SHARDS = 10_000
SAMPLED = 32           # sampled rows per shard
FILE_BYTES = 1 << 26   # compressed size from which the next file is begun
READ_BYTES = 1 << 20
# Fixed values of the format.
VERSION, BREAK = b"WARC/1.1", b"\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NO_ID = "none"

REPORT = ("shard int, seq int, temporary string, name string, records bigint, bytes bigint, sha1 string, "
          "first_page bigint, last_page bigint")
RECORD = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
          "refers_to bigint, record_id string, file string, position bigint, payload binary")


def located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, key: bytes, copy: int) -> str:
    """Names the page, the payload and which of several equal rows it is."""
    return f"<urn:page:{NO_ID if page_id is None else page_id}:{key.hex()}:{copy}>"


def page_of(identifier: str) -> int | None:
    page = identifier.split(":")[2]
    return None if page == NO_ID else int(page)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers),
             f"Content-Length: {len(block)}".encode()]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(BREAK.join(lines) + 2 * BREAK + block + 2 * BREAK) + packer.flush()


def page_record(page_id: int | None, url: str | None, key: bytes, payload: bytes, copy: int,
                original: str | None) -> bytes:
    """A response, or with ``original`` (a record id) a revisit of it, without the payload."""
    block = HTTP.format(len(payload)).encode() + (payload if original is None else b"")
    headers = [("WARC-Type", "response" if original is None else "revisit"),
               ("WARC-Record-ID", record_id(page_id, key, copy)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=URL_CHARACTERS)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}")]
    if original is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", original)]
    return record([*headers, ("Content-Type", "application/http; msgtype=response")], block)


# Printable ASCII but the space; other characters are percent-encoded, so none can end a header line.
URL_CHARACTERS = "".join(map(chr, range(33, 127)))


class Roll:
    """Files of one shard; a new one begins once the last reached ``limit`` compressed bytes."""

    def __init__(self, folder: str, shard: int, attempt: str, limit: int):
        self.system, self.folder = located(folder)
        self.shard, self.attempt, self.limit, self.seq, self.out = shard, attempt, limit, -1, None

    def add(self, page_id: int | None, data: bytes) -> Iterator[dict]:
        if self.out is None:
            self.seq += 1
            self.name = f"pages-{self.shard:05d}-{self.seq:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{self.attempt}"
            self.out = self.system.open_output_stream(f"{self.folder}/{self.temporary}")
            self.sha1, self.size, self.records, self.first = hashlib.sha1(), 0, 0, page_id
            self.put(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{self.name}>"),
                             ("WARC-Date", DATE), ("WARC-Filename", self.name),
                             ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self.put(data)
        self.records, self.last = self.records + 1, page_id
        if self.size >= self.limit:
            yield from self.close()

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.size += len(data)

    def close(self) -> Iterator[dict]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield {"shard": [self.shard], "seq": [self.seq], "temporary": [self.temporary], "name": [self.name],
                   "records": [self.records], "bytes": [self.size], "sha1": [self.sha1.hexdigest()],
                   "first_page": [self.first], "last_page": [self.last]}


def prepared(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("bigint"), "url", payload.alias("payload"),
                        F.unhex(F.sha2(payload, 256)).alias("key"))


def bounds_of(keys: DataFrame, shard_bytes: int) -> list[tuple[int, bytes]]:
    """First (page_id, key) of every shard but the first: cuts of a sample, which depends on contents only."""
    n, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = min(MAX_SHARDS, -(-total // shard_bytes))
    if shards < 2:
        return []
    share = min(1.0, SAMPLED * shards / n)
    chosen = F.xxhash64("page_id", "key") < int((share - 0.5) * (1 << 64)) if share < 1 else F.lit(True)
    sample = sorted((r["at"], bytes(r["key"]), r["size"]) for r in keys.filter(chosen).select(
        shard_id().alias("at"), "key", "size").collect())
    step, reached, cuts = sum(x[2] for x in sample) / shards, 0, []
    for at, key, size in sample:
        if reached >= step * (len(cuts) + 1):
            cuts.append((at, key))
        reached += size
    return sorted(set(cuts))


def shard_id() -> "F.Column":
    """Null page ids come first."""
    return F.coalesce("page_id", F.lit(-(1 << 63)))


def write_archives(pages: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``path``, a new folder; returns the manifest.

    Of rows with equal payloads that of the largest page_id (null is smallest; of equal ids one) is the
    response, the others are revisits of it. Null html counts as empty, a null url gives no target, repeated
    rows give a record each. No page gives a manifest without files. Payloads are shuffled once, by range;
    which ones repeat is found on hashes, and those decisions are sorted in before the pages they are for.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = prepared(pages)
    keys = written(rows.select("page_id", "key", F.octet_length("payload").cast("bigint").alias("size")), "warc-keys")
    # Written, so that a hot key is split by the skew join: nothing lies between its shuffles and the join.
    repeated = written(keys.groupBy("key").agg(F.count("*").alias("n"), F.max("page_id").alias("winner"))
                       .filter("n > 1").select("key", "winner"), "warc-repeated")
    decisions = (keys.join(repeated, "key").select("page_id", "key", "winner").distinct()
                 .select("page_id", "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                         F.lit(None).cast("binary").alias("payload"), "winner"))
    bounds = bounds_of(keys, shard_bytes)

    @F.pandas_udf("int")
    def shard(at: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, (int(a), bytes(k))) for a, k in zip(at, key)], dtype="int32")

    parts = len(bounds) + 1
    together = (rows.select("page_id", "key", F.lit(1).alias("kind"), "url", "payload",
                            F.lit(None).cast("bigint").alias("winner")).unionByName(decisions)
                .withColumn("shard", shard(shard_id(), F.col("key")) if bounds else F.lit(0))
                .repartitionById(parts, "shard").sortWithinPartitions("page_id", "key", "kind", "url"))
    root = path.rstrip("/")
    system, folder = located(root)
    system.create_dir(f"{folder}/_temporary")

    def start():
        import uuid
        attempt, roll, own, copies, decided = uuid.uuid4().hex, None, None, 0, None

        def step(batch):
            nonlocal roll, own, copies, decided
            if batch is None:
                yield from roll.close() if roll else ()
                return
            columns = [batch[c] for c in ("page_id", "key", "kind", "url", "payload", "winner", "shard")]
            for i in range(batch.num_rows):
                page_id, key, kind, url, payload, winner, place = (c[i].as_py() for c in columns)
                if (page_id, key) != own:
                    own, copies, decided = (page_id, key), 0, None
                if kind == 0:
                    decided = (winner,)
                    continue
                roll = roll or Roll(root, place, attempt, file_bytes)
                first = decided is None or (winner_is(decided[0], page_id) and copies == 0)
                original = None if first else record_id(decided[0], key, 0)
                yield from roll.add(page_id, page_record(page_id, url, key, payload, copies, original))
                copies += 1
        return step

    report = written(map_rows(together, REPORT, start), "warc-report")

    def commit():
        target, base = located(root)

        def step(batch):
            if batch is None:
                return
            for row in batch.to_pylist():
                source, name = f"{base}/{row['temporary']}", f"{base}/{row['name']}"
                if target.get_file_info(source).type != arrow_fs.FileType.NotFound:
                    target.move(source, name)
                elif target.get_file_info(name).size != row["bytes"]:
                    raise FileNotFoundError(f"{name}: neither committed nor there to commit")
                yield {k: [v] for k, v in row.items()}
        return step

    done = map_rows(report.repartition("name"), REPORT, commit).drop("temporary")
    done.write.parquet(f"{root}/_manifest")
    system.delete_dir(f"{folder}/_temporary")
    return manifest(spark, path)


def winner_is(winner: int | None, page_id: int | None) -> bool:
    return winner == page_id


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of a finished archive with size, digest, number of records and first and last page."""
    return spark.read.parquet(f"{path.rstrip('/')}/_manifest")


def members(stream) -> Iterator[tuple[int, bytes]]:
    """Position and content of every gzip member."""
    position, data = 0, b""
    while True:
        unpacker, parts, used = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            data = data or stream.read(READ_BYTES)
            if not data:
                if used:
                    raise EOFError("a record is cut off")
                return
            parts.append(unpacker.decompress(data))
            used += len(data) - len(unpacker.unused_data)
            data = unpacker.unused_data
        yield position, b"".join(parts)
        position += used


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    head, rest = content.split(2 * BREAK, 1)
    version, *lines = head.split(BREAK)
    if version != VERSION:
        raise ValueError(f"no record: {version!r}")
    headers = {name.lower(): value for name, value in (x.decode().split(": ", 1) for x in lines)}
    block = rest[:int(headers["content-length"])]
    if rest[len(block):] != 2 * BREAK:
        raise ValueError(f"{headers['warc-record-id']}: wrong length")
    return headers, block


def page_row(headers: dict[str, str], block: bytes) -> dict:
    """A record as a row; digests are computed again, and payload lengths read from the block."""
    identifier, kind = headers["warc-record-id"], headers["warc-type"]
    if headers["warc-block-digest"] != f"sha1:{digest_of(block)}":
        raise ValueError(f"{identifier}: block and digest differ")
    head, payload = block.split(2 * BREAK, 1)
    size = int(next(x for x in head.split(BREAK) if x.startswith(b"Content-Length: "))[16:])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload), digest_of(payload)) != (size, digest):
        raise ValueError(f"{identifier}: payload and digest differ")
    refers = headers.get("warc-refers-to")
    return {"page_id": page_of(identifier), "url": headers.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": size, "payload_digest": digest, "refers_to": refers and page_of(refers),
            "record_id": identifier, "payload": payload if kind == "response" else None}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per page record of the files in the manifest, each file read by one task as a stream.

    A wrong length or digest, or a file that ends inside a record, raises. ``payload`` is null for revisits,
    and for all rows with ``payloads=False``. An archive without pages gives no row.
    """
    bounded_batches(spark)
    root = path.rstrip("/")
    files = manifest(spark, path).select("name")
    n = files.count()

    def start():
        system, folder = located(root)

        def step(batch):
            for name in batch["name"].to_pylist() if batch is not None else []:
                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    held, size = [], 0
                    for position, content in members(stream):
                        headers, block = parsed(content)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        row = page_row(headers, block)
                        if not payloads:
                            row["payload"] = None
                        held.append(row | {"file": name, "position": position})
                        size += len(row["payload"] or b"") + 500
                        if size >= READ_BYTES:
                            yield {c: [x[c] for x in held] for c in held[0]}
                            held, size = [], 0
                    if held:
                        yield {c: [x[c] for x in held] for c in held[0]}
        return step

    return map_rows(files.repartition(max(1, min(n, MAX_SHARDS))), RECORD, start)
