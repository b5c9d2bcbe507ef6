"""Media columns: content-addressed payloads in tar shards, read back by byte ranges.

A payload is a text's UTF-8 bytes with zeros up to a positive multiple of 64. It is stored losslessly as an
8-bit grayscale PNG, 64 samples wide, under the name of its SHA-256 digest, in a tar shard. Every payload is stored
once, however many rows and tasks hold it: digests that occur once are told from the others by a narrow count and
go to the shards from where they are, the others meet by digest first, with partial aggregation, so a group of
copies of any size sends one payload a task. Rows carry digest, shard, offset and length of the stored form.
Metadata columns come from range reads of the PNG header alone (33 bytes), contents from range reads of the whole
member, both once for each stored form. Equal texts have equal values in all columns.

Shards lie in the shared folder. A shard is written under a name of its own attempt and then moved to the name
that its rows carry, so a task that is lost and run again leaves whole shards only; the table of places is written
before anything is read back, so rows and shards belong together. Shards are the operator's product and stay.

Null texts count as empty. Repeated rows each get a row. An empty table gives no rows and no shards. Columns named
in keep are carried along; one with the name of a new column gives way to it. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bitmap, col, perhaps_in, shared_dir, small_batches, table, written

WIDTH = 64
#: A shard is closed beyond so many bytes, and the next begun.
SHARD_BYTES = 128 << 20
HEADER_BYTES = 33
LEVEL = 6
#: The rows of a payload that more rows than this hold are dealt over so many join keys.
HOT_ROWS, SALTS = 1000, 32
#: Stored forms that a task reads back, about, and bytes of a shard that are read by one task.
READ_ROWS, READ_BYTES = 8192, 16 << 20
NEW = (
    "n_bytes", "payload_bytes", "digest", "shard", "offset", "length", "width", "height", "bits",
    "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "hot",
)

_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: str | bytes | None) -> bytes:
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def payload_column(raw: Column) -> Column:
    """payload_of() of a binary column."""
    zeros = F.when(F.octet_length(raw) == 0, WIDTH).otherwise(F.pmod(-F.octet_length(raw), F.lit(WIDTH)))
    return F.concat(raw, F.substring(F.lit(bytes(WIDTH)), F.lit(1), zeros.cast("int")))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """An 8-bit grayscale PNG of the payload, one row for each 64 bytes."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), dtype=np.uint8)  # each line begins with its filter type, 0
    lines[:, 1:] = rows
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bits a sample, from the first 33 bytes."""
    if head[:8] != _SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", head[16:25])


def from_png(png: bytes) -> bytes:
    """The samples of a PNG of to_png."""
    width, height, _ = png_header(png[:HEADER_BYTES])
    body, at = [], 8
    while at < len(png):
        size, kind = struct.unpack(">I4s", png[at : at + 8])
        if kind == b"IDAT":
            body.append(png[at + 8 : at + 8 + size])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(body)), dtype=np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def feature_of(payload: bytes, width: int, height: int, bits: int) -> str:
    """Geometry from the header, and mean, deviation and zero share of the samples read back."""
    x = np.frombuffer(payload, dtype=np.uint8)
    return f"png:{width}x{height}x{bits};mean={x.mean():.4f};std={x.std():.4f};zeros={(x == 0).mean():.4f}"


def _files(folder: str):
    """The file system of a folder as Spark names it, and the path in it."""
    if "://" not in folder:  # a plain path, or Hadoop's file:/path
        folder = "file://" + folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1) if folder.startswith("s3a://") else folder)


class _Shards:
    """Tar shards that one task attempt writes."""

    def __init__(self, folder: str, task: int):
        self.fs, self.root = _files(folder)
        self.task, self.number, self.out = task, 0, None

    def put(self, payload: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.name = f"shard-{self.task:06d}-{self.number:04d}-{uuid.uuid4().hex[:8]}.tar"
            self.out, self.at = self.fs.open_output_stream(f"{self.root}/{self.name}.part"), 0
        png = to_png(payload)
        info = tarfile.TarInfo(hashlib.sha256(payload).hexdigest() + ".png")
        info.size = len(png)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.out.write(head + png + bytes(-len(png) % 512))
        place = (self.name, self.at + len(head), len(png))
        self.at += len(head) + len(png) + -len(png) % 512
        if self.at >= SHARD_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.fs.move(f"{self.root}/{self.name}.part", f"{self.root}/{self.name}")
            self.out, self.number = None, self.number + 1


def store_payloads(payloads: DataFrame, folder: str) -> DataFrame:
    """Writes the payloads of payloads(digest, raw) into tar shards, each row once: digest, payload_bytes, shard, offset, length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder, TaskContext.get().partitionId())
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [(len(p), *shards.put(p)) for p in map(payload_of, batch.column(1).to_pylist())]
            made = [pa.array(v, k) for v, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["digest", "payload_bytes", "shard", "offset", "length"])
        shards.close()

    files, root = _files(folder)
    files.create_dir(root, recursive=True)
    return payloads.select("digest", "raw").mapInArrow(run, "digest binary, payload_bytes long, shard string, offset long, length long")


def _stored(docs: DataFrame, folder: str, keep: tuple[str, ...], text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stores every different payload once. Returns the rows (keep, n_bytes, digest, hot) and the places of the stored
    forms (digest, hot, payload_bytes, shard, offset, length), to be put together by placed()."""
    small_batches(docs)
    keep = [c for c in dict.fromkeys(keep) if c not in NEW]
    raw = F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary")
    digest = F.unhex(F.sha2(payload_column(raw), 256))
    narrow = written(docs.select(*[col(c) for c in keep], F.octet_length(raw).cast("long").alias("n_bytes"), digest.alias("digest")))
    key = F.xxhash64("digest")
    counts = written(narrow.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    twice, many = bitmap(counts, F.col("key")), bitmap(counts.where(F.col("n") > HOT_ROWS), F.col("key"))
    marked = perhaps_in(docs.select(raw.alias("raw"), digest.alias("digest")), key, twice, "repeated")
    met = marked.where("repeated").groupBy("digest").agg(F.first("raw").alias("raw"))
    places = written(store_payloads(marked.where("not repeated").select("digest", "raw").unionByName(met), folder))
    return perhaps_in(narrow, key, many, "hot"), perhaps_in(places, key, many, "hot")


def placed(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """rows(..., digest, hot) with the columns of their stored forms. The rows of a hot payload are dealt over SALTS
    keys, for each of which its one stored row is repeated."""
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*[col(c) for c in rows.columns]), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    each = stored.withColumn("__salt", F.explode(salts)).drop("hot")
    both = rows.withColumn("__salt", salt).join(each, ["digest", "__salt"]).drop("__salt", "hot")
    return both.withColumn("digest", F.lower(F.hex("digest")))


def store_media(docs: DataFrame, folder: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Writes payloads into tar shards under folder: keep, n_bytes, payload_bytes, digest, shard, offset, length."""
    got = placed(*_stored(docs, folder, keep, text_col))
    return got.select(*[col(c) for c in got.columns if c not in NEW], *NEW[:6])


def header_columns(index: DataFrame, folder: str) -> DataFrame:
    """index with width, height and bits, from a 33-byte range read of each row's stored form."""
    return _ranged(index, folder, HEADER_BYTES, [("width", pa.int64()), ("height", pa.int64()), ("bits", pa.int64())], png_header)


def _contents(png: bytes) -> tuple:
    payload = from_png(png)
    width, height, bits = png_header(png[:HEADER_BYTES])
    return (
        hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(png), hashlib.sha256(png).hexdigest(), feature_of(payload, width, height, bits),
    )


def content_columns(index: DataFrame, folder: str) -> DataFrame:
    """index with digests, checksum and feature of what is read back of each row's stored form."""
    kinds = [("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    return _ranged(index, folder, None, kinds, _contents)


def _ranged(index: DataFrame, folder: str, head: int | None, kinds: list, f) -> DataFrame:
    """Reads head bytes (None: all) at each row's offset, with one shard open at a time."""
    known = [c for c in index.columns if c not in dict(kinds)]
    source = index.select(*[col(c) for c in known])
    new = [T.StructField(name, T.StringType() if kind == pa.string() else T.LongType()) for name, kind in kinds]
    schema = T.StructType([*source.schema.fields, *new])
    at = [known.index(c) for c in ("shard", "offset", "length")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        name, opened = None, None
        try:
            for batch in batches:
                rows = []
                for shard, offset, length in zip(*(batch.column(i).to_pylist() for i in at)):
                    if shard != name:
                        if opened is not None:
                            opened.close()
                        name, opened = shard, files.open_input_file(f"{root}/{shard}")
                    rows.append(f(opened.read_at(length if head is None else min(head, length), offset)))
                if rows:
                    arrays = [batch.column(i) for i in range(len(known))] + [pa.array(v, k) for v, (_, k) in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        finally:
            if opened is not None:
                opened.close()

    return source.mapInArrow(run, schema)


def media_table(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Stores every text's payload and returns its row with place, header and content columns."""
    folder = shared_dir(docs.sparkSession)
    rows, places = _stored(docs, folder, keep, text_col)
    # the table of places is small beside what it points to: its rows are dealt out by shard, as many tasks as reads need
    tasks = max(1, -(-places.count() // READ_ROWS))
    places = places.repartition(tasks, "shard", F.floor(F.col("offset") / READ_BYTES))
    return placed(rows, written(content_columns(header_columns(places, folder), folder)))


def op8_media_columns(spark, sf_dir):
    got = media_table(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature",
        "digest", "shard", "offset", "length", "width", "height", "bits",
    )
