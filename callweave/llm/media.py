"""Media columns: payloads stored as grey-scale images in archives, and read back
by a Spark data source.

A payload is a row of frames of 576 samples of 8 bits and is stored as a PNG of
that width, without loss.  Images are members of stored (not deflated) ZIP
archives.  The source plans byte ranges of the archives; a task opens the archive
of a range once, reads its central directory, takes the members whose header
starts in the range, and streams them in small Arrow batches.  Every member is read and
decoded on its own at its offset, and retried on its own.
"""

from __future__ import annotations

import io
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .bpe import small_batches
from .storage import open_filesystem, shared_folder

FRAME, PAD = 576, b"\xff"
ARCHIVE_BYTES, RANGE_BYTES, BATCH_BYTES, ATTEMPTS = 32 << 20, 8 << 20, 4 << 20, 3
MOST_TASKS = 100_000  # that a read is planned as
PNG_MAGIC = b"\x89PNG\r\n\x1a\n"  # fixed value of the format
SCHEMA = "archive string, member string, offset long, media binary, payload binary, attempts int"


def to_payload(text: str | None) -> bytes:
    """UTF-8 bytes, padded with bytes 255 (which UTF-8 never has) to whole frames, at least one."""
    raw = (text or "").encode("utf-8", "replace")
    return raw + PAD * (-len(raw) % FRAME if raw else FRAME)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes) -> bytes:
    """An 8-bit grey-scale PNG, FRAME wide, one row a frame, rows unfiltered."""
    import numpy as np

    rows = np.frombuffer(payload, np.uint8).reshape(-1, FRAME)
    framed = np.zeros((len(rows), FRAME + 1), np.uint8)
    framed[:, 1:] = rows
    head = struct.pack(">IIBBBBB", FRAME, len(rows), 8, 0, 0, 0, 0)
    return PNG_MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(framed.tobytes(), 1)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> bytes:
    """Samples of an image as ``encode_png`` writes it; ValueError if it is damaged or another kind."""
    import numpy as np

    if media[:8] != PNG_MAGIC:
        raise ValueError("no PNG")
    at, body, head = 8, [], b""
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + data) != struct.unpack_from(">I", media, at + 8 + size)[0]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IHDR":
            head = data
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + size
    width, height, *form = struct.unpack(">IIBBBBB", head)
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if form != [8, 0, 0, 0, 0] or rows[:, 0].any():
        raise ValueError("not an unfiltered 8-bit grey-scale PNG")
    return rows[:, 1:].tobytes()


def write_archives(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Stores every row's text and returns the path of the manifest table
    (archive, bytes, members).  A member's name holds the id (``null`` for none)
    and a number.  A task that runs twice leaves an archive that no manifest row
    names.  A task holds one archive in memory: ARCHIVE_BYTES and the longest text."""
    folder = folder or shared_folder(docs.sparkSession, "media")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fs, root = open_filesystem(folder)
        fs.create_dir(root, recursive=True)
        schema = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("members", pa.int64())])
        held = io.BytesIO()
        zipped, members = zipfile.ZipFile(held, "w", zipfile.ZIP_STORED), 0

        def close() -> pa.RecordBatch:
            zipped.close()
            data, name = held.getvalue(), f"{uuid.uuid4().hex}.zip"
            with fs.open_output_stream(f"{root}/{name}.part") as out:
                out.write(data)
            fs.move(f"{root}/{name}.part", f"{root}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(data)]), pa.array([members])], schema=schema)

        for whole in batches:
            for b in small_batches(whole):
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    zipped.writestr(zipfile.ZipInfo(f"{'null' if doc is None else doc}/{members}.png"), encode_png(to_payload(text)))
                    members += 1
                    if held.tell() > ARCHIVE_BYTES:
                        yield close()
                        held = io.BytesIO()
                        zipped, members = zipfile.ZipFile(held, "w", zipfile.ZIP_STORED), 0
        if members:
            yield close()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    manifest = f"{folder}/manifest"
    src.mapInArrow(run, "archive string, bytes long, members long").write.parquet(manifest)
    return manifest


@dataclass
class ByteRanges(InputPartition):
    """What one task reads: (archive, start, stop) of some ranges."""

    ranges: list[tuple[str, int, int]]


class MediaReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.manifest, self.folder = options.get("manifest"), options.get("path")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def _archives(self) -> list[tuple[str, int]]:
        from pyarrow import fs as pafs

        if self.manifest:
            import pyarrow.dataset as ds

            fs, at = open_filesystem(self.manifest)
            files = [f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.path.endswith(".parquet")]
            if not files:
                return []
            table = ds.dataset(files, filesystem=fs, format="parquet").to_table(columns=["archive", "bytes"])
            return sorted(zip(table.column("archive").to_pylist(), table.column("bytes").to_pylist()))
        fs, at = open_filesystem(self.folder)
        base = self.folder.rstrip("/")
        found = fs.get_file_info(pafs.FileSelector(at, recursive=True))
        return sorted((f"{base}/{f.path[len(at.rstrip('/')) + 1:]}", f.size) for f in found if f.path.endswith(".zip"))

    def partitions(self) -> list[ByteRanges]:
        """One row for each archive is read here; members are never listed on the driver.
        Of very many ranges, several in a row make a task."""
        step = self.range_bytes
        ranges = [(a, at, min(at + step, n)) for a, n in self._archives() for at in range(0, n, step)]
        each = -(-len(ranges) // MOST_TASKS) or 1
        return [ByteRanges(ranges[i : i + each]) for i in range(0, len(ranges), each)] or [ByteRanges([])]

    def _member(self, file, archive: str, info: zipfile.ZipInfo) -> tuple[bytes, bytes, int]:
        """Stored bytes, payload and attempts of one member, read at its offset: first
        from the file that is open for the range, then from the archive opened anew."""
        for attempt in range(1, self.attempts + 1):
            try:
                media = _stored(file, info) if attempt == 1 else self._opened_anew(archive, info)
                if len(media) != info.file_size or zlib.crc32(media) != info.CRC:
                    raise ValueError(f"{archive} at {info.header_offset}: damaged member")
                return media, decode_png(media), attempt
            except (OSError, ValueError, struct.error, zlib.error):
                if attempt == self.attempts:
                    raise
                time.sleep(0.1 * 2**attempt)
        raise AssertionError("attempts must be positive")

    def _opened_anew(self, archive: str, info: zipfile.ZipInfo) -> bytes:
        fs, at = open_filesystem(archive)
        with fs.open_input_file(at) as f:
            return _stored(f, info)

    def _members(self, ranges: list[tuple[str, int, int]]) -> Iterator[tuple]:
        for archive, start, stop in ranges:
            fs, at = open_filesystem(archive)
            with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                for info in z.infolist():
                    if start <= info.header_offset < stop:
                        yield (archive, info.filename, info.header_offset, *self._member(f, archive, info))

    def read(self, partition: ByteRanges) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("payload", pa.binary()), ("attempts", pa.int32())])
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        rows: list[tuple] = []
        size = 0
        for row in self._members(partition.ranges):
            rows.append(row)
            size += len(row[3]) + len(row[4])
            if size > BATCH_BYTES:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


def _stored(file, info: zipfile.ZipInfo) -> bytes:
    """The bytes of a stored member, at its offset in the archive."""
    file.seek(info.header_offset)
    head = file.read(30)
    name, extra = struct.unpack("<HH", head[26:30])
    file.seek(info.header_offset + 30 + name + extra)
    return file.read(info.file_size)


class MediaArchives(DataSource):
    """``spark.read.format("media_archives")`` with option manifest (as
    ``write_archives`` returns) or path (a folder of archives)."""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MediaReader:  # type: ignore[no-untyped-def]
        return MediaReader(dict(self.options))


def read_archives(spark: SparkSession, **options: str) -> DataFrame:
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").options(**options).load()


def describe(payload: bytes) -> tuple[int, str]:
    """Length without padding, and signal features of the samples."""
    import numpy as np

    x = np.frombuffer(payload, np.uint8)
    found = np.bincount(x, minlength=256)
    share = found[found > 0] / len(x)
    level = float(found @ np.arange(256)) / len(x)
    power = float(found @ np.arange(256) ** 2) / len(x)
    above = x > level
    crossings = np.count_nonzero(above[1:] != above[:-1]) / len(x)
    feature = f"mean={level:.3f};rms={power**0.5:.3f};entropy={float(-(share * np.log2(share)).sum()):.4f};crossings={crossings:.4f}"
    return len(payload.rstrip(PAD)), feature


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature), one row per row of ``docs``, from the stored bytes.

    Null counts as empty, whose payload is one frame of padding.  Equal texts
    give equal values; rows may repeat; ids may be null; other columns are
    ignored; an empty table gives no rows.
    """
    stored = read_archives(docs.sparkSession, manifest=write_archives(docs, None, id_col, text_col))

    @F.pandas_udf("n_bytes long, feature string")
    def described(payloads):  # type: ignore[no-untyped-def]
        import pandas as pd

        return pd.DataFrame([describe(p) for p in payloads], columns=["n_bytes", "feature"])

    owner = F.split_part("member", F.lit("/"), F.lit(1))
    return stored.withColumn("d", described("payload")).select(
        F.when(owner != "null", owner).cast("long").alias("doc_id"),
        "d.n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "d.feature",
    )
