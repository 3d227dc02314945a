"""Token ids in seekable zstandard files: one frame per document, a seek table at the end.

File layout: one independent zstandard frame per document (its ids as little-endian
unsigned 32-bit integers), a skippable frame with the document ids, and as the last
skippable frame the seek table of the public "seekable format": for each frame its
compressed size, its decompressed size and the low 32 bits of the XXH64 of its content, then
the number of frames, a descriptor and the magic number. Any zstandard tool can unpack the file;
a reader that wants a few documents reads the tail, seeks to their frames and unpacks only them.

Defined results: null text is an empty document (just the end id); null ids come first in the
order; equal rows are written one after another; an empty table gives no file and no row; other
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editsieve.llm.bpe import PieceEncoder, tokenizer_path
from editsieve.llm.common import bucket_bounds, bucket_of, id_text, scratch_path, settle, shuffle_width

# Fixed values of the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
HAS_CHECKSUM = 0x80

DOCS_PER_FILE = 8192
END_ID = 2
MANIFEST = "bucket int, path string, n_docs long, n_ids long"
DOCUMENT = "doc_id long, local_start long, n_tokens long, ids_crc32 long, path string"


class FrameWriter:
    """Streams frames to one file; the file gets its name only when it is complete."""

    def __init__(self, folder: str, name: str, level: int = 1):
        import xxhash
        import zstandard

        self.hash = xxhash.xxh64_intdigest
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.final, self.part = f"{root}/{name}.zst", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.path = f"{folder.rstrip('/')}/{name}.zst"
        self.out = self.files.open_output_stream(self.part)
        self.table = bytearray()
        self.doc_ids: list[int | None] = []
        self.n_ids = 0

    def _entry(self, packed: int, plain: int, check: int) -> None:
        self.table += struct.pack("<III", packed, plain, check)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.out.write(frame)
        self._entry(len(frame), len(ids), self.hash(ids) & 0xFFFFFFFF)
        self.doc_ids.append(doc_id)
        self.n_ids += len(ids) // 4

    def close(self) -> None:
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8).tobytes()
        ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes()
        body = ids + known
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        self._entry(8 + len(body), 0, 0)
        frames = len(self.doc_ids) + 1
        tail = bytes(self.table) + struct.pack("<IBI", frames, HAS_CHECKSUM, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(tail)) + tail)
        self.out.close()
        self.files.move(self.part, self.final)


class FrameReader:
    """Random access to one file: ``doc_ids``, ``lengths`` (ids per document) and ``ids(i)``."""

    def __init__(self, path: str):
        import xxhash
        import zstandard

        self.hash = xxhash.xxh64_intdigest
        self.unpacker = zstandard.ZstdDecompressor()
        files, inner = fs.FileSystem.from_uri(path)
        self.file = files.open_input_file(inner)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & HAS_CHECKSUM:
            raise ValueError(f"{path}: no seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), dtype="<u4").reshape(-1, 3)
        self.sizes, self.checks = table[:-1, 1].astype(np.int64), table[:-1, 2]
        self.starts = np.concatenate(([0], np.cumsum(table[:, 0].astype(np.int64))))
        n = frames - 1
        body = self._at(int(self.starts[n]) + 8, int(table[n, 0]) - 8)
        raw, known = np.frombuffer(body, dtype="<i8", count=n), np.frombuffer(body, dtype=np.uint8, offset=8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(raw, known)]
        self.lengths = self.sizes // 4

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def ids(self, i: int) -> bytes:
        frame = self._at(int(self.starts[i]), int(self.starts[i + 1] - self.starts[i]))
        plain = self.unpacker.decompress(frame) if self.sizes[i] else b""
        if len(plain) != self.sizes[i] or self.hash(plain) & 0xFFFFFFFF != int(self.checks[i]):
            raise ValueError(f"frame {i}: wrong content")
        return plain

    def close(self) -> None:
        self.file.close()


def write_frames(
    docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = END_ID, docs_per_file: int = DOCS_PER_FILE
) -> DataFrame:
    """Write all documents in ascending id order and return the manifest, one row per file.

    Ranges of ids become files; the ranges come from quantiles of the id column alone, so texts are
    shuffled once. A file is written under a name of its own and renamed when complete, and the manifest
    names the files of finished tasks only: a lost executor leaves at most a stray file.
    """
    rows = id_text(docs)
    bounds = bucket_bounds(docs, "doc_id", docs_per_file)
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        enc, open_bucket, out, done = PieceEncoder.of(tokenizer), None, None, []

        def finish() -> None:
            out.close()
            done.append((open_bucket, out.path, len(out.doc_ids), out.n_ids))

        for batch in batches:
            for bucket, doc_id, ids in zip(
                batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), enc.stream(batch.column("text"))
            ):
                if bucket != open_bucket:
                    if out:
                        finish()
                    open_bucket, out = bucket, FrameWriter(folder, f"ids-{bucket:06d}-{uuid.uuid4().hex[:8]}")
                out.add(doc_id, ids + end)
        if out:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["bucket", "path", "n_docs", "n_ids"],
            )

    placed = rows.withColumn("bucket", bucket_of(F.col("doc_id"), bounds))
    width = min(shuffle_width(docs.sparkSession), len(bounds) + 1)
    sorted_rows = placed.repartition(width, "bucket").sortWithinPartitions("bucket", "doc_id", "text")
    return settle(sorted_rows.mapInArrow(write, MANIFEST), "frames-manifest")


def file_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``: the ids in all files before this one. One row per file."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_frames(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """Documents of the files, or only those with the ``wanted`` ids (their frames alone are unpacked)."""
    spark = manifest.sparkSession
    chosen = None if wanted is None else frozenset(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file = FrameReader(path)
                starts = np.concatenate(([0], np.cumsum(file.lengths)))
                take = [i for i, d in enumerate(file.doc_ids) if chosen is None or d in chosen]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.doc_ids[i] for i in take], pa.int64()),
                        pa.array([int(starts[i]) for i in take], pa.int64()),
                        pa.array([int(file.lengths[i]) for i in take], pa.int64()),
                        pa.array([zlib.crc32(file.ids(i)) for i in take], pa.int64()),
                        pa.array([path] * len(take), pa.string()),
                    ],
                    names=["doc_id", "local_start", "n_tokens", "ids_crc32", "path"],
                )
                file.close()

    return manifest.select("path").repartition(shuffle_width(spark)).mapInArrow(read, DOCUMENT)


def token_frames(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` and read them back: start, number and checksum of each document."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    manifest = write_frames(docs, scratch_path(spark, "token-frames"), path)
    starts = settle(file_starts(manifest).select("path", "start"), "frame-starts")
    return read_frames(manifest).join(starts, "path").select(
        "doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
