"""Token-id files of independent zstandard frames with a trailing seek table (op 10).

A file is a run of zstandard frames, one per document, in ascending document order, followed by a
skippable frame with the document ids and the public "seekable format" table: per frame the
compressed size, the raw size and the low 32 bits of the raw bytes' XXH64, then the number of
frames, a descriptor byte and a magic number. Any zstandard reader can decompress the whole file;
`read_documents` decompresses only the frames it is asked for.

Order: doc_id ascending, null ids first, then by xxhash64 of the text and the text itself. A null
text is empty and has the end id alone; repeated rows are documents of their own; an empty table
gives no file and no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SLICE_BYTES, filesystem, map_rows, raw_text, work_dir, written
from .tokens import coder

# Fixed values of the public zstandard seekable format.
SKIPPABLE_IDS, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Chunks in a generation of the writing workers' caches (about 100 MB); a smaller one only takes longer.
CACHE_CHUNKS = 800_000


class FrameWriter:
    """Writes frames to a stream; close() appends the ids and the seek table."""

    def __init__(self, stream, level: int = 1):
        self.stream, self.zip = stream, zstandard.ZstdCompressor(level=level)
        self.ids: list[int | None] = []
        self.seek: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.zip.compress(raw)
        self.stream.write(frame)
        self.ids.append(doc_id)
        self.seek.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        present = np.array([i is not None for i in self.ids], dtype="u1")
        ids = np.array([i or 0 for i in self.ids], dtype="<i8")
        body = ids.tobytes() + present.tobytes()
        self.stream.write(struct.pack("<II", SKIPPABLE_IDS, len(body)) + body)
        table = np.array(self.seek, dtype="<u4").reshape(-1, 3).tobytes()
        foot = struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(foot)) + table + foot)
        self.stream.close()


class FrameReader:
    """Reads a file's tables, then single frames by number; a wrong checksum raises ValueError."""

    def __init__(self, file, size: int):
        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        file.seek(size - 9)
        n, flag, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        file.seek(size - 9 - 12 * n)
        self.seek = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.seek[:, 0])])
        file.seek(int(self.at[-1]) + 8)
        ids, present = np.frombuffer(file.read(8 * n), "<i8"), file.read(n)
        self.ids = [int(i) if p else None for i, p in zip(ids, present, strict=True)]

    def frame(self, k: int) -> bytes:
        self.file.seek(int(self.at[k]))
        size, raw_size, check = self.seek[k].tolist()
        raw = self.unzip.decompress(self.file.read(size), max_output_size=max(1, raw_size))
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: wrong checksum")
        return raw


def write_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the documents' ids to files in the shared folder.

    Returns one row per file (part, path, n_docs, n_ids), parts in document order. Each attempt of
    a task writes a file of its own name and only finished ones are listed, so a lost executor
    leaves at most a file that no row names.
    """
    folder = folder or work_dir(docs.sparkSession, "frames")
    fs, path = filesystem(folder)
    fs.create_dir(path)
    tail = struct.pack("<I", end_id)

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part, code, out, n_ids = TaskContext.get().partitionId(), coder(tokenizer, CACHE_CHUNKS), None, 0
        uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        for group in _groups(it):
            if out is None:
                tfs, tpath = filesystem(uri)
                out = FrameWriter(tfs.open_output_stream(tpath, compression=None))
            for (doc_id, _), ids in zip(group, code.ids([t for _, t in group]), strict=True):
                out.add(doc_id, ids + tail)
                n_ids += len(ids) // 4 + 1
        if out is not None:
            out.close()
            yield part, uri, len(out.ids), n_ids

    ranged = (docs.select("doc_id", raw_text().alias("text"), F.xxhash64("text").alias("h"))
              .repartitionByRange(F.col("doc_id").asc_nulls_first(), "h")
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "text").select("doc_id", "text"))
    return written(map_rows(ranged, rows, "part int, path string, n_docs long, n_ids long", ("tokens",)), "frame-files")


def _groups(it: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows in groups of about SLICE_BYTES of text."""
    held, size = [], 0
    for r in it:
        held.append(r)
        size += len(r[-1] or b"") + 64
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def starts(files: DataFrame) -> DataFrame:
    """Adds `start`, the ids of all files before; the table has one row per file, not per document."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def dealt(files: DataFrame, *columns: str) -> DataFrame:
    """The files, spread over as many tasks as Spark's parallelism: a stated number, which adaptive
    execution does not merge into one task although the table itself is tiny."""
    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return files.select(*columns).repartition(4 * n, "path")


def read_back(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        for path, start in it:
            fs, p = filesystem(path)
            with fs.open_input_file(p) as f:
                r = FrameReader(f, f.size())
                for k, doc_id in enumerate(r.ids):
                    raw = r.frame(k)
                    yield doc_id, start, len(raw) // 4, zlib.crc32(raw)
                    start += len(raw) // 4

    todo = dealt(starts(files), "path", "start")
    return map_rows(todo, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the wanted documents only: other frames are neither read nor decompressed.

    `wanted` (doc_id) is matched with the files' id tables by a join, so it may be large.
    """

    def listed(it: Iterator[tuple]) -> Iterator[tuple]:
        for (path,) in it:
            fs, p = filesystem(path)
            with fs.open_input_file(p) as f:
                for k, doc_id in enumerate(FrameReader(f, f.size()).ids):
                    yield path, k, doc_id

    def frames(it: Iterator[tuple]) -> Iterator[tuple]:
        path, f, r = None, None, None
        for where, k, doc_id in it:
            if where != path:
                if f is not None:
                    f.close()
                fs, p = filesystem(path := where)
                f = fs.open_input_file(p)
                r = FrameReader(f, f.size())
            yield doc_id, np.frombuffer(r.frame(k), "<u4").astype(np.int64).tolist()

    index = map_rows(dealt(files, "path"), listed, "path string, k int, doc_id long")
    hits = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    return map_rows(hits.select("path", "k", "doc_id").repartition("path").sortWithinPartitions("path", "k"),
                    frames, "doc_id long, ids array<long>")
