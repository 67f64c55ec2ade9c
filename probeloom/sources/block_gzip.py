"""Block-gzipped text: one file read by many tasks, and written with its blocks' places known.

Such a file is a chain of gzip members of at most 64 KB each, which say in their headers how long they are. Any gzip
reader can read it from the start; readers that know the headers can begin at any member.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Fixed values of the format: how a member begins, and the empty member at the end of a file.
_MAGIC = b"\x1f\x8b\x08\x04"
_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_HEADER = 18
#: Text in a member, compressed bytes in a task, text in a batch.
BLOCK_BYTES, SPLIT_BYTES, BATCH_BYTES = 65_280, 16 << 20, 1 << 20

SCHEMA = "path string, part int, line long, value string"


def pack_block(text: bytes) -> bytes:
    """One member with at most BLOCK_BYTES of text."""
    for level in (6, 0):  # text that compression makes longer is stored
        deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = deflate.compress(text) + deflate.flush()
        if len(body) + _HEADER + 8 <= 1 << 16:
            break
    head = _MAGIC + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + _HEADER + 7)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


def _member_size(head: bytes) -> int | None:
    """The length of the member that begins so; None if none does."""
    if len(head) < _HEADER or head[:4] != _MAGIC:
        return None
    extra = head[12 : 12 + struct.unpack("<H", head[10:12])[0]]
    while len(extra) >= 4:
        n = struct.unpack("<H", extra[2:4])[0]
        if extra[:2] == b"BC" and n == 2 and len(extra) >= 6:
            return struct.unpack("<H", extra[4:6])[0] + 1
        extra = extra[4 + n :]
    return None


def _unpack(member: bytes) -> bytes | None:
    """The text of a member; None if it isn't one."""
    skip = 12 + struct.unpack("<H", member[10:12])[0]
    try:
        text = zlib.decompress(member[skip:-8], -15)
    except zlib.error:
        return None
    return text if struct.unpack("<II", member[-8:]) == (zlib.crc32(text), len(text)) else None


class BlockFile:
    """Members of one file, from any place on."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1))
        self.file = fs.open_input_file(name)
        self.size = self.file.size()

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The text of the member at a place, and the place after it; None if there is none."""
        size = _member_size(self.file.read_at(min(4096, self.size - at), at))
        if size is None or at + size > self.size:
            return None
        text = _unpack(self.file.read_at(size, at))
        return None if text is None else (text, at + size)

    def first_at(self, place: int) -> int:
        """Where the first member at or after a place begins; the file's size if none does."""
        at = place
        while at < self.size:
            window = self.file.read_at(min(1 << 17, self.size - at), at)
            found = window.find(_MAGIC)
            while found >= 0:
                whole = self.member(at + found)  # a chance likeness of the magic inside a member doesn't unpack
                if whole and (whole[1] == self.size or self.file.read_at(4, whole[1]) == _MAGIC):
                    return at + found
                found = window.find(_MAGIC, found + 1)
            at += max(1, len(window) - 3)
        return self.size

    def lines(self, lo: int, hi: int) -> Iterator[bytes]:
        """Lines that belong to the members that begin in [lo, hi).

        Those are the lines that begin after the first line's end there (or at the file's start) and up to the place
        where the next members begin, that place included; the last one is read to its end, however far it goes.
        """
        at, rest, skips = self.first_at(lo) if lo else 0, b"", lo > 0
        if at >= hi:
            return
        while at < hi and at < self.size:
            text, at = self._must(at)
            if skips:
                cut = text.find(b"\n")
                if cut < 0:
                    continue
                text, skips = text[cut + 1 :], False
            *whole, rest = (rest + text).split(b"\n")
            yield from whole
        if skips:
            return
        pieces = [rest]
        while at < self.size:
            text, at = self._must(at)
            cut = text.find(b"\n")
            pieces.append(text if cut < 0 else text[:cut])
            if cut >= 0:
                yield b"".join(pieces)
                return
        if any(pieces):
            yield b"".join(pieces)

    def _must(self, at: int) -> tuple[bytes, int]:
        found = self.member(at)
        if found is None:
            raise ValueError(f"no block begins at {at}")
        return found


@dataclass
class _Stretch(InputPartition):
    path: str
    part: int
    lo: int
    hi: int


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split: int):
        self.files, self.split = files, split

    def partitions(self) -> list[InputPartition]:
        cuts = [(path, lo, min(lo + self.split, size)) for path, size in self.files for lo in range(0, size, self.split)]
        return [_Stretch(path, i, lo, hi) for i, (path, lo, hi) in enumerate(cuts)] or [_Stretch("", 0, 0, 0)]

    def read(self, partition: _Stretch) -> Iterator[pa.RecordBatch]:
        if partition.lo == partition.hi:
            return
        batch, size, line = [], 0, 0

        def out() -> pa.RecordBatch:
            n = len(batch)
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * n), pa.array([partition.part] * n, pa.int32()), pa.array(range(line - n, line), pa.int64()), pa.array(batch, pa.string())], names=["path", "part", "line", "value"])

        for text in BlockFile(partition.path).lines(partition.lo, partition.hi):
            batch.append(text.removesuffix(b"\r").decode(errors="replace"))
            size, line = size + len(text) + 64, line + 1
            if size > BATCH_BYTES:
                yield out()
                batch, size = [], 0
        if batch:
            yield out()


@dataclass
class _Written(WriterCommitMessage):
    path: str


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        """One file with the values of a task's rows as lines."""
        from pyspark import TaskContext

        fs, folder = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.gz"
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            held = bytearray()
            for row in iterator:
                held += row["value"].encode() + b"\n"
                while len(held) >= BLOCK_BYTES:
                    out.write(pack_block(bytes(held[:BLOCK_BYTES])))
                    del held[:BLOCK_BYTES]
            if held:
                out.write(pack_block(bytes(held)))
            out.write(_END)
        return _Written(f"{folder}/{name}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of attempts that didn't count go."""
        fs, folder = pafs.FileSystem.from_uri(self.path)
        kept = {m.path for m in messages if m}
        for found in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if found.base_name.startswith("part-") and found.path not in kept:
                fs.delete_file(found.path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m:
                fs, _ = pafs.FileSystem.from_uri(self.path)
                fs.delete_file(m.path)


class BlockGzipSource(DataSource):
    """Lines of block-gzipped files: path, part (of all files in order), line (in its part) and value."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader([tuple(x) for x in json.loads(self.options["files"])], int(self.options.get("split", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The files that a path, a folder or a pattern names, and their sizes."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(place) or []:
        for status in fs.listStatus(found.getPath()):
            if not status.isDirectory() and not status.getPath().getName().startswith(("_", ".")):
                out.append((status.getPath().toUri().toString(), status.getLen()))
    if not out:
        raise FileNotFoundError(path)
    return sorted(out)


def read_block_gzip(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    """path, part, line and value of the lines of block-gzipped files: about one task for each split bytes of a file.

    A line belongs to the task where it begins; within a path, part and line are its order. Files of plain gzip members
    are an error. Empty files have no lines.
    """
    spark.dataSource.register(BlockGzipSource)
    return spark.read.format("block_gzip").option("files", json.dumps(_files(spark, path))).option("split", split).load()


def write_block_gzip(lines: DataFrame, path: str) -> None:
    """Lines (column value) as a new folder of block-gzipped files, one for each task; null values are left out."""
    spark = lines.sparkSession
    spark.dataSource.register(BlockGzipSource)
    lines.select("value").where("value IS NOT NULL").write.format("block_gzip").mode("append").option("path", path).save()
