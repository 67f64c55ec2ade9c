"""Sorted, block-gzipped tables with an index, so that a region is read from its own blocks only.

Each part file has the usual index of such tables beside it (.tbi, for places below 2^29: bins of six sizes, and the first place of every
16 kb); a small list of the parts and the chromosomes in them stands in the folder.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .block_gzip import _END, BLOCK_BYTES, BlockFile, pack_block

#: Fixed values of the index format: first bin and width (as a power of two) of each level, the finest first; the width of linear windows.
_LEVELS = ((4681, 14), (585, 17), (73, 20), (9, 23), (1, 26))
_WINDOW = 14
_LIST = "_regions.json"


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds [begin, end), from 0; bin 0 holds everything."""
    return next((first + (begin >> shift) for first, shift in _LEVELS if begin >> shift == max(begin, end - 1) >> shift), 0)


def bins_over(begin: int, end: int) -> Iterator[int]:
    """All bins that may hold intervals that overlap [begin, end)."""
    yield 0
    for first, shift in _LEVELS:
        yield from range(first + (begin >> shift), first + (max(begin, end - 1) >> shift) + 1)


@dataclass
class _Chromosome:
    """Places are (bytes of file before the block) << 16 | bytes of text before it in the block."""

    bins: dict[int, list[list[int]]] = field(default_factory=dict)
    first: list[int] = field(default_factory=list)  # by window, the first place of an interval that overlaps it
    begin: int = 1 << 62
    end: int = 0

    def add(self, begin: int, end: int, start: int, stop: int) -> None:
        chunks = self.bins.setdefault(bin_of(begin, end), [])
        if chunks and chunks[-1][1] == start:
            chunks[-1][1] = stop
        else:
            chunks.append([start, stop])
        last = max(begin, end - 1) >> _WINDOW
        self.first += [0] * (last + 1 - len(self.first))
        for w in range(begin >> _WINDOW, last + 1):
            self.first[w] = self.first[w] or start + 1  # one more, as 0 stands for none
        self.begin, self.end = min(self.begin, begin), max(self.end, end)

    def chunks_over(self, begin: int, end: int) -> list[tuple[int, int]]:
        """Stretches of the file that hold all intervals overlapping [begin, end), joined where they touch."""
        windows = self.first[begin >> _WINDOW :]
        least = next((x - 1 for x in windows if x), 1 << 62)
        found = sorted(tuple(c) for b in bins_over(begin, end) for c in self.bins.get(b, []) if c[1] > least)
        out: list[tuple[int, int]] = []
        for lo, hi in found:
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], hi))
            else:
                out.append((lo, hi))
        return out


def pack_index(chromosomes: dict[str, _Chromosome], columns: tuple[int, int, int]) -> bytes:
    """columns: where chromosome, begin and end (from 0, not included) stand, from 1."""
    names = b"".join(c.encode() + b"\0" for c in chromosomes)
    out = [b"TBI\1", struct.pack("<8i", len(chromosomes), 0x10000, *columns, ord("#"), 0, len(names)), names]
    for c in chromosomes.values():
        out.append(struct.pack("<i", len(c.bins)))
        for number, chunks in sorted(c.bins.items()):
            out.append(struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *x) for x in chunks))
        filled, last = [], 0
        for x in c.first:  # an empty window has the place of the one before
            last = x - 1 if x else last
            filled.append(last)
        out.append(struct.pack(f"<i{len(filled)}Q", len(filled), *filled))
    data = b"".join(out)
    return b"".join(pack_block(data[i : i + BLOCK_BYTES]) for i in range(0, len(data), BLOCK_BYTES)) + _END


def unpack_index(data: bytes) -> dict[str, _Chromosome]:
    count, *_, size = struct.unpack_from("<8i", data, 4)
    names = data[36 : 36 + size].split(b"\0")[:count]
    at, out = 36 + size, {}
    for name in names:
        c = out[name.decode()] = _Chromosome()
        (bins,) = struct.unpack_from("<i", data, at)
        at += 4
        for _ in range(bins):
            number, chunks = struct.unpack_from("<Ii", data, at)
            at += 8
            c.bins[number] = [list(struct.unpack_from("<QQ", data, at + 16 * i)) for i in range(chunks)]
            at += 16 * chunks
        (windows,) = struct.unpack_from("<i", data, at)
        c.first = [x + 1 for x in struct.unpack_from(f"<{windows}Q", data, at + 4)]
        at += 4 + 8 * windows
    return out


@dataclass
class _Written(WriterCommitMessage):
    name: str
    spans: list[tuple[str, int, int]]  # chromosome, least begin, greatest end


class _Writer(DataSourceWriter):
    def __init__(self, path: str, columns: tuple[int, int, int]):
        self.path, self.columns = path, columns

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        fs, folder = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.gz"
        chromosomes: dict[str, _Chromosome] = {}
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            held, written = bytearray(), 0
            for row in iterator:
                start = written << 16 | len(held)
                held += row["value"].encode() + b"\n"
                while len(held) >= BLOCK_BYTES:
                    block = pack_block(bytes(held[:BLOCK_BYTES]))
                    out.write(block)
                    written += len(block)
                    del held[:BLOCK_BYTES]
                chromosomes.setdefault(row["chrom"], _Chromosome()).add(row["begin"], row["end"], start, written << 16 | len(held))
            if held:
                out.write(pack_block(bytes(held)))
            out.write(_END)
        with fs.open_output_stream(f"{folder}/{name}.tbi", compression=None) as out:
            out.write(pack_index(chromosomes, self.columns))
        return _Written(name, [(k, c.begin, c.end) for k, c in chromosomes.items()])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """The list of parts, in order; files of attempts that didn't count go."""
        fs, folder = pafs.FileSystem.from_uri(self.path)
        kept = sorted((m for m in messages if m), key=lambda m: m.name)
        names = {m.name for m in kept}
        for found in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if found.base_name.startswith("part-") and found.base_name.removesuffix(".tbi") not in names:
                fs.delete_file(found.path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{_LIST}", compression=None) as out:
            out.write(json.dumps({"columns": self.columns, "parts": [{"name": m.name, "spans": m.spans} for m in kept]}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            if m:
                for name in (m.name, f"{m.name}.tbi"):
                    fs.delete_file(f"{folder}/{name}")


@dataclass
class _Stretch(InputPartition):
    path: str
    start: int
    stop: int


def lines_between(file: BlockFile, start: int, stop: int) -> Iterator[bytes]:
    """The lines from one place to another, both at lines' beginnings."""
    at, skip, rest = start >> 16, start & 0xFFFF, b""
    while at <= stop >> 16 and (at < stop >> 16 or stop & 0xFFFF):
        last = at == stop >> 16
        text, at = file._must(at)
        *whole, rest = (rest + text[skip : stop & 0xFFFF if last else None]).split(b"\n")
        skip = 0
        yield from whole
        if last:
            break


class _Reader(DataSourceReader):
    def __init__(self, path: str, chrom: str, begin: int, end: int):
        self.path, self.chrom, self.begin, self.end = path, chrom, begin, end

    def partitions(self) -> list[InputPartition]:
        fs, folder = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(f"{folder}/{_LIST}") as file:
            parts = json.loads(file.read())["parts"]
        out: list[InputPartition] = []
        for part in parts:
            if any(c == self.chrom and lo < self.end and self.begin < hi for c, lo, hi in part["spans"]):
                index = BlockFile(f"{self.path}/{part['name']}.tbi")
                data, at = b"", 0
                while at < index.size:
                    text, at = index._must(at)
                    data += text
                out += [_Stretch(f"{self.path}/{part['name']}", lo, hi) for lo, hi in unpack_index(data)[self.chrom].chunks_over(self.begin, self.end)]
        return out or [_Stretch("", 0, 0)]

    def read(self, partition: _Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        batch: list[str] = []
        for line in lines_between(BlockFile(partition.path), partition.start, partition.stop):
            batch.append(line.decode())
            if len(batch) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], names=["value"])
                batch = []
        if batch:
            yield pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], names=["value"])


class RegionSource(DataSource):
    """Lines of an indexed table: written with chrom, begin, end and value; read by region."""

    @classmethod
    def name(cls) -> str:
        return "indexed_regions"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["chrom"], int(self.options["begin"]), int(self.options["end"]))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], tuple(json.loads(self.options["columns"])))


def write_indexed(table: DataFrame, path: str, chrom: str, begin: str, end: str, parts: int | None = None) -> None:
    """A table as tab-separated lines without header in a new folder, sorted by place, in as many block-gzipped and indexed parts.

    begin is counted from 0 and end isn't included; neither they nor the chromosome may be null. Other nulls are empty.
    """
    spark = table.sparkSession
    spark.dataSource.register(RegionSource)
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in table.columns])
    columns = [table.columns.index(c) + 1 for c in (chrom, begin, end)]
    rows = table.select(F.col(chrom).cast("string").alias("chrom"), F.col(begin).cast("long").alias("begin"), F.col(end).cast("long").alias("end"), line.alias("value"))
    order = ["chrom", "begin", "end", "value"]
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.format("indexed_regions").mode("append").option("path", path).option("columns", json.dumps(columns)).save()


def read_region(spark: SparkSession, path: str, columns: dict[str, str], chrom: str, begin: str, end: str, region: tuple[str, int, int]) -> DataFrame:
    """The rows of an indexed table that overlap a region (chromosome, begin from 0, end not included), from its blocks only.

    columns: names and types of all of the table's columns, in order.
    """
    spark.dataSource.register(RegionSource)
    raw = spark.read.format("indexed_regions").options(path=path, chrom=region[0], begin=region[1], end=region[2]).load()
    cells = F.split("value", "\t", -1)
    kinds: list[Column] = [cells[i].cast(kind).alias(name) for i, (name, kind) in enumerate(columns.items())]
    rows = raw.select(*kinds)
    # an empty interval counts as its first base
    return rows.where((F.col(chrom) == region[0]) & (F.col(begin) < region[2]) & (F.greatest(F.col(end), F.col(begin) + 1) > region[1]))
