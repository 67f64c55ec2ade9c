"""Wide files without a pivot, and indexed tables read by region, against plain versions."""

import csv
import gzip
import random

import pytest
from pyspark.sql import functions as F

from probeloom.sources import block_gzip as B
from probeloom.sources import readers as R
from probeloom.sources import region_index as X
from probeloom.sources import writers as W


def folder_lines(path):
    return [line for f in sorted(path.glob("part-*")) if not f.name.endswith(".crc") for line in f.read_text().splitlines()]


def test_wide_file_with_gaps_quotes_and_nulls(spark, tmp_path):
    rows = [("s2", "b", 1.5), ("s1", "a", 2.0), ("s1", 'c,"x"', None), ("s1", None, 4.0), ("s3", "a", None), ("s1", "a", 1.0), (None, "b", 7.0), ('q"1', "d", 0.0)]
    W.write_wide_matrix(spark.createDataFrame(rows, "s string, v string, x double"), f"file://{tmp_path}/w", "s", "v", "x")
    lines = list(csv.reader(folder_lines(tmp_path / "w")))
    assert lines[0] == ["s", "", "a", "b", 'c,"x"', "d"]
    assert {tuple(x) for x in lines[1:]} == {("s1", "4.0", "2.0", "", "", ""), ("s2", "", "", "1.5", "", ""), ("s3", "", "", "", "", ""), ("", "", "", "7.0", "", ""), ('q"1', "", "", "", "", "0.0")}
    back = R.read_wide_matrix(spark, f"file://{tmp_path}/w", ["s"]).where("value is not null and sample_id <> ''")
    assert {tuple(r) for r in back.collect()} == {("s1", "", 4.0), ("s1", "a", 2.0), ("s2", "b", 1.5), ('q"1', "d", 0.0)}


def test_six_header_levels_and_a_hundred_thousand_columns(spark, tmp_path):
    levels = ["Gene ID", "Gene", "Mutation Name", "ExonicFunc", "AA Change", "Targeted"]
    names = [F.concat(F.lit("id"), F.col("id") % 50), F.concat(F.lit("g"), F.col("id") % 50), F.concat(F.lit("m"), F.lpad(F.col("id").cast("string"), 6, "0")), F.lit("missense_variant"), F.concat(F.lit("Ala"), "id", F.lit("Val")), F.when(F.col("id") % 9 == 0, "Yes").otherwise("No")]
    columns = spark.range(100_000).select("id", *[c.alias(n) for c, n in zip(names, levels)])
    cells = columns.crossJoin(spark.range(4).select(F.concat(F.lit("s"), "id").alias("sample_id"), F.col("id").alias("k"))).where("(id + k) % 3 > 0").withColumn("x", (F.col("id") * 4 + F.col("k")).cast("double"))
    W.write_header_matrix(cells, f"file://{tmp_path}/m", "sample_id", levels, "x")
    lines = folder_lines(tmp_path / "m")
    assert [x.split(",")[0] for x in lines] == [*levels, "s0", "s1", "s2", "s3"] and {x.count(",") for x in lines} == {100_000}
    back = R.read_wide_matrix(spark, f"file://{tmp_path}/m", levels).where("value is not null")
    assert back.select("sample_id", *levels, "value").exceptAll(cells.select("sample_id", *levels, "x")).count() == 0
    assert back.count() == cells.count()


def test_bins_hold_their_intervals():
    rng = random.Random(1)
    for _ in range(3000):
        begin = rng.randrange(1 << 29 - rng.randrange(20))
        end = min(begin + rng.choice([0, 1, 50, 20_000, 10**6, 10**8]), 1 << 29)
        lo = max(0, begin - rng.randrange(1000))
        assert X.bin_of(begin, end) in set(X.bins_over(lo, max(end, lo + 1)))
    assert X.bin_of(0, 1) == 4681 and X.bin_of(0, 1 << 14) == 4681 and X.bin_of(0, (1 << 14) + 1) == 585 and X.bin_of(0, 1 << 29) == 0


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = []
    for i in range(30_000):
        begin = rng.randrange(3_000_000)
        rows.append((f"chr{rng.choice([1, 1, 1, 2, 10])}", begin, begin + rng.choice([0, 1, 1, 1, 90, 40_000, 2_000_000]), f"n{i}", None if i % 5 else "xé"))
    folder = tmp_path_factory.mktemp("regions")
    df = spark.createDataFrame(rows, "chrom string, begin long, end long, name string, note string")
    X.write_indexed(df, f"file://{folder}/t", "chrom", "begin", "end", parts=3)
    return rows, df, folder / "t"


def test_parts_are_sorted_gzip_with_an_index(indexed):
    rows, _, folder = indexed
    parts = sorted(folder.glob("part-*.gz"))
    assert len(parts) == 3 and all((folder / f"{p.name}.tbi").exists() for p in parts)
    lines = [x.split("\t") for p in parts for x in gzip.decompress(p.read_bytes()).decode().splitlines()]
    assert [(x[0], int(x[1]), int(x[2])) for x in lines] == sorted((r[0], r[1], r[2]) for r in rows)
    for p in parts:
        index = gzip.decompress((folder / f"{p.name}.tbi").read_bytes())
        assert index[:4] == b"TBI\1" and X.unpack_index(index).keys() == {x.split(b"\t")[0].decode() for x in gzip.decompress(p.read_bytes()).splitlines()}


@pytest.mark.parametrize("region", [("chr1", 0, 1), ("chr1", 1_000_000, 1_000_400), ("chr2", 0, 5_000_000), ("chr10", 2_999_000, 3_500_000), ("chr10", 9_000_000, 9_000_001), ("chr3", 0, 10)])
def test_a_region_equals_a_filter(spark, indexed, region):
    rows, df, folder = indexed
    got = X.read_region(spark, f"file://{folder}", dict(df.dtypes), "chrom", "begin", "end", region).collect()
    want = [(c, b, e, n, x or "") for c, b, e, n, x in rows if c == region[0] and b < region[2] and max(e, b + 1) > region[1]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_region_touches_only_its_blocks(indexed, monkeypatch):
    """Intervals of one length class near each other: a short region needs a block or two of a file of many."""
    _, _, folder = indexed
    rng = random.Random(5)
    c, held, places = X._Chromosome(), b"", []
    file = folder.parent / "short.gz"
    written, out = 0, bytearray()
    for begin in sorted(rng.randrange(2_000_000) for _ in range(60_000)):
        start = written << 16 | len(held)
        held += f"chr1\t{begin}\t{begin + 1}\t{rng.random()}\n".encode()
        if len(held) >= 4000:
            block = B.pack_block(held[:4000])
            out += block
            written, held = written + len(block), held[4000:]
        c.add(begin, begin + 1, start, written << 16 | len(held))
        places.append(begin)
    file.write_bytes(bytes(out) + B.pack_block(held) + B._END)
    read = []
    own = B.BlockFile.member
    monkeypatch.setattr(B.BlockFile, "member", lambda self, at: read.append(at) or own(self, at))
    again = X.unpack_index(gzip.decompress(X.pack_index({"chr1": c}, (1, 2, 3))))["chr1"]
    found = [line for lo, hi in again.chunks_over(1_000_000, 1_000_200) for line in X.lines_between(B.BlockFile(str(file)), lo, hi)]
    inside = [x for x in found if 1_000_000 <= int(x.split(b"\t")[1]) < 1_000_200]
    assert len(inside) == sum(1_000_000 <= p < 1_000_200 for p in places)
    assert len(set(read)) <= 12 and written / 1500 > 300  # of some hundred blocks


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "chrom string, begin long, end long")
    X.write_indexed(df, f"file://{tmp_path}/e", "chrom", "begin", "end")
    assert X.read_region(spark, f"file://{tmp_path}/e", dict(df.dtypes), "chrom", "begin", "end", ("chr1", 0, 10)).count() == 0
    assert W.matrix_lines(spark.createDataFrame([], "s string, v string, x double"), "s", ["v"], "x").count() == 0
