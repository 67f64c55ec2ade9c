"""Block-gzipped files read in pieces against the plain reader."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from probeloom.sources import block_gzip as B
from probeloom.sources import readers as R


def write(path, text, block):
    data = b"".join(B.pack_block(text[i : i + block]) for i in range(0, len(text), block)) + B._END
    path.write_bytes(data)
    return data


def some_text(rng, n, longest):
    return "\n".join("".join(rng.choices("ACGT@+ é\t", k=rng.randrange(longest))) for _ in range(n)).encode()


def test_blocks_are_gzip(tmp_path):
    rng = random.Random(1)
    text = some_text(rng, 2000, 90) + rng.randbytes(200_000)  # what compression makes longer is stored
    write(tmp_path / "a.gz", text, 65_280)
    assert gzip.decompress((tmp_path / "a.gz").read_bytes()) == text


@pytest.mark.parametrize("end", [b"", b"\n", b"\n\n", b"\nno end"])
@pytest.mark.parametrize("block,longest", [(7, 5), (50, 400), (3000, 60)])
def test_any_cut_gives_each_line_once(tmp_path, block, longest, end):
    rng = random.Random(block)
    text = some_text(rng, 150, longest) + end
    data = write(tmp_path / "a.gz", text, block)
    want = text.split(b"\n")
    if want[-1] == b"":
        want.pop()
    for split in (1, 31, 97, 1000, 10**6):
        file = B.BlockFile(str(tmp_path / "a.gz"))
        assert [x for lo in range(0, len(data), split) for x in file.lines(lo, min(lo + split, len(data)))] == want, split


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(3)
    text = some_text(rng, 4000, 80) + b"\r\nlast\n"
    write(tmp_path / "a.gz", text, 900)
    write(tmp_path / "b.gz", b"", 900)
    lines = B.read_block_gzip(spark, f"file://{tmp_path}", split=5000)
    assert lines.rdd.getNumPartitions() > 10
    got = [r["value"] for r in lines.orderBy("path", "part", "line").collect()]
    assert got == [x.removesuffix("\r") for x in text.decode().split("\n")[:-1]]
    assert sorted(got) == sorted(r["value"] for r in spark.read.option("lineSep", "\n").text(f"file://{tmp_path}/a.gz").select(F.regexp_replace("value", "\r$", "").alias("value")).collect())


def test_plain_gzip_and_missing_files_are_errors(spark, tmp_path):
    with gzip.open(tmp_path / "plain.gz", "wb") as f:
        f.write(b"x\n" * 10)
    file = B.BlockFile(str(tmp_path / "plain.gz"))
    with pytest.raises(ValueError, match="no block"):
        list(file.lines(0, file.size))
    with pytest.raises(FileNotFoundError):
        B.read_block_gzip(spark, f"file://{tmp_path}/none-*.gz")


def test_writer_and_fastq_records_across_blocks(spark, tmp_path):
    rng = random.Random(4)
    records = [(f"r{i}", "".join(rng.choices("ACGT", k=rng.randrange(1, 300)))) for i in range(3000)]
    lines = spark.createDataFrame([(f"@{n}\n{s}\n+\n{'I' * len(s)}",) for n, s in records] + [(None,)], "value string").coalesce(2)
    B.write_block_gzip(lines, f"file://{tmp_path}/out")
    files = sorted(tmp_path.glob("out/part-*.gz"))
    assert len(files) == 2 and (tmp_path / "out" / "_SUCCESS").exists()
    text = "".join(gzip.decompress(f.read_bytes()).decode() for f in files)
    assert text.count("\n") == 4 * len(records)
    (tmp_path / "one").mkdir()
    data = b"".join(f.read_bytes()[: -len(B._END)] for f in files) + B._END  # members of several files make one
    (tmp_path / "one" / "all.gz").write_bytes(data)
    for folder in ("out", "one"):
        got = R.read_fastq(spark, f"file://{tmp_path}/{folder}", block_gzip=True)
        assert sorted((r["id"], r["seq"], r["qual"]) for r in got.collect()) == sorted((n, s, "I" * len(s)) for n, s in records)


def test_fastq_cut_off_by_the_files_end(spark, tmp_path):
    write(tmp_path / "a.gz", b"@a\nAC\n+\nII\n@b\nACG\n+", 4)
    assert [r["id"] for r in R.read_fastq(spark, f"file://{tmp_path}/a.gz", block_gzip=True).collect()] == ["a"]
