"""Joins of hot keys, totals over sorted rows, scratch tables, and files in parts."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from probeloom import scratch, spread
from probeloom.sources import readers as R
from probeloom.sources import writers as W


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot,most", [(1, 10**6), (5, 10**6), (1, 0), (5, 0), (10**6, 0)])
def test_spread_join_is_a_join(spark, monkeypatch, how, hot, most):
    monkeypatch.setattr(spread, "HOT_ROWS", hot)
    monkeypatch.setattr(spread, "HOT_BYTES", most)
    rng = random.Random(1)
    left = [(rng.choice([1, 1, 1, 2, 3, 4, None]), i) for i in range(60)]
    count = Counter(k for k, _ in left)
    right = [(k, f"v{k}", count[k]) for k in (1, 2, 4, 9)]
    a, b = spark.createDataFrame(left, "k long, i long"), spark.createDataFrame(right, "k long, v string, n long")
    got = sorted(map(str, spread.spread_join(a, b, ["k"], how=how).select("k", "i", "v").collect()))
    assert got == sorted(map(str, a.join(b.drop("n"), ["k"], how).select("k", "i", "v").collect()))


def test_hot_rows_stay_where_they_are(spark, monkeypatch):
    """The hot key's rows meet a broadcast; the number of hot keys is bounded by the number of rows."""
    monkeypatch.setattr(spread, "HOT_ROWS", 10)
    a = spark.range(1000).select((F.col("id") % 100 * (F.col("id") % 2)).alias("k"), "id")
    b = a.groupBy("k").agg(F.count("*").alias("n"))
    plan = spread.spread_join(a, b, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    monkeypatch.setattr(spread, "MAX_HOT_KEYS", 1)  # then a hot key needs all the rows
    assert "strategy=broadcast" not in spread.spread_join(a, b, ["k"])._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("hot", [1, 4, 10**6])
def test_spread_pairs_is_a_join(spark, monkeypatch, hot):
    monkeypatch.setattr(spread, "HOT_ROWS", hot)
    rng = random.Random(3)
    x = spark.createDataFrame([(rng.choice([1, 1, 2, 3, None]), i) for i in range(20)], "k long, i long")
    y = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 4, None]), i) for i in range(50)], "k long, j long")
    got = sorted(map(tuple, spread.spread_pairs(x, y, ["k"]).select("k", "i", "j").collect()))
    assert got == sorted(map(tuple, x.join(y, "k").select("k", "i", "j").collect()))


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(9)) for i in range(200)]
    rng.shuffle(rows)
    got = {r["i"]: r["before"] for r in spread.running_total(spark.createDataFrame(rows, "i long, v long"), ["i"], "v", "before").collect()}
    total, want = 0, {}
    for i, v in sorted(rows):
        want[i] = total
        total += v
    assert got == want


def test_temporary_tables_are_deleted(spark):
    with scratch.temporary_tables(spark):
        path = scratch.materialize(spark.range(3), "x").inputFiles()[0].removeprefix("file://")
        assert Path(path).exists()
    assert not Path(path).exists()


def test_a_cluster_needs_a_shared_folder():
    class Fake:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch.scratch_root(Fake)


def test_vcf_samples_come_from_each_files_header(spark, tmp_path):
    for name, samples in (("a", ["s1"]), ("b", ["s2", "s3"])):
        head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])
        (tmp_path / f"{name}.vcf").write_text("\n".join([head, "\t".join(["chr1", "7", ".", "A", "G", "9", "PASS", "DP=3;OT", "GT", *["0/1"] * len(samples)])]))
    rows = R.read_vcf(spark, str(tmp_path)).select("sample", "pos", F.col("call")["GT"].alias("gt")).collect()
    assert sorted(map(tuple, rows)) == [("s1", 7, "0/1"), ("s2", 7, "0/1"), ("s3", 7, "0/1")]


@pytest.mark.parametrize("part", [None, 64])
def test_fastq_lines_are_numbered_over_blocks(spark, tmp_path, part):
    """Plain files are read in blocks, gzipped ones whole; qualities may begin with '@'; a cut record is left out."""
    text = "".join(f"@r{i} x\n{'ACGT' * (i % 5 + 1)}\n+\n{'@' * 4 * (i % 5 + 1)}\n" for i in range(50)) + "@cut\nAC\n"
    (tmp_path / "a.fastq").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if part:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(part))
    try:
        rows = R.read_fastq(spark, str(tmp_path / "a.fastq")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["id"], r["seq"], r["qual"]) for r in rows) == sorted((f"r{i} x", "ACGT" * (i % 5 + 1), "@" * 4 * (i % 5 + 1)) for i in range(50))


def test_fastq_files_follow_the_number_of_reads(spark, tmp_path):
    reads = spark.range(300).select(F.when(F.col("id") < 280, "big").otherwise("small").alias("sample_id"), F.col("id").cast("string").alias("name"), F.lit("ACGT").alias("seq"), F.lit("IIII").alias("qual"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would put a few small reads in one file
    try:
        W.write_fastq_per_sample(reads, str(tmp_path / "out"), per_file=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out" / "sample_id=big").glob("*.gz"))) > 1 and len(list((tmp_path / "out" / "sample_id=small").glob("*.gz"))) == 1
    assert R.read_fastq(spark, f"{tmp_path}/out/*/*.gz").count() == 300
