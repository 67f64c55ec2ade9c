"""Left alignment, block decomposition and bottom-k sampling against plain versions."""

import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from probeloom import plans
from probeloom.operators import haplotypes as H
from probeloom.operators import variants as V

SF = "/root/testdata/sf0.001"


def plain_left(genome, pos, ref, alt):
    """Shared last bases go, one base of the genome comes in front where nothing is left; then shared first bases."""
    if ref == alt:
        return plain_trim(pos, ref, alt)
    while True:
        if ref and alt and ref[-1] == alt[-1] and (min(len(ref), len(alt)) > 1 or pos > 1):
            ref, alt = ref[:-1], alt[:-1]
        elif not ref or not alt:
            pos -= 1
            ref, alt = genome[pos - 1] + ref, genome[pos - 1] + alt
        else:
            break
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def plain_trim(pos, ref, alt):
    while min(len(ref), len(alt)) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


@pytest.mark.parametrize("chunk,window", [(10, 10), (16, 7), (64, 64), (500, 100)])
def test_left_align_equals_one_base_at_a_time(spark, chunk, window):
    rng = random.Random(chunk)
    genome = {"x": "".join(rng.choice(["A", "AC", "CAG", "T" * rng.randint(1, 30), "AC" * rng.randint(1, 20)]) for _ in range(60)), "y": "A" * 130 + "C" + "GA" * 50}
    contigs = [(c, i // chunk, g[i : i + chunk]) for c, g in genome.items() for i in range(0, len(g), chunk)]
    sites = set()
    for _ in range(300):
        c = rng.choice("xy")
        pos, n = rng.randint(1, len(genome[c]) - 12), rng.randint(1, 8)
        ref = genome[c][pos - 1 : pos - 1 + n]
        alt = rng.choice([ref[0], ref + ref[-1] * rng.randint(1, 3), ref[0] + ref, ref[:-1] or "G", "".join(rng.choices("ACGT", k=rng.randint(1, 5))), ref + genome[c][pos - 1 + n :][:2]])
        sites.add((c, pos, ref, alt))
    sites |= {("x", 5, genome["x"][4], "<DEL>"), ("z", 3, "AC", "A"), ("y", 1, "AAA", "A"), ("y", 1, "A", "AA"), ("y", 100, "AA", "AA")}
    got = V.left_align(spark.createDataFrame(list(sites), "chrom string, pos long, ref string, alt string"), spark.createDataFrame(contigs, "chrom string, chunk int, seq string"), chunk, window)
    want = {(c, p, r, a, *(plain_left(genome[c], p, r, a) if c in genome and a != "<DEL>" else plain_trim(p, r, a))) for c, p, r, a in sites}
    assert {tuple(r) for r in got.collect()} == want


def test_left_align_never_broadcasts_the_genome(spark):
    """Pieces made by explode() look as small as the few rows that they come from."""
    contigs = spark.createDataFrame([("c", 2000)], "chrom string, n long").select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), "n")).alias("chunk")).withColumn("seq", F.repeat(F.lit("ACGTT"), 20))
    moving = spark.createDataFrame([("c", 1), ("c", 100), ("c", 101), ("c", 5000), ("c", 300_000), ("z", 7)], "chrom string, _at long")
    seen = V._with_pieces(moving, contigs, 100)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 1
    assert sorted((r["_at"], r["_chunk"], len(r["_seq"]), len(r["_earlier"] or "")) for r in seen.collect()) == [(1, 0, 100, 0), (100, 0, 100, 0), (101, 1, 100, 100), (5000, 49, 100, 100)]


def test_split_multiallelic_along_the_genome(spark):
    genome = "GGATATATATCC"
    calls = spark.createDataFrame([("c", 9, "AT", "A,G,ATAT", f"S{i}", "1,2,3", "4,5,6", "0/1") for i in range(3)], "chrom string, pos long, ref string, alt string, sample_id string, ao string, qa string, gt string")
    contigs = spark.createDataFrame([("c", i, genome[4 * i : 4 * i + 4]) for i in range(3)], "chrom string, chunk int, seq string")
    got = V.split_multiallelic(calls, contigs=contigs, chunk_size=4).select("sample_id", "pos", "ref", "alt", "ao", "genotype").collect()
    assert len(got) == 9 and {tuple(r)[1:] for r in got} == {(9, "AT", "A", 1.0, 1), (9, "AT", "G", 2.0, 0), (2, "G", "GAT", 3.0, 0)}
    assert V.split_multiallelic(calls.limit(0), contigs=contigs, chunk_size=4).count() == 0


@lru_cache(None)
def least_cost(ref, alt, before=0):
    """Of all alignments: a pair costs 0 or 1, a gap 2 and 1 a base. before: what the last column held."""
    if not ref and not alt:
        return 0
    options = []
    if ref and alt:
        options.append(least_cost(ref[1:], alt[1:], 0) + (ref[0] != alt[0]))
    if ref:
        options.append(least_cost(ref[1:], alt, 1) + (1 if before == 1 else 3))
    if alt:
        options.append(least_cost(ref, alt[1:], 2) + (1 if before == 2 else 3))
    return min(options)


def test_aligned_changes_are_cheapest_and_make_the_allele():
    rng = random.Random(8)
    for _ in range(1500):
        ref = "".join(rng.choices("ACG", k=rng.randint(1, 7)))
        alt = "".join(rng.choices("ACG", k=rng.randint(1, 7)))
        changes, made, cost = V.aligned_changes(ref, alt), ref, 0
        assert [c[0] for c in changes] == sorted(c[0] for c in changes)
        for off, r, a in reversed(changes):
            assert ref[off : off + len(r)] == r
            if len(r) != len(a):
                cost += 2 + abs(len(r) - len(a))
                # the base that both have is the last one at the beginning, else the first
                off, r, a = (off, r[:-1], a[:-1]) if off == 0 and r[-1] == a[-1] else (off + 1, r[1:], a[1:])
            else:
                cost += 1
            made = made[:off] + a + made[off + len(r) :]
        assert cost == least_cost(ref, alt), (ref, alt, changes)
    assert V.aligned_changes("ACGT", "AGT") == [(0, "AC", "A")]
    assert V.aligned_changes("GATTA", "GACCTTG") == [(1, "A", "ACC"), (4, "A", "G")]
    assert V.aligned_changes("CCAT", "AT") == [(0, "CCA", "A")]


def test_decompose_blocks_aligned(spark):
    rows = [("c", 10, "ACGT", "AGT", 1), ("c", 20, "AC", "GT", 2), ("c", 30, "A", "AT", 3), ("c", 40, "GATTA", "GACCTTG", 4), ("c", 40, "GATTA", "GACCTTG", 5), ("c", 50, "AC", "<X>", 6), ("c", 60, "AC", None, 7)]
    got = V.decompose_blocks(spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, n int"), align=True)
    want = [("c", 1, 10, "AC", "A"), ("c", 2, 20, "A", "G"), ("c", 2, 21, "C", "T"), ("c", 3, 30, "A", "AT"), ("c", 4, 41, "A", "ACC"), ("c", 4, 44, "A", "G"), ("c", 5, 41, "A", "ACC"), ("c", 5, 44, "A", "G"), ("c", 6, 50, "AC", "<X>"), ("c", 7, 60, "AC", None)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_decompose_blocks_aligned_query(spark):
    got = [tuple(r) for r in plans.QUERIES["decompose_blocks_aligned"](spark, SF).collect()]
    sites = plans.registry.rows(spark, SF, "SELECT DISTINCT mip AS chrom, cast(l AS bigint) AS pos, s AS ref, substr(s, 1, k) || 'G' || substr(s, k + 3) AS alt FROM (SELECT mip, haplotype_sequence AS s, length(haplotype_sequence) AS l, 1 + umi_count % 9 AS k FROM calls)").collect()
    want = [(r["chrom"], r["pos"] + off, a, b) for r in sites for off, a, b in V.aligned_changes(r["ref"], r["alt"])]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("weighted", [False, True])
def test_downsampling_in_parts_takes_the_same_records(spark, weighted):
    reads = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("big")).otherwise((F.col("id") % 50).cast("string")).alias("s"), F.col("id").alias("k"), (F.col("id") % 7 + 1).cast("double").alias("w"))
    take = lambda part: sorted(map(tuple, H.downsample_umis(reads, 12, ["s"], F.col("k"), F.col("w") if weighted else None, 5, part).collect()))
    whole = take(10**6)
    assert take(40) == whole and len(whole) == 12 * (1 + len({r["s"] for r in reads.select("s").distinct().collect()} - {"big"}))


def test_umi_read_names_of_the_expanded_reads(spark):
    """Equal to a count over the reads; names are neither sorted nor shuffled."""
    rng = random.Random(4)
    calls = spark.createDataFrame([(f"S{rng.randint(0, 5)}", f"m{rng.randint(0, 3)}.1", rng.choice([0, 1, 2, 9, 10, 11, 120])) for _ in range(60)] + [("S9", "m1.1", 0), ("S9", "m2.1", -1), ("S10", "m1.1", 12)], "sample_id string, haplotype_id string, umi_count long")
    want = H.expand_umi_reads(calls).groupBy("sample_id", "haplotype_id").agg(F.count("*").alias("reads"), F.countDistinct("read_name").alias("names"), F.max("read_name").alias("last_name"))
    got = H.umi_read_names(calls)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = plans.QUERIES["expand_umi_reads"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1
