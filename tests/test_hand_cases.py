"""Small cases for rules that are easy to get wrong."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from probeloom.functions import seq as Q
from probeloom.operators import components as G
from probeloom.operators import copy_number as C
from probeloom.operators import genotypes as T
from probeloom.operators import haplotypes as H
from probeloom.operators import intervals as I
from probeloom.operators import microhaplotypes as M
from probeloom.operators import samples as S
from probeloom.operators import variants as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_replicates(spark):
    df = spark.createDataFrame([("a", "s", r, i) for i, r in enumerate([1, 1, None, 4])], "sample_name string, sample_set string, replicate int, ord int")
    assert [r["assigned"] for r in S.assign_replicates(df).orderBy("ord").collect()] == [1, 2, 3, 4]


@pytest.mark.parametrize("spacer,want", [(0, [(1, 20), (22, 30)]), (2, [(1, 30)])])
@pytest.mark.parametrize("size", [5, 1000])
def test_interval_merge(spark, spacer, want, size):
    df = spark.createDataFrame([("c", 1, 10), ("c", 10, 20), ("c", 22, 30)], "chrom string, start long, stop long")
    assert sorted((r["start"], r["stop"]) for r in I.merge_intervals(df, spacer, bin_size=size).collect()) == want


def test_interval_merge_over_bins_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), s := rng.randrange(2000), s + rng.randrange(60)) for _ in range(150)]
    got = sorted((r["chrom"], r["start"], r["stop"]) for r in I.merge_intervals(spark.createDataFrame(rows, "chrom string, start long, stop long"), 3, bin_size=50).collect())
    want = []
    for c, s, e in sorted(rows):
        if want and want[-1][0] == c and s - want[-1][2] <= 3:
            want[-1][2] = max(want[-1][2], e)
        else:
            want.append([c, s, e])
    assert got == [tuple(x) for x in want]


def test_subtract_drops_single_bases(spark):
    frame = lambda *x: spark.createDataFrame([("c", *p) for p in x], "chrom string, start long, stop long")
    assert I.subtract_intervals(frame((1, 10)), frame((2, 10))).collect() == []
    got = I.subtract_intervals(frame((1, 10), (11, 30)), frame((5, 6), (20, 22), (90, 99))).collect()
    assert sorted((r["start"], r["stop"]) for r in got) == [(1, 4), (7, 19), (23, 30)]


def test_overlaps(spark):
    a = spark.createDataFrame([("c", 10, 30)], "chrom string, start long, stop long")
    b = spark.createDataFrame([("c", 20, 40)], "chrom string, start long, stop long")
    r = I.intersect_intervals(a, b, bin_size=7).collect()
    assert [(x["common_start"], x["common_stop"]) for x in r] == [(20, 30)]
    parts = I.remove_overlap(I.overlap_join(a, b)).collect()
    assert sorted((x["part_start"], x["part_stop"]) for x in parts) == [(10, 19), (31, 40)]


def test_trim_overlaps(spark):
    frame = spark.createDataFrame([("c", 1, 100), ("c", 95, 200), ("d", 1, 100), ("d", 2, 100), ("d", 2, 100), ("e", 1, 100), ("e", 50, 150)], "chrom string, start long, stop long")
    got = sorted(tuple(r) for r in I.trim_overlaps(frame).collect())
    assert got == [("c", 1, 94, False), ("c", 101, 200, False), ("d", 2, 100, False), ("e", 1, 100, True), ("e", 50, 150, True)]


def test_amino_acid_split(spark):
    rows = spark.createDataFrame([("AspGluAsp144HisGlnTyr", "missense_variant"), ("AspGlu10AspGln", "missense_variant"), ("Ala3Ala", "synonymous_variant")], "aa_change string, effect string")
    got = [(r["change"], r["same"]) for r in V.split_aa_changes(rows).collect()]
    assert got == [("Asp144His", False), ("Glu145Gln", False), ("Asp146Tyr", False), ("Asp10Asp", True), ("Glu11Gln", False), ("Ala3Ala", True)]


def test_combined_genotypes(spark):
    cases = [[0, 2], [1, 2], [2, None], [None], [0, 0]]
    rows = spark.createDataFrame([(i, g) for i, c in enumerate(cases) for g in c], "k int, genotype int")
    assert {r["k"]: r["genotype"] for r in V.combine_genotypes(rows, ["k"]).collect()} == {0: 1, 1: 1, 2: 2, 3: -1, 4: 0}


def test_indel_rows(spark):
    rows = spark.createDataFrame([("c", 5, "TA", "T"), ("c", 5, "T", "TA"), ("c", 5, "TAG", "TCC")], "chrom string, pos long, ref string, alt string")
    got = [(r["pos"], r["ref"], r["alt"], r["kind"]) for r in V.variant_positions(rows).collect()]
    assert got == [(6, "A", "-", "deletion"), (5, "-", "A", "insertion"), (6, "-", "A", "insertion"), (5, "TAG", "TCC", "malformed")]


def test_multiallelic_trimming(spark):
    rows = spark.createDataFrame([(10, "CAA", "CA,CTA", "1,2", "3,4", "1/2")], "pos long, ref string, alt string, ao string, qa string, gt string")
    got = {(r["pos"], r["ref"], r["alt"], r["ao"], r["genotype"]) for r in V.split_multiallelic(rows).collect()}
    assert got == {(10, "CA", "C", 1.0, 1), (11, "A", "T", 2.0, 1)}


def test_genotype_calls(spark):
    rows = spark.createDataFrame([("v", f"s{i}", a, c) for i, (a, c) in enumerate([(1, 20), (5, 20), (20, 20), (5, 8), (0, 0)])], "variant string, sample_id string, alt long, coverage long")
    assert [r["genotype"] for r in T.call_genotypes(rows, 2, 10, 0.0).orderBy("sample_id").collect()] == [0, 1, 2, None, None]
    rows = spark.createDataFrame([("v", f"s{i}", a, 100) for i, a in enumerate([5, 50, 95])], "variant string, sample_id string, alt long, coverage long")
    assert [r["genotype"] for r in T.call_genotypes(rows, 0, 0, 0.1).orderBy("sample_id").collect()] == [0, 1, 2]


def test_keep_rule_is_strict_for_umis(spark):
    rows = spark.createDataFrame([("v", "No", 0.9, 3), ("v", "No", 0.9, 3), ("w", "Yes", 0.0, 0)], "variant string, targeted string, wsaf double, filtered_alt long")
    assert {r["variant"] for r in T.keep_variants(rows, 0.1, 1, 3, 2).collect()} == {"w"}


@pytest.mark.parametrize("shares,want", [((0.75, 0.25), [75, 25]), ((None, None), [50, 50]), ((0.0, 0.0), [50, 50]), ((1.0, None), [100, 0])])
def test_multimapped_shares(spark, shares, want):
    mapped = spark.createDataFrame([("s", "g", "m", "h", f"C{i}", 2, 100, 100) for i in range(2)], "sample_id string, gene string, mip string, haplotype_id string, copy string, mapped_copy_number int, umi_count long, read_count long")
    known = spark.createDataFrame([("s", "g", f"C{i}", x) for i, x in enumerate(shares)], "sample_id string, gene string, copy string, copy_share double")
    assert [r["umi_count"] for r in H.redistribute_multimapped(mapped, known).orderBy("copy").collect()] == want


def test_repool(spark):
    rows = spark.createDataFrame([("zero", 0, 0, 0, 0), ("deep", 5580, 209, 5, 3), ("done", 900, 600, 20, 20), ("more", 600, 300, 9, 9)], "sample_id string, read_count long, umi_count long, targets_1 long, targets_10 long")
    got = {r["sample_id"]: r["status"] for r in H.repool_decision(rows, 1000, goal=15, low_action="Low").collect()}
    assert got == {"zero": "Low", "deep": "Recapture", "done": "Complete", "more": "Repool"}


def test_prevalence_text(spark):
    called = spark.createDataFrame([("a", "v", 1), ("b", "v", 0), ("c", "v", None), ("d", "v", 1)], "sample_id string, variant string, prevalence int")
    meta = spark.createDataFrame([(s, "x", 1.0, 2.0) for s in "abcd"], "sample_id string, site string, latitude double, longitude double")
    got = {(r["site"], r["text"]) for r in T.prevalence_text(T.prevalence_by_site(called, meta)).collect()}
    assert got == {("x", "0.6667 (2/3)"), ("overall", "0.6667 (2/3)")}


def test_contingency(spark):
    assert T._tail(3, 1, 1, 3)[0] == pytest.approx(0.4857142857)
    assert T._tail(8, 2, 1, 5)[0] == pytest.approx(0.0349650350)
    assert T._tail(10, 20, 30, 40)[1] == pytest.approx(0.5040358664, abs=1e-6)


def test_sequences(spark):
    assert one(spark, Q.reference_length(F.lit("2S20M1I2M5D"))) == 29
    assert one(spark, Q.cigar_lengths(F.lit("2S20M1I2M5D"))) == {"S": 2, "M": 22, "I": 1, "D": 5}
    assert one(spark, Q.reverse_complement(F.lit("ACGTNacg-RYSWz"))) == "XSWRY-cgtNACGT"
    assert one(spark, Q.gc_percent(F.lit("ACGN"))) == 66 and one(spark, Q.gc_percent(F.lit("NN"))) is None
    assert one(spark, Q.translate_codons(F.lit("ATGTAANNNAC"))) == "M*X" and one(spark, Q.translate_codons(F.lit("atg"), three_letter=True)) == "Met"
    assert sorted(one(spark, Q.iupac_expand(F.lit("AY")))) == ["AC", "AT"]
    assert one(spark, S.strip_percent(F.lit("123(45.6%)"))) == 123
    assert one(spark, Q.alphanumerize(F.lit("a b_c-é1"))) == "a-b-c-é1"
    tm = one(spark, Q.nearest_neighbor_tm(F.lit("GATTACAGATTACAGGC"), 250.0, 50.0, 0.0))
    assert 35 < tm < 60 and tm < one(spark, Q.nearest_neighbor_tm(F.lit("GATTACAGATTACAGGC"), 250.0, 50.0, 10.0))


def test_control_copies(spark):
    probes = spark.createDataFrame([("m", f"C{i}", "c", 100 * i, 100 * i + 9) for i in range(4)], "mip string, copy string, chrom string, capture_start long, capture_end long")
    known = spark.createDataFrame([("s", "c", 100 * i, 100 * i + 3, n) for i, hit in enumerate([[3, 2], [3, 1], [1, 2], []]) for n in hit], "sample_id string, chrom string, start long, stop long, copies int")
    got = [r["copies"] for r in C.control_copies(probes, known, spark.createDataFrame([("s",)], "sample_id string")).orderBy("copy").collect()]
    assert got == [3, None, 1, 2]


def test_segments():
    rng = np.random.default_rng(1)
    levels = np.concatenate([np.ones(20), np.full(15, 2.0), np.ones(30)]) + rng.normal(0, 0.05, 65)
    assert C.split_series(levels, 3.0) == [20, 35]
    assert C.split_series(np.ones(30), 3.0) == []


def test_components(spark):
    rng = random.Random(4)
    pairs = [(a, b) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(160)) if a != b] + [(i, i + 1) for i in range(400, 440)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in G.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_pmo_last_row_wins(spark):
    rows = spark.createDataFrame([("s", "t", "A", 5, 1), ("s", "t", "A", 7, 2), ("s", "u", "C", 1, 3)], "sample_id string, locus string, sequence string, read_count long, ord long")
    doc = M.pmo_detected(rows, M.pmo_representatives(rows)).first()["targets"]
    assert doc["t"]["t.0"]["read_count"] == 7 and list(doc) == ["t", "u"]


def test_downsampling(spark):
    rows = spark.range(1000).select((F.col("id") % 4).alias("g"), "id", (F.col("id") % 10 + 1).cast("double").alias("w"))
    a = H.downsample_umis(rows, 20, ["g"], F.col("id"), seed=1)
    assert {r["g"]: r["count"] for r in a.groupBy("g").count().collect()} == {0: 20, 1: 20, 2: 20, 3: 20}
    assert sorted(r["id"] for r in a.collect()) == sorted(r["id"] for r in H.downsample_umis(rows, 20, ["g"], F.col("id"), seed=1).collect())
    heavy = H.downsample_umis(rows, 60, ["g"], F.col("id"), F.col("w"), seed=1).agg(F.avg("w")).first()[0]
    assert heavy > 6


def test_pca_centres(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 4)) @ np.diag([5, 1, 0.5, 0.1]) + 100
    rows = spark.createDataFrame([(f"s{i}", f"v{j}", float(x[i, j])) for i in range(30) for j in range(4)], "sample_id string, variant string, imputed double")
    got = T.pca(rows, 2).collect()
    c = np.array([r["components"] for r in got])
    assert np.allclose(c.mean(0), 0, atol=1e-9)
    s = np.linalg.svd(x - x.mean(0))[1] ** 2
    assert np.allclose(got[0]["explained"], (s / s.sum())[:2])
    assert math.isclose(c.var(0, ddof=1)[0], s[0] / 29, rel_tol=1e-9)


def test_segments_compute_copy_counts_once(spark, monkeypatch):
    from probeloom.plans import copy_number_queries as CQ

    calls, counts = [], CQ._counts
    monkeypatch.setattr(CQ, "_counts", lambda *a: calls.append(a) or counts(*a))
    assert CQ._segments(spark, "/root/testdata/sf0.001").count() >= 0
    assert len(calls) == 1
