"""Interval joins and merges against plain versions, with intervals of very different lengths."""

import random

import pytest
from pyspark.sql import functions as F

from probeloom.operators import genotypes as G
from probeloom.operators import intervals as I

SPANS = "chrom string, start long, stop long, name int"


def spans(rng, n, longest):
    out = []
    for i in range(n):
        lo = rng.randrange(1, 5000)
        out.append((rng.choice("xy"), lo, lo + rng.randrange(rng.choice(longest)), i))
    return out


@pytest.mark.parametrize("padding", [0, 7])
@pytest.mark.parametrize("bin_size", [1, 16, 256, 100_000])
def test_overlap_join_equals_all_pairs(spark, bin_size, padding):
    rng = random.Random(bin_size + padding)
    a, b = spans(rng, 120, [1, 8, 300, 20_000]), spans(rng, 150, [1, 5, 2000, 10**6])
    a += [("x", -40, 9, 900), ("x", 1, 10**9, 901), ("z", 5, 5, 902)]
    got = I.overlap_join(spark.createDataFrame(a, SPANS), spark.createDataFrame(b, SPANS), padding, bin_size)
    assert got.columns == ["chrom", "start", "stop", "name", "b_start", "b_stop", "b_name"]
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] + padding and y[1] - padding <= x[2])
    assert sorted((r["name"], r["b_name"]) for r in got.collect()) == want


def test_long_intervals_lie_in_few_bins(spark):
    """A chromosome-long interval isn't cut into as many bins as short ones need, and short ones don't meet in its bins."""
    short = spark.range(20_000).select(F.lit("x").alias("chrom"), (F.col("id") * 50).alias("start"), (F.col("id") * 50 + 5).alias("stop"), F.col("id").alias("name"))
    long = spark.createDataFrame([("x", 1, 240_000_000, -1)], "chrom string, start long, stop long, name long")
    both = short.unionByName(long)
    got = I.overlap_join(both, both).where("name < b_name")
    assert got.count() == 20_000  # the long one with each, and no two short ones
    plan = I.overlap_join(both, both)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def merged(rows, spacer):
    out = []
    for c, lo, hi, *_ in sorted(rows):
        if out and out[-1][0] == c and lo - out[-1][2] <= spacer:
            out[-1][2], out[-1][3] = max(out[-1][2], hi), out[-1][3] + 1
        else:
            out.append([c, lo, hi, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("spacer", [0, 1, 25])
@pytest.mark.parametrize("bin_size", [3, 40, 1_000_000])
def test_merge_intervals_equals_one_scan(spark, bin_size, spacer):
    rng = random.Random(bin_size * 31 + spacer)
    for longest in ([1, 4], [1, 30, 900], [2, 4000]):
        rows = spans(rng, 150, longest)
        got = I.merge_intervals(spark.createDataFrame(rows, SPANS), spacer, bin_size=bin_size).collect()
        assert sorted(tuple(r) for r in got) == merged(rows, spacer)


def test_merge_intervals_edges(spark):
    assert I.merge_intervals(spark.createDataFrame([], SPANS)).count() == 0
    rows = [(None, 1, 5, 1), (None, 5, 9, 2), ("x", 3, 3, 3), ("x", 3, 3, 3), ("x", -9, -2, 4)]
    got = {tuple(r) for r in I.merge_intervals(spark.createDataFrame(rows, SPANS), bin_size=4).collect()}
    assert got == {(None, 1, 9, 2), ("x", 3, 3, 2), ("x", -9, -2, 1)}


def test_plink_lines_have_every_site(spark):
    """A sample without a row for a variant keeps its place in the line; so does a null genotype."""
    sites = spark.createDataFrame([("v1", "g", "1", 5, "A", "C"), ("v2", "g", "1", 9, "A", "G"), ("v3", "h", "2", 1, "T", "G")], "variant string, gene string, chrom string, pos long, ref string, alt string")
    calls = spark.createDataFrame([("s1", "v1", 0), ("s1", "v2", 1), ("s1", "v3", 2), ("s2", "v1", 1), ("s2", "v3", None), ("s3", "v2", 2), ("s4", "v1", 0)], "sample_id string, variant string, genotype int")
    people = spark.createDataFrame([("s1", True), ("s2", False), ("s3", False), ("s5", True)], "sample_id string, affected boolean")
    ped, places, geno, _ = G.plink_tables(calls, sites, people)
    assert {r["line"] for r in ped.collect()} == {"s1 s1 0 0 0 2 A A A G G G", "s2 s2 0 0 0 1 A C 0 0 0 0", "s3 s3 0 0 0 1 0 0 G G 0 0"}
    assert {r["line"] for r in geno.collect()} == {"s1\t0\t1\t2", "s2\t1\t.\t.", "s3\t.\t2\t."}
    assert [r["variant"] for r in places.orderBy("chrom", "pos").collect()] == ["v1", "v2", "v3"]


def test_islands_equal_merged_intervals_without_meeting_them_again(spark):
    rng = random.Random(5)
    for spacer, bin_size in ((0, 50), (7, 13), (0, 1000)):
        rows = [(f"chr{rng.randrange(2)}", s := rng.randrange(2000), s + rng.choice((0, 3, 9, 40)), f"n{i}") for i in range(300)] + [("chr0", 2500, 9000, "long"), ("chr0", 2501, 2600, "in"), (None, 1, 2, "nowhere")]
        frame = spark.createDataFrame(rows, "chrom string, start long, stop long, name string")
        merged = I.merge_intervals(frame.where("chrom is not null"), spacer, bin_size=bin_size).collect()
        got = I.islands(frame, spacer, bin_size=bin_size).collect()
        assert len(got) == len(rows) - 1
        for r in got:
            assert [m["start"] for m in merged if m["chrom"] == r["chrom"] and m["start"] <= r["start"] and r["stop"] <= m["stop"]] == [r["island"]]


def test_trim_overlaps_drops_settled_islands_from_its_rounds(spark, monkeypatch):
    seen = []
    write = I.materialize
    monkeypatch.setattr(I, "materialize", lambda df, name: seen.append((name, (out := write(df, name)).count())) or out)
    rows = [("chr1", i * 100, i * 100 + 10) for i in range(200)] + [("chr1", 50_000 + i * 3, 50_000 + i * 3 + 40) for i in range(12)]
    assert I.trim_overlaps(spark.createDataFrame(rows, "chrom string, start long, stop long")).count() >= 200
    rounds = [n for name, n in seen if name == "neighbours"]
    assert len(rounds) > 1 and rounds[0] == 212 and max(rounds[1:]) < 40


def test_overlap_join_broadcasts_only_what_is_small_once_dealt(spark):
    many = spark.range(30_000).selectExpr("'x' AS chrom", "id * 10 AS start", "id * 10 + 700 AS stop", "cast(id AS int) AS name")
    few = many.where("name < 50")
    plan = lambda a, b: I.overlap_join(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(many, many) and "SortMergeJoin" in plan(many, many)
    assert "BroadcastHashJoin" in plan(few, many) and "BroadcastHashJoin" in plan(many, few)
    assert I.overlap_join(few, many).count() == I.overlap_join(many, few).count() == 50 * 71 + sum(min(i, 70) for i in range(50))
