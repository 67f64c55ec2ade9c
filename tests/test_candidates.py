"""Pairs of primers against all pairs, with insertions of any size."""

import random

import pytest

from probeloom.operators import candidates as K

PRIMERS = "primer string, copy string, chrom string, strand string, start long, stop long"
INSERTIONS = "chrom string, pos long, size int"


def all_pairs(extension, ligation, insertions, least, most, apart=None):
    found = []
    for e in extension:
        for x in ligation:
            a, b = (e, x) if e[3] == "+" else (x, e)
            if None in e or None in x or e[1:4] != x[1:4] or e[3] not in "+-" or a[5] >= b[4] or (apart is not None and b[4] - a[5] > apart):
                continue
            inserted, size = sum(n or 0 for c, at, n in insertions if c == e[2] and at is not None and a[4] <= at <= b[5]), b[5] - a[4] + 1
            if size - inserted <= most and (e[1] != "C0" or size >= least):
                found.append((e[0], x[0], *e[1:4], e[4], e[5], x[4], x[5], a[4], b[5], inserted, size))
    on_reference = {p[:2] for p in found if p[2] == "C0"}
    return sorted(p for p in found if p[:2] in on_reference)


def made(rng, sizes):
    def primers(name):
        out = [(f"{name}{rng.randrange(25)}", f"C{rng.randrange(2)}", rng.choice("xy"), rng.choice("+-"), at := rng.randrange(-200, 1500), at + rng.randrange(12)) for _ in range(120)]
        return [*out, *out[:3], (None, "C0", "x", "+", 5, 9), (f"{name}1", "C0", None, "+", 5, 9), (f"{name}2", None, "x", "+", 5, 9), (f"{name}3", "C0", "x", ".", 5, 9), (f"{name}4", "C0", "x", "+", None, 9)]

    inserted = [(rng.choice("xy"), rng.randrange(-200, 1500), rng.choice(sizes)) for _ in range(60)]
    return primers("e"), primers("l"), [*inserted, *inserted[:5], ("x", 7, None), (None, 7, 9), ("y", None, 9)]


def paired(spark, extension, ligation, insertions, *bounds, **options):
    frames = [spark.createDataFrame(r, s) for r, s in ((extension, PRIMERS), (ligation, PRIMERS), (insertions, INSERTIONS))]
    out = K.pair_primers(*frames, *bounds, **options)
    return out.select("e_primer", "l_primer", "copy", "chrom", "strand", "e_start", "e_stop", "l_start", "l_stop", "start", "stop", "inserted", "size")


@pytest.mark.parametrize("sizes", [(1, 2, 3), (1, 400), (2000,)])
def test_pair_primers_equals_all_pairs(spark, sizes):
    """Insertions make room for pairs far apart: none may be lost for lying beyond most."""
    rows = made(random.Random(sum(sizes)), sizes)
    want = all_pairs(*rows, 30, 90)
    assert want
    assert sorted(map(tuple, paired(spark, *rows, 30, 90).collect())) == want


@pytest.mark.parametrize("apart", [None, 1, 70])
@pytest.mark.parametrize("bin_size", [1, 64, 100_000])
def test_pair_primers_bins_and_gaps_change_nothing_else(spark, bin_size, apart):
    rows = made(random.Random(bin_size), (1, 3, 150))
    assert sorted(map(tuple, paired(spark, *rows, 30, 90, apart=apart, bin_size=bin_size).collect())) == all_pairs(*rows, 30, 90, apart)


def test_pairs_of_primers_meet_nothing_else(spark):
    """The join that makes the pairs is the last one: neither insertions nor the reference copy's pairs are joined to them."""
    plan = paired(spark, *made(random.Random(1), (1, 2)), 30, 90)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "copy" in joins[0] and "strand" in joins[0] and "_cell" in joins[0]
