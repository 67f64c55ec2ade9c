"""Operators and queries that SQL can't express, against plain versions."""

import hashlib
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from probeloom import plans
from probeloom.operators import copy_number as C
from probeloom.operators import genotypes as G
from probeloom.operators import intervals as I
from probeloom.operators import segmentation as S
from probeloom.plans import copy_number_queries as CQ

SF = "/root/testdata/sf0.001"


# --- overlapping intervals ----------------------------------------------------------------------------------------


def change_of(a, b, low, high):
    """What becomes of an overlapping pair, and its hash; None if it stays."""
    lo, hi = b[1], min(a[2], b[2])
    ratio = (hi - lo) / (min(a[2] - a[1], b[2] - b[1]) + 1)
    if low < ratio < high:
        return None
    new = {(a[0], lo, hi)} if ratio >= high else {p for p in ((a[0], a[1], lo - 1), (a[0], hi + 1, max(a[2], b[2]))) if p[1] <= p[2]}
    return hashlib.md5(":".join(map(str, (a[0], *a[1:], *b[1:]))).encode()).hexdigest(), a, b, new


def trimmed(rows, low, high, bin_size=500):
    """The rounds of trim_overlaps on sets of (chrom, start, stop): neighbours of a bin, then all pairs."""
    live = set(rows)
    for neighbours in (True, False):
        while True:
            if neighbours:
                order = sorted(live, key=lambda x: (x[0], x[1] // bin_size, *x[1:]))
                pairs = [(a, b) for a, b in zip(order, order[1:]) if a[0] == b[0] and a[1] // bin_size == b[1] // bin_size]
            else:
                pairs = combinations(sorted(live), 2)
            changes = [c for a, b in pairs if a[0] == b[0] and b[1] <= a[2] and (c := change_of(a, b, low, high))]
            if not changes:
                break
            first = {}
            for key, a, b, _ in changes:
                for x in (a, b):
                    first[x] = min(first.get(x, key), key)
            turn = [(a, b, new) for key, a, b, new in changes if first[a] == first[b] == key]
            live -= {x for a, b, _ in turn for x in (a, b)}
            live |= {p for *_, new in turn for p in new}
    return sorted((*a, any(a != b and a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2] for b in live)) for a in live)


@pytest.mark.parametrize("seed", [1, 2])
def test_trim_overlaps_matches_its_rounds(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), s := rng.randrange(900), s + rng.choice([0, 3, 20, 60])) for _ in range(90)]
    rows += rows[:5] + [("c", i * 9, i * 9 + 10) for i in range(30)]
    got = sorted(tuple(r) for r in I.trim_overlaps(spark.createDataFrame(rows, "chrom string, start long, stop long"), bin_size=50).select("chrom", "start", "stop", "unclear").collect())
    assert got == trimmed(rows, 0.1, 0.9, 50)


def test_trim_overlaps_of_a_deep_pile(spark):
    """Intervals that all overlap: neighbours thin them out before any pairs are made."""
    rows = [("x", 1000 + i % 7, 3000 + i) for i in range(400)] + [("x", 10_000 + 20 * i, 10_025 + 20 * i) for i in range(100)]
    got = sorted(tuple(r) for r in I.trim_overlaps(spark.createDataFrame(rows, "chrom string, start long, stop long")).collect())
    assert got == trimmed(rows, 0.1, 0.9, 10_000) and sum(r[1] < 5000 for r in got) == 1


def test_trim_overlaps_query(spark):
    """Over all intervals of the smallest tables."""
    rows = [tuple(r) for r in plans.registry.rows(spark, SF, "intervals").select("chrom", "start", "stop").collect()]
    got = sorted(tuple(r) for r in plans.QUERIES["trim_overlaps"](spark, SF).select("chrom", "start", "stop", "unclear").collect())
    want = []
    for chrom in {r[0] for r in rows}:
        want += trimmed([r for r in rows if r[0] == chrom], 0.1, 0.9)
    assert got == sorted(want)


# --- principal components -----------------------------------------------------------------------------------------


def components_of(x, k):
    """Of the rows of a matrix, up to signs; and shares of variance."""
    c = x - x.mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    return np.abs(u[:, :k] * s[:k]), (s**2 / (s**2).sum())[:k]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("columns", [6, 130])
def test_pca_matches_numpy(spark, monkeypatch, wide, columns):
    if wide:
        monkeypatch.setattr(G, "MAX_PCA_COLUMNS", 1)
    rng = np.random.default_rng(columns)
    x = rng.normal(size=(40, columns)) * np.linspace(9, 1, columns) ** 2 + 50
    rows = spark.createDataFrame([(f"s{i:02d}", f"v{j:03d}", float(x[i, j])) for i in range(40) for j in range(columns)], "sample_id string, variant string, imputed double")
    got = G.pca(rows, 3).orderBy("sample_id").collect()
    want, share = components_of(x, 3)
    assert np.allclose(np.abs([r["components"] for r in got]), want, atol=1e-6) and np.allclose(got[0]["explained"], share)


@pytest.mark.parametrize("wide", [False, True])
def test_pca_takes_absent_cells_as_the_mean(spark, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(G, "MAX_PCA_COLUMNS", 1)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 7)) * np.linspace(9, 1, 7) ** 2
    x[[0, 4, 29, 4], [0, 6, 3, 2]] = np.nan
    x[:, 5] = np.nan  # a variant without any value
    cells = [(f"s{i:02d}", f"v{j}", None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(30) for j in range(7) if j == 5 or not np.isnan(x[i, j])]
    got = G.pca(spark.createDataFrame(cells, "sample_id string, variant string, imputed double"), 3).orderBy("sample_id").collect()
    x[:, 5] = 0
    want, share = components_of(np.where(np.isnan(x), np.nanmean(x, axis=0), x), 3)
    assert len(got) == 30 and np.allclose(np.abs([r["components"] for r in got]), want, atol=1e-6) and np.allclose(got[0]["explained"], share)


def test_wide_pca_of_little_or_nothing(spark):
    """Fewer samples than components, equal samples, one sample, none."""
    for rows in ([[1.0, 2.0, 4.0], [2.0, 2.0, 1.0]], [[1.0, 1.0]] * 3, [[5.0, 6.0]]):
        x = np.array(rows)
        df = spark.createDataFrame([(f"s{i}", f"v{j}", float(x[i, j])) for i in range(len(x)) for j in range(x.shape[1])], "sample_id string, variant string, _c double")
        centred = df.withColumn("_c", F.col("_c") - F.avg("_c").over(Window.partitionBy("variant")))
        got = G._wide_pca(centred, 3).orderBy("sample_id").collect()
        c = x - x.mean(0)
        want = np.zeros((len(x), 3))
        u, s, _ = np.linalg.svd(c, full_matrices=False)
        want[:, : len(s)] = np.abs(u * s)[:, :3]
        assert np.allclose(np.abs([r["components"] for r in got]), want, atol=1e-9)
        assert np.isclose(sum(got[0]["explained"]), 1.0 if np.abs(c).max() > 0 else 0.0)
    assert G._wide_pca(df.limit(0), 2).count() == 0


# --- copy numbers -------------------------------------------------------------------------------------------------


def kept_borders(segments, least, copies=None):
    """Right ends that stay; segments: (first, stop) in order."""
    if segments[-1][1] <= least:
        return [s for _, s in segments]
    size = [b - a for a, b in segments]
    gives = defaultdict(set)
    for i, n in enumerate(size):
        if n >= least or len(size) == 1:
            continue
        left, right = (size[i - 1] if i else None), (size[i + 1] if i + 1 < len(size) else None)
        if left is not None and right is not None and copies is not None and int(copies[i - 1]) == int(copies[i + 1]):
            gives[i] = {"left", "right"}
        else:
            gives[i] = {"left" if right is None or (left is not None and left > right) else "right"}
    return [s for i, (_, s) in enumerate(segments) if "right" not in gives[i] and "left" not in gives[i + 1]]


def chain(stops):
    return list(zip([0, *stops], stops))


def cleaned(segments, min_small=3, min_large=5, large=50):
    out = []
    for unit in {r[0] for r in segments}:
        own = [r for r in segments if r[0] == unit]
        least = min_large if max(r[4] for r in own) > large else min_small
        stops = set()
        for cluster in {r[1] for r in own}:
            series = sorted((r[3], r[4], r[5]) for r in own if r[1] == cluster)
            stops |= set(kept_borders([x[:2] for x in series], least, [x[2] for x in series]))
        out += [(unit, i, *x) for i, x in enumerate(chain(kept_borders(chain(sorted(stops)), least)))]
    return sorted(out)


_SEGMENTS = "unit string, cluster int, segment int, first int, stop int, copies double"


def test_clean_breakpoints_matches_the_rule(spark):
    rng = random.Random(5)
    rows = []
    for u in range(30):
        n = rng.choice([2, 3, 12, 40, 70])
        for c in range(rng.randint(1, 3)):
            stops = sorted({*rng.sample(range(1, n), min(n - 1, rng.randrange(9))), n})
            rows += [(f"u{u}", c, i, lo, hi, rng.choice([0.9, 1.2, 2.0, 2.9])) for i, (lo, hi) in enumerate(chain(stops))]
    got = C.clean_breakpoints(spark.createDataFrame(rows, _SEGMENTS), "unit").select("unit", "segment", "first", "stop").collect()
    assert sorted(tuple(r) for r in got) == cleaned(rows)


@pytest.mark.parametrize("stops,copies,want", [
    ([2, 10, 12, 30], [1.0, 2.0, 3.0, 4.0], [10, 30]),  # the first joins the next, a middle one the larger neighbour
    ([10, 12, 20, 22], [1.0, 2.0, 3.0, 4.0], [12, 22]),  # a middle one joins a larger left neighbour; the last joins the one before
    ([10, 12, 20], [2.2, 3.0, 2.9], [20]),  # between equal copies both borders go
    ([10, 12, 22], [1.0, 3.0, 2.0], [10, 22]),  # equal neighbours: the right one
    ([2], [1.0], [2]),
])
def test_clean_breakpoints_cases(spark, stops, copies, want):
    rows = [("u", 0, i, lo, hi, c) for i, ((lo, hi), c) in enumerate(zip(chain(stops), copies))]
    got = C.clean_breakpoints(spark.createDataFrame(rows, _SEGMENTS), "unit").orderBy("stop").collect()
    assert [r["stop"] for r in got] == want and [r["segment"] for r in got] == list(range(len(want)))


def clustered(points, hashes, k, rounds=20):
    """K-means on one unit: {sample: vector}."""
    names = sorted(points)
    x = np.array([points[n] for n in names])
    centres = [x[min(range(len(names)), key=lambda i: (hashes[names[i]], names[i]))]]
    for _ in range(k - 1):
        d = np.array([min(((v - c) ** 2).sum() for c in centres) for v in x])
        if d.max() > 0:
            centres.append(x[int(d.argmax())])
    centres = np.array(centres)
    for _ in range(rounds):
        own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centres)])
        if np.array_equal(moved, centres):
            break
        centres = moved
    return dict(zip(names, ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1).tolist()))


def segmented(levels, undo, least=2):
    """Break points: the best split of a stretch stays if its means differ by undo noise deviations, then both sides."""
    noise = np.median([abs(b - a) for a, b in zip(levels, levels[1:])]) / 0.9539 if len(levels) > 1 else 0.0

    def split(lo, hi):
        part = levels[lo:hi]
        options = [(sum((v - np.mean(part)) ** 2 for v in part) - sum((v - np.mean(h)) ** 2 for h in (part[:i], part[i:]) for v in h), -i) for i in range(least, len(part) - least + 1)]
        if not options:
            return []
        gain, at = max(options)
        if gain <= 1e-12 or abs(np.mean(part[:-at]) - np.mean(part[-at:])) < undo * noise:
            return []
        return [*split(lo, lo - at), lo - at, *split(lo - at, hi)]

    return split(0, len(levels))


@pytest.fixture(scope="module")
def counts(spark):
    return CQ._counts(spark, SF).withColumnRenamed("chrom", "unit").select("unit", "sample_id", "mip", "copy", "begin", "copy_count", F.xxhash64("sample_id").alias("h")).toPandas().dropna()


@pytest.fixture(scope="module")
def clusters(counts):
    out = {}
    for unit, own in counts.groupby("unit"):
        wide = own.pivot(index="sample_id", columns=["mip", "copy"], values="copy_count").dropna(axis=1)
        wide = wide[sorted(wide.columns)]
        found = clustered(dict(zip(wide.index, wide.to_numpy())), dict(zip(own["sample_id"], own["h"])), 3)
        out |= {(unit, s): c for s, c in found.items()}
    return out


def test_cluster_samples_query(spark, clusters):
    assert {(r["unit"], r["sample_id"]): r["cluster"] for r in plans.QUERIES["cluster_samples"](spark, SF).collect()} == clusters


def best_arc(part, least):
    """All arcs by their definition: difference of means over its standard error with noise 1."""
    n, found = len(part), []
    for i in range(n):
        for j in range(i + least, n + 1):
            if n - (j - i) >= least:
                inside, outside = part[i:j], np.concatenate([part[:i], part[j:]])
                found.append((abs(inside.mean() - outside.mean()) / np.sqrt(1 / len(inside) + 1 / len(outside)), -(j - i), -i))
    z, size, at = max(found)
    return z, -at, -at - size


def circular(levels, seed, alpha, permutations, least):
    """Break points by plain recursion, with the operator's draws."""

    def cut(lo, hi):
        part = levels[lo:hi]
        n = hi - lo
        if n < 2 * least:
            return []
        z, i, j = best_arc(part, least)
        draws = [x for rows in S.arranged(part - part.mean(), seed, lo, permutations) for x in rows]
        if z < 1e-9 or sum(best_arc(x, least)[0] >= z * (1 - 1e-12) for x in draws) > alpha * permutations:
            return []
        at = [lo, *[lo + x for x in (i, j) if least <= x <= n - least], hi]
        if len(at) == 2:
            return []
        return at[1:-1] + [c for a, b in zip(at, at[1:]) for c in cut(a, b)]

    return sorted(cut(0, len(levels)))


@pytest.mark.parametrize("seed", range(6))
def test_circular_cuts_equal_all_arcs(seed):
    rng = np.random.default_rng(seed)
    for steps in ([0], [0, 2], [0, 3, 0], [1, 0, 0.4, 3]):
        levels = np.concatenate([rng.normal(m, 0.4, rng.integers(2, 12)) for m in steps])
        z, i, j = S.greatest_arc(levels, 2) if len(levels) >= 4 else (0, 0, 0)
        if len(levels) >= 4:
            want = best_arc(levels, 2)
            assert np.isclose(z, want[0]) and {i % len(levels), j % len(levels)} - {0} == {want[1] % len(levels), want[2] % len(levels)} - {0}
        assert S.circular_cuts(levels, seed, 0.05, 60, 2) == circular(levels, seed, 0.05, 60, 2)


def test_circular_cuts_find_a_short_gain_and_little_in_noise():
    rng = np.random.default_rng(9)
    levels = np.concatenate([rng.normal(1, 0.1, 60), rng.normal(1.6, 0.1, 5), rng.normal(1, 0.1, 60)])
    assert S.circular_cuts(levels, 1) == [60, 65]
    assert sum(bool(S.circular_cuts(rng.normal(0, 1, 40), k)) for k in range(60)) <= 4
    assert S.circular_cuts(np.ones(50), 1) == [] and S.circular_cuts(np.array([1.0]), 1) == [] and S.circular_cuts(np.zeros(0), 1) == []


def test_smoothing_and_undoing():
    levels = np.array([1, 1.1, 0.9, 9.0, 1.0, 1.1, 0.9, 1.0])
    smooth = S.smooth_series(levels)
    assert smooth[3] < 2 and (np.delete(smooth, 3) == np.delete(levels, 3)).all()
    step = np.array([1.0, 1.1, 0.9, 1.0, 5.0, 5.1, 4.9, 5.0])
    assert (S.smooth_series(step) == step).all()
    assert S.undone([2, 2, 2], [2.0, 2.2, 8.0], 0.5) == [0, 2]  # means 1, 1.1, 4
    assert S.undone([2, 2, 2], [2.0, 2.2, 8.0], 9.0) == [0] and S.undone([2, 2], [2.0, 8.0], 0.0) == [0, 1]


def test_segment_breakpoints_of_long_series(spark):
    """Stretches find what lies anywhere in a long series; a short one goes as in one piece."""
    rng = np.random.default_rng(3)
    long = np.concatenate([rng.normal(1 + (k % 2), 0.2, n) for k, n in enumerate([95, 40, 300, 7, 210, 150])])
    short = np.concatenate([rng.normal(0, 0.2, 12), rng.normal(2, 0.2, 9)])
    rows = [("long", 0, i, float(x)) for i, x in enumerate(long)] + [("short", 1, i, float(x)) for i, x in enumerate(short)] + [("one", 0, 0, 1.0)]
    profiles = spark.createDataFrame(rows, "unit string, cluster int, ordinal int, level double")
    got = C.segment_breakpoints(profiles, "unit", undo_small=2.0, undo_large=2.0, stretch=120).orderBy("unit", "segment").collect()
    assert [r["stop"] for r in got if r["unit"] == "long"] == [95, 135, 435, 442, 652, 802]
    assert [(r["first"], r["stop"]) for r in got if r["unit"] == "short"] == [(0, 12), (12, 21)]
    assert [(r["first"], r["stop"], r["copies"]) for r in got if r["unit"] == "one"] == [(0, 1, 2.0)]
    again = C.segment_breakpoints(profiles.repartition(7), "unit", undo_small=2.0, undo_large=2.0, stretch=120).orderBy("unit", "segment").collect()
    assert again == got
    assert C.segment_breakpoints(profiles.limit(0), "unit").count() == 0


def test_segment_and_clean_breakpoints_queries(spark, counts, clusters):
    """The query against a plain version; the same with splits in two."""
    rows = counts.assign(cluster=[clusters.get(x) for x in zip(counts["unit"], counts["sample_id"])]).dropna()
    series = {}
    for (unit, cluster), own in rows.groupby(["unit", "cluster"]):
        probes = own.groupby(["begin", "mip", "copy"])["copy_count"].median().sort_index()
        series[unit, int(cluster)] = np.log2(probes.to_numpy() + 1e-20)

    def plain(cuts):
        return sorted((unit, c, i, lo, hi, float(2 ** levels[lo:hi].mean())) for (unit, c), levels in series.items() for i, (lo, hi) in enumerate(chain([*cuts(levels, unit, c), len(levels)])))

    def by_arcs(levels, unit, c):
        seed = int.from_bytes(hashlib.blake2b(f"{unit}:{c}:0".encode(), digest_size=8).digest(), "big")
        cuts = [0, *circular(S.smooth_series(levels), seed, 0.01, 1000, 2), len(levels)]
        while len(cuts) > 2:
            means = [levels[a:b].mean() for a, b in zip(cuts, cuts[1:])]
            step, i = min((abs(y - x), k) for k, (x, y) in enumerate(zip(means, means[1:])))
            if step >= S.noise_of(levels):
                break
            del cuts[i + 1]
        return cuts[1:-1]

    columns = ("unit", "cluster", "segment", "first", "stop", "copies")
    profiles = C.cluster_profiles(CQ._counts(spark, SF).withColumnRenamed("chrom", "unit"), CQ._clusters(spark, SF), "unit")
    two = C.segment_breakpoints(profiles, "unit", undo_small=1.0, method="binary")
    for found, want in ((plans.QUERIES["segment_breakpoints"](spark, SF), plain(by_arcs)), (two, plain(lambda levels, *_: segmented(levels, 1.0)))):
        got = sorted(tuple(r) for r in found.select(*columns).collect())
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert np.allclose([r[5] for r in got], [r[5] for r in want])
    assert sorted(tuple(r) for r in plans.QUERIES["clean_breakpoints"](spark, SF).select("unit", "segment", "first", "stop").collect()) == cleaned(plain(by_arcs))
