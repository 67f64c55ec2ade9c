"""Change points of series of levels: circular binary segmentation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Arrangements that are drawn at a time.
_BATCH = 100


def smooth_series(levels: np.ndarray, region: int = 2, outlier: float = 4.0, to: float = 2.0) -> np.ndarray:
    """Levels with outliers brought in: one that lies over outlier noise deviations beyond all of its region becomes the region's median and to deviations."""
    n, noise = len(levels), noise_of(levels)
    out = levels.copy()
    for i in range(n):
        near = np.delete(levels[max(0, i - region) : i + region + 1], min(i, region))
        if not len(near):
            continue
        above, below = levels[i] - near.max(), near.min() - levels[i]
        if max(above, below) > outlier * noise:
            middle = np.median(levels[max(0, i - region) : i + region + 1])
            out[i] = middle + to * noise if above > 0 else middle - to * noise
    return out


def noise_of(levels: np.ndarray) -> float:
    """The standard deviation of normal noise around steps: the median absolute difference of neighbours is 0.9539 of it."""
    return float(np.median(np.abs(np.diff(levels)))) / 0.9539 if len(levels) > 1 else 0.0


def _weights(n: int, least: int) -> Iterator[tuple[int, float]]:
    """Lengths of arcs and what makes their sums comparable."""
    for k in range(least, n - least + 1):
        yield k, float(np.sqrt(n / (k * (n - k))))


def greatest_arc(part: np.ndarray, least: int) -> tuple[float, int, int]:
    """The arc [i, j) whose mean differs most from that of the rest of the circle, in standard errors of noise 1; and how much.

    All pairs of ends, from prefix sums: of centred levels an arc's sum alone tells the difference of means. An arc that
    touches an end is as good as the rest of the circle and cuts in the same place.
    """
    n = len(part)
    sums = np.concatenate([[0.0], np.cumsum(part - part.mean())])
    best, ends = -1.0, (0, n)
    for k, weight in _weights(n, least):
        arcs = np.abs(sums[k:] - sums[:-k]) * weight
        i = int(arcs.argmax())
        if arcs[i] > best:
            best, ends = float(arcs[i]), (i, i + k)
    return best, *ends


def arranged(part: np.ndarray, seed: int, lo: int, permutations: int) -> Iterator[np.ndarray]:
    """Random arrangements of a part of a series, the same ones on every run."""
    rng = np.random.Generator(np.random.Philox(key=[seed & (1 << 64) - 1, lo << 32 | len(part)]))
    for done in range(0, permutations, _BATCH):
        yield rng.permuted(np.tile(part, (min(_BATCH, permutations - done), 1)), axis=1)


def circular_cuts(levels: np.ndarray, seed: int, alpha: float = 0.01, permutations: int = 1000, least: int = 2) -> list[int]:
    """Break points: the greatest arc of a part cuts it at both of its ends if few arrangements have as great a one.

    At most a share alpha of so many arrangements; then the parts are cut in turn. No part is shorter than least.
    """
    cuts, todo = [], [(0, len(levels))]
    while todo:
        lo, hi = todo.pop()
        part, n = levels[lo:hi], hi - lo
        if n < 2 * least:
            continue
        seen, i, j = greatest_arc(part, least)
        centred = part - part.mean()
        if seen <= 1e-9 * (1 + np.abs(part).max()):
            continue
        as_great = 0
        for rows in arranged(centred, seed, lo, permutations):
            sums = np.concatenate([np.zeros((len(rows), 1)), np.cumsum(rows, axis=1)], axis=1)
            most = np.zeros(len(rows))
            for k, weight in _weights(n, least):
                np.maximum(most, np.abs(sums[:, k:] - sums[:, :-k]).max(1) * weight, out=most)
            as_great += int((most >= seen * (1 - 1e-12)).sum())
            if as_great > alpha * permutations:
                break
        if as_great > alpha * permutations:
            continue
        # an end piece shorter than least isn't cut off; its arc ends at the series' end
        ends = [x for x in (i, j) if least <= x <= n - least]
        at = [lo, *[lo + x for x in ends], hi]
        if not ends:
            continue
        cuts += at[1:-1]
        todo += list(zip(at, at[1:], strict=False))
    return sorted(cuts)


def undone(sizes: list[int], totals: list[float], least_step: float) -> list[int]:
    """Which segments stay as beginnings: the border with the least step between its sides' means goes while that is under least_step."""
    kept, sizes, totals = list(range(len(sizes))), list(sizes), list(totals)
    while len(kept) > 1:
        means = np.array(totals) / np.array(sizes)
        steps = np.abs(np.diff(means))
        i = int(steps.argmin())
        if steps[i] >= least_step:
            break
        sizes[i : i + 2] = [sizes[i] + sizes[i + 1]]
        totals[i : i + 2] = [totals[i] + totals[i + 1]]
        del kept[i + 1]
    return kept
