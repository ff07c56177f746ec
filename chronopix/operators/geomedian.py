"""Geometric medians and the spread around them, by vectorised iteration over Arrow batches of pixels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.model import Measurement
from chronopix.operators.base import Kernel, Statistic, statistic

#: Numbers of one padded block of pixels; bounds the kernel's memory, whatever the depth of a batch.
BLOCK = 2_000_000
ROUNDS = 1_000
#: What the unit vectors to the other observations may sum to beyond the number of those at the estimate, by observation.
SETTLED = 1e-6


def weiszfeld(x: np.ndarray, valid: np.ndarray, eps: float = 1e-3) -> np.ndarray:
    """Geometric medians (n, bands) of x (n, time, bands), whose rows count where valid (n, time); NaN without any.

    Weiszfeld's iteration from the mean, with Vardi and Zhang's correction where the estimate is at an observation. Two things
    spare rounds: an observation that satisfies the condition of the optimum is the answer (tried in rounds 1, 2, 4, ...), and
    a Newton step, or a part of one, is taken in place of Weiszfeld's wherever it leaves a smaller sum of distances. It ends when no
    estimate moves by eps, or after ROUNDS rounds. Estimates that stopped short of the condition of the optimum, as within rounding
    of an observation that is not the median, are found anew from the best observation.
    """
    n = valid.sum(axis=1)
    x = np.where(valid[:, :, None], x, 0.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        m = x.sum(axis=1) / n[:, None]
    going = np.nonzero(n > 1)[0]
    unsettled = np.zeros(len(x), bool)
    unsettled[going] = True
    for r in range(ROUNDS):
        if r & (r + 1) == 0 and len(going):
            nearest, best = _nearest(x[going], valid[going], m[going])
            m[going[best]] = nearest[best]
            unsettled[going[best]] = False
            going = going[~best]
        if not len(going):
            break
        xs, vs, ms = x[going], valid[going], m[going]
        new = _step(xs, vs, ms)
        moved = np.sqrt(((new - ms) ** 2).sum(axis=1))
        m[going] = new
        going = going[moved >= eps]
    left = np.nonzero(unsettled)[0]
    if len(left):
        _, d, w = _distances(x[left], valid[left], m[left])
        excess = _length(((x[left] - m[left][:, None, :]) * w[:, :, None]).sum(axis=1)) - (valid[left] & (d == 0)).sum(axis=1)
        for i in left[excess > max(eps, SETTLED) * n[left]].tolist():
            m[i] = _anew(x[i][valid[i]], max(eps, SETTLED))
    return m


def _length(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v**2).sum(axis=-1))


def _pull(x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The sum of the unit vectors from m to the observations x (time, bands) that are not at it, the weights 1 / distance, and how many are at it."""
    gap = x - m
    d = _length(gap)
    w = np.divide(1.0, d, out=np.zeros_like(d), where=d > 0)
    return (gap * w[:, None]).sum(axis=0), w, int((d == 0).sum())


def _anew(x: np.ndarray, tolerance: float) -> np.ndarray:
    """The geometric median of x (time, bands), from the observation whose distances sum to the least.

    If that is not the median, no observation is: steps along the pull, then Newton's, each to the least sum along its line, lead down from
    it and so never meet another. The least along a line is told by the sign of the slope, which is exact where sums only differ by rounding.
    """
    some = max(1, BLOCK // x.size)
    m = x[np.concatenate([_length(x[a : a + some, None, :] - x[None, :, :]).sum(axis=1) for a in range(0, len(x), some)]).argmin()]
    eye = np.eye(x.shape[1])
    for _ in range(ROUNDS):
        pull, w, here = _pull(x, m)
        if _length(pull) <= here + tolerance * len(x):
            break
        way = pull
        if not here:
            scaled = (x - m) * (w**1.5)[:, None]
            newton = np.linalg.lstsq(w.sum() * (1 + 1e-9) * eye - scaled.T @ scaled, pull, rcond=None)[0]
            way = newton if newton @ pull > 0 else pull
        slope = lambda s, m=m, way=way: _pull(x, m + s * way)[0] @ way  # noqa: E731  positive while the sum falls
        low, high = 0.0, 1.0 if not here else 1e-9 * (1 + _length(m)) / _length(way)
        while slope(high) > 0:
            low, high = high, 2 * high
        for _ in range(100):
            half = (low + high) / 2
            if half in (low, high):
                break
            low, high = (half, high) if slope(half) > 0 else (low, half)
        new = m + (low or high) * way
        if (new == m).all():
            break
        m = new
    return m


def _distances(x: np.ndarray, valid: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Differences from m, their lengths, and 1 / length where that is a number and the row counts, else 0."""
    diff = x - m[:, None, :]
    d = np.sqrt((diff**2).sum(axis=2))
    return diff, d, np.where(valid & (d > 0), 1 / np.where(d > 0, d, 1), 0.0)


def _nearest(x: np.ndarray, valid: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The observation nearest to m, and whether it is the median: the others' unit vectors sum to less than its multiplicity."""
    _, d, _ = _distances(x, valid, m)
    nearest = x[np.arange(len(x)), np.where(valid, d, np.inf).argmin(axis=1)]
    diff, d, w = _distances(x, valid, nearest)
    pulled = np.sqrt(((diff * w[:, :, None]).sum(axis=1) ** 2).sum(axis=1))
    return nearest, pulled < (valid & (d == 0)).sum(axis=1) * (1 - 1e-9)


def _step(x: np.ndarray, valid: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The next estimates after m."""
    diff, d, w = _distances(x, valid, m)
    total = w.sum(axis=1)
    gradient = -(diff * w[:, :, None]).sum(axis=1)
    t = m - np.divide(gradient, total[:, None], out=np.zeros_like(m), where=total[:, None] > 0)
    here = (valid & (d == 0)).sum(axis=1)
    pulled = np.sqrt((gradient**2).sum(axis=1))
    pull = np.where(here > 0, np.minimum(1.0, np.divide(here, pulled, out=np.ones_like(pulled), where=pulled > 0)), 0.0)
    new = (1 - pull[:, None]) * t + pull[:, None] * m

    scaled = diff * (w**1.5)[:, :, None]
    eye = np.eye(x.shape[2])
    hessian = total[:, None, None] * (1 + 1e-9) * eye - scaled.transpose(0, 2, 1) @ scaled
    smooth = (here == 0) & (total > 0)
    hessian[~smooth] = eye
    newton = m - np.linalg.solve(hessian, gradient[:, :, None])[:, :, 0]
    least = _sums(x, valid, new)
    left, share = np.nonzero(smooth)[0], 1.0
    while len(left) and share > 1e-3:  # where a whole Newton step overshoots, as along a line that all but goes through the observations, a part of it may not
        some = m[left] + share * (newton[left] - m[left])
        sums = _sums(x[left], valid[left], some)
        better = sums < least[left]
        new[left[better]], least[left[better]] = some[better], sums[better]
        left, share = left[~better], share / 4
    return new


def _sums(x: np.ndarray, valid: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sums of the distances from m."""
    return np.where(valid, np.sqrt(((x - m[:, None, :]) ** 2).sum(axis=2)), 0.0).sum(axis=1)


def _blocks(column: pa.Array, bands: int):
    """Row numbers, values and validity of padded blocks of rows of like depth, from a list<struct<v0, ...>> column."""
    depth = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    values = np.stack([flat.field(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(bands)], axis=1) if len(flat) else np.zeros((0, bands))
    starts = np.cumsum(depth) - depth
    order, at = np.argsort(depth, kind="stable"), 0
    while at < len(order):
        size = max(1, BLOCK // max(1, int(depth[order[min(at + 1000, len(order) - 1)]]) * bands))
        rows = order[at : at + size]
        deepest = max(1, int(depth[rows].max()))
        index = np.arange(deepest)[None, :]
        valid = index < depth[rows][:, None]
        x = values[np.minimum(starts[rows][:, None] + index, max(0, len(values) - 1))] if len(values) else np.zeros((len(rows), deepest, bands))
        yield rows, x, valid
        at += size


def _collected(inputs: Sequence[Measurement]) -> Column:
    whole = F.lit(True)
    for m in inputs:
        c = F.col(f"`{m.name}`")
        whole = whole & c.isNotNull()
    return F.collect_list(F.when(whole, F.struct(*[F.col(f"`{m.name}`").cast("double").alias(f"v{i}") for i, m in enumerate(inputs)])))


@statistic("geomedian")
class GeometricMedian(Statistic):
    """The geometric median over all bands of the observations that lack none; one that is zero in every band is missing."""

    def __init__(self, eps: float = 1e-3, num_threads: int | None = None):
        self.eps = eps  # threads are the cluster's business

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {"obs": _collected(inputs)}

    def kernel(self, inputs: Sequence[Measurement]) -> Kernel:
        bands, eps = len(inputs), self.eps

        def run(column: pa.Array) -> list[pa.Array]:
            out = np.full((len(column), bands), np.nan)
            for rows, x, valid in _blocks(column, bands):
                out[rows] = weiszfeld(x, valid, eps)
            gone = ~valid_rows(out)
            return [pa.array(out[:, i], pa.float64(), mask=gone) for i in range(bands)]

        return Kernel("obs", {m.name: "double" for m in inputs}, run)


def valid_rows(m: np.ndarray) -> np.ndarray:
    return np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)


@statistic("spectral_mad")
class SpectralMAD(Statistic):
    """smad: the median over time of the cosine distance to the geometric median; missing where a norm is zero or nothing is complete."""

    def __init__(self, eps: float = 1e-3, num_threads: int | None = None):
        self.eps = eps

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [Measurement("smad", "float32", float("nan"))]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {"obs": _collected(inputs)}

    def kernel(self, inputs: Sequence[Measurement]) -> Kernel:
        bands, eps = len(inputs), self.eps

        def run(column: pa.Array) -> list[pa.Array]:
            out = np.full(len(column), np.nan)
            for rows, x, valid in _blocks(column, bands):
                m = weiszfeld(x, valid, eps)
                with np.errstate(invalid="ignore", divide="ignore"):
                    norms = np.sqrt((x**2).sum(axis=2)) * np.sqrt((m**2).sum(axis=1))[:, None]
                    d = np.where(valid, 1 - (x * m[:, None, :]).sum(axis=2) / norms, np.nan)
                ok = valid_rows(m) & ~(valid & ~np.isfinite(d)).any(axis=1)
                if ok.any():
                    out[rows[ok]] = np.nanmedian(d[ok], axis=1)
            return [pa.array(out, pa.float64(), mask=np.isnan(out))]

        return Kernel("obs", {"smad": "double"}, run)
