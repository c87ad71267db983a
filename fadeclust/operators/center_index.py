"""An exact index over the centers of a model (J1, V3), for many centers.

Some centers, chosen far from one another, and the origin serve as reference
points; the distance of every center to each of them is kept.  By the triangle
inequality a center c cannot be nearer to a point x than

    max over reference points p of | |x - p| - |c - p| |,

with the origin as p this is the norm bound.  A point is first compared with the
reference centers.  The centers are sorted by their distance to each reference
center, so that those that can still be nearer than the best one so far lie in one
window of the list of the point's nearest reference center: the search starts next
to the point's own place and goes outward a few places on either side; if the window
is still wide, the center of the least bound over all reference points is tried; what
is left of the window is then compared, less the centers that another reference point
excludes.

Distances are added up as the plain forms do and bounds leave a margin for
rounding, so labels and distances are bit for bit those of comparing all centers;
ties go to the lowest label.  Where bounds do not help (points far from all
centers, as random points in many dimensions are) the index says so after some
points, and all centers are compared.
"""

from __future__ import annotations

import numpy as np

REFERENCES = 8          # reference centers, besides the origin
OUTWARD = 4             # places on either side that are tried first
PAIR_BLOCK = 1 << 15    # point-center pairs compared at once
TRIAL_POINTS = 2048     # after these many points a useless index is given up
_MARGIN = 1e-9


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, added up from left to right."""
    diff = x - c
    diff *= diff
    return np.cumsum(diff, axis=1, out=diff)[:, -1]


class CenterIndex:
    def __init__(self, centers: np.ndarray):
        self.centers = np.ascontiguousarray(centers, dtype=np.float64)
        k = len(self.centers)
        self.norm = np.sqrt(squared_distances(self.centers, np.zeros_like(self.centers)))
        chosen = [int(np.argmax(np.where(np.isfinite(self.norm), self.norm, -1.0)))]
        to = [self._to_all(chosen[0])]
        while len(chosen) < min(REFERENCES, k):
            far = np.where(np.isfinite(to[-1]), np.min(to, axis=0), -1.0)
            far[chosen] = -1.0
            chosen.append(int(np.argmax(far)))
            to.append(self._to_all(chosen[-1]))
        self.references = np.array(chosen)
        self.to = np.array(to)                                      # reference x center
        self.order = np.argsort(self.to, axis=1, kind="stable")     # NaN last
        self.sorted = np.take_along_axis(self.to, self.order, axis=1)
        self.finite = bool(np.isfinite(self.centers).all())
        self.points = self.compared = 0

    def _to_all(self, j: int) -> np.ndarray:
        return np.sqrt(squared_distances(self.centers, self.centers[j]))

    @property
    def useful(self) -> bool:
        return self.finite and (self.points < TRIAL_POINTS or 2 * self.compared < self.points * len(self.centers))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and squared distance of each point (finite or not)."""
        n, k = len(x), len(self.centers)
        best = np.full(n, np.inf)
        label = np.zeros(n, dtype=np.int32)
        near = np.empty((len(self.references), n))
        for r, j in enumerate(self.references):
            d = squared_distances(x, self.centers[j])
            near[r] = np.sqrt(d)
            better = (d < best) | ((d == best) & (j < label))
            best[better], label[better] = d[better], j
        norm = np.sqrt(squared_distances(x, np.zeros_like(self.centers[0])))
        self.points += n
        self.compared += n * len(self.references)
        known = np.zeros(k, dtype=bool)
        known[self.references] = True
        own = np.argmin(np.where(np.isnan(near), np.inf, near), axis=0)
        at = near[own, np.arange(n)]
        odd = ~np.isfinite(at) | ~np.isfinite(norm)                 # no bound holds
        place = np.empty(n, dtype=np.int64)
        for r in range(len(self.references)):
            mine = own == r
            place[mine] = np.searchsorted(self.sorted[r], at[mine])
        lo, hi = np.clip(place - OUTWARD, 0, k), np.clip(place + OUTWARD, 0, k)
        lo[odd], hi[odd] = 0, 0
        args = (x, norm, near, own, known, best, label)
        self._compare(np.arange(n), lo, hi, *args)
        left, right = self._window(norm, near, own, at, best)
        if 4 * int((right - left)[~odd].sum()) > n * k and x.shape[1] > 2 * len(self.references):
            # still wide: the center of the least bound over all reference points
            self._least_bound(np.flatnonzero(~odd), *args)
            left, right = self._window(norm, near, own, at, best)
        # what is left of the window on either side
        left[odd], right[odd] = 0, k
        rows = np.concatenate([np.arange(n), np.arange(n)])
        starts = np.concatenate([np.minimum(left, lo), np.maximum(hi, left)])
        ends = np.concatenate([lo, np.where(odd, k, right)])
        starts[:n][odd], ends[:n][odd] = 0, 0
        starts[n:][odd] = 0
        self._compare(rows, starts, ends, *args)
        return label, best

    def _window(self, norm, near, own, at, best) -> tuple[np.ndarray, np.ndarray]:
        """Places of the centers that the nearest reference center does not exclude."""
        reach = np.sqrt(best) * (1 + _MARGIN) + _MARGIN * (norm + at)
        left, right = np.empty(len(at), dtype=np.int64), np.empty(len(at), dtype=np.int64)
        for r in range(len(self.references)):
            mine = own == r
            left[mine] = np.searchsorted(self.sorted[r], at[mine] - reach[mine], side="left")
            right[mine] = np.searchsorted(self.sorted[r], at[mine] + reach[mine], side="right")
        return left, right

    def _least_bound(self, rows, x, norm, near, own, known, best, label) -> None:
        k = len(self.centers)
        size = max(1, 16 * PAIR_BLOCK // k)
        for a in range(0, len(rows), size):
            row = rows[a:a + size]
            bound = np.abs(norm[row][:, None] - self.norm)
            for r in range(len(self.references)):
                np.maximum(bound, np.abs(near[r][row][:, None] - self.to[r]), out=bound)
            bound[:, known] = np.inf
            c = np.argmin(bound, axis=1)
            self._settle(row, c, x, best, label)

    def _settle(self, row, c, x, best, label) -> None:
        """Compute these pairs and keep each point's least distance, then label."""
        self.compared += len(row)
        d = np.empty(len(row))
        for a in range(0, len(row), 4096):
            d[a:a + 4096] = squared_distances(x[row[a:a + 4096]], self.centers[c[a:a + 4096]])
        d = np.where(np.isnan(d), np.inf, d)
        by = np.lexsort((c, d, row))
        row, c, d = row[by], c[by], d[by]
        top = np.ones(len(row), dtype=bool)
        top[1:] = row[1:] != row[:-1]
        row, c, d = row[top], c[top], d[top]
        better = (d < best[row]) | ((d == best[row]) & (c < label[row]) & np.isfinite(d))
        best[row[better]], label[row[better]] = d[better], c[better]

    def _compare(self, rows, starts, ends, x, norm, near, own, known, best, label) -> None:
        """Compare points with the centers in places start..end-1 of their lists."""
        sizes = np.maximum(ends - starts, 0)
        total = np.concatenate([[0], np.cumsum(sizes)])
        first = 0
        while first < len(rows):
            last = max(first + 1, int(np.searchsorted(total, total[first] + PAIR_BLOCK, side="right")) - 1)
            part = sizes[first:last]
            row = np.repeat(rows[first:last], part)
            step = np.arange(len(row)) - np.repeat(total[first:last] - total[first], part)
            c = self.order[own[row], np.repeat(starts[first:last], part) + step]
            first = last
            reach = np.sqrt(best[row]) * (1 + _MARGIN)
            slack = _MARGIN * (norm[row] + self.norm[c])
            keep = ~known[c] & ~(np.abs(norm[row] - self.norm[c]) > reach + slack)
            for r in range(len(self.references)):
                row, c, reach, slack = row[keep], c[keep], reach[keep], slack[keep]
                keep = ~(np.abs(near[r][row] - self.to[r][c]) > reach + slack)
            row, c = row[keep], c[keep]
            if len(row):
                self._settle(row, c, x, best, label)
