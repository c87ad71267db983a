"""The forgetful center update.

With decay ``a``, weight ``w_k``, center ``c_k`` and, for one batch, count
``m_k`` and vector sum ``S_k`` of the points nearest to ``c_k`` *before* the
update::

    w_k   := a * w_k                      for every k (also with no points)
    w'_k   = w_k + m_k                    only where m_k > 0
    lam    = m_k / max(w'_k, 1e-16)
    c'_k   = (1 - lam) * c_k + (lam / m_k) * S_k

Options (off by default): ``time_unit="points"`` discounts by ``a`` to the
power of the batch's point count instead of once per batch; ``split_dying``
splits the heaviest cluster when the lightest falls below 1e-8 of it.

The update acts on the k collected stats rows (model-sized), like Spark's own
streaming k-means; the data-sized work is :func:`train_step`'s assignment and
aggregation, which run as one Spark job.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .assign import assign_nearest
from .model import ModelState
from .stats import cluster_stats, collect_stats

# Fixed values of the update rule.
MIN_WEIGHT = 1e-16          # floor of the updated weight in lam
DYING_RATIO = 1e-8          # a cluster below this share of the heaviest dies
SPLIT_JITTER = 1e-14        # relative offset of the two halves of a split


@dataclass(frozen=True)
class UpdateParams:
    decay: float = 0.5
    time_unit: str = "batches"      # or "points"
    split_dying: bool = False
    method: str = "auto"            # assignment form, see operators.assign
    stats_form: str = "auto"        # see operators.stats
    handle_invalid: str = "skip"    # training drops NULL/NaN/Inf features

    def __post_init__(self):
        if not 0.0 <= float(self.decay) <= 1.0:
            raise ValueError(f"decayFactor must be in [0, 1], got {self.decay}")
        if self.time_unit not in ("batches", "points"):
            raise ValueError("time_unit must be 'batches' or 'points'")


def apply_update(state: ModelState, stats, params: UpdateParams,
                 batch_id: int | None = None) -> ModelState:
    """New model from the old one and ``stats`` = [(label, n, sum)]."""
    C = np.array(state.centers, dtype=np.float64, copy=True)
    w = np.array(state.weights, dtype=np.float64, copy=True)
    a = float(params.decay)
    if params.time_unit == "points":
        total = sum(int(n) for _, n, _ in stats)
        discount = a ** total
    else:
        discount = a
    w = w * discount
    for label, n, s in sorted(stats, key=lambda t: t[0]):
        if n <= 0:
            continue
        new_w = w[label] + n
        lam = n / max(new_w, MIN_WEIGHT)
        w[label] = new_w
        C[label] = (1.0 - lam) * C[label] + (lam / n) * np.asarray(s, dtype=np.float64)
    if params.split_dying and C.shape[0] > 1:
        largest, smallest = int(np.argmax(w)), int(np.argmin(w))
        if w[smallest] < DYING_RATIO * w[largest]:
            half = (w[largest] + w[smallest]) / 2.0
            w[largest] = w[smallest] = half
            x = C[largest].copy()
            p = SPLIT_JITTER * np.maximum(np.abs(x), 1.0)
            C[largest] = x + p
            C[smallest] = x - p
    return ModelState(C, w, state.batch_id + 1 if batch_id is None else batch_id)


def batch_stats(batch: DataFrame, state: ModelState, params: UpdateParams,
                features_col: str = "features", observation: Observation | None = None):
    """Assign one batch to the model's centers and collect the k stats rows
    (one Spark job: projection, partial aggregation, one small shuffle).  An
    ``observation`` gets ``rows`` and ``cost`` (sum of squared distances to the
    centers before the update) from the same job."""
    labelled = assign_nearest(batch, state, features_col, "__label",
                              "__distance" if observation is not None else None,
                              method=params.method,
                              handle_invalid=params.handle_invalid)
    if observation is not None:
        labelled = labelled.observe(observation, F.count(F.lit(1)).alias("rows"),
                                    F.coalesce(F.sum("__distance"), F.lit(0.0)).alias("cost"))
    stats = cluster_stats(labelled, "__label", features_col, state.dim,
                          params.stats_form)
    return collect_stats(stats, state.k)


def train_step(batch: DataFrame, state: ModelState, params: UpdateParams,
               features_col: str = "features",
               batch_id: int | None = None,
               observation: Observation | None = None) -> ModelState:
    """One update of the model with one batch frame; ``observation`` as in
    :func:`batch_stats`."""
    return apply_update(state, batch_stats(batch, state, params, features_col, observation),
                        params, batch_id)
