"""Operators: nearest-center assignment, cluster statistics, the forgetful
update and display views."""

from .assign import (assign_nearest, attach_center, cluster_cost,
                     nearest_columns, predict_point)
from .model import (HISTORY_SCHEMA, STATE_SCHEMA, ModelState, centers_array,
                    initial_state_from_first, random_state)
from .stats import cluster_stats, collect_stats, stats_long
from .update import UpdateParams, apply_update, batch_stats, train_step
from .views import center_display, latest_center, latest_n

__all__ = [
    "assign_nearest", "attach_center", "cluster_cost", "nearest_columns",
    "predict_point", "HISTORY_SCHEMA", "STATE_SCHEMA", "ModelState",
    "centers_array", "initial_state_from_first", "random_state",
    "cluster_stats", "collect_stats", "stats_long", "UpdateParams",
    "apply_update", "batch_stats", "train_step", "center_display",
    "latest_center", "latest_n",
]
