"""fadeclust: forgetful streaming k-means and its point pipeline on Spark."""

from .operators import (ModelState, UpdateParams, apply_update, assign_nearest,
                        attach_center, cluster_cost, cluster_stats, train_step)

__all__ = ["ModelState", "UpdateParams", "apply_update", "assign_nearest",
           "attach_center", "cluster_cost", "cluster_stats", "train_step"]
