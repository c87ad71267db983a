"""Plans: the batch fold, scoring against a model history, the query set."""

from .fold import (batch_keys, fit_fold, fold_batches, fold_history, history_df,
                   history_long, score_with_history, stage_by_batch)

__all__ = ["batch_keys", "fit_fold", "fold_batches", "fold_history", "history_df",
           "history_long", "score_with_history", "stage_by_batch"]
