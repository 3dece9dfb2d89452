"""DataFrame operators of the rating model (no Python UDFs anywhere)."""

from biasfit.operators.joins import JoinPolicy, keyed_join
from biasfit.operators.order_stats import exact_percentiles, kth_rows
from biasfit.operators.sampling import (assign_holdout_roles, exact_stratified_sample, semi_join_keys,
                                        window_stratified_sample)
from biasfit.operators.effects import (BiasModel, fit_bias, global_mean, item_stats, predict_bias,
                                       predict_flags, residuals, user_flag_effects, user_flag_stats)
from biasfit.operators.sweep import best_lambda, sweep_bias, sweep_bias_naive, sweep_flags
from biasfit.operators.select import forward_select
from biasfit.operators.diagnostics import boxplot_stats, null_cells, null_cells_by_column, preview, row_counts

__all__ = [
    "JoinPolicy", "keyed_join", "exact_percentiles", "kth_rows", "assign_holdout_roles",
    "exact_stratified_sample", "semi_join_keys", "window_stratified_sample", "BiasModel", "fit_bias",
    "global_mean", "item_stats", "predict_bias", "predict_flags", "residuals", "user_flag_effects",
    "user_flag_stats", "best_lambda", "sweep_bias", "sweep_bias_naive", "sweep_flags", "forward_select",
    "boxplot_stats", "null_cells", "null_cells_by_column", "preview", "row_counts",
]
