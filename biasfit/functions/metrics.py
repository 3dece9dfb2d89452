"""Error metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def squared_error(truth: str | Column, pred: str | Column) -> Column:
    t = F.col(truth) if isinstance(truth, str) else truth
    p = F.col(pred) if isinstance(pred, str) else pred
    d = t - p
    return d * d


def rmse_columns(truth: str | Column = "rating", pred: str | Column = "pred",
                 name: str = "rmse") -> list[Column]:
    """Strict RMSE plus the counts it rests on.

    Like a mean without NA removal, the RMSE is NULL as soon as one
    prediction (or truth) is NULL; ``n_rows`` and ``n_null_pred`` say why.
    """
    se = squared_error(truth, pred)
    n = F.count(F.lit(1))
    n_ok = F.count(se)
    return [
        F.when((n == n_ok) & (n > 0), F.sqrt(F.sum(se) / n)).alias(name),
        n.alias("n_rows"),
        (n - n_ok).alias("n_null_pred"),
    ]
