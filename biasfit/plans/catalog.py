"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's parquet tables (through
``sources.testdata``) and runs over all their rows.  Doubles are rounded
to 6 decimals so results compare across engines (summation order differs);
the DuckDB twins live in ``plans.oracle``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from biasfit import schemas as S
from biasfit.functions.flags import add_flags
from biasfit.functions.hashing import hash_prefix_number, order_hash
from biasfit.functions.metrics import rmse_columns
from biasfit.operators.diagnostics import boxplot_outliers, boxplot_stats, counted_nulls, preview
from biasfit.operators.sampling import ROW_ID, STRATUM, assign_holdout_roles, exact_stratified_sample, prepare
from biasfit.plans import edge_cases
from biasfit.plans.analysis import PipelineConfig, RatingsPipeline
from biasfit.plans.stages import Files
from biasfit.session import scratch_path
from biasfit.sources.testdata import KEY_COLS, TIE_COLS, TestdataViews
from biasfit.sources.text import read_items_text, read_ratings_text, write_items_text, write_ratings_text

RATING_COLS = ["userId", "movieId", "rating", "timestamp"]
LINE_ID = ["l_orderkey", "l_linenumber"]
FLAGS = list(S.TESTDATA_FLAGS)


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def testdata_config(**kw) -> PipelineConfig:
    # after the split no query reads the columns that only break the samples' ties
    kw.setdefault("keep_cols", [*RATING_COLS, *LINE_ID, *FLAGS])
    return PipelineConfig(flags=dict(S.TESTDATA_FLAGS), key_cols=KEY_COLS, tie_cols=TIE_COLS, **kw)


_ANALYSES: dict[tuple[str, str, str], RatingsPipeline] = {}


def analysis(spark: SparkSession, sf_dir: str, **kw) -> RatingsPipeline:
    """The staged analysis of ``sf_dir``.

    With the default configuration it is kept per Spark application and
    state of the input files, so queries run in one session share the written split and the
    persisted statistics (like reusing a materialised table); every stage is
    still computed from the parquet tables by Spark the first time.
    """
    files = Files(spark)
    key = (spark.sparkContext.applicationId, sf_dir, str([files.state(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "part")]))
    if not kw and key in _ANALYSES:
        return _ANALYSES[key]
    v = TestdataViews(spark, sf_dir)
    p = RatingsPipeline(spark, v.facts(), testdata_config(**kw))
    if not kw:
        _ANALYSES[key] = p
    return p


def reset_analyses() -> None:
    """Forget kept analyses (and release their cached tables)."""
    for p in _ANALYSES.values():
        p.release()
    _ANALYSES.clear()


# ------------------------------------------------------------- data stages

def q_ratings_fact(spark, sf_dir):
    return TestdataViews(spark, sf_dir).facts().select(*RATING_COLS, "title", "genres")


def q_genre_flags(spark, sf_dir):
    f = TestdataViews(spark, sf_dir).facts().select(*RATING_COLS, "title", "genres")
    return add_flags(f, S.TESTDATA_FLAGS)


def q_preview_head(spark, sf_dir):
    f = add_flags(TestdataViews(spark, sf_dir).facts(), S.TESTDATA_FLAGS)
    order = ["userId", "movieId", "timestamp", *TIE_COLS]
    return preview(f, order, S.PREVIEW_ROWS).select(*RATING_COLS, *FLAGS)


def _nulls(spark, sf_dir) -> dict[str, int]:
    """NULL cells by column, counted while the facts were written: no job of their own."""
    seen = analysis(spark, sf_dir).prepared.nulls
    return {c: seen[c] for c in [*RATING_COLS, *FLAGS]}


def q_null_cells(spark, sf_dir):
    return spark.createDataFrame([(sum(_nulls(spark, sf_dir).values()),)], "n_null BIGINT")


def q_null_cells_by_column(spark, sf_dir):
    return counted_nulls(spark, _nulls(spark, sf_dir))


def _split1(spark, sf_dir, info: dict | None = None):
    # written: the sampler's pass (and the row id that splits copy runs) reads the narrow columns of one stable copy
    w = prepare(TestdataViews(spark, sf_dir).facts(), "facts", "rating", {"_h0": hash_prefix_number(order_hash("1", KEY_COLS))})
    return exact_stratified_sample(w.df, "rating", S.HOLDOUT_FRACTION, "1", KEY_COLS, TIE_COLS, flag="sampled", keep_stratum=True,
                                   info=info, row_id=ROW_ID, hash_col="_h0", bounds=w.bounds, total=w.n_rows).drop("_h0", *ROW_ID)


def q_rating_strata(spark, sf_dir):
    info: dict = {}
    s = _split1(spark, sf_dir, info)
    b = info["breaks"]        # the sample's own exact type-7 breaks
    bounds = spark.createDataFrame([(i + 1, float(b[i]), float(b[i + 1])) for i in range(len(b) - 1)],
                                   f"{STRATUM} INT, lower DOUBLE, upper DOUBLE")
    agg = s.groupBy(STRATUM).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count(F.when(F.col("sampled"), 1)).alias("n_sampled"))
    return (agg.join(F.broadcast(bounds), STRATUM)
            .select(F.col(STRATUM).alias("stratum"), "lower", "upper", "n_rows", "n_sampled"))


def q_stratified_holdout(spark, sf_dir):
    return _split1(spark, sf_dir).where("sampled").select(*RATING_COLS, *LINE_ID)


def _holdout(spark, sf_dir):
    s = _split1(spark, sf_dir).drop(STRATUM)
    return assign_holdout_roles(s, "sampled", orphan="return", held_role="validation", rest_role="pool")


def q_leak_free_train(spark, sf_dir):
    return _holdout(spark, sf_dir).where("role = 'pool'").select(*RATING_COLS, *LINE_ID)


def q_leak_free_validation(spark, sf_dir):
    return _holdout(spark, sf_dir).where("role = 'validation'").select(*RATING_COLS, *LINE_ID)


def q_train_test_split(spark, sf_dir):
    p = analysis(spark, sf_dir)
    return p.split.where("role <> 'validation'").select(*RATING_COLS, *LINE_ID, "role")


def q_row_counts(spark, sf_dir):
    """Counted while the split was written: no job of its own."""
    return spark.createDataFrame(list(analysis(spark, sf_dir).role_counts.items()), "role STRING, n_rows BIGINT")


# ------------------------------------------------------------------ biases

def q_global_mean(spark, sf_dir):
    """Observed while the split was written."""
    p = analysis(spark, sf_dir)
    return spark.createDataFrame([(p.mu, p.n_train)], "mu DOUBLE, n_rows BIGINT").select(r6("mu").alias("mu"), "n_rows")


def q_item_effect(spark, sf_dir):
    m = analysis(spark, sf_dir).bias_model
    return m.items.select("movieId", r6("b_i").alias("b_i"), "n_i")


def q_user_effect(spark, sf_dir):
    m = analysis(spark, sf_dir).bias_model
    return m.users.select("userId", r6("b_u").alias("b_u"), "m_u")


def q_bias_predictions(spark, sf_dir):
    p = analysis(spark, sf_dir)
    return p.predictions(p.test).select("userId", "movieId", "rating", *LINE_ID, r6("pred").alias("pred"))


def q_bias_rmse(spark, sf_dir):
    p = analysis(spark, sf_dir)
    return p.predictions(p.test).agg(*rmse_columns()).select(
        r6("rmse").alias("rmse"), "n_rows", "n_null_pred", F.lit(p.best_bias[0]).alias("lambda"))


def q_bias_lambda_sweep(spark, sf_dir):
    return analysis(spark, sf_dir).bias_sweep.select("lambda", r6("rmse").alias("rmse"))


def q_best_bias_lambda(spark, sf_dir):
    lam, rmse = analysis(spark, sf_dir).best_bias
    return spark.range(1).select(F.lit(lam).alias("lambda"), F.round(F.lit(rmse), 6).alias("rmse"))


def q_bias_residuals(spark, sf_dir):
    p = analysis(spark, sf_dir)
    return p.train_residuals.select("userId", "movieId", "rating", *LINE_ID, r6("b_i").alias("b_i"),
                                    r6("b_u").alias("b_u"), r6("resid").alias("resid"))


# ------------------------------------------------------------------- flags

def q_flag_boxstats(spark, sf_dir):
    p = analysis(spark, sf_dir)
    b = boxplot_stats(p.train_residuals, FLAGS, "resid")
    return b.select("flag", "level", "n", *[r6(c).alias(c) for c in
                                            ("q1", "median", "q3", "whisker_low", "whisker_high")], "n_outliers")


def q_flag_outliers(spark, sf_dir):
    """The points that the box plots show beyond their whiskers."""
    p = analysis(spark, sf_dir)
    out = boxplot_outliers(p.train_residuals, boxplot_stats(p.train_residuals, FLAGS, "resid"), FLAGS, "resid")
    return out.select("flag", "level", r6("value").alias("resid"))


def q_user_flag_effects(spark, sf_dir):
    p = analysis(spark, sf_dir)
    e = p.flag_effects(S.SCREEN_LAMBDA)
    return e.select("userId", *[r6(c).alias(c) for f in FLAGS for c in (f"{f}_down", f"{f}_up")])


def q_flag_predictions(spark, sf_dir):
    p = analysis(spark, sf_dir)
    pr = p.flag_predictions(p.test_scored, p.selection.kept, p.best_flag[0])
    return pr.select("userId", "movieId", "rating", *LINE_ID, r6("pred").alias("pred"))


def q_placed_flag_predictions(spark, sf_dir):
    """The analysis with facts and users' statistics laid out by user: the joins
    of residuals, selection, flag sweep and predictions with them move no row."""
    p = analysis(spark, sf_dir, user_buckets=16, policy=edge_cases.SALTED)
    pr = p.flag_predictions(p.test_scored, p.selection.kept, p.best_flag[0])
    return pr.select("userId", "movieId", "rating", *LINE_ID, r6("pred").alias("pred"))


def q_forward_selection(spark, sf_dir):
    sel = analysis(spark, sf_dir).selection
    rows = [(s["step"], s["flag"], None if math.isnan(s["rmse"]) else round(float(s["rmse"]), 6), s["decision"], s["kept"])
            for s in sel.steps]
    return spark.createDataFrame(rows, "step INT, flag STRING, rmse DOUBLE, decision STRING, kept STRING")


def q_flag_lambda_sweep(spark, sf_dir):
    return analysis(spark, sf_dir).flag_sweep.select("lambda", r6("rmse").alias("rmse"))


def q_best_flag_lambda(spark, sf_dir):
    lam, rmse = analysis(spark, sf_dir).best_flag
    return spark.range(1).select(F.lit(lam).alias("lambda"), F.round(F.lit(rmse), 6).alias("rmse"))


def q_final_score(spark, sf_dir):
    fs = analysis(spark, sf_dir).final_score()
    return fs.select(r6("rmse").alias("rmse"), "n_rows", "n_null_pred", "bias_lambda", "flag_lambda", "flags")


def q_model_ledger(spark, sf_dir):
    led = analysis(spark, sf_dir).ledger()
    return led.select("step", "model", r6("rmse").alias("rmse"), r6("delta").alias("delta"), "decision")


# --------------------------------------------------------------- text files

def q_read_ratings_text(spark, sf_dir):
    """Ratings written as '::' text by Spark, read back with the text reader."""
    path = scratch_path(spark, "ratings-dat")
    write_ratings_text(TestdataViews(spark, sf_dir).ratings(with_identity=False), path)
    return read_ratings_text(spark, path)


def q_read_movies_text(spark, sf_dir):
    path = scratch_path(spark, "movies-dat")
    write_items_text(TestdataViews(spark, sf_dir).items(), path)
    return read_items_text(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_fact": q_ratings_fact,
    "genre_flags": q_genre_flags,
    "preview_head": q_preview_head,
    "null_cells": q_null_cells,
    "null_cells_by_column": q_null_cells_by_column,
    "rating_strata": q_rating_strata,
    "stratified_holdout": q_stratified_holdout,
    "leak_free_train": q_leak_free_train,
    "leak_free_validation": q_leak_free_validation,
    "train_test_split": q_train_test_split,
    "row_counts": q_row_counts,
    "global_mean": q_global_mean,
    "item_effect": q_item_effect,
    "user_effect": q_user_effect,
    "bias_predictions": q_bias_predictions,
    "bias_rmse": q_bias_rmse,
    "bias_lambda_sweep": q_bias_lambda_sweep,
    "best_bias_lambda": q_best_bias_lambda,
    "bias_residuals": q_bias_residuals,
    "flag_boxstats": q_flag_boxstats,
    "flag_outliers": q_flag_outliers,
    "user_flag_effects": q_user_flag_effects,
    "flag_predictions": q_flag_predictions,
    "placed_flag_predictions": q_placed_flag_predictions,
    "forward_selection": q_forward_selection,
    "flag_lambda_sweep": q_flag_lambda_sweep,
    "best_flag_lambda": q_best_flag_lambda,
    "final_score": q_final_score,
    "model_ledger": q_model_ledger,
    "read_ratings_text": q_read_ratings_text,
    "read_movies_text": q_read_movies_text,
    **edge_cases.QUERIES,
}
