"""biasfit: shrunken bias models for user x item ratings, built on Spark DataFrames.

Layout
------
sources/    readers for '::'-delimited rating and item files, testdata views
functions/  column builders: tag flags, error metrics, hashing
operators/  exact order statistics, exact stratified sample, skew-aware joins,
            effect fits, vectorised sweeps, forward selection, diagnostics
plans/      hold-out composites, the end-to-end pipeline, the query catalog
llm/        optional: operations for preparing language-model training data
"""

from biasfit.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
