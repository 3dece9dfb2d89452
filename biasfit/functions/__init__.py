"""Column builders (all JVM-side expressions; no Python UDFs)."""

from biasfit.functions.flags import flag_columns, add_flags
from biasfit.functions.metrics import rmse_columns, squared_error
from biasfit.functions.hashing import order_hash, hash_prefix_number

__all__ = ["flag_columns", "add_flags", "rmse_columns", "squared_error",
           "order_hash", "hash_prefix_number"]
