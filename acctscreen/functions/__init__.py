"""Column-level helpers: every one returns a built-in Spark ``Column``."""

from acctscreen.functions.predicates import (
    differs_with_null,
    in_date_window,
    is_individual_id,
    isin_keep_null,
    strict_cast,
    teller_code_ok,
)
from acctscreen.functions.datetime import (
    epoch_to_datetime,
)

__all__ = [
    "differs_with_null",
    "in_date_window",
    "is_individual_id",
    "isin_keep_null",
    "strict_cast",
    "teller_code_ok",
    "epoch_to_datetime",
]
