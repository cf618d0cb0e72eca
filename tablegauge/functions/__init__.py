from tablegauge.functions.columns import (
    as_column,
    div0,
    exact_length,
    like,
    min_digits,
    ntz_literal,
    percentage,
    run_id_date,
    within,
)

__all__ = [
    "as_column",
    "div0",
    "exact_length",
    "like",
    "min_digits",
    "ntz_literal",
    "percentage",
    "run_id_date",
    "within",
]
