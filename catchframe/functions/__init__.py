"""Column helpers: missing-value rules, text and rounding."""

from catchframe.functions.arrow import map_batches
from catchframe.functions.frames import attach, conditional_pivot, null_safe_join, stored
from catchframe.functions.intervals import interval_join, runs_of
from catchframe.functions.normal import normal_quantile
from catchframe.functions.ordered import in_order, ranked, running_sums
from catchframe.functions.semantics import (
    clean_nan,
    half_even,
    if_else,
    na_sum,
    not_in,
    poison_avg,
    poison_over,
    poison_sum,
    ratio,
    sig_round,
    to_double,
    to_int,
    two_measure_sum,
    z_value,
)
from catchframe.functions.text import digits, number_text, split_to_numbers

__all__ = [
    "attach", "clean_nan", "conditional_pivot", "digits", "half_even", "if_else", "in_order", "interval_join", "map_batches", "na_sum",
    "normal_quantile", "not_in", "null_safe_join", "number_text", "poison_avg", "poison_over", "poison_sum",
    "ranked", "ratio", "running_sums", "runs_of", "sig_round", "split_to_numbers", "stored", "to_double", "to_int", "two_measure_sum", "z_value",
]
