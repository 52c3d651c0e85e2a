from kpiloom.functions.scalars import (  # noqa: F401
    NULL_KEY, NUMBER_TEXT, any_of, case_tier, contains_ci, fmt_pct, fmt_thousands, from_units, key_norm,
    money_units, num_coerce, safe_name, safe_ratio_pct, sum_of, to_day, trunc_int, unknown, word_name,
)
from kpiloom.functions.search import search_any, search_col, search_summary  # noqa: F401
