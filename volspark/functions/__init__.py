from volspark.functions.columns import (
    PERIODS_PER_YEAR,
    annualize,
    change_sign,
    decimals_text,
    percent_text,
    rolling_mean,
    rolling_std,
    symbol_label,
    truncated_share,
)

__all__ = [
    "PERIODS_PER_YEAR",
    "annualize",
    "change_sign",
    "decimals_text",
    "percent_text",
    "rolling_mean",
    "rolling_std",
    "symbol_label",
    "truncated_share",
]
