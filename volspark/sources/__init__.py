from volspark.sources.bars import read_bars, read_implied_vol
from volspark.sources.fixtures import bars_from_lineitem, index_from_orders
from volspark.sources.tables import (
    load_featured,
    read_importances,
    read_models,
    read_processed,
    read_results,
    write_processed_csv,
    write_results_csv,
)

__all__ = [
    "bars_from_lineitem",
    "index_from_orders",
    "load_featured",
    "read_bars",
    "read_implied_vol",
    "read_importances",
    "read_models",
    "read_processed",
    "read_results",
    "write_processed_csv",
    "write_results_csv",
]
