"""Functions from DataFrames to DataFrames."""

from tarnlake.operators.batches import between, latest_batch, latest_slice, ledger_rows
from tarnlake.operators.checks import assert_not_empty, check_not_empty, null_profile, preview
from tarnlake.operators.enrich import enrich, enrich_sql
from tarnlake.operators.heavy import heavy_keys
from tarnlake.operators.history import latest_per_key, row_number_desc
from tarnlake.operators.metrics import annual_metrics, count_rows, date_range
from tarnlake.operators.sets import distinct_ids, except_all, reconcile_ids

__all__ = [
    "annual_metrics",
    "assert_not_empty",
    "between",
    "check_not_empty",
    "count_rows",
    "date_range",
    "distinct_ids",
    "enrich",
    "enrich_sql",
    "except_all",
    "heavy_keys",
    "latest_batch",
    "latest_per_key",
    "latest_slice",
    "ledger_rows",
    "null_profile",
    "preview",
    "reconcile_ids",
    "row_number_desc",
]
