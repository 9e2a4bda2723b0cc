"""Move, query, convert and sync relational tables with Spark.

Everything takes DataFrames and returns DataFrames. Nothing is collected on the
driver except values whose size does not depend on the data (one row of bounds,
a schema, a capped size probe).
"""

from tablebridge.operators.checks import column_stats, key_violations
from tablebridge.operators.deltas import delta_page, latest_changes
from tablebridge.operators.filters import filter_rows
from tablebridge.operators.infer import apply_types, infer_types, rejected_values
from tablebridge.operators.paging import page, page_text
from tablebridge.plans.spec import run_spec
from tablebridge.sources.factory import open_source

__all__ = [
    "apply_types",
    "column_stats",
    "delta_page",
    "filter_rows",
    "infer_types",
    "key_violations",
    "latest_changes",
    "open_source",
    "page",
    "page_text",
    "rejected_values",
    "run_spec",
]
