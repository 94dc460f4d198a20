"""Fixed parameters of the registered queries (shared by Spark and DuckDB)."""

import datetime as _dt

# The as-of day that stands in for "today" in date defaults, so that results
# are repeatable.
AS_OF = _dt.date(2025, 1, 15)
