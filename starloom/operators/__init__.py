"""Relational operators built from DataFrame primitives."""

from .batches import BatchTables
from .bitmap_membership import KeyBitmap
from .dedupe import dedupe_by_key, distinct_values, drop_duplicates_by_id, drop_exact_duplicates
from .joins import broadcast_budget, hot_pairs, lookup, maybe_broadcast, salted_join
from .key_registry import Delivery, KeyRegistry
from .keys import Keyed, assign_dense_key, renumber
from .materialize import materialize, observed_write
from .membership import drop_existing, keep_existing, rejected_rows
from .pair_registry import PairRegistry
from .parallel import spread
from .publish import Publication
from .quality import null_census, null_census_tall, referential_counts, row_count, schema_report
from .topk import sort_desc, top_k

__all__ = [
    "BatchTables",
    "Delivery",
    "KeyBitmap",
    "KeyRegistry",
    "Keyed",
    "PairRegistry",
    "Publication",
    "assign_dense_key",
    "broadcast_budget",
    "dedupe_by_key",
    "distinct_values",
    "drop_duplicates_by_id",
    "drop_exact_duplicates",
    "drop_existing",
    "hot_pairs",
    "keep_existing",
    "lookup",
    "materialize",
    "maybe_broadcast",
    "null_census",
    "null_census_tall",
    "observed_write",
    "referential_counts",
    "rejected_rows",
    "renumber",
    "row_count",
    "salted_join",
    "schema_report",
    "sort_desc",
    "spread",
    "top_k",
]
