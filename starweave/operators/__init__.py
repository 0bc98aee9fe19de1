"""DataFrame operators: dedup, quarantine, lookups, SCD1 upsert, data quality."""
from .dedup import keep_latest
from .quarantine import REASONS, tag_rules, split_valid, Split
from .lookup import lookup
from .upsert import upsert, MERGE_ACTION
from .quality import (Check, RowCount, NullRate, DuplicateRate, ValueRange, RegexMatch,
                      run_checks, referential_integrity, foreign_keys, row_counts, enforce)

__all__ = [
    "keep_latest", "REASONS", "tag_rules", "split_valid", "Split", 
    "lookup", "upsert", "MERGE_ACTION", "Check", "RowCount", "NullRate", "DuplicateRate",
    "ValueRange", "RegexMatch", "run_checks", "referential_integrity", "foreign_keys", "row_counts", "enforce",
]
