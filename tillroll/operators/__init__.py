"""Relational operators: functions from DataFrames to DataFrames."""

from tillroll.operators.distinct import by_type, count_distinct, distinct_by_type, fewer_keys, per_value
from tillroll.operators.grouping import pivot_types, sum_by, to_long, with_overall
from tillroll.operators.lookup import DuplicateKeys, lookup, profile, require_unique, with_spread
from tillroll.operators.ordering import positioned, rank_whole
from tillroll.operators.ranking import ranked, top_n

__all__ = [
    "DuplicateKeys",
    "by_type",
    "count_distinct",
    "distinct_by_type",
    "fewer_keys",
    "lookup",
    "per_value",
    "pivot_types",
    "positioned",
    "profile",
    "rank_whole",
    "ranked",
    "require_unique",
    "sum_by",
    "to_long",
    "top_n",
    "with_overall",
    "with_spread",
]
