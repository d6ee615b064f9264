"""DataFrame operators.  Each takes and returns a lazy DataFrame."""

from periodfact.operators.columns import (drop_columns, drop_null_keys, filter_category,
                                          first_columns, measure_gap, numeric_columns,
                                          round_columns, safe_column_names, safe_names,
                                          strip_agg_names)
from periodfact.operators.contract import Contract, conform
from periodfact.operators.fact import (assemble_fact, join_on_period,
                                       spine_join, to_decimal, union_families)
from periodfact.operators.periods import (filter_period, global_mean, lag_change,
                                          mean_by_period, mean_from_parts, mean_parts, means_of_parts, part_columns,
                                          row_total, sum_all_by_period, with_period)
from periodfact.operators.reshape import (BlockLayout, pivot_categories, to_blocks,
                                          unpivot_blocks, unpivot_layouts)
from periodfact.operators.tally import (apply_unmatched_policy, assert_all_matched,
                                        category_rank, first_by_key,
                                        lookup_first, shares, tally, unmatched,
                                        winner_category, winner_item,
                                        winner_of_columns)

__all__ = [
    "drop_columns", "drop_null_keys", "filter_category", "first_columns", "measure_gap",
    "numeric_columns", "round_columns", "safe_column_names", "safe_names", "strip_agg_names",
    "Contract", "conform", "assemble_fact", "join_on_period", "spine_join", "to_decimal",
    "union_families", "global_mean", "lag_change", "mean_by_period", "row_total",
    "sum_all_by_period", "with_period", "BlockLayout", "pivot_categories", "unpivot_blocks",
    "unpivot_layouts", "apply_unmatched_policy", "assert_all_matched",
    "category_rank", "first_by_key", "lookup_first", "shares", "tally", "unmatched",
    "winner_category", "winner_item", "winner_of_columns", "filter_period", "mean_parts",
    "mean_from_parts", "to_blocks",
]
