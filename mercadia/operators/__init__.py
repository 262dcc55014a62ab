from .grouping import cohort_retention, filter_sum, segment_by_recency, top_k, top_row_per_key
from .quality import dq_accepted_values, dq_not_null, dq_range, dq_relationship, dq_unique_grain
from .windows import Key, global_window, ntile_of, pareto, period_over_period, running_total

__all__ = ["Key", "cohort_retention", "dq_accepted_values", "dq_not_null", "dq_range", "dq_relationship",
           "dq_unique_grain", "filter_sum", "global_window", "ntile_of", "pareto", "period_over_period",
           "running_total", "segment_by_recency", "top_k", "top_row_per_key"]
