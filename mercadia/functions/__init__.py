from .exprs import (avg_exact, blank_to_null, elapsed_days, interval_days, money, month_index,
                    month_start, pg_initcap, ratio, round_to, safe_pct)

__all__ = ["avg_exact", "blank_to_null", "elapsed_days", "interval_days", "money", "month_index",
           "month_start", "pg_initcap", "ratio", "round_to", "safe_pct"]
