from .columns import (clean_brand, clean_price, safe_rate, round_half_up, money, money_sum, money_avg, segment, ltv_tier, is_type,
                      count_of, users_of, distinct_of, revenue_of, purchase_revenue, quantity_of,
                      MONEY, RATE)
from .calendar import calendar_columns, date_key

__all__ = ["clean_brand", "clean_price", "safe_rate", "round_half_up", "money", "money_sum", "money_avg", "segment", "ltv_tier", "is_type",
           "count_of", "users_of", "distinct_of", "revenue_of", "purchase_revenue",
           "quantity_of", "MONEY", "RATE", "calendar_columns", "date_key"]
