from .incremental import (arrivals, clean_on_arrival, event_stream, funnel_refresh, lines_with_orders,
                          monthly_visitors, read_funnel, read_weekly_sales, settle_weekly_sales,
                          user_days_refresh, visit_summary_stream, weekly_sales_refresh, with_users,
                          write_closed_visits)

__all__ = ["arrivals", "clean_on_arrival", "event_stream", "funnel_refresh", "lines_with_orders", "monthly_visitors",
           "read_funnel", "read_weekly_sales", "settle_weekly_sales", "user_days_refresh",
           "visit_summary_stream", "weekly_sales_refresh", "with_users", "write_closed_visits"]
