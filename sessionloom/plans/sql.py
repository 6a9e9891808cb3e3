"""The reports as SQL over registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOURLY_REVENUE = """
    SELECT date_trunc('HOUR', window_start) AS hour,
           sum(revenue) AS revenue,
           sum(purchases) AS purchases
    FROM {gold}
    GROUP BY 1
"""

FUNNEL = """
    WITH sessions AS (
        SELECT session_id,
               sum(page_views) AS page_views,
               sum(cart_adds) AS cart_adds,
               sum(purchases) AS purchases
        FROM {gold}
        GROUP BY session_id
    ), stages AS (
        SELECT count_if(page_views > 0) AS viewed_sessions,
               count_if(cart_adds > 0) AS carted_sessions,
               count_if(purchases > 0) AS purchased_sessions
        FROM sessions
    )
    SELECT *,
           coalesce(try_divide(carted_sessions, viewed_sessions), 0D) AS view_to_cart_rate,
           coalesce(try_divide(purchased_sessions, carted_sessions), 0D) AS cart_to_purchase_rate,
           coalesce(try_divide(purchased_sessions, viewed_sessions), 0D) AS view_to_purchase_rate
    FROM stages
"""

TOP_PRODUCTS = """
    SELECT product_id, sum(price) AS revenue, count(*) AS purchases
    FROM {silver}
    WHERE event_type = 'purchase'
    GROUP BY product_id
    ORDER BY revenue DESC, product_id
    LIMIT {n}
"""


def run_sql(spark: SparkSession, text: str, **tables: DataFrame | str | int) -> DataFrame:
    """Run one of the texts above. A table is given as a DataFrame or as a registered name, a
    limit as a number."""
    frames = {k: v for k, v in tables.items() if isinstance(v, DataFrame)}
    names = {k: "{" + k + "}" if isinstance(v, DataFrame) else v for k, v in tables.items()}
    return spark.sql(text.format(**names), **frames)
