"""Banding rules: each maps metrics to a label, first matching row of the table wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cut-offs and labels of the marts' published contract.
TREND_NEW, TREND_HIGH, TREND_STABLE, TREND_DOWN = "New", "High Growth", "Stable", "Declining"
TREND_HIGH_FROM, TREND_STABLE_FROM = 20, 0
STOCK_UNKNOWN, STOCK_CRITICAL, STOCK_WATCH, STOCK_HEALTHY = "Unknown", "Critical", "Watch", "Healthy"
STOCK_CRITICAL_FROM, STOCK_WATCH_FROM = 1, 0.7
PRODUCT_BEST, PRODUCT_GOOD, PRODUCT_SLOW = "Best Seller", "Good Performer", "Slow Moving"
PRODUCT_BEST_FACTOR = 1.5
RISK_LOW, RISK_NONE = "Low Stock Risk", "Healthy"
RISK_LOW_BELOW = -100
POPULARITY_OVER, POPULARITY_UNDER, POPULARITY_ON = "Overperforming", "Underperforming", "On Track"
POPULARITY_OVER_FACTOR = 5
FUNNEL_EXCELLENT, FUNNEL_GOOD, FUNNEL_POOR = "Excellent", "Good", "Needs Attention"
FUNNEL_EXCELLENT_FROM, FUNNEL_GOOD_FROM = 15, 8
CUSTOMER_NEVER, CUSTOMER_ACTIVE = "Never Purchased", "Active"
CUSTOMER_AT_RISK, CUSTOMER_INACTIVE = "At Risk", "Inactive"
CUSTOMER_ACTIVE_DAYS, CUSTOMER_AT_RISK_DAYS = 30, 90


def banded(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    (condition, label), *rest = rules
    out = F.when(condition, label)
    for condition, label in rest:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def sales_trend(growth_percent: Column) -> Column:
    return banded(
        [
            (growth_percent.isNull(), TREND_NEW),
            (growth_percent >= TREND_HIGH_FROM, TREND_HIGH),
            (growth_percent >= TREND_STABLE_FROM, TREND_STABLE),
        ],
        TREND_DOWN,
    )


def inventory_status(consumption_ratio: Column) -> Column:
    return banded(
        [
            (consumption_ratio.isNull(), STOCK_UNKNOWN),
            (consumption_ratio >= STOCK_CRITICAL_FROM, STOCK_CRITICAL),
            (consumption_ratio >= STOCK_WATCH_FROM, STOCK_WATCH),
        ],
        STOCK_HEALTHY,
    )


def product_status(revenue: Column, mean_revenue: Column) -> Column:
    return banded(
        [
            (revenue >= mean_revenue * PRODUCT_BEST_FACTOR, PRODUCT_BEST),
            (revenue >= mean_revenue, PRODUCT_GOOD),
        ],
        PRODUCT_SLOW,
    )


def inventory_risk(net_change: Column) -> Column:
    return banded([(net_change < RISK_LOW_BELOW, RISK_LOW)], RISK_NONE)


def sales_vs_popularity(units: Column, popularity: Column) -> Column:
    return banded(
        [
            (units > popularity * POPULARITY_OVER_FACTOR, POPULARITY_OVER),
            (units < popularity, POPULARITY_UNDER),
        ],
        POPULARITY_ON,
    )


def funnel_status(overall_rate: Column) -> Column:
    return banded(
        [
            (overall_rate >= FUNNEL_EXCELLENT_FROM, FUNNEL_EXCELLENT),
            (overall_rate >= FUNNEL_GOOD_FROM, FUNNEL_GOOD),
        ],
        FUNNEL_POOR,
    )


def customer_status(last_purchase: Column, days_since: Column) -> Column:
    return banded(
        [
            (last_purchase.isNull(), CUSTOMER_NEVER),
            (days_since <= CUSTOMER_ACTIVE_DAYS, CUSTOMER_ACTIVE),
            (days_since <= CUSTOMER_AT_RISK_DAYS, CUSTOMER_AT_RISK),
        ],
        CUSTOMER_INACTIVE,
    )
