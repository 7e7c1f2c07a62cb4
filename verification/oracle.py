"""All DuckDB queries by registered name."""

from __future__ import annotations

from verification import oracle_kpi, oracle_more, oracle_quality

_SAME = ("gold_daily_revenue", "gold_revenue_by_category", "gold_customer_satisfaction", "gold_seller_performance")

ORACLE: dict[str, str] = {
    **oracle_kpi.QUERIES,
    # the same figures from tables in buckets
    **{name.replace("gold_", "bucketed_"): oracle_kpi.QUERIES[name] for name in _SAME},
    **oracle_quality.QUERIES,
    **oracle_more.QUERIES,
}
