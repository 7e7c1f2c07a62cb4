"""Gold by period: a late load rebuilds the months it touches, and no others.

Day totals are stored by month. A late load names the orders it brings rows for; their days give the
months, the facts of those months' orders are reduced again, and dynamic partition overwrite replaces
just these months when the job commits, so a failed rebuild leaves the table as it was. What depends
on neighbouring days (change against the day before) is derived when the table is read, from one row
a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import gold
from tidemark.sources.files import TableStore

NAME = "gold_day_totals"
PERIOD = ("order_year", "order_month")


def months_of(orders: DataFrame, order_ids: DataFrame) -> DataFrame:
    """The months (year, month) that hold the named orders: one row per calendar month."""
    return orders.join(order_ids.select("order_id").distinct(), "order_id", "left_semi").select(*PERIOD).distinct()


def _within(silver: gold.Silver, months: DataFrame) -> dict[str, DataFrame]:
    """The facts of the orders that lie, with any of their rows, in the given months."""
    orders = silver["orders"]
    other = months.toDF(*[f"_{c}" for c in PERIOD])
    same = F.lit(True)
    for c in PERIOD:
        same = same & orders[c].eqNullSafe(other[f"_{c}"])
    # a calendar list: at most one row a month
    chosen = orders.join(F.broadcast(other), same, "left_semi")
    ids = chosen.select("order_id").distinct()
    facts = {t: silver[t].join(ids, "order_id", "left_semi") for t in ("order_payments", "order_items")}
    return {"orders": chosen, **facts}


def _write(store: TableStore, totals: DataFrame) -> None:
    # one row a day: a task and a file per month
    (
        totals.repartition(*PERIOD).write.format(store.table_format).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*PERIOD).save(store.path("gold", NAME))
    )


def build(store: TableStore, silver: gold.Silver) -> None:
    """All months."""
    _write(store, gold.day_totals(silver))


def rebuild(store: TableStore, silver: gold.Silver, late_orders: DataFrame) -> None:
    """The months of the orders that a load has brought rows for; ``silver`` holds that load already."""
    _write(store, gold.day_totals(_within(silver, months_of(silver["orders"], late_orders))))


def daily_revenue(store: TableStore) -> DataFrame:
    """The daily revenue KPI from the stored totals."""
    path = store.path("gold", NAME)
    totals = store.spark.read.format(store.table_format).load(path)
    typed = totals.withColumns({c: F.col(c).cast("int") for c in PERIOD})
    return gold.daily_revenue_of(typed)
