"""KPIs over bucketed facts: equal results, and no fact table is dealt by order again."""

from __future__ import annotations

import re
import uuid
from pathlib import Path

import pytest

from tests.test_gold import both
from tidemark.config import TABLES
from tidemark.plans import bucketed, gold, pipeline, silver
from tidemark.plans.bucketed import FACTS, BucketedSilver, GoldFacts, write_bucketed
from tidemark.sources import star
from tidemark.sources.files import TableStore

KPIS = ("gold_daily_revenue", "gold_revenue_by_category", "gold_customer_satisfaction", "gold_seller_performance")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    plain = silver.CleanTables(lambda table: star.bronze(spark, FOLDER, table))
    return plain, BucketedSilver(spark, plain, f"t_{uuid.uuid4().hex[:8]}", 6)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kpi", KPIS)
def test_results_are_equal_and_orders_are_not_dealt(spark, conf, tables, kpi):
    plain, bucketed = tables
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    seen = []
    real = gold.rank_by_total
    gold.rank_by_total = lambda df, *a: (seen.append(plan_of(df)), real(df, *a))[1]  # staged in between
    try:
        df = gold.GOLD[kpi](bucketed)
    finally:
        gold.rank_by_total = real
    plans = [*seen, plan_of(df)]
    assert any("Bucketed: true" in p for p in plans)
    assert not any(re.search(r"hashpartitioning\(order_id", p) for p in plans), plans
    rows = lambda frame: sorted(map(str, frame.collect()))
    assert rows(df) == rows(gold.GOLD[kpi](plain))


def test_one_file_a_bucket_and_replacement(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id % 97 AS string) AS order_id", "id")
    name = f"t_{uuid.uuid4().hex[:8]}"
    assert write_bucketed(df, name, str(tmp_path / "a"), 4).count() == 1000
    assert len(list((tmp_path / "a").glob("*.parquet"))) == 4
    assert write_bucketed(df.limit(10), name, str(tmp_path / "b"), 4).count() == 10
    with pytest.raises(Exception, match="boom"):
        write_bucketed(df.selectExpr("order_id", "raise_error('boom') AS id"), name, str(tmp_path / "c"), 4)
    assert spark.table(name).count() == 10


def test_categorised_items_are_a_fact(tables):
    assert gold.CATEGORISED in FACTS and gold.CATEGORISED in set(tables[1]) and len(tables[1]) == len(set(tables[1]))


def stored(spark, tmp_path, *tables):
    """A store with silver tables of random rows: repeated, dangling and hot keys."""
    store = TableStore(spark, str(tmp_path / "store"))
    frames, _ = both(spark, 5, hot=True)
    for table in tables or TABLES:
        store.overwrite(frames[table], "silver", TABLES[table].silver)
    return store


def test_a_run_of_all_kpis_deals_no_fact_by_order(spark, conf, tmp_path, monkeypatch):
    """Facts are written in buckets once; before, every KPI shuffled the facts it joins by order."""
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    store, plans, real, ranked = stored(spark, tmp_path), {}, TableStore.overwrite, gold.rank_by_total
    monkeypatch.setattr(TableStore, "overwrite", lambda self, df, layer, name: (plans.update({name: plan_of(df)}), real(self, df, layer, name))[1])
    monkeypatch.setattr(gold, "rank_by_total", lambda df, *a: (plans.update(ranked=plan_of(df)), ranked(df, *a))[1])
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 20)  # several buckets
    report = {r["table_name"]: r for r in pipeline.run_gold(store).collect()}
    assert {r["status"] for r in report.values()} == {"SUCCESS"} and set(report) == set(gold.GOLD)
    for plan in (plans[name] for name in (*KPIS[:3], "ranked")):  # sellers are staged before their ranks
        assert "Bucketed: true" in plan and not re.search(r"hashpartitioning\(order_id", plan), plan
    rows = lambda frame: sorted(map(str, frame.collect()))
    for kpi, build in gold.GOLD.items():
        found = rows(store.read("gold", kpi))
        assert found == rows(build(pipeline.StoredSilver(store))) and len(found) == report[kpi]["rows_out"] > 0


def test_shared_facts_are_written_once_and_dropped(spark, tmp_path, monkeypatch):
    store, written, real = stored(spark, tmp_path), [], bucketed.write_bucketed
    monkeypatch.setattr(bucketed, "write_bucketed", lambda df, name, path, *a, **k: (written.append((name, path)), real(df, name, path, *a, **k))[1])
    pipeline.run_gold(store)
    assert len(written) == len(FACTS)
    assert not any(spark.catalog.tableExists(name) or Path(path).parent.exists() for name, path in written)


def test_a_missing_fact_fails_only_its_kpis(spark, tmp_path):
    store = stored(spark, tmp_path, *(t for t in TABLES if t != "order_reviews"))
    failed = {r["table_name"] for r in pipeline.run_gold(store).collect() if r["status"] == "FAILED"}
    assert failed == {"gold_customer_satisfaction", "gold_seller_performance"}


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    count = lambda rows: GoldFacts(spark, {"orders": spark.range(rows).selectExpr("cast(id AS string) AS order_id")}).buckets()
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 100)
    monkeypatch.setattr(bucketed, "LEAST_ROWS", 50)
    assert [count(n) for n in (0, 10, 120, 5_000)] == [1, 1, 3, 50]
