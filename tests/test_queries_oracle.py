"""Every registered query against its DuckDB oracle (sf0.001, fast)."""

import pytest

from tests.compare import compare

SF = "/root/testdata/sf0.001"


def test_registry_has_oracles():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 65


def test_all_queries_match_oracle(spark):
    from tiffin.plans.queries import QUERIES
    res = compare(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    assert not bad, bad


def test_golden_kpis(spark):
    import __spark_entry__ as E
    q = E.queries()
    sf = "/root/testdata/sf0.01"
    assert q["kpi_business"](spark, sf).first()["active_restaurants"] == 212
    assert q["kpi_customers"](spark, sf).first()["new_customers"] == 16
    tiers = {r["value_tier"]: (r["customers"], r["tier_revenue"]) for r in q["value_tiers"](spark, sf).collect()}
    assert tiers["High value"] == (202, pytest.approx(599452624.19))
    assert tiers["Mid value"] == (1005, pytest.approx(1683485713.93))
    assert tiers["Low value"] == (290, pytest.approx(202101527.62))
    assert tiers["No orders"] == (3, 0.0)
    b = {r["bucket"]: r["deliveries"] for r in q["delivery_time_buckets"](spark, sf).collect()}
    assert b == {"< 20 min": 22957, "20–30 min": 12012, "30–45 min": 17896, "45+ min": 7135}
    assert q["kpi_delivery"](spark, sf).first()["on_time_pct"] == round(100 * 29936 / 60000, 1)
    dq = q["dq_summary"](spark, sf).first()
    assert (dq["total_tests"], dq["passed_tests"]) == (37, 37)
