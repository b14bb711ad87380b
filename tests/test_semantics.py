
from pyspark.sql import functions as F

from tiffin.operators import dq, model, transform
from tiffin.operators import validate as V
from tiffin.plans import kpi


def test_repeated_cuisine_yields_two_bridge_rows(spark):
    df = spark.createDataFrame([(1, "Thai, Thai,Cafe"), (2, None), (3, " , ")], "restaurant_id long, cuisines string")
    got = sorted((r["restaurant_id"], r["cuisine"]) for r in transform.restaurant_cuisines(df).collect())
    assert got == [(1, "Cafe"), (1, "Thai"), (1, "Thai")]


def test_partner_with_two_names_fails_unique(spark):
    d = spark.createDataFrame([(1, 7, "Ann"), (2, 7, "Anne"), (3, 8, "Bo"), (4, None, "X")],
                              "delivery_id long, delivery_partner_id long, delivery_partner_name string")
    dim = model.dim_delivery_partner(d)
    assert dim.count() == 3
    res = {r["test_name"]: r["failures"] for r in dq.run_tests(
        {"dim_delivery_partner": dim}, [dq.Test("unique", "dim_delivery_partner", "delivery_partner_id"),
                                        dq.Test("not_null", "dim_delivery_partner", "delivery_partner_id")]).collect()}
    assert res == {"unique_dim_delivery_partner_delivery_partner_id": 1,
                   "not_null_dim_delivery_partner_delivery_partner_id": 0}


def test_relationships_null_fk_passes_missing_fails(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 99)], "order_id long, customer_id long")
    parent = spark.createDataFrame([(10,)], "customer_id long")
    t = dq.Test("relationships", "fact_orders", "customer_id", "dim_customer", "customer_id")
    r = dq.run_tests({"fact_orders": child, "dim_customer": parent}, [t]).first()
    assert (r["failures"], r["status"]) == (2, "fail")
    rows = dq.failing_rows({"fact_orders": child, "dim_customer": parent}, [t]).collect()
    assert [(x["value"], x["rows"]) for x in rows] == [("99", 2)]


def test_only_cancelled_customers_are_no_orders(spark):
    dc = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    fo = spark.createDataFrame([(1, "Delivered", 6000.0), (2, "Cancelled", 9000.0), (1, "Delivered", 1.0)],
                               "customer_id long, order_status string, order_total double") \
        .withColumn("order_total", F.col("order_total").cast("decimal(18,2)"))
    tiers = {r["value_tier"]: r["customers"] for r in kpi.value_tiers({"dim_customer": dc, "fact_orders": fo}).collect()}
    assert tiers == {"High value": 1, "No orders": 2}


def test_null_amounts_pass_rules(spark):
    p = spark.createDataFrame([(1, 1, None), (2, 1, 0.0), (3, 1, 5.0)], "payment_id long, order_id long, amount double")
    vo = spark.createDataFrame([(1,)], "order_id long")
    got = {r["payment_id"]: r["reject_reason"] for r in V.validate_payments(p, vo).collect()}
    assert got == {1: None, 2: "non_positive_amount", 3: None}


def test_gate_uses_worst_entity_and_strict_threshold(spark):
    rep = spark.createDataFrame([("a", 98, 2, 100, 0.02), ("b", 1000, 0, 1000, 0.0)],
                                "entity string, valid long, rejected long, total long, rejection_rate double")
    s = V.rejection_summary(rep).first()
    assert s["gate_failed"] is False and s["worst_rate"] == 0.02 and abs(s["overall_rate"] - 2 / 1100) < 1e-15
    rep2 = rep.withColumn("rejection_rate", F.when(F.col("entity") == "a", 0.021).otherwise(0.0))
    assert V.rejection_summary(rep2).first()["gate_failed"] is True
