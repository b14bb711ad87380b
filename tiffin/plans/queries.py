"""Every query of the library bound to the fixture role views.

``QUERIES[name](spark, sf_dir) -> DataFrame``.  Each call builds its inputs
from the parquet tables under ``sf_dir`` (so the work grows with the data)
and returns a DataFrame; queries that share a costly input between branches
write it to the shared folder first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.fmt import format_report
from tiffin.functions.numeric import cents
from tiffin.operators import dq, generate, model, profile, reviews, transform, validate
from tiffin.operators.joins import lookup_join
from tiffin.plans import health, kpi, round_trips
from tiffin.session import cut_lineage, in_partitions, shared_dir
from tiffin.sources import fixtures as fx

# Fixture parameter: tier thresholds scaled to the fixture's order totals.
FIXTURE_TIERS = (("High value", 2_500_000), ("Mid value", 1_000_000))


class Lazy(dict):
    """A mapping whose values are built on first access (and memoised)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._b = builders

    def __missing__(self, key):
        v = self._b[key]()
        self[key] = v
        return v

    def __contains__(self, key):
        return key in self._b


def validate_all_lazy(raw) -> Lazy:
    """The V11 cascade, building each entity's plan only when asked for.

    Valid keys that feed several validations are written once
    (``valid_orders`` for the children).
    """
    out: Lazy

    def orders():
        return validate.validate_orders(
            raw["orders"], cut_lineage(validate.valid(out["restaurants"]).select("restaurant_id")),
            cut_lineage(validate.valid(out["customers"]).select("customer_id")))
    out = Lazy({
        "restaurants": lambda: validate.validate_restaurants(raw["restaurants"]),
        "customers": lambda: validate.validate_customers(raw["customers"]),
        "orders": orders,
        "written_orders": lambda: cut_lineage(out["orders"].select("order_id", "order_date", "reject_reason")),
        "valid_orders": lambda: validate.valid(out["written_orders"]).select("order_id"),
        "order_items": lambda: validate.validate_order_items(raw["order_items"], out["valid_orders"]),
        "payments": lambda: validate.validate_payments(raw["payments"], out["valid_orders"]),
        "deliveries": lambda: validate.validate_deliveries(raw["deliveries"], out["valid_orders"]),
    })
    return out


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = in_partitions(spark)
        base = fx.loader(spark, sf_dir)
        tables: dict[str, DataFrame] = {}

        def t(name: str) -> DataFrame:
            if name not in tables:
                tables[name] = base(name)
            return tables[name]
        self.t = t
        self.staging = Lazy({
            "restaurants": lambda: transform.clean_restaurants(fx.restaurants(t)),
            "restaurant_cuisines": lambda: transform.restaurant_cuisines(fx.restaurants(t)),
            "customers": lambda: transform.clean_customers(fx.customers(t), fx.orders(t)),
            "orders": lambda: transform.clean_orders(fx.orders(t)),
            "order_items": lambda: transform.clean_order_items(fx.order_items(t)),
            "payments": lambda: transform.clean_payments(fx.payments(t)),
            "deliveries": lambda: transform.clean_deliveries(fx.deliveries(t)),
            "reviews": lambda: reviews.parsed_reviews(reviews.with_parsed(fx.reviews_raw(t))),
        })
        self.star = self._star(self.staging)
        # no KPI reads an order's location, so theirs do without that lookup
        self.orders_star = self._star(self.staging, located=False)
        kpi_staging = Lazy(dict(self.staging._b, deliveries=lambda: transform.clean_deliveries(fx.deliveries_at_scale(t))))
        self.kpi_star = self._star(kpi_staging, located=False)

    def _star(self, st: Lazy, located: bool = True) -> Lazy:
        spark = self.spark
        s = None

        def get(k):
            return s[k]
        s = Lazy({
            "dim_location": lambda: model.dim_location(st["restaurants"]),
            "dim_cuisine": lambda: model.dim_cuisine(st["restaurant_cuisines"]),
            "dim_restaurant": lambda: model.dim_restaurant(st["restaurants"], get("dim_location")),
            "bridge_restaurant_cuisine": lambda: model.bridge_restaurant_cuisine(st["restaurant_cuisines"], get("dim_cuisine")),
            "dim_customer": lambda: model.dim_customer(st["customers"]),
            "dim_delivery_partner": lambda: model.dim_delivery_partner(st["deliveries"]),
            "dim_date": lambda: model.dim_date(st["orders"]),
            "dim_time": lambda: model.dim_time(spark),
            "fact_orders": lambda: (model.fact_orders(st["orders"], get("dim_restaurant")) if located
                                    else model.unlocated_orders(st["orders"])),
            "fact_order_items": lambda: model.fact_order_items(st["order_items"]),
            "fact_payments": lambda: model.fact_payments(st["payments"]),
            "fact_deliveries": lambda: model.fact_deliveries(st["deliveries"]),
            "fact_reviews": lambda: model.fact_reviews(st["reviews"]),
        })
        return s

    def raw_inputs(self) -> Lazy:
        """The six raw (dirty) entity inputs (role views over the given tables)."""
        if not hasattr(self, "_raw"):
            t = self.t
            self._raw = Lazy({
                "restaurants": lambda: fx.restaurants_dirty(t),
                "customers": lambda: fx.customers_dirty(t),
                "orders": lambda: fx.orders_dirty(t),
                "order_items": lambda: fx.order_items_dirty(t),
                "payments": lambda: fx.payments_dirty(t),
                "deliveries": lambda: fx.deliveries_dirty(t),
            })
        return self._raw

    # validation cascade over the dirty fixtures
    def tagged(self) -> dict[str, DataFrame]:
        if not hasattr(self, "_tagged"):
            raw = self.raw_inputs()
            self._tagged = validate_all_lazy(raw)
        return self._tagged

    def outcomes(self) -> dict[str, DataFrame]:
        """Counts of validation outcomes of all entities (the orders are tagged and written once)."""
        t = self.tagged()
        return validate.outcomes(self.raw_inputs(), t["written_orders"], t["valid_orders"])


# Output projections of the validation queries (keys + checked fields + reason).
VALIDATION_COLUMNS = {
    "restaurants": ["restaurant_id", "url", "name", "votes", "reject_reason"],
    "customers": ["customer_id", "seq", "reject_reason"],
    "orders": ["order_id", "seq", "customer_id", "restaurant_id", "order_total", "reject_reason"],
    "order_items": ["order_item_id", "order_id", "item_price", "reject_reason"],
    "payments": ["payment_id", "order_id", "amount", "reject_reason"],
    "deliveries": ["delivery_id", "order_id", "delivery_time_minutes", "reject_reason"],
}


def _validation(entity: str):
    def q(spark, sf_dir):
        return Ctx(spark, sf_dir).tagged()[entity].select(*VALIDATION_COLUMNS[entity])
    return q


def _staging(name: str):
    return lambda spark, sf_dir: Ctx(spark, sf_dir).staging[name]


def _star(name: str):
    return lambda spark, sf_dir: Ctx(spark, sf_dir).star[name]


def _kpi(fn, kpi_star: bool = False, **kw):
    def q(spark, sf_dir):
        c = Ctx(spark, sf_dir)
        return fn(c.kpi_star if kpi_star else c.orders_star, **kw)
    return q


# What a KPI reads beside sums: dimensions, no fact.
KPI_DIMENSIONS = ("dim_restaurant", "dim_location", "dim_cuisine", "bridge_restaurant_cuisine", "dim_customer",
                  "dim_delivery_partner")


def _summed(fn, tables: tuple[str, ...], kpi_star: bool = False, **kw):
    """A KPI answered from daily sums, without any fact."""
    def q(spark, sf_dir):
        c = Ctx(spark, sf_dir)
        facts = c.kpi_star if kpi_star else c.star
        s = Lazy({d: lambda d=d: facts[d] for d in KPI_DIMENSIONS})
        s._b.update({t: lambda df=df: df for t, df in round_trips.summed(spark, facts, tables).items()})
        return fn(s, **kw)
    return q


def q_rejected_reviews(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return reviews.rejected_reviews(reviews.with_parsed(fx.reviews_raw(c.t)))


def q_parsed_reviews(spark, sf_dir):
    return Ctx(spark, sf_dir).staging["reviews"]


def q_dim_time(spark, sf_dir):
    """M8: all 24 hours with their band and the orders placed in each."""
    c = Ctx(spark, sf_dir)
    per_hour = c.staging["orders"].groupBy(F.col("order_hour").alias("hour_id")).agg(F.count(F.lit(1)).alias("orders"))
    return model.dim_time(spark).join(per_hour, "hour_id", "left").na.fill(0, ["orders"])


def q_orders_per_band(spark, sf_dir):
    """Orders, hours and hours without orders of every band of the day."""
    hours = q_dim_time(spark, sf_dir)
    return hours.groupBy("time_period").agg(F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("hours"),
                                            F.count_if(F.col("orders") == 0).alias("idle_hours"))


def q_quarantine_reasons(spark, sf_dir):
    return validate.reason_histogram(Ctx(spark, sf_dir).outcomes())


def q_rejection_report(spark, sf_dir):
    return validate.rejection_report(Ctx(spark, sf_dir).outcomes())


def q_rejection_summary(spark, sf_dir):
    return validate.rejection_summary(validate.rejection_report(Ctx(spark, sf_dir).outcomes()))


def materialise(frames: dict[str, DataFrame], workers: int = 4) -> dict[str, DataFrame]:
    """Write several frames as parquet in the shared folder with concurrent jobs and read them back.

    As in the pipeline, the tests run over *written* models: each is made
    once, and a test reads only the columns that it needs.
    """
    from concurrent.futures import ThreadPoolExecutor

    def write(name: str, df: DataFrame) -> DataFrame:
        path = shared_dir(df.sparkSession, f"model-{name}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    with ThreadPoolExecutor(max_workers=workers) as ex:
        futures = {k: ex.submit(write, k, df) for k, df in frames.items()}
        return {k: f.result() for k, f in futures.items()}


def _written_star(c: Ctx) -> dict[str, DataFrame]:
    return materialise({k: c.star[k] for k in c.star._b})


def q_dq_results(spark, sf_dir):
    return dq.run_tests(_written_star(Ctx(spark, sf_dir)))


def q_dq_summary(spark, sf_dir):
    return dq.summarize(dq.run_tests(_written_star(Ctx(spark, sf_dir))))


def dirty_star(c: Ctx) -> dict[str, DataFrame]:
    """The written star of unvalidated dirty inputs: all 13 models."""
    st = Lazy(dict(c.staging._b,
                   customers=lambda: transform.clean_customers(fx.customers_dirty(c.t), fx.orders_dirty(c.t)),
                   orders=lambda: transform.clean_orders(fx.orders_dirty(c.t)),
                   order_items=lambda: transform.clean_order_items(fx.order_items_dirty(c.t)),
                   payments=lambda: transform.clean_payments(fx.payments_dirty(c.t)),
                   deliveries=lambda: transform.clean_deliveries(fx.deliveries_dirty(c.t))))
    s = c._star(st)
    return materialise({m: s[m] for m in s._b})


def q_dq_failing_rows(spark, sf_dir):
    return dq.failing_rows(dirty_star(Ctx(spark, sf_dir)))


def q_kpi_customers(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return kpi.kpi_customers(c.orders_star, fx.as_of(c.t))


def q_new_customers_by_day(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return kpi.new_customers_by_day(c.orders_star, fx.as_of(c.t))


def q_kpi_delivery(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    s = c.kpi_star
    return kpi.kpi_delivery({"fact_deliveries": s["fact_deliveries"], "fact_orders": c.orders_star["fact_orders"],
                             "dim_restaurant": c.star["dim_restaurant"]})


def _validation_runs(c: Ctx) -> DataFrame:
    raw = c.raw_inputs()
    return health.validation_runs_by_year(validate.master_outcomes(raw), validate.order_outcomes(raw, c.tagged()["written_orders"]),
                                          raw["orders"])


def _test_runs(c: Ctx) -> DataFrame:
    return health.test_runs_by_year(dirty_star(c), c.raw_inputs()["orders"])


def q_validation_trend(spark, sf_dir):
    return health.validation_trend(_validation_runs(Ctx(spark, sf_dir)))


def q_dq_trend(spark, sf_dir):
    return health.test_trend(_test_runs(Ctx(spark, sf_dir)))


def q_health_kpis(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return health.health_kpis(_validation_runs(c), _test_runs(c))


def q_recent_runs(spark, sf_dir):
    return health.recent_runs(_validation_runs(Ctx(spark, sf_dir)))


def q_format_report(spark, sf_dir):
    return format_report(kpi.value_tiers(Ctx(spark, sf_dir).orders_star, FIXTURE_TIERS))


def q_profile_shape(spark, sf_dir):
    return profile.shape(fx.restaurants_dirty(fx.loader(spark, sf_dir)))


def q_profile_nulls(spark, sf_dir):
    return profile.null_counts(fx.restaurants_dirty(fx.loader(spark, sf_dir)))


def q_profile_duplicates(spark, sf_dir):
    t = fx.loader(spark, sf_dir)
    return profile.duplicate_count(fx.restaurants_dirty(t), "url").unionByName(
        profile.duplicate_count(fx.customers_dirty(t), "customer_id"))


def q_profile_samples(spark, sf_dir):
    r = fx.restaurants_dirty(fx.loader(spark, sf_dir))
    return profile.distinct_samples(r, {"rate": 20, "approx_cost(for two people)": 20, "cuisines": 10})


def q_impute_stats(spark, sf_dir):
    return generate.impute_stats(Ctx(spark, sf_dir).staging["restaurants"])


def q_weighted_assignment(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    w = generate.impute(c.staging["restaurants"]).select("restaurant_id", "weight")
    orders = c.staging["orders"].select("order_id")
    return generate.weighted_assignment(w, orders, "restaurant_id", "weight", "order_id")


def q_allocate_residual(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    # the items of every 13th order are free
    w = F.when(F.col("order_id") % 13 == 0, F.lit(0)).otherwise(cents("item_price")).alias("w")
    items = c.staging["order_items"].select("order_id", "order_item_id", w)
    totals = c.staging["orders"].select("order_id", cents("order_total").alias("total_cents"))
    lines = lookup_join(items, totals, ["order_id"], "inner")
    return generate.allocate_residual(lines, "order_id", "order_item_id", "w", "total_cents")


def q_anchored_amounts(spark, sf_dir):
    """G3 + G4: each order's weighted-chosen restaurant and its anchored amount."""
    c = Ctx(spark, sf_dir)
    half = F.when(F.col("restaurant_id") % 3 == 0, F.lit(0.5)).otherwise(F.lit(0.0))  # some costs have a fraction
    r = generate.impute(c.staging["restaurants"]).select(
        "restaurant_id", "weight", (F.col("cost_filled") + half).alias("cost_filled"))
    o = c.staging["orders"].select("order_id", "party_size")
    pick = generate.weighted_assignment(r.select("restaurant_id", "weight"), o.select("order_id"),
                                        "restaurant_id", "weight", "order_id")
    j = lookup_join(lookup_join(pick, o, ["order_id"], "inner"), r.select("restaurant_id", "cost_filled"),
                    ["restaurant_id"], "inner")
    cents_ = generate.anchored_amount_cents(F.col("cost_filled"), F.col("party_size"), F.col("order_id"))
    return j.select("order_id", "restaurant_id", "party_size",
                    (cents_.cast("decimal(38,0)") / 100).cast("decimal(18,2)").alias("amount"))


def q_derived_deliveries(spark, sf_dir):
    """One delivery per non-cancelled order, minutes floored at 10."""
    o = Ctx(spark, sf_dir).staging["orders"]
    d = generate.status_children(o, "order_status", kpi.CANCELLED, (F.col("order_id") * 13) % 50)
    return d.select(F.col("order_id").alias("delivery_id"), "order_id", "delivery_time_minutes")


def q_job_run(spark, sf_dir):
    """The daily job over dirty inputs (but items with unique ids), its logical time the day after the last order."""
    c = Ctx(spark, sf_dir)
    raw = {e: c.raw_inputs()[e] for e in validate.ENTITIES} | {"order_items": fx.order_items(c.t)}
    last = fx.orders(c.t).agg(F.max("order_date")).first()[0]
    run_at = dt.datetime(last.year, last.month, last.day) + dt.timedelta(days=1)
    return round_trips.job_run(spark, raw, fx.reviews_raw(c.t), run_at)


def q_test_gate(spark, sf_dir):
    """Tests of orders and of items with repeated ids, and whether they withhold the publish."""
    c = Ctx(spark, sf_dir)
    items = model.fact_order_items(transform.clean_order_items(fx.order_items_raw(c.t)))
    return dq.gate(dq.run_tests({"fact_orders": c.star["fact_orders"], "fact_order_items": items}, [
        t for t in dq.star_tests() if t.model == "fact_order_items" or (t.model, t.to) == ("fact_orders", None)]))


def q_profile_guarded(spark, sf_dir):
    """A column that the table lacks is left out of the samples."""
    r = fx.restaurants_dirty(fx.loader(spark, sf_dir))
    return profile.distinct_samples(r, {"rate": 20, "delivery fee": 20})


def q_latest_validation_run(spark, sf_dir):
    """Q24: the latest run of the validation log."""
    return health.latest(_validation_runs(Ctx(spark, sf_dir)))


def _round_trip(fn, source):
    """A query of ``round_trips`` over what ``source`` makes of the context."""
    def q(spark, sf_dir):
        made = source(Ctx(spark, sf_dir))
        return fn(spark, *(made if isinstance(made, tuple) else (made,)))
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # validation (V)
    **{f"validate_{e}": _validation(e) for e in validate.ENTITIES},
    "quarantine_reasons": q_quarantine_reasons,
    "rejection_report": q_rejection_report,
    "rejection_summary": q_rejection_summary,
    # cleaning (T)
    "clean_restaurants": _staging("restaurants"),
    "restaurant_cuisines": _staging("restaurant_cuisines"),
    "clean_customers": _staging("customers"),
    "clean_orders": _staging("orders"),
    "clean_order_items": _staging("order_items"),
    "clean_payments": _staging("payments"),
    "clean_deliveries": _staging("deliveries"),
    # reviews (T10, T11, S5, F5)
    "parsed_reviews": q_parsed_reviews,
    "rejected_reviews": q_rejected_reviews,
    # star (M, F)
    "dim_date_padded": lambda spark, sf_dir: model.dim_date(Ctx(spark, sf_dir).staging["orders"], pad_names=True),
    **{name: _star(name) for name in (
        "dim_location", "dim_cuisine", "dim_restaurant", "bridge_restaurant_cuisine", "dim_customer",
        "dim_delivery_partner", "dim_date", "fact_orders", "fact_order_items",
        "fact_payments", "fact_deliveries", "fact_reviews")},
    "dim_time": q_dim_time,
    "orders_per_band": q_orders_per_band,
    # data tests (D)
    "dq_results": q_dq_results,
    "dq_summary": q_dq_summary,
    "dq_failing_rows": q_dq_failing_rows,
    # KPIs (Q1-Q23)
    "kpi_business": _kpi(kpi.kpi_business),
    "revenue_trend": _kpi(kpi.revenue_trend),
    "orders_by_area": _kpi(kpi.orders_by_area),
    "top_cuisines": _kpi(kpi.top_cuisines),
    "top_restaurants": _kpi(kpi.top_restaurants),
    "kpi_customers": q_kpi_customers,
    "value_tiers": _kpi(kpi.value_tiers, tiers=FIXTURE_TIERS),
    "value_tiers_share": _kpi(kpi.value_tiers, tiers=FIXTURE_TIERS, with_share=True),
    "orders_by_payment_method": _kpi(kpi.orders_by_payment_method),
    "new_customers_by_day": q_new_customers_by_day,
    "kpi_delivery": q_kpi_delivery,
    "orders_by_hour": _kpi(kpi.orders_by_hour),
    "delivery_time_buckets": _kpi(kpi.delivery_time_buckets, kpi_star=True),
    "partner_leaderboard": _kpi(kpi.partner_leaderboard, kpi_star=True),
    "online_vs_offline": _kpi(kpi.online_vs_offline),
    # the same from daily sums that loads add to
    "summed_kpi_business": _summed(kpi.kpi_business, ("order_sums",)),
    "summed_revenue_trend": _summed(kpi.revenue_trend, ("order_sums",)),
    "summed_orders_by_area": _summed(kpi.orders_by_area, ("order_sums",)),
    "summed_top_cuisines": _summed(kpi.top_cuisines, ("order_sums",)),
    "summed_top_restaurants": _summed(kpi.top_restaurants, ("order_sums",)),
    "summed_online_vs_offline": _summed(kpi.online_vs_offline, ("order_sums",)),
    "summed_value_tiers": _summed(kpi.value_tiers, ("customer_sums",), tiers=FIXTURE_TIERS),
    "summed_orders_by_hour": _summed(kpi.orders_by_hour, ("hour_sums",)),
    "summed_orders_by_payment_method": _summed(kpi.orders_by_payment_method, ("method_sums",)),
    "summed_kpi_delivery": _summed(kpi.kpi_delivery, ("order_sums", "partner_sums"), kpi_star=True),
    "summed_delivery_time_buckets": _summed(kpi.delivery_time_buckets, ("minute_sums",), kpi_star=True),
    "summed_partner_leaderboard": _summed(kpi.partner_leaderboard, ("partner_sums",), kpi_star=True),
    # pipeline health (Q24-Q32)
    "health_kpis": q_health_kpis,
    "validation_trend": q_validation_trend,
    "dq_trend": q_dq_trend,
    "recent_runs": q_recent_runs,
    "format_report": q_format_report,
    # profiling and generation cores (P, G)
    "profile_shape": q_profile_shape,
    "profile_nulls": q_profile_nulls,
    "profile_duplicates": q_profile_duplicates,
    "profile_samples": q_profile_samples,
    "impute_stats": q_impute_stats,
    "weighted_assignment": q_weighted_assignment,
    "allocate_residual": q_allocate_residual,
    "anchored_amounts": q_anchored_amounts,
    "derived_deliveries": q_derived_deliveries,
    "latest_validation_run": q_latest_validation_run,
    # sources and sinks (S)
    "csv_payments": _round_trip(round_trips.csv_payments, lambda c: (
        fx.payments_dirty(c.t), validate.valid(c.tagged()["orders"]).select("order_id"))),
    "csv_mixed_headers": _round_trip(round_trips.csv_mixed_headers, lambda c: fx.payments(c.t)),
    "csv_malformed": _round_trip(round_trips.csv_malformed, lambda c: fx.payments(c.t)),
    "appended_years": _round_trip(round_trips.appended_years, lambda c: fx.orders(c.t)),
    "compacted_years": _round_trip(round_trips.compacted_years, lambda c: fx.orders(c.t)),
    "indexed_duplicates": _round_trip(round_trips.indexed_duplicates, lambda c: (
        fx.orders_dirty(c.t), cut_lineage(validate.valid(c.tagged()["restaurants"]).select("restaurant_id")),
        cut_lineage(validate.valid(c.tagged()["customers"]).select("customer_id")))),
    "quarantine_sinks": _round_trip(round_trips.quarantine, lambda c: c.tagged()["orders"]),
    "staged_orders": _round_trip(round_trips.staged_orders, lambda c: c.staging["orders"]),
    "published_orders": _round_trip(round_trips.published_orders, lambda c: c.star["fact_orders"]),
    "bucketed_join": _round_trip(round_trips.bucketed_join, lambda c: (c.star["fact_orders"], c.star["fact_order_items"])),
    "job_run": q_job_run,
    "test_gate": q_test_gate,
    "profile_guarded": q_profile_guarded,
    "run_log": _round_trip(round_trips.run_log, lambda c: _validation_runs(c)),
    "test_artifact": _round_trip(round_trips.test_artifact, lambda c: dq.run_tests(_written_star(c))),
}
