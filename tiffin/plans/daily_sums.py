"""Mergeable sums of the facts that the KPIs (Q1-Q23) are answered from.

Every load adds the sums of its own rows to tables that grow by batches
(``sources.growing``); a KPI adds up what all batches gave.  A day that comes
late, or rows of a day that was loaded before, are one more batch; a load that
is repeated replaces its own.  All measures are counts and exact sums, so the
order of the batches doesn't matter.

What a KPI reads grows with days times restaurants (or with loads times hours,
partners, minutes, methods), not with orders.  Customers have a row a load and
year of order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.numeric import money_sum
from tiffin.plans.kpi import CANCELLED, DELIVERED
from tiffin.sources import growing

KEY = "year"


@dataclass(frozen=True)
class Sums:
    """A table of sums: the fact that it sums up, what by, and its measures (name, type, aggregate)."""
    fact: str
    by: tuple[tuple[str, str], ...]
    measures: tuple[tuple[str, str, Column], ...]

    @property
    def schema(self) -> str:
        return ", ".join(f"{n} {t}" for n, t in (*self.by, *((n, t) for n, t, _ in self.measures), (KEY, "date")))


def _tables() -> dict[str, Sums]:
    status = F.col("order_status")
    done, cancelled = status == DELIVERED, status == CANCELLED
    total, minutes, rows = F.col("order_total"), F.col("delivery_time_minutes"), F.count(F.lit(1))
    return {
        "order_sums": Sums("fact_orders", (("date_id", "date"), ("restaurant_id", "long")), (
            ("orders", "long", rows), ("delivered", "long", F.count_if(done)), ("cancelled", "long", F.count_if(cancelled)),
            ("valued", "long", F.count_if(done & total.isNotNull())), ("revenue", "decimal(38,2)", money_sum(F.when(done, total))))),
        "hour_sums": Sums("fact_orders", (("hour_id", "int"),), (("orders", "long", rows),)),
        "customer_sums": Sums("fact_orders", (("customer_id", "long"),), (("spend", "decimal(38,2)", money_sum(F.when(done, total))),)),
        "partner_sums": Sums("fact_deliveries", (("delivery_partner_id", "long"),), (
            ("deliveries", "long", rows), ("minutes", "long", F.sum(minutes)), ("timed", "long", F.count(minutes)),
            ("on_time", "long", F.count_if(F.col("delivery_status") == DELIVERED)))),
        "minute_sums": Sums("fact_deliveries", (("delivery_time_minutes", "int"),), (("deliveries", "long", rows),)),
        "method_sums": Sums("fact_payments", (("payment_method", "string"),), (("payments", "long", rows),)),
    }


def _chosen(tables: Iterable[str] | None) -> dict[str, Sums]:
    """All tables, or those named."""
    known = _tables()
    return known if tables is None else {n: known[n] for n in tables}


def fact_of(table: str) -> str:
    """The fact that a table sums up."""
    return _tables()[table].fact


def create(spark: SparkSession, root: str, tables: Iterable[str] | None = None) -> None:
    """Empty tables, where there are none."""
    for name, t in _chosen(tables).items():
        growing.create(spark, f"{root}/{name}", t.schema, KEY)


def add(spark: SparkSession, root: str, batch_id: int, facts: dict[str, DataFrame], loaded: dt.date,
        tables: Iterable[str] | None = None) -> None:
    """Add the sums of a load's rows of some facts; the same load again replaces its sums.

    Sums of orders are kept by the year of the order, those of deliveries and
    payments, which have no date, by that of ``loaded``.
    """
    for name, t in _chosen(tables).items():
        if t.fact in facts:
            day = F.col("date_id") if t.fact == "fact_orders" else F.lit(loaded)
            by = [F.col(n).cast(ty).alias(n) for n, ty in t.by]
            sums = (facts[t.fact].groupBy(*by, F.trunc(day, "year").alias(KEY))
                    .agg(*[a.cast(ty).alias(n) for n, ty, a in t.measures]))
            growing.append(sums, f"{root}/{name}", KEY, batch_id)


def compact(spark: SparkSession, root: str, max_folders: int = 8) -> int:
    """Bring years that are spread over many loads together; returns how many."""
    return sum(growing.compact(spark, f"{root}/{n}", t.schema, KEY, max_folders) for n, t in _tables().items())


def read(spark: SparkSession, root: str, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The tables of sums, for a star that the KPIs read."""
    return {n: growing.read(spark, f"{root}/{n}", t.schema, KEY) for n, t in _chosen(tables).items()}
