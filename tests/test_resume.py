import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.test_pipeline_io import SF, _clean_raw
from tiffin.plans import pipeline
from tiffin.sources import fixtures as fx
from tiffin.sources import io


def stages(spark, root):
    rows = spark.read.parquet(f"{root}/meta/ledger").orderBy("nr").collect()
    return [(r.run_at.day, r.stage) for r in rows], [r.version for r in rows]


def test_a_failure_in_publish_repeats_publish_alone(spark, monkeypatch):
    raw = _clean_raw(fx.loader(spark, SF))
    root = tempfile.mkdtemp(prefix="tiffin-resume-")
    write, calls = io.publish_bucketed, []

    def failing(*a, **k):
        calls.append(a)
        if len(calls) == 3:
            raise RuntimeError("disk")
        return write(*a, **k)
    monkeypatch.setattr(io, "publish_bucketed", failing)
    day = dt.datetime(2024, 2, 1)
    with pytest.raises(RuntimeError, match="disk"):
        pipeline.run(spark, raw, root, day)
    done = ["validate", "stage", "model", "test"]
    assert stages(spark, root)[0] == [(1, s) for s in done]
    for name in ("_validate", "_stage", "_model"):
        monkeypatch.setattr(pipeline, name, lambda *a: 1 / 0)
    res = pipeline.run(spark, raw, root, day)
    assert stages(spark, root)[0] == [(1, s) for s in [*done, "publish"]] and len(set(stages(spark, root)[1])) == 1
    assert (res.tests_total, res.tests_passed) == (34, 34) and res.published["fact_orders"] > 0
    assert {r["entity"] for r in res.report} == set(fx_entities())
    # one health row and one test row for the day
    assert spark.read.parquet(f"{root}/meta/test_runs").count() == 1 == spark.read.parquet(f"{root}/meta/validation_runs").count()
    assert io.current(spark, f"{root}/star_current") == io.current(spark, f"{root}/warehouse_current")
    # a finished run isn't resumed, nor one with other inputs
    with pytest.raises(ZeroDivisionError):
        pipeline.run(spark, raw, root, day)


def fx_entities():
    from tiffin.operators import validate
    return validate.ENTITIES


def test_kpis_agree_with_and_without_the_location_of_an_order(spark):
    from tiffin.plans import kpi
    from tiffin.plans.queries import FIXTURE_TIERS, Ctx
    c = Ctx(spark, SF)
    whole = {k: c.star[k] for k in ("fact_orders", "dim_restaurant", "dim_date", "dim_customer")}
    assert "location_id" in whole["fact_orders"].columns
    for fn, kw in ((kpi.kpi_business, {}), (kpi.revenue_trend, {}), (kpi.value_tiers, {"tiers": FIXTURE_TIERS}), (kpi.orders_by_hour, {})):
        both = [sorted(map(str, fn(star, **kw).collect())) for star in (whole, c.orders_star)]
        assert both[0] == both[1] and both[0]
    assert c.star["fact_orders"].where(F.col("location_id").isNotNull()).count() > 0
