"""Dev tool: run the pipeline once and print the physical plans of KPI
queries over the *written* star tables (what production queries see)."""

import datetime as dt
import sys
import tempfile

sys.path.insert(0, "/root/repo")

from pyspark.sql import functions as F  # noqa: E402

from tiffin.plans import kpi, pipeline  # noqa: E402
from tiffin.session import get_session  # noqa: E402
from tiffin.sources import fixtures as fx, io  # noqa: E402


def main(sf_dir: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=8)
    t = fx.loader(spark, sf_dir)
    raw = {"restaurants": fx.restaurants(t), "customers": fx.customers(t), "orders": fx.orders(t),
           "order_items": fx.order_items(t).withColumn("seq", F.lit(0)), "payments": fx.payments(t),
           "deliveries": fx.deliveries(t)}
    root = tempfile.mkdtemp(prefix="tiffin-explain-")
    pipeline.run(spark, raw, root, dt.datetime(2024, 1, 1), reviews_raw=fx.reviews_raw(t))
    star = {n: spark.read.parquet(f"{root}/star/{io.current(spark, f'{root}/star_current')}/{n}") for n in pipeline.PUBLISH_KEYS}
    for name, df in [("revenue_trend", kpi.revenue_trend(star)), ("top_cuisines", kpi.top_cuisines(star)),
                     ("value_tiers", kpi.value_tiers(star))]:
        print(f"==== {name}")
        df.explain()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
