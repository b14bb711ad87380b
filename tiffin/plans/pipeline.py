"""The daily batch job.

validate -> (quarantine + health row) -> gate -> clean -> stage -> model ->
test -> (test-run row, always) -> publish only when every gate passed.

All hand-offs are parquet tables under ``root`` (a shared folder); each
stage reads the previous stage's written tables, so a lost executor costs a
stage retry, never the run, and lineage stays short.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators import dq, model, reviews, transform, validate
from tiffin.operators.joins import lookup_join
from tiffin.operators.ordered import with_position
from tiffin.session import shared_dir
from tiffin.sources import io

VALIDATION_RUNS_SCHEMA = "run_at timestamp_ntz, total_valid long, total_rejected long, rejection_rate double"
TEST_RUNS_SCHEMA = "run_at timestamp_ntz, total_tests long, passed_tests long"
LEDGER_SCHEMA = "nr long, run_at timestamp_ntz, inputs string, stage string, version string, detail string"
#: Stages that a ledger notes, in their order; the last one ends the run.
STAGES = ("land", "validate", "stage", "model", "test", "publish")
REVIEW_RUNS_SCHEMA = "run_at timestamp_ntz, lists long, rejected long"
# Publish key of each model (bucketing key in the warehouse copy).
PUBLISH_KEYS = {
    "dim_location": "location_id", "dim_cuisine": "cuisine_id", "dim_restaurant": "restaurant_id",
    "bridge_restaurant_cuisine": "restaurant_id", "dim_customer": "customer_id",
    "dim_delivery_partner": "delivery_partner_id", "dim_date": "date_id", "dim_time": "hour_id",
    "fact_orders": "order_id", "fact_order_items": "order_id", "fact_payments": "order_id",
    "fact_deliveries": "order_id", "fact_reviews": "restaurant_id",
}


class GateFailed(RuntimeError):
    pass


@dataclass
class RunResult:
    report: list = field(default_factory=list)
    worst_rate: float = 0.0
    overall_rate: float = 0.0
    tests_total: int = 0
    tests_passed: int = 0
    published: dict = field(default_factory=dict)
    malformed: dict = field(default_factory=dict)


class Ledger:
    """Finished stages of a run, appended to ``<root>/meta/ledger`` one row each.

    A run with the same logical time and the same input files as the last one
    in the ledger, which it didn't finish, goes on with that one's version:
    ``once`` then loads what a finished stage has written instead of making it.
    """

    def __init__(self, spark: SparkSession, root: str, run_at: dt.datetime, inputs: str, job: str):
        self.spark, self.path, self.key = spark, f"{root}/meta/{job}", {"run_at": run_at, "inputs": inputs}
        self.done: dict[str, dict] = {}
        rows: list = []
        try:
            rows = spark.read.schema(LEDGER_SCHEMA).parquet(self.path).orderBy(F.desc("nr")).limit(2 * len(STAGES)).collect()
        except AnalysisException:
            pass
        self.nr = rows[0]["nr"] if rows else 0
        self.version = f"{run_at:%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"
        if rows and (rows[0]["run_at"], rows[0]["inputs"]) == (run_at, inputs) and rows[0]["stage"] != STAGES[-1]:
            self.version = rows[0]["version"]
            self.done = {r["stage"]: json.loads(r["detail"]) for r in rows if r["version"] == self.version}

    def once(self, stage: str, make, load):
        """``make()`` returns a result and what ``load`` needs to get it back; a stage that raises isn't finished."""
        if stage in self.done:
            return load(self.done[stage])
        result, detail = make()
        self.nr += 1
        io.append_row(self.spark, self.path, {"nr": self.nr, **self.key, "stage": stage, "version": self.version,
                                              "detail": json.dumps(detail)}, LEDGER_SCHEMA)
        return result


def _fingerprint(names: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def run_files(spark: SparkSession, directory: str, root: str | None, run_at: dt.datetime, **options) -> RunResult:
    """J1 from the raw files ``raw_<entity>.csv`` of a folder.

    Files are read by their own headers and landed as parquet.  Records that
    don't fit their header go to ``malformed/<entity>`` with file and record
    number, and are counted in the result; they are no part of the rates of
    the gate.  Restaurants get their position in the file (from 0) as their
    id, which orders refer to.  After a failure, the same call with unchanged
    files goes on after the last finished stage.
    """
    root = (root or shared_dir(spark, "tiffin-run")).rstrip("/")
    directory = directory.rstrip("/")
    files = spark.read.format("binaryFile").load([f"{directory}/raw_{e}.csv" for e in validate.ENTITIES]).select(
        F.concat_ws(" ", "path", F.unix_micros("modificationTime"), "length")).collect()
    ledger = Ledger(spark, root, run_at, _fingerprint([f[0] for f in files]), "landing_ledger")
    path = f"{root}/landed/{ledger.version}"

    def land():
        raw, malformed = {}, {}
        for entity in validate.ENTITIES:
            raw[entity], bad, malformed[entity] = io.land_csv(
                spark, f"{directory}/raw_{entity}.csv", io.RAW_COLUMNS[entity], f"{path}/scanned/{entity}")
            io.write_table(bad, f"{root}/malformed/{entity}")
        raw["restaurants"] = with_position(raw["restaurants"], ["seq"], "restaurant_id").withColumn(
            "restaurant_id", F.col("restaurant_id") - 1)
        raw["orders"] = raw["orders"].withColumn("restaurant_id", F.col("restaurant_id").try_cast("long"))
        for entity in ("restaurants", "orders"):
            raw[entity] = io.land(raw[entity], f"{path}/{entity}")
        return (raw, malformed), {"malformed": malformed}

    def load(detail: dict):
        raw = {e: spark.read.parquet(f"{path}/scanned/{e}").where("fits").drop("fits", io.MALFORMED, io.RAW) for e in validate.ENTITIES}
        return raw | {e: spark.read.parquet(f"{path}/{e}") for e in ("restaurants", "orders")}, detail["malformed"]
    raw, malformed = ledger.once("land", land, load)
    res = run(spark, raw, root, run_at, **options)
    ledger.once(STAGES[-1], lambda: (None, {}), lambda _: None)
    res.malformed = malformed
    return res


def run(spark: SparkSession, raw: dict[str, DataFrame], root: str | None, run_at: dt.datetime,
        threshold: float = validate.REJECTION_RATE_THRESHOLD, publish_buckets: int | None = None,
        reviews_raw: DataFrame | None = None) -> RunResult:
    """One daily run parameterised by its logical time ``run_at``.

    ``raw`` holds the six raw entity frames (with a ``seq`` order column).
    Review lists are those of valid restaurants: their ``reviews_list`` column,
    or the frame ``reviews_raw``.  Raises ``GateFailed`` when the rejection
    gate (V14) or the data tests (D6) fail.  Quarantine and health rows are
    written before that; the test-run row is written whatever happens (J2),
    with no tests if the run did not come so far.

    Every stage is noted in a ledger when it is finished.  After a failure, a
    call with the same ``run_at`` and the same input files goes on after the
    last finished stage, unless another run came between.
    """
    root = (root or shared_dir(spark, "tiffin-run")).rstrip("/")
    sources = [f for df in [*raw.values(), *([reviews_raw] if reviews_raw is not None else [])] for f in df.inputFiles()]
    ledger = Ledger(spark, root, run_at, _fingerprint(sources), "ledger")
    version, res = ledger.version, RunResult()

    def tables(path: str):
        return lambda names: {n: spark.read.parquet(f"{path}/{n}") for n in names}

    def validated():
        valid = _validate(spark, raw, root, run_at, threshold, res)
        return valid, {"report": res.report, "worst_rate": res.worst_rate, "overall_rate": res.overall_rate}

    def known(detail: dict):
        res.report, res.worst_rate, res.overall_rate = detail["report"], detail["worst_rate"], detail["overall_rate"]
        return {r["entity"]: io.valid_side(spark, f"{root}/validated/{r['entity']}") for r in res.report}

    def named(frames: dict[str, DataFrame]):
        return frames, list(frames)

    def tested():
        results = dq.run_tests(star)
        results.write.mode("overwrite").parquet(f"{root}/meta/test_results")
        s = dq.gate(spark.read.schema(results.schema).parquet(f"{root}/meta/test_results")).first()
        res.tests_total, res.tests_passed = int(s["total_tests"]), int(s["passed_tests"])
        if s["gate_failed"]:
            raise GateFailed(f"{res.tests_total - res.tests_passed} data tests failed")
        return None, [res.tests_total, res.tests_passed]

    def passed(detail: list):
        res.tests_total, res.tests_passed = detail

    def published():
        _publish(spark, star, root, version, publish_buckets, res)
        return None, {}
    try:
        valid = ledger.once("validate", validated, known)
        staged = ledger.once("stage", lambda: named(_stage(spark, valid, reviews_raw, root, version, run_at)), tables(f"{root}/staging/{version}"))
        star = ledger.once("model", lambda: named(_model(spark, staged, root, version)), tables(f"{root}/star/{version}"))
        ledger.once("test", tested, passed)
    finally:
        if "test" not in ledger.done:
            io.append_row(spark, f"{root}/meta/test_runs",
                          {"run_at": run_at, "total_tests": res.tests_total, "passed_tests": res.tests_passed},
                          TEST_RUNS_SCHEMA)
    ledger.once("publish", published, lambda _: None)
    return res


def _validate(spark: SparkSession, raw: dict[str, DataFrame], root: str, run_at: dt.datetime, threshold: float,
              res: RunResult) -> dict[str, DataFrame]:
    """Validation cascade, quarantine, health row and gate; the valid tables, each written once."""
    counts, valid = [], {}

    def split(name: str, tagged: DataFrame) -> DataFrame:
        valid[name], _, good, bad = io.write_split(tagged, f"{root}/validated/{name}")
        counts.append((name, good, bad, good + bad, bad / (good + bad) if good + bad else 0.0))
        return valid[name]

    r = split("restaurants", validate.validate_restaurants(raw["restaurants"]))
    c = split("customers", validate.validate_customers(raw["customers"]))
    o = split("orders", validate.validate_orders(raw["orders"], r, c)).select("order_id")
    split("order_items", validate.validate_order_items(raw["order_items"], o))
    split("payments", validate.validate_payments(raw["payments"], o))
    split("deliveries", validate.validate_deliveries(raw["deliveries"], o))
    report = spark.createDataFrame(counts, "entity string, valid long, rejected long, total long, rejection_rate double")
    summary = validate.rejection_summary(report, threshold).first()
    res.report = [row.asDict() for row in report.collect()]  # six rows
    res.worst_rate, res.overall_rate = summary["worst_rate"], summary["overall_rate"]
    io.append_row(spark, f"{root}/meta/validation_runs",
                  {"run_at": run_at, "total_valid": summary["total_valid"],
                   "total_rejected": summary["total_rejected"], "rejection_rate": summary["overall_rate"]},
                  VALIDATION_RUNS_SCHEMA)
    if summary["gate_failed"]:
        raise GateFailed(f"rejection rate {summary['worst_rate']:.2%} exceeds {threshold:.0%}")
    return valid


def _stage(spark: SparkSession, valid: dict[str, DataFrame], reviews_raw: DataFrame | None, root: str, version: str,
           run_at: dt.datetime) -> dict[str, DataFrame]:
    """Clean and stage all tables under one version; the pointer moves when the last is written."""
    staging = {
        "restaurants": transform.clean_restaurants(valid["restaurants"]),
        "restaurant_cuisines": transform.restaurant_cuisines(valid["restaurants"]),
        "customers": transform.clean_customers(valid["customers"], valid["orders"]),
        "orders": transform.clean_orders(valid["orders"]),
        "order_items": transform.clean_order_items(valid["order_items"]),
        "payments": transform.clean_payments(valid["payments"]),
        "deliveries": transform.clean_deliveries(valid["deliveries"]),
    }
    if reviews_raw is None and "reviews_list" in valid["restaurants"].columns:
        reviews_raw = valid["restaurants"]
    if reviews_raw is not None:
        own = lookup_join(reviews_raw, valid["restaurants"].select("restaurant_id"), ["restaurant_id"], "left_semi")
        parsed = io.land(reviews.with_parsed(own), f"{root}/parsed/reviews")  # lists are parsed once
        staging["reviews"] = reviews.parsed_reviews(parsed)
        rejected = io.land(reviews.rejected_reviews(parsed), f"{root}/rejected/reviews")
        # a seventh entity of the log, outside the gate
        io.append_row(spark, f"{root}/meta/review_runs", {
            "run_at": run_at, "lists": parsed.count(), "rejected": rejected.count()}, REVIEW_RUNS_SCHEMA)
    path = f"{root}/staging/{version}"
    for name, df in staging.items():
        io.write_table(df, f"{path}/{name}")
    io.point_to(spark, f"{root}/staging_current", version)
    return {n: spark.read.schema(df.schema).parquet(f"{path}/{n}") for n, df in staging.items()}


def _model(spark: SparkSession, staged: dict[str, DataFrame], root: str, version: str) -> dict[str, DataFrame]:
    """All models under one version, each written once and read back; the pointer moves when the last is written."""
    path, star = f"{root}/star/{version}", {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        io.write_table(df, f"{path}/{name}")
        star[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        return star[name]
    have = dict(staged)
    for name in model.SHARED_DIMS:
        have[name] = keep(name, model.shared_dim(name, have))
    for name, df in model.build_star(have, spark).items():
        if name not in star:
            keep(name, df)
    io.point_to(spark, f"{root}/star_current", version)
    return star


def _publish(spark: SparkSession, star: dict[str, DataFrame], root: str, version: str, buckets: int | None,
             res: RunResult) -> None:
    """Bucketed copies under one version; names that users read move to it after the last is written."""
    for name, df in star.items():
        res.published[name] = io.publish_bucketed(df, f"wh_{name}_{version}", PUBLISH_KEYS[name],
                                                  f"{root}/warehouse/{version}/{name}", buckets)
    for name in star:
        spark.sql(f"CREATE OR REPLACE VIEW wh_{name} AS SELECT * FROM wh_{name}_{version}")
    io.point_to(spark, f"{root}/warehouse_current", version)
