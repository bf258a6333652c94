"""The daily ELT run as one object: raw tabs -> staging -> analytics -> marts.

``TradingModel`` builds every model lazily from the three raw tabs; each
property is one DataFrame, built once.  ``run`` materialises the marts: the
allocated lines are written first (four marts read them), then each mart is
computed from the written table, so a lost executor only recomputes from the
last written table and not from the raw scans.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.operators import skew
from ledgerflow.plans import analytics, marts, rollups, staging, store
from ledgerflow.sources import fixtures


class TradingModel:
    def __init__(self, tabs: dict[str, DataFrame], run_date: _dt.date = config.RUN_DATE,
                 spark: SparkSession | None = None, stage_key: str | None = None):
        self.tabs = tabs
        self.run_date = run_date
        self.spark = spark
        self.stage_key = stage_key

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, run_date: _dt.date = config.RUN_DATE) -> "TradingModel":
        return cls(fixtures.raw_tabs(spark, sf_dir), run_date)

    @classmethod
    def staged(cls, spark: SparkSession, sf_dir: str, run_date: _dt.date = config.RUN_DATE) -> "TradingModel":
        """Model whose ingest (raw tabs) and mart base (allocated lines) are written once per session.

        The ingested log keeps the sheet row number (``source_row_number``) next to
        the contract columns; staging selects columns by name and ignores it.
        """
        # one after the other: each shuffles all lines, and the files of one are gone before the next
        tabs = {name: store.stage(spark, f"raw|{sf_dir}|{name}", lambda: fixtures.raw_tabs(spark, sf_dir, True)[name])  # noqa: B023 - runs at once
                for name in ("transaction_log", "vendor_rates", "customer_rates")}
        return cls(tabs, run_date, spark, f"{sf_dir}|{run_date.isoformat()}")

    # staging
    @cached_property
    def stg_log(self) -> DataFrame:
        return staging.stg_transaction_log(self.tabs["transaction_log"], self.run_date)

    @cached_property
    def stg_vendor_rates(self) -> DataFrame:
        return staging.stg_vendor_rates(self.tabs["vendor_rates"])

    @cached_property
    def stg_customer_rates(self) -> DataFrame:
        return staging.stg_customer_rates(self.tabs["customer_rates"])

    # intermediate
    @cached_property
    def vendor_rate_history(self) -> DataFrame:
        return analytics.rate_history(self.stg_vendor_rates, "vendor_name")

    @cached_property
    def customer_rate_history(self) -> DataFrame:
        return analytics.rate_history(self.stg_customer_rates, "customer_name")

    # analytics
    @cached_property
    def items(self) -> DataFrame:
        return analytics.transaction_items(self.stg_log)

    @cached_property
    def payments(self) -> DataFrame:
        return analytics.transaction_payment(self.stg_log)

    @cached_property
    def rates(self) -> DataFrame:
        return analytics.unified_rates(self.stg_vendor_rates, self.stg_customer_rates)

    @cached_property
    def chosen_rates(self) -> DataFrame:
        """Rate per (transaction key, product); written once per run when staged (the as-of join runs once)."""
        if self.stage_key is None:
            return analytics.choose_rates(self.items, self.rates)
        return store.stage(self.spark, f"chosen|{self.stage_key}",
                           lambda: analytics.choose_rates(self.items, self.rates))

    @cached_property
    def heavy_keys(self) -> list[str]:
        """Transaction keys shared by more forms than one task should hold (forms that cannot be read share one)."""
        return skew.heavy_keys(analytics.with_transaction_key(self.stg_log), "transaction_key")

    @cached_property
    def enriched(self) -> DataFrame:
        return marts.enriched_lines(self._allocated_forms)

    # marts
    @cached_property
    def _allocated_forms(self) -> DataFrame:
        """Allocated lines, written once per run when staged; ``first`` marks one row of each line."""
        build = lambda stage=None: marts.allocated_forms(self.stg_log, self.items, self.payments, self.rates, self.heavy_keys, stage)
        if self.stage_key is None:
            return build()
        with store.passing(self.spark, f"allocated|{self.stage_key}") as passing:
            return store.stage(self.spark, f"allocated|{self.stage_key}", lambda: build(passing))

    @cached_property
    def allocated(self) -> DataFrame:
        return self._allocated_forms.drop("first")

    @cached_property
    def mart_transactions(self) -> DataFrame:
        return marts.mart_transactions(self.allocated)

    def rollup(self, *dimensions: str) -> DataFrame:
        """The smallest roll-up state with the dimensions."""
        return self._rollup(rollups.level_for(dimensions))

    def _rollup(self, level: str) -> DataFrame:
        """Straight from the lines: the state with all dimensions is about as long as they are, so a way through it would shuffle and write them once more."""
        build = lambda: rollups.state_of(self.allocated, level)
        if self.stage_key is None:
            return build()
        return store.stage(self.spark, f"rollup-{level}|{self.stage_key}", lambda: rollups.by_month(build()), ["month_start"])

    @cached_property
    def transaction_keys(self) -> DataFrame:
        if self.stage_key is None:
            return rollups.key_state(self.allocated)
        return store.stage(self.spark, f"rollup-keys|{self.stage_key}", lambda: rollups.by_month(rollups.key_state(self.allocated)), ["month_start"])

    @cached_property
    def weighted_lines(self) -> DataFrame:
        """Lines with their sums weighed by copies, for measures that no state answers."""
        return self.allocated.select([(F.col(c) * F.col("copies")).alias(c) if c in rollups.SUMS else F.col(c) for c in marts.MART_TRANSACTIONS_COLUMNS])

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return marts.daily_metrics(self.allocated)

    def _intervals(self, name: str, build) -> DataFrame:
        if self.stage_key is None:
            return build(self.allocated)
        return store.stage(self.spark, f"{name}|{self.stage_key}", lambda: build(self.allocated))

    @cached_property
    def vendor_intervals(self) -> DataFrame:
        """Balances as intervals; written once per run when staged."""
        return self._intervals("vendor-intervals", marts.vendor_intervals)

    @cached_property
    def customer_intervals(self) -> DataFrame:
        return self._intervals("customer-intervals", marts.customer_intervals)

    @cached_property
    def vendor_summary(self) -> DataFrame:
        return marts.vendor_summary(self.vendor_intervals)

    @cached_property
    def customer_summary(self) -> DataFrame:
        return marts.customer_summary(self.customer_intervals)

    @cached_property
    def product_summary(self) -> DataFrame:
        return marts.product_summary(self.allocated)


def run(spark: SparkSession, model: TradingModel, out_root: str) -> dict[str, str]:
    """Materialise the marts under ``out_root`` (a shared path on a cluster); returns name -> path.

    Tables are rebuilt in full (overwrite), like the reference's nightly run.
    Date-filtered marts are partitioned by month so range queries prune files.
    """
    paths: dict[str, str] = {}
    alloc_path = f"{out_root}/marts/allocated_lines"
    rollups.by_month(model.allocated).write.mode("overwrite").partitionBy("month_start").parquet(alloc_path)
    allocated = spark.read.schema(model.allocated.schema).parquet(alloc_path)  # a partitioned table may be empty
    paths["allocated_lines"] = alloc_path
    intervals = {}
    for name, build in (("vendor_balance_intervals", marts.vendor_intervals), ("customer_balance_intervals", marts.customer_intervals)):
        paths[name] = f"{out_root}/marts/{name}"
        build(allocated).write.mode("overwrite").parquet(paths[name])
        intervals[name] = spark.read.parquet(paths[name])
    full_path = f"{out_root}/rollups/full"
    state = rollups.full_state(allocated)
    rollups.by_month(state).write.mode("overwrite").partitionBy("month_start").parquet(full_path)
    paths["rollup_full"] = full_path
    full = spark.read.schema(state.schema).parquet(full_path)
    outputs = {
        "mart_transactions": (marts.mart_transactions(allocated), "month_start"),
        "mart_daily_metrics": (marts.daily_metrics(allocated), None),
        "mart_vendor_summary": (marts.vendor_summary(intervals["vendor_balance_intervals"]), None),
        "mart_customer_summary": (marts.customer_summary(intervals["customer_balance_intervals"]), None),
        "mart_product_summary": (marts.product_summary(allocated), None),
        "rollup_keys": (rollups.key_state(allocated), "month_start"),
        **{f"rollup_{level}": (rollups.roll_up(full, level), "month_start") for level in rollups.LEVELS if level != "full"},
    }

    def write(name, df, part):
        w = df.write.mode("overwrite")
        if part:
            w = rollups.by_month(df).write.mode("overwrite").partitionBy(part)
        path = f"{out_root}/{'rollups' if name.startswith('rollup_') else 'marts'}/{name.removeprefix('rollup_')}"
        w.parquet(path)
        return name, path

    # The marts and states only read written tables: independent jobs, run concurrently.
    paths.update(store.in_parallel([lambda n=n, d=d, p=p: write(n, d, p) for n, (d, p) in outputs.items()]))
    return paths
