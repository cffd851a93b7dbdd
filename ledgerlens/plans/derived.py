"""Materialise the derived tables of the catalogue once.

The case studies store their cleaned and derived tables and read them in
later questions. ``build_derived_tables`` runs those steps as one job DAG and
writes Parquet under ``out_dir``:

- ``clean_weekly_sales`` partitioned by ``calendar_year`` / ``week_number``,
  so the before/after questions read only the weeks they need (partition
  pruning instead of a full scan);
- ``order_items_clean``, ``runs_clean`` (typed, cleaned);
- ``payments`` (the billing schedule);
- ``product_funnel``, ``campaign_summary`` (visit grain, partitioned by visit day).

``open_derived_tables`` reads them back for the question functions.

``DerivedStore`` does the same one table at a time and only when needed: a stored version is
read as long as the base tables that it depends on have the same files; else the table is built
anew and replaces the version in one step, so readers never see a part of it.
"""

from __future__ import annotations

import os
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.fixtures import Fixtures
from ..sources.sinks import write_table
from ..sources.versions import VersionedTable, fingerprint
from . import clickstream as cs
from . import delivery as dl
from . import retail as rt
from . import subscriptions as sb

PARTITIONS = {
    "clean_weekly_sales": ["calendar_year", "week_number"],
    "campaign_summary": ["visit_day"],
}

#: Base tables that each derived table is made of.
DEPENDS = {
    "clean_weekly_sales": ("lineitem", "orders", "customer", "nation", "region"),
    "order_items_clean": ("lineitem", "orders"),
    "runs_clean": ("orders",),
    "payments": ("orders",),
    "product_funnel": ("events",),
    "campaign_summary": ("events",),
}
#: Raised when the rules of a derived table change, so that stored versions of the old ones are
#: not read.
RULES = "1"


def _summary(fx: Fixtures) -> DataFrame:
    summary = cs.campaign_summary(fx.web_events, fx.users, fx.page_hierarchy, fx.event_identifier, fx.campaigns)
    return summary.withColumn("visit_day", F.to_date("visit_start_time"))


MAKERS = {
    "clean_weekly_sales": lambda fx: rt.clean_weekly_sales(fx.weekly_sales_raw),
    "order_items_clean": lambda fx: dl.clean_order_items(fx.order_items_raw),
    "runs_clean": lambda fx: dl.clean_runs(fx.runs_raw),
    "payments": lambda fx: sb.payments(fx.subscriptions, fx.plans),
    "product_funnel": lambda fx: cs.product_funnel(fx.web_events, fx.page_hierarchy, fx.event_identifier),
    "campaign_summary": _summary,
}


def derived_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    fx = Fixtures(spark, sf_dir)
    return {name: make(fx) for name, make in MAKERS.items()}


def build_derived_tables(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    paths = {}
    for name, df in derived_frames(spark, sf_dir).items():
        path = os.path.join(out_dir, name)
        write_table(df, path, mode="overwrite", partition_by=PARTITIONS.get(name))
        paths[name] = path
    return paths


def open_derived_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    tables = {}
    for name in ("clean_weekly_sales", "order_items_clean", "runs_clean", "payments",
                 "product_funnel", "campaign_summary"):
        df = spark.read.parquet(os.path.join(out_dir, name))
        if name == "campaign_summary":
            df = df.drop("visit_day")
        tables[name] = df
    return tables


class DerivedStore:
    """Derived tables of one folder of base tables, kept in versions under the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        name = sha256(self.sf_dir.encode()).hexdigest()[:16]
        self.root = root or f"{shared_folder(spark)}/derived/{name}"
        self.built: list[str] = []

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}", tuple(PARTITIONS.get(name, ())))

    def state(self, name: str) -> str:
        """Fingerprint of the files that ``name`` depends on."""
        return fingerprint(self.spark, [f"{self.sf_dir}/{t}.parquet" for t in DEPENDS[name]], RULES)

    def open(self, name: str) -> DataFrame:
        """The stored version of ``name`` if it is fresh, else a new one."""
        table, state = self.table(name), self.state(name)
        version = table.current()
        if version is None or version.fingerprint != state:
            version = table.replace(MAKERS[name](Fixtures(self.spark, self.sf_dir)), state)
            self.built.append(name)
        return table.read(version)
