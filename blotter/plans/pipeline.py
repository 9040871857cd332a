"""Batch composition of the layers: bronze -> silver -> dimensions -> fact.

``run_batch`` writes every layer as a Parquet table in dependency order
(dimensions before the fact) and returns frames that read those tables back,
so each later step reads only the columns it needs. ``build_layers`` composes
the same layers lazily, without a table.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import dims as D
from ..operators.fact import fact_incidents, star_view
from ..operators.quality import quarantine
from ..operators.silver import silver as silver_op
from ..sources.csv import with_ingest_audit
from ..sources.fixture import incidents
from ..sources.tables import Layout, materialize, read_table


@dataclass
class Layers:
    bronze: DataFrame
    silver: DataFrame
    dims: dict[str, DataFrame]
    fact: DataFrame
    # Quality-gate metrics observed while silver was written (run_batch).
    quality: dict | None = None
    # Rows of the written dimensions.
    sizes: dict[str, int] = field(default_factory=dict)

    def star(self, roles=None, cfg: C.Config = C.DEFAULT) -> DataFrame:
        return star_view(self.fact, self.dims, roles, cfg, self.sizes)


def bronze_from_fixture(spark: SparkSession, sf_dir: str, ts: Column | None = None) -> DataFrame:
    """Bronze over the derived ``incidents`` source (no files: the source
    label is the view name)."""
    return with_ingest_audit(incidents(spark, sf_dir), ts=ts, source="incidents")


def build_layers(spark: SparkSession, bronze: DataFrame, cfg: C.Config = C.DEFAULT,
                 ts: Column | None = None) -> Layers:
    silver = silver_op(bronze, cfg, ts)
    dims = D.build_dims(spark, silver, cfg, ts)
    return Layers(bronze, silver, dims, fact_incidents(silver, dims, cfg, ts))


def read_layers(spark: SparkSession, layout: Layout) -> Layers:
    """The tables that ``run_batch`` wrote, with the dimensions' row counts
    (from the files' footers)."""
    dims = {name: read_table(spark, layout.path(name)) for name in ("dim_date", "dim_time", *D.DATA_DIMS)}
    return Layers(read_table(spark, layout.path(C.BRONZE)), read_table(spark, layout.path(C.SILVER)), dims,
                  read_table(spark, layout.path(C.FACT)), sizes={k: v.count() for k, v in dims.items()})


def run_batch(spark: SparkSession, layout: Layout, bronze: DataFrame, cfg: C.Config = C.DEFAULT,
              ts: Column | None = None, timings: dict | None = None,
              fact_by_month: bool = False) -> Layers:
    """Materialize bronze, silver, the quarantined rows, the eight dimensions
    and the fact. Every row of bronze is in silver or in quarantine.

    ``fact_by_month`` writes the fact partitioned by ``month_occurred``
    (yyyymm; the fact's columns stay), clustered first so that each month has
    few files and date filters prune whole directories.
    """
    def step(name, fn):
        t0 = time.perf_counter()
        out = fn()
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 3)
        return out

    step("bronze", lambda: materialize(bronze, layout.path(C.BRONZE)))
    b = read_table(spark, layout.path(C.BRONZE))
    gate = Observation("silver_expectations")
    step("silver", lambda: materialize(silver_op(b, cfg, ts, observe_name=gate), layout.path(C.SILVER)))
    step("quarantine", lambda: materialize(quarantine(b, cfg.rules), layout.path(C.QUARANTINE)))
    s = read_table(spark, layout.path(C.SILVER))
    # One pruned aggregation of silver per dimension: the dimensions read
    # disjoint columns, so separate scans decode nothing twice and no row is
    # expanded per dimension (fused=True trades that for fewer jobs, which
    # only pays off on small inputs).
    built = D.build_dims(spark, s, cfg, ts)
    for name, df in built.items():
        step(name, lambda df=df, name=name: materialize(df, layout.path(name)))
    dims = {name: read_table(spark, layout.path(name)) for name in built}
    sizes = {name: df.count() for name, df in dims.items()}
    fact = fact_incidents(s, dims, cfg, ts, sizes)
    if fact_by_month:
        # The date key is yyyymmdd.
        fact = fact.withColumn("month_occurred", F.floor(F.col("date_occurred_key") / 100).cast("int"))
        fact = fact.hint("rebalance", "month_occurred")
    step("fact", lambda: materialize(fact, layout.path(C.FACT), ["month_occurred"] if fact_by_month else None))
    return Layers(b, s, dims, read_table(spark, layout.path(C.FACT)), quality=dict(gate.get), sizes=sizes)
