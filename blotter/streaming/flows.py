"""Incremental pipeline on Structured Streaming.

Flows run in dependency order, each as an ``availableNow`` query that
processes whatever is new since its checkpoint and stops:

1. bronze  - CSV directory -> Parquet (file source remembers seen files)
2. silver  - bronze stream -> quality gate (+ observed metrics) -> enrich
3. dims    - date/time are batch tables; each data dimension inserts the
             members it has not seen yet (micro-batch pre-aggregated, then
             anti-joined with the table; or, opt-in, streaming
             ``dropDuplicates`` on the natural key)
4. fact    - silver stream joined to static snapshots of the dimensions
             (stream-static left joins, broadcast after a size check)

The dimensions finish before the fact starts, so a fact row never misses a
member that exists in the same run. Every sink is a Parquet file sink with
its own checkpoint, so output is exactly-once across restarts and executor
loss.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from .. import config as C
from ..operators import dims as D
from ..operators.fact import fact_incidents
from ..operators.quality import quarantine
from ..operators.silver import silver as silver_op
from ..sources.csv import CORRUPT, stream_incidents_csv, with_corrupt, with_ingest_audit
from ..sources.schema import INCIDENT_SCHEMA
from ..sources.tables import Layout, append_flow, materialize, read_table, stream_table, table_exists

BRONZE, SILVER, FACT, QUARANTINE = C.BRONZE, C.SILVER, C.FACT, C.QUARANTINE
SILVER_METRICS = "silver_expectations"


@dataclass
class RunReport:
    rows: dict[str, int] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], _nullable(schema))


def bronze_schema(spark: SparkSession, schema: T.StructType = INCIDENT_SCHEMA) -> T.StructType:
    return _nullable(with_ingest_audit(_empty(spark, with_corrupt(schema, CORRUPT)), source="").schema)


def silver_schema(spark: SparkSession, cfg: C.Config = C.DEFAULT,
                  schema: T.StructType = INCIDENT_SCHEMA) -> T.StructType:
    return _nullable(silver_op(_empty(spark, bronze_schema(spark, schema)), cfg).drop(CORRUPT).schema)


class _ProgressTotals(StreamingQueryListener):
    """Sums input rows and observed gate metrics of every micro-batch, per
    query id (``recentProgress`` only keeps the last few batches)."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.metrics: dict[str, dict[str, int]] = {}
        self._done: dict[str, threading.Event] = {}

    def done(self, qid: str) -> threading.Event:
        return self._done.setdefault(qid, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        qid = str(p.id)
        self.rows[qid] = self.rows.get(qid, 0) + int(p.numInputRows or 0)
        row = (p.observedMetrics or {}).get(SILVER_METRICS)
        if row is not None:
            acc = self.metrics.setdefault(qid, {})
            for k, v in row.asDict().items():
                acc[k] = acc.get(k, 0) + int(v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # Delivered after every progress event of the query.
        self.done(str(event.id)).set()


def _await(q, report: RunReport, name: str, totals: _ProgressTotals) -> None:
    q.awaitTermination()
    qid = str(q.id)
    # The termination event comes after every progress event; without it the
    # totals could be short, which must not pass unnoticed.
    if not totals.done(qid).wait(timeout=300):
        raise RuntimeError(f"{name}: no termination event, so its row counts may be incomplete")
    rows, metrics = totals.rows.get(qid, 0), totals.metrics.get(qid, {})
    for k, v in metrics.items():
        report.quality[k] = report.quality.get(k, 0) + v
    report.rows[name] = report.rows.get(name, 0) + rows


def bronze_flow(spark: SparkSession, layout: Layout, source_dir: str,
                schema: T.StructType = INCIDENT_SCHEMA, max_files_per_trigger: int | None = None):
    """X1 + S4 + S9 + K1: ingest new CSV files into the bronze table; the text
    of a malformed line is kept in ``corrupt_record``."""
    raw = stream_incidents_csv(spark, source_dir, schema, CORRUPT, max_files_per_trigger)
    return append_flow(with_ingest_audit(raw), layout.path(BRONZE), layout.checkpoint("bronze"),
                       name="bronze_ingest")


def silver_flow(spark: SparkSession, layout: Layout, cfg: C.Config = C.DEFAULT,
                schema: T.StructType = INCIDENT_SCHEMA):
    """X2 + X6: gate and enrich new bronze rows; rule failures are observed."""
    bronze = stream_table(spark, layout.path(BRONZE), bronze_schema(spark, schema))
    out = silver_op(bronze, cfg, observe_name=SILVER_METRICS).drop(CORRUPT)
    return append_flow(out, layout.path(SILVER), layout.checkpoint("silver"), name="silver_transform")


def quarantine_flow(spark: SparkSession, layout: Layout, cfg: C.Config = C.DEFAULT,
                    schema: T.StructType = INCIDENT_SCHEMA):
    """Q3: the bronze rows that the gate drops, with the rules they fail and the
    text of malformed lines. Every bronze row is in silver or here."""
    bronze = stream_table(spark, layout.path(BRONZE), bronze_schema(spark, schema))
    return append_flow(quarantine(bronze, cfg.rules), layout.path(QUARANTINE), layout.checkpoint("quarantine"),
                       name="silver_quarantine")


def _merge_new_members(name: str, fn, path: str, cfg: C.Config):
    """foreachBatch body: insert the micro-batch's dimension members that the
    table does not hold yet.

    The micro-batch is deduplicated as a batch aggregate (partial aggregation
    per task, so a key holding most rows is collapsed before any shuffle),
    then anti-joined (NULL-safe) with the existing members. Re-running a batch after a failure
    finds its members already present, so the insert is idempotent.
    """
    key, natural = D.NATURAL_KEYS[name]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        members = fn(batch, cfg)
        if table_exists(spark, path):
            existing = read_table(spark, path).select(*natural)
            cond = None
            for c in natural:
                e = F.col(f"m.{c}").eqNullSafe(F.col(f"e.{c}"))
                cond = e if cond is None else cond & e
            members = members.alias("m").join(existing.alias("e"), cond, "left_anti")
        members.write.mode("append").parquet(path)
    return run


def dimension_flows(spark: SparkSession, layout: Layout, cfg: C.Config = C.DEFAULT,
                    schema: T.StructType = INCIDENT_SCHEMA, stateful: bool = False) -> list:
    """One insert-only flow per data dimension; D1/D2 are batch tables.

    Default: ``foreachBatch`` merge of new members (skew-proof, see
    ``_merge_new_members``). ``stateful=True``: streaming ``dropDuplicates``
    on the natural key with a Parquet file sink (first row seen wins; state
    holds one entry per member, but every row of a micro-batch is shuffled
    by key first).
    """
    for name, build in (("dim_date", lambda: D.dim_date(spark, cfg)), ("dim_time", lambda: D.dim_time(spark, cfg))):
        if not table_exists(spark, layout.path(name)):
            materialize(build(), layout.path(name))
    queries = []
    sschema = silver_schema(spark, cfg, schema)
    for name, fn in D.DATA_DIMS.items():
        # A micro-batch is handed over whole: only the dimension's columns are read into it.
        keys, payload = D.DIM_COLUMNS[name]
        s = stream_table(spark, layout.path(SILVER), sschema).select(*keys, *payload)
        if stateful:
            q = append_flow(fn(s, cfg), layout.path(name), layout.checkpoint(name), name=name)
        else:
            q = (s.writeStream.queryName(name)
                 .option("checkpointLocation", layout.checkpoint(f"{name}_merge"))
                 .foreachBatch(_merge_new_members(name, fn, layout.path(name), cfg))
                 .trigger(availableNow=True).start())
        queries.append((name, q))
    return queries


def fact_flow(spark: SparkSession, layout: Layout, cfg: C.Config = C.DEFAULT,
              schema: T.StructType = INCIDENT_SCHEMA):
    """New silver rows joined with static snapshots of the dimensions."""
    s = stream_table(spark, layout.path(SILVER), silver_schema(spark, cfg, schema))
    dims = {name: read_table(spark, layout.path(name))
            for name in ["dim_date", "dim_time", *D.DATA_DIMS]}
    sizes = {name: dim.count() for name, dim in dims.items()}
    return append_flow(fact_incidents(s, dims, cfg, sizes=sizes), layout.path(FACT), layout.checkpoint("fact"), name="fact")


def run_flows(spark: SparkSession, layout: Layout, source_dir: str, cfg: C.Config = C.DEFAULT,
              schema: T.StructType = INCIDENT_SCHEMA, stateful_dims: bool = False) -> RunReport:
    """Run all flows once, in dependency order, on what is new."""
    report = RunReport()
    totals = _ProgressTotals()
    spark.streams.addListener(totals)
    try:
        _await(bronze_flow(spark, layout, source_dir, schema), report, BRONZE, totals)
        _await(silver_flow(spark, layout, cfg, schema), report, SILVER, totals)
        _await(quarantine_flow(spark, layout, cfg, schema), report, QUARANTINE, totals)
        for name, q in dimension_flows(spark, layout, cfg, schema, stateful=stateful_dims):
            _await(q, report, name, totals)
        _await(fact_flow(spark, layout, cfg, schema), report, FACT, totals)
    finally:
        spark.streams.removeListener(totals)
    return report
