"""Benchmark: the whole pipeline plus every report, at one scale factor.

Steps (each timed): bronze ingest of the incidents source, silver, the eight
dimensions, the fact, then every profiling report over bronze (three
passes, ``profile_all``) and every dashboard mart over the star
(``marts_all``). Layers are written as Parquet tables into a
fresh scratch folder (the session's checkpoint folder on a cluster).

Prints one JSON line:
{"metric": "pipeline_sec", "value": total, "unit": "sec", "queries": {...}, "sf": ...}

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from blotter import config as C  # noqa: E402
from blotter.operators import marts as M  # noqa: E402
from blotter.operators import profile as R  # noqa: E402
from blotter.plans.execution import build_session, checkpoint_dir  # noqa: E402
from blotter.plans.pipeline import bronze_from_fixture, run_batch  # noqa: E402
from blotter.sources.tables import Layout  # noqa: E402

CFG = C.Config(as_of="2026-01-01")


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(f"local[{cpus}]", app="blotter-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    base = checkpoint_dir(spark)
    base = f"{base.rstrip('/')}/bench" if base else tempfile.mkdtemp(prefix="blotter-bench-", dir="/tmp")
    layout = Layout(base)

    # Warm the JVM (class loading, Parquet writer/reader, codegen) outside
    # the timings with a 1,000-row round trip that shares no data with the run.
    warm = f"{base.rstrip('/')}/_warmup"
    spark.range(1000).selectExpr("id", "cast(id as string) AS s").write.mode("overwrite").parquet(warm)
    spark.read.parquet(warm).groupBy("s").count().collect()

    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    layers = run_batch(spark, layout, bronze_from_fixture(spark, sf_dir), CFG, timings=timings)
    dims_total = sum(v for k, v in timings.items() if k.startswith("dim_"))
    queries: dict[str, float] = {
        "bronze": timings["bronze"], "silver": timings["silver"],
        "dims": round(dims_total, 3), "fact": timings["fact"],
    }
    queries.update({k: v for k, v in timings.items() if k.startswith("dim_")})

    # Profiling: every report of R1-R28 from three passes over bronze.
    raw = layers.bronze.drop("ingestion_datetime", "source_filename", "created_by")
    t_prof = time.perf_counter()
    reports = R.profile_all(raw, CFG)
    for name, rep in reports.items():
        queries[f"profile.{name}"] = _timed(lambda rep=rep: rep.collect())
    queries["profile_all"] = round(time.perf_counter() - t_prof, 3)
    reports.release()

    # Dashboards: the 18 marts, each over the star roles it needs.
    t_marts = time.perf_counter()
    for name, mart in M.marts_all(lambda roles: layers.star(roles, CFG), CFG).items():
        queries[f"mart.{name}"] = _timed(lambda mart=mart: mart.collect())
    queries["marts_all"] = round(time.perf_counter() - t_marts, 3)
    total = round(time.perf_counter() - t0, 3)

    rows = layers.fact.count()
    rows_in = int(layers.quality.get("rows_in", 0)) if layers.quality else None
    print(json.dumps({
        "metric": "pipeline_sec", "value": total, "unit": "sec", "queries": queries, "sf": sf,
        "input_rows": rows_in, "fact_rows": rows, "cpus": cpus,
        "rows_per_sec": {k: round(rows_in / queries[k]) for k in ("bronze", "silver", "fact") if rows_in},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
