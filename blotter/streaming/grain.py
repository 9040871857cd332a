"""One row per incident across runs.

``enforce_grain`` takes a run's rows and a table of the keys that earlier runs
accepted. A key that is there already, or a second row of a key in the same
run, goes to quarantine with the rule ``unique_incident``; of several rows of a
run the one reported first stays. The key table is Parquet, one folder per run,
with a Bloom filter on the key in every file; it is only read through a
semi-join with the keys of the run, for which Spark adds a runtime Bloom filter
where the table is large. A run writes its own folders, so repeating it after a
failure changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..sources.tables import Layout, materialize, read_table, stream_table, table_exists, write_part

RULE = "unique_incident"
UNIQUE = "incidents_unique"
REPEATED = "incidents_repeated"
KEYS = "incident_keys"


def first_reported() -> Column:
    """Earlier reports first, unknown dates last."""
    return F.coalesce(F.unix_micros(F.col("date_rptd").cast("timestamp")), F.lit((1 << 63) - 1))


def enforce_grain(batch: DataFrame, layout: Layout, run: int, key: str = "dr_no", order: Column | None = None) -> dict[str, int]:
    """Split ``batch`` into the tables ``incidents_unique`` and
    ``incidents_repeated`` (with ``failed_rules``). Rows without key stay: that
    they have none is another rule's matter. Returns the rows of either and the
    keys held, over all runs.

    Ties of ``order`` go by a hash of the row, then by its place in the run."""
    spark, columns = batch.sparkSession, batch.columns
    path = layout.path(f"_staging/grain-{run}-{uuid.uuid4().hex}")
    judged_path = layout.path(f"_staging/judged-{run}-{uuid.uuid4().hex}")
    rank = F.struct((order if order is not None else first_reported()).alias("o"),
                    F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("h"), F.monotonically_increasing_id().alias("i"))
    materialize(batch.withColumn("_rank", rank), path)
    rows = read_table(spark, path)
    # Counted per task first, so a key on a third of the rows moves as one count.
    several = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(key)
    first = (rows.select(key, "_rank").join(several, key, "left_semi").groupBy(key).agg(F.min("_rank").alias("_first")))
    keys = rows.select(key).filter(F.col(key).isNotNull()).distinct()
    if table_exists(spark, layout.path(KEYS)):
        held = read_table(spark, layout.path(KEYS)).filter(F.col("run") != run).select(key)
        known = held.join(keys, key, "left_semi").distinct().withColumn("_known", F.lit(True))
    else:
        known = keys.limit(0).withColumn("_known", F.lit(True))
    judged = (rows.join(first, key, "left").join(known, key, "left")
              .withColumn("_stays", F.col("_known").isNull() & (F.col("_first").isNull() | (F.col("_first") == F.col("_rank")))))
    # Whole rows move once, for both tables.
    materialize(judged.select(*columns, "_stays"), judged_path)
    judged = read_table(spark, judged_path)
    stays = judged.filter("_stays").select(*columns)
    write_part(stays, layout.path(UNIQUE), run=run)
    write_part(judged.filter("not _stays").select(*columns, F.lit(RULE).alias("failed_rules")), layout.path(REPEATED), run=run)
    write_part(stays.select(key).filter(F.col(key).isNotNull()), layout.path(KEYS),
               {f"parquet.bloom.filter.enabled#{key}": "true"}, run=run)
    return {name: read_table(spark, layout.path(t)).count() for name, t in (("unique", UNIQUE), ("repeated", REPEATED), ("keys", KEYS))}


def grain_flow(spark: SparkSession, layout: Layout, source: str = C.BRONZE, schema=None, max_files_per_trigger: int | None = None):
    """The rows of a table as a stream through ``enforce_grain``, a run per micro-batch."""
    rows = stream_table(spark, layout.path(source), schema, max_files_per_trigger)
    return (rows.writeStream.queryName("grain").option("checkpointLocation", layout.checkpoint("grain"))
            .foreachBatch(lambda batch, run: enforce_grain(batch, layout, run) and None)
            .trigger(availableNow=True).start())
