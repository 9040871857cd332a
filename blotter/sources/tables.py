"""Table layout and table I/O: namespace scoping (S10), batch snapshot reads
(S6), stream reads (S5), materialized tables (K2), append flows (K1) and table
comments (K3).

Tables are Parquet directories under one base path (a shared filesystem or
object store on a cluster). Streaming sinks keep their own ``_spark_metadata``
log; a whole-directory read honours it, so only committed files are seen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config as C

# Table -> comment, in dependency order.
COMMENTS = {
    C.BRONZE: "Raw incidents as ingested, with audit columns",
    C.SILVER: "Incidents that pass the quality gate, cleaned and enriched",
    C.QUARANTINE: "Incidents that the quality gate drops, with the rules they fail",
    "dim_date": "Calendar days",
    "dim_time": "Minutes of the day",
    "dim_status": "Case statuses",
    "dim_location": "Areas and reporting districts",
    "dim_premise": "Premises",
    "dim_weapon": "Weapons",
    "dim_crime_type": "Crime codes",
    "dim_victim_demographics": "Victim age, sex and descent",
    C.FACT: "Incidents with foreign keys, measures and flags",
}


@dataclass
class Layout:
    """Where the tables of one pipeline live.

    ``base`` is a directory URI; ``checkpoints`` defaults to ``base/_checkpoints``
    and must be outside any input directory. No metastore is required; where a
    ``schema`` is named, ``register`` enters the tables and their comments there.
    """

    base: str
    checkpoints: str | None = None
    catalog: str | None = None
    schema: str | None = None
    comments: dict[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"

    def checkpoint(self, flow: str) -> str:
        root = self.checkpoints or f"{self.base.rstrip('/')}/_checkpoints"
        return f"{root.rstrip('/')}/{flow}"

    def qualified(self, table: str) -> str:
        parts = [p for p in (self.catalog, self.schema) if p]
        return ".".join(parts + [table])

    def tables(self, spark: SparkSession) -> list[str]:
        """Readable tables below the base folder, whatever their names."""
        base = spark._jvm.org.apache.hadoop.fs.Path(self.base)
        fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(base):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(base) if f.isDirectory()]
        return sorted(n for n in names if not n.startswith(("_", ".")) and table_exists(spark, self.path(n)))

    def register(self, spark: SparkSession) -> list[str]:
        """Enter the existing tables, with their comments, into the named schema
        (K3, S10): external tables over the same files."""
        if not self.schema:
            raise ValueError("name a schema to register tables in")
        space = ".".join(f"`{p}`" for p in (self.catalog, self.schema) if p)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {space}")
        names = self.tables(spark)
        for name in names:
            text = self.comments.get(name, COMMENTS.get(name, "")).replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"DROP TABLE IF EXISTS {space}.`{name}`")
            spark.sql(f"CREATE TABLE {space}.`{name}` USING parquet LOCATION '{self.path(name)}' COMMENT '{text}'")
        return names

    def use(self, spark: SparkSession) -> None:
        """Make the layout's catalog/schema current when the session has them."""
        if self.catalog:
            spark.catalog.setCurrentCatalog(self.catalog)
        if self.schema and spark.catalog.databaseExists(self.schema):
            spark.catalog.setCurrentDatabase(self.schema)

    def comment(self, table: str, text: str) -> None:
        """Set a table comment (K3), stored by ``register``."""
        self.comments[table] = text


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a readable Parquet table exists at ``path`` (only the file
    listing and footers are touched; no job runs)."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Batch snapshot of a table."""
    return spark.read.parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Read an upstream table as a stream (S5). The schema is taken from the
    existing files unless given."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a batch table (K2)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_part(df: DataFrame, path: str, options: dict[str, str] | None = None, **part: int) -> None:
    """Write one partition folder of a table anew (K2): writing a run again,
    after a failure, leaves the same rows."""
    folder = "/".join(f"{k}={v}" for k, v in part.items())
    df.write.mode("overwrite").options(**(options or {})).parquet(f"{path}/{folder}")


def overwrite_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace those partitions of a table that ``df`` has rows of; others stay as they are.

    ``df`` must not read the table itself: write it to another folder first."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def append_flow(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
                available_now: bool = True, partition_by: list[str] | None = None) -> StreamingQuery:
    """Start an append-only streaming flow into a Parquet table (K1).

    ``availableNow`` processes everything present and stops; the checkpoint
    makes reruns incremental and the file sink makes the output exactly-once.
    """
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(path)
