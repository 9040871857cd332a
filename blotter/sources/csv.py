"""Raw CSV ingest: batch scan (S1, S9), incremental directory stream
and bronze audit columns (S4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .schema import INCIDENT_SCHEMA


#: Column for the text of malformed lines.
CORRUPT = "corrupt_record"


def with_corrupt(schema: T.StructType, corrupt_col: str | None) -> T.StructType:
    if corrupt_col and corrupt_col not in schema.fieldNames():
        return T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    return schema


def _as_written(schema: T.StructType) -> T.StructType:
    """Integers are parsed as doubles: a writer that knows missing values only
    in floating point (pandas) writes 5 as 5.0 wherever a column has one."""
    return T.StructType([T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
                         for f in schema.fields])


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The integer columns of ``schema`` as integers again; a fraction is NULL."""
    ints = {f.name for f in schema.fields if isinstance(f.dataType, T.IntegerType)}
    whole = {c: F.when(F.col(c) == F.floor(c), F.col(c)).cast("int") for c in ints}
    return df.select(*[whole[c].alias(c) if c in ints else F.col(c) for c in df.columns], "_metadata")


def _csv_reader(reader, schema: T.StructType, corrupt_col: str | None):
    r = (reader.schema(_as_written(with_corrupt(schema, corrupt_col)))
         .option("header", True)
         .option("mode", "PERMISSIVE"))
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r


def read_incidents_csv(spark: SparkSession, path: str, schema: T.StructType = INCIDENT_SCHEMA,
                       corrupt_col: str | None = None) -> DataFrame:
    """Batch CSV scan with a header and an explicit schema (PERMISSIVE).

    With ``corrupt_col`` set, a malformed line keeps its raw text there and
    its typed fields are NULL instead of failing the job (S9).
    """
    return _typed(_csv_reader(spark.read, schema, corrupt_col).csv(path), schema)


def stream_incidents_csv(spark: SparkSession, directory: str, schema: T.StructType = INCIDENT_SCHEMA,
                         corrupt_col: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental ingest of a CSV directory (S2). The query checkpoint records
    which files were read, so each file is ingested exactly once."""
    r = _csv_reader(spark.readStream, schema, corrupt_col)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _typed(r.csv(directory), schema)


def with_ingest_audit(df: DataFrame, flow: str = C.FLOW_BRONZE, ts: Column | None = None,
                      source: str | None = None) -> DataFrame:
    """Add ``ingestion_datetime``, ``source_filename`` and ``created_by``.

    ``source_filename`` comes from the file metadata column for file scans;
    pass ``source`` to label frames that are not file scans.
    """
    src = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumns({
        "ingestion_datetime": ts if ts is not None else F.current_timestamp(),
        "source_filename": src,
        "created_by": F.lit(flow),
    }).drop("_metadata")
