"""Pinned source schema (28 columns) and helpers to infer/persist one (S3)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

INCIDENT_SCHEMA = T.StructType([
    T.StructField("dr_no", _L),
    T.StructField("date_rptd", _TS),
    T.StructField("date_occ", _TS),
    T.StructField("time_occ", _I),
    T.StructField("area", _I),
    T.StructField("area_name", _S),
    T.StructField("rpt_dist_no", _I),
    T.StructField("part_1_2", _I),
    T.StructField("crm_cd", _I),
    T.StructField("crm_cd_desc", _S),
    T.StructField("mocodes", _S),
    T.StructField("vict_age", _I),
    T.StructField("vict_sex", _S),
    T.StructField("vict_descent", _S),
    T.StructField("premis_cd", _D),
    T.StructField("premis_desc", _S),
    T.StructField("weapon_used_cd", _D),
    T.StructField("weapon_desc", _S),
    T.StructField("status", _S),
    T.StructField("status_desc", _S),
    T.StructField("crm_cd_1", _D),
    T.StructField("crm_cd_2", _D),
    T.StructField("crm_cd_3", _D),
    T.StructField("crm_cd_4", _D),
    T.StructField("location", _S),
    T.StructField("cross_street", _S),
    T.StructField("lat", _D),
    T.StructField("lon", _D),
])

SOURCE_COLUMNS = [f.name for f in INCIDENT_SCHEMA.fields]


def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def infer_and_pin_schema(spark: SparkSession, path: str, schema_file: str | None = None,
                         sampling_ratio: float = 1.0) -> T.StructType:
    """Infer the CSV schema once with a batch read and optionally persist it as JSON.

    Later streaming reads take the pinned schema, so types (and therefore hash
    keys) cannot drift between runs.
    """
    df: DataFrame = (spark.read.option("header", True).option("inferSchema", True)
                     .option("samplingRatio", sampling_ratio).csv(path))
    schema = df.schema
    if schema_file:
        _write_text(spark, schema_file, schema_to_json(schema))
    return schema


def load_pinned_schema(spark: SparkSession, schema_file: str) -> T.StructType:
    text = "".join(r.value for r in spark.read.text(schema_file, wholetext=True).collect())
    return schema_from_json(text)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    # A one-row text dataset: works on any Hadoop-compatible filesystem.
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
