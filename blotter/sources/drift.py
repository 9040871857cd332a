"""CSV files whose columns drift (S2, S3, S9): no cell is lost.

Files of one feed may order, name, add or leave out columns differently. Each
file is read by its own header: files of equal headers form one scan, whose
columns are matched by name (``normal_name`` and ``aliases``) with the pinned
schema. What the pinned schema has no place for is kept in the map ``rescued``:

* a column it does not know, under the file's name for it,
* a value that its type can't hold, under the column's name (the column is NULL),
* a second column of a name, as ``name#position``.

A column that a file lacks is NULL. Blank text in a typed column is a missing
value. A malformed line keeps its text in ``corrupt_record``. ``drift_report``
counts what was rescued, and ``evolved_schema`` widens the schema to hold it.

Only the first line of each file passes the driver, several files at a time; it
must hold the whole header. Rows are read once, by Spark.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv import CORRUPT, with_ingest_audit
from .schema import INCIDENT_SCHEMA
from .tables import Layout, write_part

RESCUED = "rescued"
RECONCILED = "incidents_reconciled"
HEADER_READERS = 16
_RESCUED_TYPE = T.MapType(T.StringType(), T.StringType())
_EXACT_IN_DOUBLE = float(1 << 53)


def normal_name(name: str) -> str:
    """``Crm Cd Desc`` and ``crm-cd-desc`` are ``crm_cd_desc``."""
    return re.sub(r"\W+", "_", name.strip().lower()).strip("_")


def listed_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a scan of ``path`` would read (their content is not)."""
    return sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").collect())


def _first_line(spark: SparkSession, file: str) -> str:
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def file_headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that have it. Files without any line are left out."""
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            out.setdefault(tuple(next(csv.reader([line.lstrip("﻿")]))), []).append(file)
    return out


def _held(text: Column, dtype: T.DataType) -> Column:
    """``text`` as ``dtype``, NULL where the type can't hold it."""
    if isinstance(dtype, T.StringType):
        return text
    exact = text.try_cast(dtype)
    if isinstance(dtype, T.IntegralType):
        # Writers that know missing values only in floating point write 5 as 5.0.
        number = text.try_cast("double")
        whole = F.when((number == F.floor(number)) & (F.abs(number) < _EXACT_IN_DOUBLE), number).try_cast(dtype)
        return F.coalesce(exact, whole)
    return exact


def _scan(spark: SparkSession, header: Sequence[str], files: Sequence[str], schema: T.StructType,
          aliases: Mapping[str, str]) -> DataFrame:
    read_as = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))] + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(read_as).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .csv([re.sub(r"([\\\[\]{}*?])", r"\\\1", f) for f in files]))
    types = {f.name: f.dataType for f in schema.fields}
    columns: dict[str, Column] = {}
    rescued, names = [], set(types)
    for i, name in enumerate(header):
        text, known = F.col(f"_c{i}"), aliases.get(normal_name(name), normal_name(name))
        if known in types and known not in columns:
            columns[known] = _held(text, types[known])
            if isinstance(types[known], T.StringType):
                continue
            key, lost = known, columns[known].isNull() & (F.trim(text) != "")
        else:
            key, lost = f"{name}#{i}" if name in names else name, text.isNotNull()
            names.add(name)
        rescued.append(F.when(lost, F.struct(F.lit(key).alias("key"), text.alias("value"))))
    kept = F.filter(F.array(*rescued), lambda e: e.isNotNull()) if rescued else None
    cells = F.when(F.size(kept) > 0, F.map_from_entries(kept)) if rescued else F.lit(None).cast(_RESCUED_TYPE)
    return raw.select(*[columns.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields],
                      cells.alias(RESCUED), CORRUPT, "_metadata")


def read_reconciled(spark: SparkSession, files: str | Sequence[str], schema: T.StructType = INCIDENT_SCHEMA,
                    aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of a folder (or of listed files) under ``schema``, with
    ``rescued`` and ``corrupt_record``. ``aliases``: earlier or other names of a
    column (in the form of ``normal_name``) -> its name in ``schema``."""
    files = listed_files(spark, files) if isinstance(files, str) else list(files)
    scans = [_scan(spark, header, group, schema, aliases or {}) for header, group in sorted(file_headers(spark, files).items())]
    if not scans:
        empty = T.StructType([*schema.fields, T.StructField(RESCUED, _RESCUED_TYPE), T.StructField(CORRUPT, T.StringType()),
                              T.StructField("_metadata", T.StructType([T.StructField("file_path", T.StringType())]))])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, scans)


#: What rescued cells may fit, narrowest first.
_FITS = ("int", "bigint", "double", "timestamp_ntz")


def drift_report(df: DataFrame, schema: T.StructType = INCIDENT_SCHEMA) -> DataFrame:
    """Per rescued name: its cells, whether the schema has the column, and the
    narrowest type that holds every rescued cell."""
    cells = df.select(F.explode(RESCUED).alias("column_name", "cell"))
    holds = [F.min(F.col("cell").try_cast(t).isNotNull()).alias(f"_{t}") for t in _FITS]
    fits = F.coalesce(*[F.when(F.col(f"_{t}"), F.lit(t)) for t in _FITS], F.lit("string"))
    return (cells.groupBy("column_name").agg(F.count(F.lit(1)).alias("cells"), *holds)
            .select("column_name", "cells", F.col("column_name").isin(schema.fieldNames()).alias("known"), fits.alias("fits")))


def evolved_schema(schema: T.StructType, report: DataFrame) -> T.StructType:
    """``schema`` with the reported columns added and its own widened where both
    old and rescued values fit without loss (else they become text). The report
    has one row per column name."""
    found = {r.column_name: (r.known, r.fits) for r in report.collect()}
    wider = {("int", "bigint"): "bigint", ("int", "double"): "double", ("double", "int"): "double"}
    fields = []
    for f in schema.fields:
        if f.name in found:
            to = wider.get((f.dataType.simpleString(), found[f.name][1]), "string")
            f = T.StructField(f.name, T._parse_datatype_string(to))
        fields.append(f)
    taken = {f.name for f in fields}
    for name in sorted(n for n, (known, _) in found.items() if not known):
        if normal_name(name) not in taken:
            taken.add(normal_name(name))
            fields.append(T.StructField(normal_name(name), T._parse_datatype_string(found[name][1])))
    return T.StructType(fields)


def reconciled_flow(spark: SparkSession, layout: Layout, directory: str, schema: T.StructType = INCIDENT_SCHEMA,
                    aliases: Mapping[str, str] | None = None, max_files_per_trigger: int | None = None):
    """Each file of a directory once (S2), reconciled, into ``incidents_reconciled``
    with audit columns. The stream carries file names only; a micro-batch writes
    its own folder anew, so a repeated one adds nothing."""
    def load(batch: DataFrame, run: int) -> None:
        files = sorted(r.path for r in batch.collect())
        if files:
            write_part(with_ingest_audit(read_reconciled(spark, files, schema, aliases)), layout.path(RECONCILED), run=run)

    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(directory).select("path").writeStream.queryName("reconciled")
            .option("checkpointLocation", layout.checkpoint("reconciled")).foreachBatch(load).trigger(availableNow=True).start())
