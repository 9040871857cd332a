"""Files of one feed with different columns."""

import gzip

from pyspark.sql import types as T

from blotter.sources import drift
from blotter.sources.tables import Layout, read_table

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("name", T.StringType()),
                       T.StructField("at", T.TimestampNTZType())])
ALIASES = {"label": "name"}


def put(folder, name, text):
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def feed(folder):
    put(folder, "a.csv", "id,n,name,at\n1,5,x,2020-01-02T03:04:05\n9007199254740993,5.0,,\n")
    put(folder, "b.csv", 'At,"LABEL",Extra 1,ID\n2020-01-02,"y, z",7,3\nnever,,8.5,4\n')
    put(folder, "c.csv", "id,n,n,name,label\n5,5.5,6,p,q\n6,3000000000, ,r,\n7, ,1,,\n")
    put(folder, "d.csv", "id,n,name,at\n8,1\n10,2,t,2020-01-01,more\n")
    put(folder, "empty.csv", "")
    put(folder, "header_only.csv", "id,n\n")
    with gzip.open(f"{folder}/z.csv.gz", "wt") as f:
        f.write("name,id\nzipped,11\n")


def rows(df):
    return {r.id: (r.n, r.name, str(r["at"])[:10] if r["at"] else None, r.rescued) for r in df.collect()}


def test_no_cell_is_lost(spark, scratch):
    feed(scratch)
    got = rows(drift.read_reconciled(spark, scratch, SCHEMA, ALIASES))
    assert got[1] == (5, "x", "2020-01-02", None) and got[9007199254740993] == (5, None, None, None)
    assert got[3] == (None, "y, z", "2020-01-02", {"Extra 1": "7"})
    assert got[4] == (None, None, None, {"at": "never", "Extra 1": "8.5"})
    assert got[5] == (None, "p", None, {"n": "5.5", "n#2": "6", "label": "q"})
    assert got[6] == (None, "r", None, {"n": "3000000000", "n#2": " "}) and got[7] == (None, None, None, {"n#2": "1"})
    assert got[11] == (None, "zipped", None, None)
    df = drift.read_reconciled(spark, scratch, SCHEMA, ALIASES)
    assert {r.corrupt_record for r in df.collect()} == {None, "8,1", "10,2,t,2020-01-01,more"}


def test_report_and_evolved_schema(spark, scratch):
    feed(scratch)
    report = drift.drift_report(drift.read_reconciled(spark, scratch, SCHEMA, ALIASES), SCHEMA)
    got = {r.column_name: (r.cells, r.known, r.fits) for r in report.collect()}
    assert got == {"Extra 1": (2, False, "double"), "at": (1, True, "string"), "n": (2, True, "double"), "n#2": (3, False, "string"),
                   "label": (1, False, "string")}
    wide = drift.evolved_schema(SCHEMA, report)
    assert {f.name: f.dataType.simpleString() for f in wide.fields} == {
        "id": "bigint", "n": "double", "name": "string", "at": "string", "extra_1": "double", "label": "string", "n_2": "string"}
    again = drift.read_reconciled(spark, scratch, wide)
    left = {k for r in again.collect() for k in (r.rescued or {})}
    assert left <= {"n#2"}
    assert {r.id: r.n for r in again.collect()}[5] == 5.5


def test_no_files_and_odd_names(spark, scratch):
    put(scratch, "empty.csv", "")
    none = drift.read_reconciled(spark, scratch, SCHEMA)
    assert none.count() == 0 and none.columns[:6] == ["id", "n", "name", "at", "rescued", "corrupt_record"]
    put(scratch, "odd {1}[2].csv", "﻿id,,rescued,_metadata\n1,a,b,c\n")
    got = drift.read_reconciled(spark, scratch, SCHEMA).collect()
    assert [(r.id, r.rescued) for r in got] == [(1, {"": "a", "rescued": "b", "_metadata": "c"})]
    assert drift.drift_report(none, SCHEMA).count() == 0


def test_stream_reads_each_file_once(spark, scratch):
    import os
    folder = f"{scratch}/in"
    os.makedirs(folder)
    layout = Layout(f"{scratch}/t", f"{scratch}/c")
    put(folder, "a.csv", "id,n\n1,2\n")
    for _ in range(2):
        drift.reconciled_flow(spark, layout, folder, SCHEMA).awaitTermination()
    put(folder, "b.csv", "n,id,new\nx,2,3\n")
    drift.reconciled_flow(spark, layout, folder, SCHEMA).awaitTermination()
    got = read_table(spark, layout.path(drift.RECONCILED))
    assert {r.id: (r.n, r.rescued) for r in got.collect()} == {1: (2, None), 2: (None, {"n": "x", "new": "3"})} and got.count() == 2
    assert {r.source_filename.rsplit("/", 1)[1] for r in got.collect()} == {"a.csv", "b.csv"}
