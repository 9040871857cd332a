"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blotter.llm import licenses, mixing, nearcopies, neighbours, packing, quality, repeats, secrets, urls, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
EXTRA = ["kept", "spans", "key", "n", "m", "block", "_q", "digest", "rep", "class_id", "size", "_tokens", "_topic", "_p", "_gone", "a"]


def documents(spark):
    line = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(1, line, "en", "s", 70), (1, line, "en", "s", 70), (2, line, None, "s", 70), (3, None, "en", None, None), (4, "", "en", "s", 0),
            (None, line, "en", "s", 70), (None, None, None, None, None), (5, " \n\t ", "de", "t", 4), (6, "word " * 200_000, "en", "s", 10 ** 6),
            (7, "password = 'abcdefghijkl' " + line, "en", "t", 99), (8, "x" * 300_000, "fr", "t", 300_000)]
    df = spark.createDataFrame(rows, DOCS)
    for i, c in enumerate(EXTRA):
        df = df.withColumn(c, F.lit(i))
    return df


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (None, 1, 0), (7, None, 0), (6, 0, 1)],
                                 "doc_id long, quality int, toxic int")


def empty(df):
    return df.sparkSession.createDataFrame([], df.schema)


BY_ROW = {
    "licenses": lambda d: licenses.recognise(d), "quality": lambda d: quality.judge(d, quality.train(d, labels(d.sparkSession))),
    "mixing": mixing.mix, "secrets": secrets.scan, "repeats": repeats.remove_repeats,
}


@pytest.mark.parametrize("name", sorted(BY_ROW))
def test_one_row_for_each(spark, name):
    d = documents(spark)
    assert BY_ROW[name](d).count() == d.count()
    assert BY_ROW[name](empty(d)).count() == 0


def test_near_copies(spark):
    d = documents(spark)
    got = {r.doc_id: r.class_id for r in nearcopies.classes(d).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1, 8: 8}
    kept = nearcopies.keep_one(d)
    assert kept.columns == d.columns and kept.count() == d.count() - 2
    assert nearcopies.classes(empty(d)).count() == 0


def test_packing(spark):
    d = documents(spark)
    rows = packing.pack_documents(d).collect()
    assert sum(r.n_tokens for r in rows if r.doc_id == 6) == 200_000
    assert sum(r.n_tokens == 0 for r in rows) == 4 and packing.pack_documents(empty(d)).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, name, stage):
    d = documents(spark)
    sf = "/root/testdata/sf0.001"
    out = stage(spark, d, sf)
    assert out.columns == d.columns
    for r in out.collect():
        assert [r[c] for c in EXTRA] == list(range(len(EXTRA)))
    assert stage(spark, empty(d), sf).count() == 0


def test_secret_stage_counts_characters(spark):
    got = {r.doc_id: r for r in secrets.redact(documents(spark)).collect()}
    assert got[7].text.startswith("[SECRET]") and got[7].n_chars == len(got[7].text) and got[3].n_chars is None


def test_pages(spark):
    rows = [(1, "http://a.org/x", "<p>"), (2, "http://a.org/x", "<p>"), (2, "http://a.org/x", "<p>"), (None, "http://a.org/x", "<p>"),
            (3, None, None), (4, "", ""), (5, "nonsense\r\nWARC-Type: x", "é" * 10 ** 6)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("surt", F.lit(1))
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_round_trip(d).collect()), key=str)
    assert got == sorted([(1, 3, "response", None), (2, 3, "revisit", 1), (2, 3, "revisit", 1), (None, 3, "revisit", 1),
                          (3, 0, "response", None), (4, 0, "revisit", 3), (5, 2 * 10 ** 6, "response", None)], key=str)
    none = spark.createDataFrame([], "page_id long, bad boolean")
    assert urls.judge(d, none).count() == len(rows)
    assert warc.archive_round_trip(empty(d)).count() == 0 and urls.judge(empty(d), none).count() == 0


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (3, None), (None, None), (4, [1e308, 1e308]), (5, [1e-300, 1e-300])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1)).withColumn("m", F.lit(1))
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in neighbours.near_vectors(d).collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (None, 3, 1), (3, 0, 3), (None, 0, None), (4, 1, 4), (5, 1, 4)], key=str)
    assert neighbours.near_vectors(empty(d)).count() == 0


def test_pipeline_whole(spark):
    """The stages in turn: nothing rejected, repeated or secret is left, and what is packed is what was kept."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, held = held, stage(spark, held, sf)
        assert set(r.doc_id for r in held.select("doc_id").collect()) <= set(r.doc_id for r in before.select("doc_id").collect())
        if name == "near_duplicates":
            assert held.groupBy("text").count().filter("count > 1").isEmpty()
        if name == "secrets":
            assert secrets.scan(held.select("doc_id", "text")).filter("size(spans) > 0").isEmpty()
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in held.select("doc_id").collect()}
