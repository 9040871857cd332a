"""Operator 1: WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per record into archive files of the
given folder, ``build_index`` sorts the captures by reversed-host key into
compressed blocks with a sparse block directory per shard, ``lookup`` binary
searches shard list, directory and block before ranged reads, and
``read_records`` parses the records at the places found.

Files are named by a fresh id per task attempt and only the files named in a
task's result rows count, so a repeated task never harms what another wrote.

Defined cases: a null payload is empty; a null url has key ``)`` and no target
line in the record; a null page id sorts last and is never referred to; rows
that repeat a page id and its payload are all of the same type; an empty table
gives empty results. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import salted_lookup, scratch, small_text_batches, stored

#: Captures per compressed block of the index.
BLOCK_LINES = 1000
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 0
CAPTURE_DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PLACES = "page_id long, surt string, file string, start long, size long"


def surt_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.org:8/x?y`` -> ``org,a,www:8)/x?y``."""
    scheme, sep, rest = (url or "").partition("://")
    if not sep:
        return ")" + (url or "")
    host = re.match(r"[^/?#]*", rest).group()
    name, colon, port = host.rpartition(":")
    if not (colon and port.isdigit()):
        name, colon, port = host, "", ""
    return ",".join(reversed(name.lower().split("."))) + colon + port + ")" + rest[len(host):]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def _id_uri(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def encode_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; the block of a revisit holds the response's HTTP head only."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_id_uri(page_id)}", f"WARC-Date: {CAPTURE_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    if revisit:
        lines += [f"WARC-Refers-To: {_id_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}",
                  f"X-Refers-To-Page: {refers_to}"]
    block = head if revisit else head + payload
    lines += [f"X-Page: {'' if page_id is None else page_id}", f"WARC-Payload-Digest: sha1:{digest}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def decode_record(raw: bytes) -> dict:
    """Fields of one record. Digest and length of a response come from its
    payload, those of a revisit from its headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    http, _, payload = rest[:int(field["Content-Length"])].partition(b"\r\n\r\n")
    revisit = field["WARC-Type"] == "revisit"
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    if not revisit and size != len(payload):
        raise ValueError("truncated payload")
    page, uri = field["X-Page"].strip(), field.get("WARC-Target-URI")
    return {"page_id": int(page) if page else None, "url": None if uri is None else unquote(uri),
            "payload_bytes": size, "record_type": field["WARC-Type"],
            "payload_digest": field["WARC-Payload-Digest"][5:] if revisit else payload_digest(payload),
            "refers_to": int(field["X-Refers-To-Page"]) if revisit else None,
            "payload": None if revisit else payload}


@F.pandas_udf(T.StructType([T.StructField("digest", T.StringType()), T.StructField("size", T.LongType())]))
def _digests(html: pd.Series) -> pd.DataFrame:
    raw = [b"" if x is None else x.encode() for x in html]
    return pd.DataFrame({"digest": [payload_digest(x) for x in raw], "size": [len(x) for x in raw]})


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload an earlier page has."""
    ids = stored(pages.select("page_id", _digests("html").alias("d"))
                 .select("page_id", "d.digest", "d.size"), "warc-digests")
    first = (ids.filter(F.col("size") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and refers_to is not null").drop("n"))
    return (salted_lookup(ids, first, ["digest"], F.col("page_id"))
            .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to").distinct())


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the records of ``pages`` (page_id, url, html); return their places."""
    own = pages.select("page_id", "url", "html")
    r = revisits(own, min_bytes)
    a = own.withColumn("digest", _digests("html")["digest"]).alias("a")
    on = F.col("a.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("a.digest") == F.col("r.digest"))
    rows = (a.join(r.alias("r").hint("shuffle_merge"), on, "left")
            .select("a.page_id", "a.url", "a.html", "a.digest", "r.refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, at = None, f"{folder}/archive-{uuid.uuid4().hex}.warc.gz", 0
        try:
            for b in batches:
                places = []
                for page, url, html, digest, ref in zip(b.page_id, b.url, b.html, b.digest, b.refers_to):
                    page = None if pd.isna(page) else int(page)
                    ref = None if pd.isna(ref) else int(ref)
                    raw = encode_record(page, url, (html or "").encode(), digest, ref)
                    z = gzip.compress(raw, 4, mtime=0)
                    if out is None:
                        fs, path = _fs(folder)
                        fs.create_dir(path)
                        out = fs.open_output_stream(f"{path}/{name.rpartition('/')[2]}", compression=None)
                    out.write(z)
                    places.append((page, surt_key(url), name, at, len(z)))
                    at += len(z)
                yield pd.DataFrame(places, columns=["page_id", "surt", "file", "start", "size"]).astype(
                    {"page_id": "Int64"})
        finally:
            if out is not None:
                out.close()

    return stored(rows.mapInPandas(write, _PLACES), "warc-places")


def _line(surt, page, file, start, size) -> bytes:
    return "\t".join((quote(surt, safe="/,)?&=:;#"), "" if page is None else str(page), file, str(start),
                      str(size))).encode()


def _sort_key(surt: str, page) -> tuple:
    return surt.encode(), page is None, page or 0


def build_index(places: DataFrame, folder: str, shards: int, block_lines: int = BLOCK_LINES) -> list[tuple]:
    """Sort the captures into index shards; return the shard list (first surt,
    page null?, first page, file, start and size of the block directory), which
    has at most ``shards`` entries."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, at, directory, held = None, 0, [], []
        name = f"{folder}/index-{uuid.uuid4().hex}.idx"

        def flush():
            nonlocal at
            z = zlib.compress(b"\n".join(_line(*x) for x in held), 6)
            out.write(z)
            directory.append((held[0][0], held[0][1], at, len(z)))
            at += len(z)
            held.clear()

        try:
            for b in batches:
                if out is None and len(b):
                    fs, path = _fs(folder)
                    fs.create_dir(path)
                    out = fs.open_output_stream(f"{path}/{name.rpartition('/')[2]}", compression=None)
                for surt, page, file, start, size in zip(b.surt, b.page_id, b.file, b.start, b["size"]):
                    held.append((surt, None if pd.isna(page) else int(page), file, start, size))
                    if len(held) == block_lines:
                        flush()
            if out is not None:
                if held:
                    flush()
                z = zlib.compress(b"\n".join(_line(s, p, "", o, n) for s, p, o, n in directory), 6)
                out.write(z)
                yield pd.DataFrame({"surt": [directory[0][0]], "page_id": pd.array([directory[0][1]], "Int64"),
                                    "file": [name], "start": [at], "size": [len(z)]})
        finally:
            if out is not None:
                out.close()

    key = [F.col("surt"), F.col("page_id").asc_nulls_last()]
    shard = (places.repartitionByRange(shards, *key).sortWithinPartitions(*key)
             .mapInPandas(write, "surt string, page_id long, file string, start long, size long"))
    rows = [(r.surt, r.page_id, r.file, r.start, r["size"]) for r in stored(shard, "warc-shards").collect()]
    return sorted(rows, key=lambda r: _sort_key(r[0], r[1]))


class _Index:
    """Ranged reads of one worker: a directory and a block are held at a time."""

    def __init__(self, shard_list: list[tuple]):
        self.shards, self.keys = shard_list, [_sort_key(s[0], s[1]) for s in shard_list]
        self.at = self.block_at = None
        self.files: dict = {}

    def _read(self, file: str, start: int, size: int) -> list[tuple]:
        raw = zlib.decompress(read_range(self.files, file, start, size))
        rows = []
        for line in raw.decode().split("\n"):
            s, p, f, a, n = line.split("\t")
            rows.append((unquote(s), int(p) if p else None, f, int(a), int(n)))
        return rows

    def find(self, surt: str, page) -> Iterator[tuple]:
        """Places of the captures with this key, oldest file order."""
        if not self.shards:
            return
        want = _sort_key(surt, page)
        i = max(0, bisect.bisect_left(self.keys, want) - 1)
        while i < len(self.shards) and self.keys[i] <= want:
            if self.at != i:
                _, _, file, start, size = self.shards[i]
                self.directory = self._read(file, start, size)
                self.heads = [_sort_key(d[0], d[1]) for d in self.directory]
                self.at, self.block_at = i, None
            j = max(0, bisect.bisect_left(self.heads, want) - 1)
            while j < len(self.heads) and self.heads[j] <= want:
                if self.block_at != j:
                    self.block = self._read(self.shards[i][2], *self.directory[j][3:])
                    self.lines = [_sort_key(b[0], b[1]) for b in self.block]
                    self.block_at = j
                lo, hi = bisect.bisect_left(self.lines, want), bisect.bisect_right(self.lines, want)
                for b in self.block[lo:hi]:
                    yield b[2:]
                j += 1
            i += 1


def read_range(files: dict, file: str, start: int, size: int) -> bytes:
    """``size`` bytes at ``start``; ``files`` keeps the last opened file."""
    if file not in files:
        for f in files.values():
            f.close()
        files.clear()
        fs, path = _fs(file)
        files[file] = fs.open_input_file(path)
    return files[file].read_at(size, start)


def lookup(keys: DataFrame, shard_list: list[tuple]) -> DataFrame:
    """Places of the captures of ``keys`` (surt, page_id), each sought in the
    index: shard list, block directory, block. Sorted keys share their reads."""
    def seek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _Index(shard_list)
        for b in batches:
            got = [(p, s, *place) for s, p in ((s, None if pd.isna(p) else int(p))
                                               for s, p in zip(b.surt, b.page_id)) for place in index.find(s, p)]
            yield pd.DataFrame(got, columns=["page_id", "surt", "file", "start", "size"]).astype(
                {"page_id": "Int64"})

    key = [F.col("surt"), F.col("page_id").asc_nulls_last()]
    n = max(1, min(len(shard_list), int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return (keys.select("surt", "page_id").repartitionByRange(n, *key).sortWithinPartitions(*key)
            .mapInPandas(seek, _PLACES))


def read_records(places: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records at ``places``, read in file order by ranges."""
    cols = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        cols, schema = cols + ["payload"], schema + ", payload binary"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files: dict = {}
        for b in batches:
            got = [decode_record(gzip.decompress(read_range(files, f, a, n)))
                   for f, a, n in zip(b.file, b.start, b["size"])]
            yield pd.DataFrame(got, columns=cols).astype({"page_id": "Int64", "refers_to": "Int64"})

    n = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (places.select("file", "start", "size").repartitionByRange(n, "file", "start")
            .sortWithinPartitions("file", "start").mapInPandas(read, schema))


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives, index them, and read every page's records
    back by index lookup of its key."""
    spark = pages.sparkSession
    small_text_batches(spark)
    folder = scratch(spark, "warc")
    places = write_archives(pages, folder, min_bytes)
    shards = build_index(places, f"{folder}/index", int(spark.conf.get("spark.sql.shuffle.partitions")))

    @F.pandas_udf("string")
    def surt(url: pd.Series) -> pd.Series:
        return url.map(surt_key)

    keys = pages.select(surt("url").alias("surt"), "page_id").distinct()
    return read_records(lookup(keys, shards), with_payload=False)


def op1_warc_index(spark, sf_dir):
    from .common import table
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BITS = "[" + ",".join(f"'{i:04b}'" for i in range(16)) + "]"
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes,
        list_aggregate(list_transform(string_split(sha1(html), ''),
          lambda c: {_BITS}[strpos('0123456789abcdef', c)]), 'string_agg', '') AS bits FROM p),
b AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32),
          lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
            + 16 * CAST(substr(bits, i * 5 + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, i * 5 + 2, 1) AS INTEGER)
            + 4 * CAST(substr(bits, i * 5 + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, i * 5 + 4, 1) AS INTEGER)
            + CAST(substr(bits, i * 5 + 5, 1) AS INTEGER) AS BIGINT), 1)), 'string_agg', '') AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
