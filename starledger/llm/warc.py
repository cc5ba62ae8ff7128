"""Content-addressed WARC archive.

An archive is two Parquet tables in one folder:

* ``records``: one row per captured page with the exact bytes of its WARC
  header block, the payload's SHA-256 and length, and what it refers to;
* ``payloads``: each distinct payload once, under its SHA-256.

The digest is verified whenever an archive is read: the stored bytes are
hashed again and a difference stops the job.  Original records come back
by joining the two tables on the digest.  :func:`export_warc` writes the
records as standard ``.warc`` files and :func:`import_warc` reads such
files by their Content-Length.

Of records with equal payloads of at least ``min_bytes``, the one with
the smallest id is the response and the others are revisits of it.  The
smallest id per digest is a partial aggregate; hot digests meet only as
narrow rows in joins whose skewed partitions AQE splits.  A payload is
shuffled once when stored (by id and digest, so copies spread out) and
once, as one row per digest, when read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import pick_rows, shared_table, text_of

MIN_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(page_id: Column, digest: Column) -> Column:
    """A record id that both the record and its revisits can compute."""
    h = F.sha2(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest).cast("binary"), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4),
                                                     h.substr(17, 4), h.substr(21, 12)), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """One header line; CR and LF in a value are percent-encoded.  Null
    values have no line."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF))).otherwise("")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Write one record per row of ``pages`` under ``path``.

    Null payloads are empty; null urls have no target line.  Null ids sort
    last: such a record revisits one with an id, and is a response where
    no equal payload has one.  Rows that repeat the smallest id of their
    payload are all responses.  Extra columns are ignored; an empty table
    writes an empty archive."""
    payload = text_of(pages, payload_col).cast("binary")
    digest = F.sha2(payload, 256)
    seen = shared_table(pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                                     digest.alias("digest"), F.octet_length(payload).cast("long").alias("bytes")),
                        "warc-seen")
    owner = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id"))
    first = seen.groupBy("digest").agg(owner.alias("first")).select("digest", F.col("first.page_id").alias("first_id"))

    joined = seen.join(first, "digest", "left")
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    refers = F.when(revisit, F.col("first_id"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(CRLF),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("digest"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")), _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _urn(refers, F.col("digest"))),
                                 _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        _line("X-Page-Id", F.col("page_id")), _line("X-Refers-To-Page-Id", refers),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))), F.lit(CRLF))
    joined.select("page_id", "digest", "bytes", header.cast("binary").alias("header")).write.parquet(f"{path}/records")

    same = seen.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("same"))
    keep = (first.join(same, "digest").where(F.col("page_id").eqNullSafe(F.col("first_id")))
            .select("first_id", "digest", "same"))
    narrow = pages.select(pages[id_col].cast("long").alias("page_id"), payload.alias("payload"))
    stored = pick_rows(narrow, "page_id", F.sha2("payload", 256), keep)
    stored.select(F.sha2("payload", 256).alias("digest"), "payload").write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``page_id``, ``header`` (exact bytes),
    ``payload`` (a revisit has the payload of the record it refers to),
    ``payload_digest``, ``payload_bytes``, ``record_type``, ``refers_to``,
    ``target_uri``, ``content_length``; the last five read from the header
    and the payload, not taken over from the writer."""
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    actual = F.sha2("payload", 256)
    # each payload is hashed once, before the join copies it to its records
    checked = payloads.select("digest", "payload", actual.alias("actual"),
                              F.octet_length("payload").cast("long").alias("payload_bytes"))
    both = records.join(checked, "digest", "left")
    text = F.col("header").cast("string")
    field = lambda name: F.nullif(F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))
    said = F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "")
    sound = F.col("actual").isNotNull() & (F.col("actual") == said) & (F.col("payload_bytes") == F.col("bytes"))
    problem = F.raise_error(F.concat(F.lit("archive is damaged at digest "), F.col("digest")))
    return both.select(
        field("X-Page-Id").cast("long").alias("page_id"), "header", "payload",
        F.when(sound, F.col("actual")).otherwise(problem).alias("payload_digest"), "payload_bytes",
        field("WARC-Type").alias("record_type"), field("X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"), field("Content-Length").cast("long").alias("content_length"))


def export_warc(archive: DataFrame, path: str, records_per_file: int = 10_000) -> None:
    """Write the records of :func:`read_archive` as ``.warc`` text parts:
    header block, the response's payload, and the two line ends that close
    a record.  Files are rolled after ``records_per_file`` records."""
    body = F.when(F.col("content_length") > 0, F.col("payload").cast("string")).otherwise("")
    (archive.select(F.concat(F.col("header").cast("string"), body).alias("record"))
     .write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records_per_file).text(path))


def parse_warc(data: bytes):
    """(header block, block) of every record in the bytes of one file."""
    at = 0
    while (end := data.find(b"\r\n\r\n", at)) >= 0:
        head = data[at:end + 4]
        length = next(int(line.split(b":", 1)[1]) for line in head.split(b"\r\n")
                      if line.lower().startswith(b"content-length:"))
        body = data[end + 4:end + 4 + length]
        if len(body) != length or data[end + 4 + length:end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield head, body
        at = end + 8 + length


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, block) of every record of the files under ``path``;
    one task reads one file at a time, bounded by the exporter's roll."""
    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = list(parse_warc(data.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([h for h, _ in found], pa.binary()),
                     pa.array([b for _, b in found], pa.binary())], ["file", "header", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, "file string, header binary, block binary")
