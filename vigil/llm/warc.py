"""WARC archives with revisit records, written and read by Spark.

Writing: payload digests of all pages form narrow headers; headers with the
same digest are pre-aggregated to (count, largest page_id) and only digests
seen twice or more go on. The pages join them by (digest, salt), so that a
digest holding a third of all pages is spread over many tasks; this is the one
exchange of the payloads. Equal payloads of at least ``least`` bytes are stored
once, by the page with the largest page_id; the others become revisit records
with fresh headers that name the response's record id. The files are WARC/1.1
under gzip: Spark's text writer puts the record end (two line ends) after each
record, so that every file system Spark can write works.

Reading: each file is parsed by Content-Length (payloads may contain anything),
response digests are checked, and revisit records are resolved by joining them
to the responses by record id.

Defined cases: null html is an empty payload; a null page_id is written
without the field, never counts as largest and comes back null; equal rows are
records of their own (all rows with the largest page_id are responses); a null
url is empty, control characters in it are percent-encoded; an empty table
writes an empty archive. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import SALTS, prepare, salted_join, work_dir, written

LEAST = 1000
FILE_BYTES = 16 << 20
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: Column, digest: Column) -> Column:
    """<urn:uuid:...> of a page's record, the same on every run."""
    h = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, file_bytes: int = FILE_BYTES,
                   compression: str = "gzip") -> None:
    """Writes ``pages`` (page_id, url, html) as deduplicated archives, each file
    compressed as a whole (``compression="none"``: plain)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("digest"),
                       F.octet_length("html").cast("long").alias("size"))
    headers = written(rows.select("page_id", "digest", "size"), "headers")
    first = (headers.filter(F.col("size") >= least).groupBy("digest")
             .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("stored_by"))
             .filter("n > 1 and stored_by is not null").select("digest", "stored_by"))
    total = headers.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-int(total) // file_bytes))
    # One exchange of the payloads: dealt evenly over files of about
    # file_bytes, rows of a hot digest over the salts.
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("salt", salt).repartition(files, "digest", "salt")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.join(first.hint("merge"), ["digest", "salt"], "left")
    revisit = F.col("stored_by").isNotNull() & ~F.col("stored_by").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("size").cast("string"), F.lit(END + END))
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x20\\x7F]", "%20")
    rows = rows.select("*", revisit.alias("again"), F.when(revisit, http).otherwise(F.concat(http, "html")).alias("block"))
    record = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                                         "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", url),
        _line("WARC-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(F.col("again"), record_id(F.col("stored_by"), F.col("digest")))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}Content-Length: "),
        F.octet_length("block").cast("string"), F.lit(END + END), F.col("block"))
    (rows.select(record.alias("value")).write.option("lineSep", END + END).option("compression", compression).text(path))


RECORD_TYPE = "record_id string, record_type string, page_id long, digest string, size long, refers_id string"
_SIZE = re.compile(rb"\r\nContent-Length: (\d+)", re.IGNORECASE)


def parse_file(data: bytes):
    """(record_id, type, page_id, payload digest, payload bytes, refers id) of each record."""
    at = 0
    view = memoryview(data)
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split(END)[1:]
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        begin = stop + 4
        end = begin + int(head["content-length"])
        body = data.index(b"\r\n\r\n", begin, end) + 4
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        size = int(_SIZE.search(data, begin, body)[1])
        if head["warc-type"] == "response":
            size = end - body
            if hashlib.sha1(view[body:end]).hexdigest() != digest:
                raise ValueError(f"the payload of {head['warc-record-id']} does not fit its digest")
        page = head.get("warc-page-id")
        yield (head["warc-record-id"], head["warc-type"], int(page) if page is not None else None, digest, size,
               head.get("warc-refers-to"))
        at = end + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of every archive under ``path``."""
    prepare(spark)
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in RECORD_TYPE.split(", ")]

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_buffer().to_pybytes()
                rows = list(parse_file(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_TYPE)


def resolve(records: DataFrame) -> DataFrame:
    """Every record with the page and the payload figures of the response that
    a revisit refers to; a revisit without its response has null figures."""
    records = written(records, "records")
    responses = (records.filter("record_type = 'response'").groupBy("record_id")
                 .agg(F.max("page_id").alias("refers_to"), F.max("size").alias("full_size"),
                      F.max("digest").alias("full_digest")))
    revisits = records.filter("record_type = 'revisit'")
    # Only responses that are referred to are repeated for the salts.
    wanted = revisits.select(F.col("refers_id").alias("record_id")).distinct()
    responses = responses.join(wanted, "record_id", "left_semi").withColumnRenamed("record_id", "refers_id")
    joined = salted_join(revisits, responses, "refers_id")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (records.filter("record_type = 'response'")
            .select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                    "record_type", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(joined.select("page_id", F.col("full_size").alias("payload_bytes"),
                                       F.col("full_digest").alias("payload_digest"), "record_type", "refers_to"))
            .select(*out))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archives under the shared folder, reads them back, resolves."""
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    return resolve(read_archives(pages.sparkSession, path))
