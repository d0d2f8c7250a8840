"""Content-addressed WARC archive.

An archive is two tables in one folder. `payloads` holds each distinct payload once under its SHA-256 and length;
`records` holds the exact header block of every WARC record, with the payload's address. A record is its header block
followed by its block of content, so joining the two gives the original bytes back. Records whose payload equals that of
an earlier one (smallest id first) are revisits: they carry no payload and name the record that does.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.llm.common import shard_join, shards_for
from creditmill.session import scratch_path, settle

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 100  # equal payloads below this many bytes are each stored as a response
PER_SHARD = 2_000  # records of one payload that a task restores
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "


def decided(pages: DataFrame, revisit_bytes: int, key: str, html: str, url: str) -> DataFrame:
    """Address and record type of every page, settled; the payloads themselves are not shuffled.

    The smallest id of a payload is found per scan partition, then over all, and told back the same way, so a payload that
    a third of all pages share is a few rows in each step.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = settle(pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("_b"))
                  .select("page_id", "url", F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"),
                          F.unhex(F.sha2("_b", 256)).alias("digest"), F.octet_length("_b").cast("bigint").alias("payload_bytes")))
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    address = ["digest", "payload_bytes"]
    by_run = rows.groupBy("run", *address).agg(F.min(place).alias("m"), F.count("*").alias("n"))
    whole = by_run.groupBy(*address).agg(F.min("m").alias("first"), F.sum("n").alias("copies"))
    told = by_run.select("run", *address).join(whole.filter("copies > 1"), address)
    first = F.coalesce(F.col("first.row"), F.col("row")) == F.col("row")
    revisit = ~first & (F.col("payload_bytes") >= revisit_bytes)
    return settle(rows.join(told, ["run", *address], "left").select(
        "page_id", "url", "row", "digest", "payload_bytes", first.alias("stored"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
        F.coalesce("copies", F.lit(1)).alias("copies")))


def _record_id(page_id: Column) -> Column:
    h = F.sha2(F.concat(F.lit("record|"), F.coalesce(page_id.cast("string"), F.lit(""))), 256)
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-8"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def header_block() -> tuple[Column, Column]:
    """WARC headers, and the HTTP headers that open the content block."""
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    revisit = F.col("record_type") == "revisit"
    content = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    # a line end inside a URL would end the header
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    warc = F.concat(F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", F.col("record_type")),
                    _header("WARC-Record-ID", _record_id(F.col("page_id"))), _header("WARC-Date", F.lit(DATE)),
                    _header("WARC-Target-URI", uri),
                    _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
                    F.when(revisit, F.concat(_header("WARC-Profile", F.lit(PROFILE)),
                                             _header("WARC-Refers-To", _record_id(F.col("refers_to"))))).otherwise(F.lit("")),
                    _header("Content-Type", F.lit("application/http; msgtype=response")),
                    _header("Content-Length", content.cast("string")), F.lit(CRLF))
    return warc, http


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, key: str = "page_id", html: str = "html",
                  url: str = "url") -> None:
    """Store a record for every row of `pages`.

    Null html is an empty payload, null URLs are empty. Of equal payloads the smallest id holds the response, null ids
    last; of rows that share that id, the first read. An empty table makes an empty archive; other columns are not read.
    """
    plan = decided(pages, revisit_bytes, key, html, url)
    warc, http = header_block()
    (plan.select("page_id", "row", "record_type", "refers_to", "digest", "payload_bytes", "copies",
                 warc.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header"))
     .write.parquet(f"{path}/records"))
    # The page whose payload is stored is found by digest and id again; rows that repeat both hold the same bytes, and the
    # join has already dealt them out by this address.
    def address(digest: Column, page_id: str) -> Column:
        return F.concat_ws("|", F.hex(digest), F.col(page_id).cast("string")).alias("_address")

    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    bodies = (pages.select(F.col(key).cast("bigint").alias("_id"), body.alias("payload"))
              .select(address(F.unhex(F.sha2("payload", 256)), "_id"), "payload"))
    wanted = plan.filter("stored").select(address(F.col("digest"), "page_id"), "digest", "payload_bytes", "copies")
    (bodies.join(wanted, "_address").dropDuplicates(["_address"]).drop("_address")
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))


def _verified(payload: Column) -> Column:
    """The payload, if it still is what its address says."""
    same = (F.unhex(F.sha2(payload, 256)) == F.col("digest")) & (F.octet_length(payload) == F.col("payload_bytes"))
    return F.when(same, payload).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.hex("digest"))).cast("binary"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record restored: page_id, record (exact WARC bytes), payload (also of revisits), and the parsed headers.

    A stored payload is verified against its address once, before the join. A payload with very many records is copied to
    as many shards as its records need.
    """
    records = spark.read.parquet(f"{path}/records").withColumn("shards", shards_for("copies", PER_SHARD))
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads = (payloads.withColumn("payload", _verified(F.col("payload")))
                .withColumn("shards", shards_for("copies", PER_SHARD)).drop("copies"))
    joined = shard_join(records, payloads, ["digest", "payload_bytes"], F.col("row"), "shards")
    header = F.col("warc_header").cast("string")

    def field(name: str) -> Column:
        return F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)", 1)

    kind = field("WARC-Type")
    block = F.concat("http_header", F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload")))
    return joined.select("page_id", F.concat("warc_header", block, F.lit((CRLF + CRLF).encode())).alias("record"), "payload",
                         kind.alias("record_type"), field("WARC-Target-URI").alias("url"),
                         field("Content-Length").cast("bigint").alias("content_length"),
                         F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("payload_digest"), "refers_to")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write an archive into the shared folder and read its records back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, **options)
    return read_archive(pages.sparkSession, path)
