"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: one record a row, payload in UTF-8. Of rows with equal payloads of at least
``MIN_REVISIT`` bytes, those with the smallest page id are responses; the others are revisits
that name it and hold no payload. Spark's writer ends each line with the record separator, so
any file system and its commit protocol will do.

Reading: Spark's text reader parts the archives at the record magic, in splits of any size.
Pieces carry their length, so their offsets are running sums by file and split. Every piece
is a candidate record: its header says where its successor must start. From each file's start
pointer jumping (doubling self-joins over file and offset) marks the candidates that are
reached; all others are magic inside payloads. A reached record whose end lies beyond its
piece takes in the pieces up to its successor.

Null payloads are empty; null ids and urls are left out of the header and come back as null;
urls with control characters are kept in hex. Rows equal in id and payload are responses
all. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoprank.session import materialise

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
MIN_REVISIT = 100


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, path: str) -> None:
    """Archives of ``pages`` (page_id, url, html) under ``path``."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    copies = (rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
              .agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1 and first is not null").drop("n"))
    # written first, so that Spark knows its size and moves the pages only where it must
    rows = rows.join(materialise(copies, "warc-copies"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    odd = F.col("url").rlike(r"[\x00-\x1F]")
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC), F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        _header("WARC-Target-URI", F.when(~odd, F.col("url"))), _header("X-Target-URI-Hex", F.when(odd, F.hex("url"))),
        _header("X-Page-Id", F.col("page_id")), F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\n"),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        _header("X-Refers-To-Page-Id", F.when(revisit, F.col("first"))),
        _header("X-Payload-Length", F.when(revisit, F.octet_length("payload"))),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", GAP).text(path)


def _field(header: Column, name: str) -> Column:
    """A header field, or null; the header holds no payload."""
    found = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(F.contains(F.concat(F.lit("\r\n"), header), F.lit(f"\r\n{name}: ")), found)


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, row, bytes, value): the archives parted at the magic, in file order."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.monotonically_increasing_id().alias("row"), F.octet_length("value").cast("long").alias("bytes"), "value")


def candidates(pieces: DataFrame) -> DataFrame:
    """Narrow rows of all pieces: offset (of the magic before the piece), successor (null where
    the header is not one), header, and digest of the payload where the record ends with the piece."""
    # headers are searched in the part before the first empty line alone
    header = F.substring_index("value", "\r\n\r\n", 1)
    size = F.try_to_number(F.regexp_extract(_field(header, "Content-Length"), r"^(\d{1,18})$", 1), F.lit("9" * 18)).cast("long")
    whole = F.octet_length("value") > F.octet_length(header)
    narrow = pieces.withColumn("header", header).withColumn("size", F.when(whole, size))
    body = F.octet_length("header") + 4
    narrow = narrow.withColumn("fits", F.coalesce(F.col("bytes") == body + F.col("size") + 4, F.lit(False)))
    payload = F.substring(F.encode("value", "UTF-8"), body + 1, F.col("size").cast("int"))
    narrow = narrow.select(
        "file", "split", "row", "bytes", F.when(F.col("size").isNotNull(), F.col("header")).alias("header"), "size",
        F.octet_length("header").alias("header_bytes"), F.when(F.col("fits"), F.sha2(payload, 256)).alias("digest"))
    narrow = materialise(narrow, "warc-pieces")
    out = narrow.join(_offsets(narrow), ["file", "split", "row"])
    successor = F.col("offset") + len(MAGIC) + F.col("header_bytes") + 4 + F.col("size") + 4
    return materialise(out.withColumn("successor", F.when(F.col("size").isNotNull(), successor)), "warc-candidates")


def _offsets(pieces: DataFrame) -> DataFrame:
    """(file, split, row, offset) of the magic before each piece: running sums inside a split,
    on top of the sums of the splits before it."""
    long = F.col("bytes") + len(MAGIC)
    splits = pieces.groupBy("file", "split").agg(F.sum(long).alias("long"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", F.coalesce(F.sum("long").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    places = pieces.select("file", "split", "row", F.coalesce(F.sum(long).over(inside), F.lit(0)).alias("within"))
    return places.join(starts, ["file", "split"]).select(
        "file", "split", "row", (F.col("start") + F.col("within") - len(MAGIC)).alias("offset"))


def reachable(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 reaches. In round k the
    reached ones jump 2**k records ahead, then the jumps are joined with themselves."""
    jumps = found.where("offset >= 0 and successor is not null").select("file", "offset", "successor")
    ends = found.select("file", F.col("offset").alias("successor"))
    jumps = materialise(jumps.join(ends, ["file", "successor"], "left_semi").select("file", "offset", "successor"), "warc-jumps")
    reached = found.where("offset = 0").select("file", "offset")
    while True:
        ahead = reached.join(jumps, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        reached = materialise(reached.unionByName(ahead), "warc-reached")
        if jumps.limit(1).count() == 0:
            return reached.distinct()
        further = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("far"))
        jumps = materialise(jumps.join(further, ["file", "successor"]).select("file", "offset", F.col("far").alias("successor")), "warc-jumps")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest) of every record of
    the archives under ``path``; a revisit's payload is described by its header."""
    found = candidates(pieces_of(spark, path))
    records = found.join(reachable(found), ["file", "offset"], "left_semi")
    simple = _records(records.where("digest is not null"), F.col("digest"))
    wide = materialise(records.where("digest is null and size is not null"), "warc-wide")
    if wide.limit(1).count() == 0:
        return simple
    # Records with magic in their payload: all pieces up to the successor, put together again.
    raw = materialise(pieces_of(spark, path).join(wide.select("file").distinct(), "file", "left_semi"), "warc-raw")
    order = Window.partitionBy("file").orderBy("offset")
    heads = wide.select("file", "offset", F.struct(F.col("offset").alias("at"), F.col("successor").alias("until")).alias("own"))
    owned = (_offsets(raw).join(heads, ["file", "offset"], "left").withColumn("own", F.last("own", True).over(order))
             .where("offset < own.until").select("file", "split", "row", "offset", F.col("own.at").alias("at")))
    whole = (owned.join(raw, ["file", "split", "row"]).groupBy("file", "at")
             .agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts"))
             .select("file", F.col("at").alias("offset"), F.encode(F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC), "UTF-8").alias("bytes_")))
    payload = F.substring("bytes_", F.col("header_bytes") + 5, F.col("size").cast("int"))
    return simple.unionByName(_records(wide.join(whole, ["file", "offset"]), F.sha2(payload, 256)))


def _records(frame: DataFrame, digest: Column) -> DataFrame:
    header = F.col("header")
    revisit = _field(header, "WARC-Type") == "revisit"
    return frame.select(
        _field(header, "X-Page-Id").cast("long").alias("page_id"),
        F.coalesce(_field(header, "WARC-Target-URI"), F.decode(F.unhex(_field(header, "X-Target-URI-Hex")), "UTF-8")).alias("url"),
        F.when(revisit, _field(header, "X-Payload-Length").cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(_field(header, "WARC-Payload-Digest"), "^sha256:", "")).otherwise(digest).alias("payload_digest"),
        _field(header, "WARC-Type").alias("record_type"), _field(header, "X-Refers-To-Page-Id").cast("long").alias("refers_to"))
