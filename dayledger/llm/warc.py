"""WARC archives with Spark's text writer and reader, and verification of record boundaries by pointer jumping.

Writing: one record a row. A payload equal to another page's is written as a revisit of the page with the largest id
that has it. Which pages those are is settled on ids and digests; payloads are not sorted.

Reading: archives are read in byte ranges, cut at every occurrence of the magic. What follows a magic is a candidate
record if it has a header with a length. The lengths of all pieces, added up within a range and over the ranges of a
file, give each candidate's offset; its header gives the offset of its successor. A magic inside a payload is a
candidate too, even one with a perfect header, so the truth is the chain from the start of the file: in each round every
candidate doubles its jump and the reachable ones mark where their jump leads, until no jump is left. A record whose
payload holds a magic is put together again from its pieces; all others are whole in theirs.

Defined cases: a NULL payload is the empty one, and empty payloads are equal to each other; rows with the same id and
payload are all response if that id is the largest; a NULL id is always response and comes back as NULL; CR and LF in a URL are written
as %0D and %0A; without pages there are no records. Bytes after a broken boundary of a file are not reachable and
yield no record.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_cut

MAGIC = "WARC/1.0\r\n"
_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# Fixed value: the profile of a revisit whose payload is that of the record it refers to.
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

Derived = dict[str, Callable[[Column], Column]]


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight groups of five hex digits, of four letters each."""
    digest, letters = F.sha1(payload), []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
    written: datetime | None = None,
) -> None:
    """Write one record a row to `path`; equal payloads of at least `least_bytes` bytes become revisits.

    `written` is the date of the records, by default now."""
    stamp = (written or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(id).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", base32_sha1(F.col("body").cast("binary")))
    keys = rows.where((F.octet_length("body") >= least_bytes) & F.col("id").isNotNull()).select("id", "digest")
    last = keys.groupBy("digest").agg(F.max("id").alias("target"), F.count("*").alias("n")).where("n > 1")
    again = cut_lineage(keys.join(last, "digest").where("id < target").select("id", "digest", "target").distinct(), "revisits")
    rows = rows.join(again, ["id", "digest"], "left")
    revisit = F.col("target").isNotNull()
    block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), "body"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    safe_url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("id")),
        line("WARC-Date", F.lit(stamp)),
        line("WARC-Target-URI", safe_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("target")), line("WARC-Profile", F.lit(_SAME_PAYLOAD)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", _END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, at, value): what follows each magic, in order within a byte range of a file.

    `range` and `at` depend on how a scan happens to be cut; they order the pieces of one scan and name none in another.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def _field(header: str, name: str) -> Column:
    found = F.regexp_extract(F.col(header), rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _payload(value: Column, skip: Column, length: Column, http: Column) -> Column:
    """The payload in a record's bytes after the magic; `skip`: its header, `length`: its block."""
    own = F.octet_length(F.substring_index(value, _END, 2)) + 4
    start = F.when(http, own).otherwise(skip)
    return F.substring(value.cast("binary"), (start + 1).cast("int"), F.greatest(F.lit(0), skip + length - start).cast("int"))


def _before(rows: DataFrame, value: Column, name: str, how: Callable[[Column], Column], join: Callable) -> DataFrame:
    """`how` over all earlier rows of the file: first within each range, then over the ranges of the file."""
    own = Window.partitionBy("file", "range").orderBy("at")
    per_range = rows.groupBy("file", "range").agg(how(value).alias("_all") if name == "offset" else F.max(value).alias("_all"))
    earlier = per_range.select(
        "file", "range", how(F.col("_all")).over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry")
    )
    local = rows.withColumn("_local", how(value).over(own.rowsBetween(Window.unboundedPreceding, 0 if name != "offset" else -1)))
    return local.join(earlier, ["file", "range"]).withColumn(name, join(F.col("_local"), F.col("_carry"))).drop("_local", "_carry")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates (file, offset, next) that the chain from offset 0 of their file reaches."""
    # offsets compress so well that file sizes do not bound what a broadcast would hold: these joins merge
    known = candidates.select("file", F.col("offset").alias("next"), F.lit(True).alias("exists")).hint("merge")
    chain = candidates.join(known, ["file", "next"], "left").select(
        "file", "offset", F.when(F.col("exists"), F.col("next")).alias("jump"), (F.col("offset") == 0).alias("reached")
    )
    chain = cut_lineage(chain, "chain")
    while not chain.where("jump is not null").isEmpty():
        marks = chain.where("reached and jump is not null").select("file", F.col("jump").alias("offset"), F.lit(True).alias("marked")).distinct()
        ahead = chain.select("file", F.col("offset").alias("jump"), F.col("jump").alias("far"))
        doubled = cut_lineage(
            chain.join(ahead.hint("merge"), ["file", "jump"], "left").join(marks.hint("merge"), ["file", "offset"], "left").select(
                "file", "offset", F.col("far").alias("jump"), (F.col("reached") | F.coalesce("marked", F.lit(False))).alias("reached")
            ),
            "chain",
        )
        remove_cut(chain)
        chain = doubled
    return chain.where("reached").select("file", "offset")


def read_archives(spark: SparkSession, path: str, derive: Derived | None = None) -> DataFrame:
    """Records of the archives in `path`: record_id, record_type, uri, digest, refers_to (as written), and columns
    derived from each payload (binary), by default the payload itself.

    Derived columns are computed where a record's bytes are read, so that payloads that nobody keeps are not moved.
    """
    derive = derive or {"payload": lambda payload: payload}
    pieces = _pieces(spark, path)
    headed = pieces.withColumn("header", F.when(F.instr("value", _END) > 0, F.substring_index("value", _END, 1)))
    told = headed.withColumns(
        {
            "bytes": F.octet_length("value").cast("bigint"),
            "skip": (F.octet_length("header") + 4).cast("bigint"),
            "length": _field("header", "Content-Length").try_cast("bigint"),
            "http": F.coalesce(_field("header", "Content-Type").startswith("application/http"), F.lit(False)),
        }
    ).withColumn("whole", F.coalesce(F.col("bytes") >= F.col("skip") + F.col("length"), F.lit(False)))
    names = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "uri": "WARC-Target-URI", "digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
    own = _payload(F.col("value"), F.col("skip"), F.col("length"), F.col("http"))
    light = told.select(
        "file", "range", "at", "bytes", "skip", "length", "http", "whole", F.sha2(F.col("value").cast("binary"), 256).alias("content"),
        *[_field("header", n).alias(c) for c, n in names.items()],
        *[F.when(F.col("whole"), f(own)).alias(c) for c, f in derive.items()],
    )
    light = cut_lineage(light, "pieces")
    # a piece is followed by the next magic; the first piece of a file lies before its first magic
    step = len(MAGIC)
    placed = _before(light, F.col("bytes") + step, "offset", F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) - step)
    placed = cut_lineage(placed, "placed")
    remove_cut(light)
    candidates = placed.where("offset >= 0 and length is not null")
    after = F.col("offset") + step + F.col("skip") + F.col("length") + 4
    true = reachable(candidates.select("file", "offset", after.alias("next")))
    records = candidates.join(true.hint("merge"), ["file", "offset"])
    columns = [*names, *derive]
    found = records.where("whole").select(*columns)
    broken = records.where("not whole").select("file", "offset", "skip", "length", "http", *names, after.alias("next"))
    broken = cut_lineage(broken, "spanning")
    if broken.isEmpty():
        return found
    # the pieces of the records that hold a magic: those between their own offset and their successor's
    marked = placed.join(broken.select("file", "offset", F.lit(True).alias("opens")), ["file", "offset"], "left").join(
        true.select("file", "offset", F.lit(True).alias("starts")).hint("merge"), ["file", "offset"], "left"
    )
    owner = F.when(F.col("starts"), F.col("offset"))
    owned = _before(marked, owner, "owner", lambda c: F.last(c, ignorenulls=True), F.coalesce)
    wanted = owned.join(broken.select("file", F.col("offset").alias("owner")), ["file", "owner"], "left_semi").select("file", "offset", "owner", "content")
    # the second scan may be cut in other ways than the first, so a piece is found again by what it holds
    wanted = cut_lineage(wanted, "wanted")
    values = pieces.select(F.sha2(F.col("value").cast("binary"), 256).alias("content"), "value")
    values = values.join(wanted.select("content").distinct().hint("merge"), "content", "left_semi").dropDuplicates(["content"])
    parts = wanted.join(values, "content")
    # the bytes of one record
    joined = parts.groupBy("file", F.col("owner").alias("offset")).agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    restored = broken.join(joined, ["file", "offset"]).withColumn("value", whole).where("octet_length(value) >= skip + length")
    own = _payload(F.col("value"), F.col("skip"), F.col("length"), F.col("http"))
    return found.unionByName(restored.select(*names, *[f(own).alias(c) for c, f in derive.items()]))


def id_of(urn: str) -> Column:
    """The page id in a record id; NULL for none."""
    return F.regexp_extract(F.col(urn), r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
