"""WARC archives of pages, read back into a globally ordered index of captures.

Writing: payloads are digested first, so that a payload met before is written as a ``revisit`` of its
first capture. Every row becomes one record of a gzip archive; Spark's text writer puts the
record separator after each, and its commit protocol keeps lost tasks from leaving half archives.

Reading: Spark's text reader streams through archives of any size, splitting them at a separator that
starts with the random id of the run, so no payload can contain it; the block of each record is then
cut by its Content-Length in bytes.

Indexing: each task's records form a run sorted by (URL key, time, record). Ranges of the key space
are dealt to tasks, and each merges its parts of all runs with a loser tree.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from scoutline.functions.values import bound
from scoutline.llm.url_filters import url_parts
from scoutline.session import shared_dir, stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
#: Where synthetic capture times start: pages without a time are dated by their id.
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hexadecimal digits are four base32 characters."""

    def quartet(part: Column) -> Column:
        value = F.conv(part, 16, 10).cast("int")
        digits = [F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*digits)

    return bound(F.sha1(payload), lambda h: F.concat(*[quartet(F.substring(h, 1 + 5 * g, 5)) for g in range(8)]))


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, so that a site stays together."""
    host, path = url_parts(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^#?]*(\?[^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(")"), path, query)


def _record_id(run: str, page_id: Column) -> Column:
    return F.concat(F.lit(f"<urn:uuid:{run}:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _separator(run: str) -> str:
    return f"{END}{END}WARC/1.1{END}WARC-Record-ID: <urn:uuid:{run}:"


def write_archives(
    pages: DataFrame, *, captured_at: Column | None = None, revisit_min_bytes: int = 0
) -> tuple[str, str]:
    """Write one record per row of ``pages`` (page_id, url, html) and return (folder, run id).

    Of rows with equal payloads of at least ``revisit_min_bytes`` bytes the one with the smallest
    page_id is a response with the payload, the others are revisits that refer to it; rows that
    repeat that very page_id are responses too. Payloads are UTF-8, NULL is the empty payload, a NULL
    URL leaves the header out, control characters in URLs are percent-encoded, and a NULL page_id
    never is the smallest. The default capture time is 2024-01-01 plus page_id seconds. Other columns
    are not read. The payloads are shuffled once, by digest, to meet the digests that occur more than
    once; adaptive execution splits a frequent digest.
    """
    run = str(uuid.uuid4())
    spark = pages.sparkSession
    seconds = F.coalesce(F.col("page_id").cast("bigint"), F.lit(0).cast("bigint"))
    moment = captured_at if captured_at is not None else F.timestamp_seconds(
        F.lit(int(EPOCH.timestamp())) + F.pmod(seconds, F.lit(2**31))
    )
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id",
        F.regexp_replace(
            F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"
        ).alias("url"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        body.alias("body"),
        sha1_base32(body.cast("binary")).alias("digest"),
        F.octet_length(body).cast("bigint").alias("bytes"),
    )
    copied = (
        rows.filter(F.col("bytes") >= revisit_min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    # Written, as adaptive execution splits a hot digest only where both sides of the join are dealt for it.
    copied = stored(copied, "repeated-digests")
    known = rows.join(copied, "digest", "left").withColumn(
        "revisits",
        F.coalesce(
            (F.col("bytes") >= revisit_min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")),
            F.lit(False),
        )
        & F.col("first_id").isNotNull(),
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END + END),
    )
    block = F.concat(http, F.when(F.col("revisits"), F.lit("")).otherwise(F.col("body")))
    record = bound(
        block,
        lambda b: F.concat(
            F.lit(f"WARC/1.1{END}"),
            _header("WARC-Record-ID", _record_id(run, F.col("page_id"))),
            F.when(F.col("revisits"), F.lit(f"WARC-Type: revisit{END}")).otherwise(F.lit(f"WARC-Type: response{END}")),
            _header("WARC-Target-URI", F.col("url")),
            _header("WARC-Date", F.col("date")),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(
                F.col("revisits"),
                F.concat(
                    _header("WARC-Refers-To", _record_id(run, F.col("first_id"))),
                    _header(
                        "WARC-Profile",
                        F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ),
                ),
            ).otherwise(F.lit("")),
            F.lit(f"Content-Type: application/http; msgtype=response{END}"),
            _header("Content-Length", F.octet_length(b).cast("string")),
            F.lit(END),
            b,
        ),
    )
    folder = shared_dir(spark, "warc")
    known.select(record.alias("value")).write.option("lineSep", END + END).option("compression", "gzip").text(folder)
    return folder, run


def read_archives(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """Records of archives written with this run id: page_id, url, date, record_type, refers_to,
    payload, payload_bytes and payload_digest, the last two from the payload itself or, for a revisit,
    from its headers. A record whose lengths or digest don't fit ends the job.
    """
    rows = spark.read.option("lineSep", _separator(run)).text(folder)
    # The first record of an archive has no separator before it, the last has the line ends after it.
    value = F.col("value")
    opening = f"WARC/1.1{END}WARC-Record-ID: <urn:uuid:{run}:"
    rows = rows.select(
        F.when(F.startswith(value, F.lit(opening)), F.substring(value, F.lit(len(opening) + 1), F.length(value)))
        .otherwise(value)
        .alias("value")
    )
    rows = rows.select("value", F.substring_index("value", END + END, 1).alias("head"))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"(?m)^{name}: ([^\r]*)\r?$", 1), F.lit(""))

    raw = F.col("value").cast("binary")
    length = field("Content-Length").cast("int")
    fields = rows.select(
        F.try_to_number(F.regexp_extract("head", r"^(-?\d+)>", 1), F.lit("S9999999999999999999"))
        .cast("bigint")
        .alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Date").alias("date"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Payload-Digest").alias("said"),
        F.regexp_extract("head", rf"(?m)^WARC-Refers-To: <urn:uuid:{run}:(-?\d+)>\r?$", 1).alias("refers"),
        length.alias("length"),
        F.substring(raw, F.octet_length("head") + 5, length).alias("block"),
    )
    http = F.substring_index(F.col("block").cast("string"), END + END, 1)
    split = fields.withColumn("http", http).withColumn(
        "payload", F.expr("substring(block, octet_length(http) + 5, length)")
    )
    is_revisit = F.col("record_type") == "revisit"
    told = F.regexp_extract("http", r"(?m)^Content-Length: (\d+)\r?$", 1)
    checked = split.withColumns(
        {
            "payload_bytes": F.when(is_revisit, F.try_to_number(told, F.lit("9999999999999999999")).cast("bigint"))
            .otherwise(F.octet_length("payload").cast("bigint")),
            "payload_digest": F.when(is_revisit, F.substring("said", 6, 32)).otherwise(sha1_base32(F.col("payload"))),
        }
    )
    sound = (
        (F.octet_length("block") == F.col("length"))
        & (F.concat(F.lit("sha1:"), F.col("payload_digest")) == F.col("said"))
        & (F.col("payload_bytes").cast("string") == told)
    )
    return checked.select(
        F.when(F.coalesce(sound, F.lit(False)), F.col("page_id"))
        .otherwise(F.raise_error(F.lit("a WARC record does not fit its headers")).cast("bigint"))
        .alias("page_id"),
        "url",
        "date",
        "record_type",
        F.nullif("refers", F.lit("")).cast("bigint").alias("refers_to"),
        "payload",
        "payload_bytes",
        "payload_digest",
    )


class LoserTree:
    """Merge of k sorted runs: inner nodes keep the losers of their matches, so that after each
    output only the path from the winner's leaf to the root is played again."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.size = max(1, len(runs))
        self.losers = [-1] * self.size
        winners = [-1] * self.size + list(range(len(runs))) + [-1] * (self.size - len(runs))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.size > 1 else winners[self.size]

    def _before(self, a: int, b: int) -> bool:
        if a < 0 or self.at[a] >= len(self.runs[a]):
            return False
        if b < 0 or self.at[b] >= len(self.runs[b]):
            return True
        return self.runs[a][self.at[a]] <= self.runs[b][self.at[b]]

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.at[self.winner] < len(self.runs[self.winner]):
            winner = self.winner
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            node = (winner + self.size) // 2
            while node:
                if self._before(self.losers[node], winner):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.winner = winner


MERGED = "url_key string, date string, record bigint, run_no int, place bigint"


def _merge_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge this range's parts of all runs. Parts arrive in any order; each is put together from its
    own places, and the parts of one range are of bounded size."""
    runs: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(batch.url_key, batch.date, batch.record, batch.run_no, batch.place):
            runs.setdefault(row[3], []).append(row)
    for run in runs.values():
        run.sort(key=lambda row: row[4])
    merged, place = [], 0
    columns = ["url_key", "date", "record", "run_no", "place"]
    for row in LoserTree(list(runs.values())):
        merged.append((*row[:4], place))
        place += 1
        if len(merged) == 8192:
            yield pd.DataFrame(merged, columns=columns)
            merged = []
    if merged:
        yield pd.DataFrame(merged, columns=columns)


#: Index rows per key range; a range is merged in memory.
RANGE_ROWS = 50_000


def capture_index(captures: DataFrame) -> DataFrame:
    """Add ``position``, the place of each capture in the order (url_key, date, record), gapless from 0.

    ``captures`` has url_key, date and a unique ``record`` number. Each of its partitions is sorted
    and written as a run; ranges of the whole order (not of URLs only, so a URL with most captures
    is spread) are merged by loser trees. Repeated captures differ by their record number.
    """
    spark = captures.sparkSession
    keys = ["url_key", "date", "record"]
    runs = stored(
        captures.select(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("run_no", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id()),
        "capture-runs",
    )
    ranges = max(spark.sparkContext.defaultParallelism, -(-runs.count() // RANGE_ROWS))
    merged = stored(
        runs.repartitionByRange(ranges, *keys)
        .mapInPandas(_merge_partition, MERGED)
        .withColumn("range_no", F.spark_partition_id())
        .select("record", "range_no", "place"),
        "capture-index",
    )
    sizes = merged.groupBy("range_no").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = sizes.select("range_no", F.coalesce(F.sum("n").over(earlier), zero).alias("before"))
    placed = merged.join(offsets, "range_no").select(
        "record", (F.col("before") + F.col("place")).alias("position")
    )
    return captures.join(placed, "record")


def archive_pages(pages: DataFrame, *, revisit_min_bytes: int = 0) -> DataFrame:
    """Write the pages as WARC records, read the archives back and index the captures.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, date and the
    global ``position`` in the capture index, one row per row of ``pages``. Payloads don't leave the
    task that reads them.
    """
    folder, run = write_archives(pages, revisit_min_bytes=revisit_min_bytes)
    records = read_archives(pages.sparkSession, folder, run)
    captures = stored(
        records.withColumn("url_key", url_key(F.col("url")))
        .drop("payload", "url")
        .withColumn("record", F.monotonically_increasing_id()),
        "captures",
    )
    return capture_index(captures).drop("record")
