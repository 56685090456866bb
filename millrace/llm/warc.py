"""WARC archives: writing, reading back, and capture histories by an external index merge.

Archives are plain text files of one folder, written and read through Spark's own file access, so they may be in any
store that Spark reaches. A record ends with CR LF CR LF, which is the line separator of the writer; payloads are
UTF-8, so the files hold exactly the bytes of the standard's records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import dropped, give_back, scratch, small_batches, written

END = b"\r\n\r\n"
RECORDS_PER_FILE = 2000
RANGE_ROWS = 50_000  # index lines that one task merges, about
BATCH_BYTES = 4 << 20  # blocks that a reader holds at a time
CAPTURE_SCHEMA = "record_id string, record_type string, url string, captured string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing --------------------------------------------------------------------------------------------------------


FIRST_CAPTURE = "2024-01-01T00:00:00Z"


def with_digests(pages: DataFrame, *, key: str, url: str, html: str, captured: Column | str | None = None) -> DataFrame:
    """page_id, url, html, captured, payload_bytes and payload_digest of every row; null html is an empty payload.

    captured: a column of times as text, FIRST_CAPTURE for all rows without it.
    """

    @F.pandas_udf("payload_bytes long, payload_digest string")
    def measure(texts: pd.Series) -> pd.DataFrame:
        payloads = [(t or "").encode("utf-8", "replace") for t in texts]
        return pd.DataFrame({"payload_bytes": [len(p) for p in payloads], "payload_digest": [digest_of(p) for p in payloads]})

    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), F.coalesce(F.lit(None) if captured is None else F.col(captured) if isinstance(captured, str) else captured, F.lit(FIRST_CAPTURE)).alias("captured"))
    return rows.withColumn("_m", measure("html")).select("page_id", "url", "html", "captured", "_m.payload_bytes", "_m.payload_digest")


def revisits(measured: DataFrame, least_bytes: int = 0) -> DataFrame:
    """record_type and refers_to of every row: of equal payloads of least_bytes or more, the smallest page_id is the response."""
    first = measured.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    again = F.col("_first").isNotNull() & (F.col("_first") != F.col("page_id"))
    return measured.join(first, ["payload_digest", "payload_bytes"], "left").withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("_first"))}).drop("_first")


def write_archives(rows: DataFrame, path: str, *, records_per_file: int = RECORDS_PER_FILE) -> str:
    """Write one record per row of revisits() below path.

    A revisit record has the headers of the profile "identical payload digest" and no payload.
    """

    @F.pandas_udf("string")
    def record(page: pd.Series, url: pd.Series, html: pd.Series, captured: pd.Series, digest: pd.Series, size: pd.Series, kind: pd.Series, refers: pd.Series) -> pd.Series:
        out = []
        for p, u, h, c, d, n, k, r in zip(page, url, html, captured, digest, size, kind, refers):
            body = "" if k == "revisit" else h
            lines = ["WARC/1.1", f"WARC-Type: {k}", f"WARC-Record-ID: <urn:page:{p}>", f"WARC-Target-URI: {clean_header(u)}", f"WARC-Date: {clean_header(c)}", f"WARC-Payload-Digest: sha1:{d}", f"X-Payload-Length: {n}"]
            if k == "revisit":
                lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{r}>"]
            lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body.encode('utf-8', 'replace'))}"]
            out.append("\r\n".join(lines) + "\r\n\r\n" + body)
        return pd.Series(out, dtype=object)

    text = rows.select(record(F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url", "html", "captured", "payload_digest", "payload_bytes", "record_type", F.col("refers_to").cast("string")).alias("value"))
    text.write.option("lineSep", END.decode()).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)
    return path


def clean_header(value: str | None) -> str:
    """A header's value on one line; null is empty."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value or "").strip()


# --- reading --------------------------------------------------------------------------------------------------------


def parse_records(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an uncompressed archive, one at a time. A broken record ends in ValueError."""
    while line := archive.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := archive.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = archive.read(size)
        if len(block) < size or archive.read(len(END)) != END:
            raise ValueError(f"the record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _captures(content: bytes) -> Iterator[tuple]:
    """Rows of CAPTURE_SCHEMA from one archive; the file is unpacked as it is read."""
    archive = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    for h, block in parse_records(io.BufferedReader(archive, 1 << 16)):
        refers = h.get("warc-refers-to")
        yield (h["warc-record-id"].strip("<>"), h["warc-type"], h.get("warc-target-uri", ""), h.get("warc-date"), h.get("warc-payload-digest", "").removeprefix("sha1:"), int(h.get("x-payload-length", len(block))), refers and refers.strip("<>"), block)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below path (gzip or plain), one task per file or more files."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows, held = [c.split()[0] for c in CAPTURE_SCHEMA.split(", ")], [], 0
        for batch in batches:
            for content in batch["content"]:
                for row in _captures(content):
                    rows.append(row)
                    held += len(row[-1])
                    if held > BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)
        give_back()

    return _files(spark, path).mapInPandas(parse, CAPTURE_SCHEMA)


# --- capture histories ----------------------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """A sort-friendly form: host labels reversed, then port, path and query in lower case, no scheme, "www." or fragment."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return (url or "").strip().lower()
    labels = ",".join(reversed(host.split("."))) if host else ""
    return f"{labels}{f':{port}' if port and port not in (80, 443) else ''}){(parts.path or '/').lower()}{'?' + parts.query.lower() if parts.query else ''}"


class LoserTree:
    """Merge sorted iterators of comparable items: each step replays one leaf against the losers above it."""

    def __init__(self, runs: list[Iterator]) -> None:
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, len(self.runs))
        for leaf in range(len(self.runs)):
            self._replay(leaf, building=True)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node > 0:
            if self.losers[node] == -1 and building:
                self.losers[node] = winner
                return
            if self.losers[node] != -1 and self._before(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and self.heads[w := self.losers[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            self._replay(w)


LINE = "url_key string, captured string, record_id string, record_type string, payload_digest string, payload_bytes long, refers_to string"
NAMES = [c.split()[0] for c in LINE.split(", ")]
ORDER = ["url_key", "captured", "record_id"]


def index_lines(spark: SparkSession, path: str) -> DataFrame:
    """LINE of every record of the archives below path. A response that differs from its digest ends the job."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for content in batch["content"]:
                for record, kind, url, captured, digest, size, refers, block in _captures(content):
                    if kind != "revisit" and digest_of(block) != digest:
                        raise ValueError(f"payload of {record} differs from its digest")
                    rows.append((url_key(url), captured or "", record, kind, digest, size, refers))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=NAMES)
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=NAMES)
        give_back()

    return _files(spark, path).mapInPandas(lines, LINE)


def sorted_runs(lines: DataFrame) -> DataFrame:
    """The lines as sorted runs, one per task of the readers: a written table in which `run` says which."""
    return written(lines.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*ORDER), "runs")


def merged_index(runs: DataFrame, *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Merge sorted runs into one order by (url_key, captured, record_id): row i of range r stands before range r+1.

    The runs' row count says how many ranges there are, so a task holds about range_rows lines, however many there are;
    the run is the last part of the ranges' key, so lines that a URL, a moment and an id share many times are dealt out as
    well. A loser tree merges the stretches that a range has of each run. Adds `range` and `position` within it.
    """
    n = max(1, -(-runs.count() // range_rows))
    dealt = runs.select("run", *NAMES).repartitionByRange(n, *ORDER, "run", F.rand(7)).sortWithinPartitions("run", *ORDER)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stretches: dict[int, list[pd.DataFrame]] = {}
        for batch in batches:
            for run, part in batch.groupby("run", sort=False):
                stretches.setdefault(int(run), []).append(part)

        def stretch(run: int) -> Iterator[tuple]:
            i = 0
            for part in stretches[run]:
                for row in part[NAMES].itertuples(index=False, name=None):
                    yield row[:3], i, row
                    i += 1

        out, start = [], 0
        for _, _, row in LoserTree([stretch(run) for run in sorted(stretches)]):
            out.append(row)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=NAMES).assign(position=range(start, start + len(out)))
                start, out = start + len(out), []
        if out:
            yield pd.DataFrame(out, columns=NAMES).assign(position=range(start, start + len(out)))
        give_back()

    return dealt.mapInPandas(merge, LINE + ", position long").withColumn("range", F.spark_partition_id())


def archive_index(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", captured: Column | str | None = None, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the pages as archives, read them back, and return their merged index.

    Each row is one capture. Null html is an empty payload, null URLs sort first, null times are FIRST_CAPTURE, repeated
    rows are captures of their own (equal ids: the first is a response, so are its repeats). An empty table gives an
    empty index. Archives that are not asked for by `path` are deleted once they are indexed.
    """
    spark = pages.sparkSession
    small_batches(spark)
    where = write_archives(revisits(with_digests(pages, key=key, url=url, html=html, captured=captured), least_bytes), path or scratch(spark, "warc"))
    runs = sorted_runs(index_lines(spark, where))
    if path is None:
        dropped(_archive_table(spark, where))
    return merged_index(runs)


def _archive_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
